"""Unbounded inputs."""
