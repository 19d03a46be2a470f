"""Readers and writers of delimited text and of weight bundles."""
