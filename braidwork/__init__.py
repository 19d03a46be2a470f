"""Spark jobs for preparing token corpora, summarising training runs,
cataloguing and comparing weight bundles, and scoring next tokens."""

from braidwork.configs import (
    InferenceConfig,
    ModelConfig,
    TokenizerConfig,
    TrainingConfig,
)

__all__ = ["InferenceConfig", "ModelConfig", "TokenizerConfig", "TrainingConfig"]
