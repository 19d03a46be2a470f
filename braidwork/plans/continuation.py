"""Prompt text in, continued text out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from braidwork.configs import InferenceConfig, TokenizerConfig
from braidwork.operators.generation import generate
from braidwork.operators.tokenizers import detokenize, end_token_id, tokenize


def continue_prompts(
    prompts: DataFrame,
    logits: DataFrame,
    tokenizer: TokenizerConfig,
    inference: InferenceConfig,
    *,
    vocab: DataFrame | None = None,
    greedy: bool = False,
) -> DataFrame:
    """``prompt_id, text`` for a table ``prompt_id, text``: each prompt with its continuation.

    ``logits`` must come from sequences of the same tokenizer (and, for the
    word tokenizer, of the same ``vocab`` table).
    """
    if tokenizer.name == "word" and vocab is None:
        raise ValueError("the word tokenizer needs the vocabulary that the logits were counted with")
    encoded = tokenize(prompts, tokenizer, id_col="prompt_id", text_col="text", vocab=vocab)
    done = generate(
        encoded, logits, inference, end_token=end_token_id(tokenizer, vocab), greedy=greedy
    )
    return detokenize(done, tokenizer, id_col="prompt_id", vocab=vocab)
