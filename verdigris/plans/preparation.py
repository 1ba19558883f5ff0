"""Raw corpus to train and test records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from verdigris.operators.corpus import VERBATIM, ConversationStyle, to_conversations
from verdigris.operators.sampling import sample_exact, split_train_test

# Sizes of the default corpus.
TRAIN_SAMPLES = 20_000
TEST_SAMPLES = 2_500


def prepare_corpus(
    corpus: DataFrame,
    total_samples: int = TRAIN_SAMPLES + TEST_SAMPLES,
    test_samples: int = TEST_SAMPLES,
    seed: int = 42,
    style: ConversationStyle = VERBATIM,
    strict: bool = False,
) -> DataFrame:
    """(row_id, messages, split). Rows are chosen before any text is rendered."""
    sample = sample_exact(corpus, total_samples, seed, strict=strict)
    return to_conversations(split_train_test(sample, test_samples, seed), style, ("row_id", "split"))
