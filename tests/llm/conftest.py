import sys

import pytest
from pyspark import cloudpickle

import __spark_entry__  # noqa: F401  registers the code that travels with a job

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHING = SCHEMA + ", kept boolean, id long, key long, row string, size int, print string, n_bytes long, spans string, rate double"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows; ``clashing`` adds columns with awkward names."""

    def make(rows, clashing=False):
        whole = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
        if clashing:
            whole = [(*row, None, 7, 7, "r", 1, "p", 3, "x", 0.5) for row in whole]
        return spark.createDataFrame(whole, CLASHING if clashing else SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty, blank and very long texts, equal and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two  three"), (5, "one two three"), (5, "one two three"), (None, "one two three"),
        (None, None), (6, long), (7, long + " end"), (8, "Ünï 😀 '<|endoftext|>' x"), (9, "a@b.co 4111 1111 1111 1111 +1 (017) 555-7713 10.0.0.1"),
    ]
