"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, on the driver, with the library.
A pre-token that is one of them counts as one without any merging; only the rest is merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, slices, text_of, worker_cache
from verdigris.llm.tokens import BYTE_PATTERN, REMEMBERED, PieceEncoder, byte_letters, encoder_for, forget_half, read_vocabulary


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and encode alone as one token: checked, not assumed."""
    encoder = PieceEncoder(vocabulary)
    letters = byte_letters()
    strings = []
    for token in encoder.library.get_vocab(with_added_tokens=False):
        try:
            text = bytes(letters[letter] for letter in token).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue  # a part of a character, or a special string
        if BYTE_PATTERN.findall(text) == [text] and text not in encoder.specials:
            strings.append(text)
    encoded = encoder.library.encode_batch_fast(strings, add_special_tokens=False)
    return frozenset(text for text, found in zip(strings, encoded) if len(found.ids) == 1)


class PieceCounter:
    """Counts tokens; the shortcut first, merges for what is left, each distinct pre-token merged once."""

    def __init__(self, vocabulary: str, whole: frozenset[str]):
        self.encoder = encoder_for(vocabulary)
        self.whole = whole
        self.known: dict[str, int] = {}

    def _learn(self, pieces: set[str]) -> None:
        cut = {piece: BYTE_PATTERN.findall(piece) for piece in pieces}
        rest = list(set().union(*cut.values()) - self.whole)
        merged = dict(zip(rest, (len(ids) // 4 for ids in self.encoder.whole(rest))))
        for piece, parts in cut.items():
            self.known[piece] = sum(1 if part in self.whole else merged[part] for part in parts)

    def count(self, texts: list[str]) -> list[int]:
        library = self.encoder.library
        special = [any(mark in text for mark in self.encoder.specials) for text in texts]
        cut = [[] if odd else self.encoder.pieces.findall(text) for text, odd in zip(texts, special)]
        seen = set().union(*cut)
        if seen - self.known.keys():
            forget_half(self.known, REMEMBERED)
            self._learn(seen - self.known.keys())
        get = self.known.__getitem__
        return [
            len(library.encode(text, add_special_tokens=False).ids) if odd else sum(map(get, pieces))
            for text, odd, pieces in zip(texts, special, cut)
        ]


def count_tokens(
    docs: DataFrame, vocabulary_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row, for a byte-level vocabulary.

    Null text counts as empty and has no tokens. Ids may be null or repeated; they are only passed
    on. Texts of any length are counted whole. No shuffle: the work stays with the scan.
    """
    spark = docs.sparkSession
    vocabulary = read_vocabulary(vocabulary_path)
    # Broadcast: the vocabulary and a subset of its strings, whatever the size of the table.
    shared = spark.sparkContext.broadcast((vocabulary, whole_tokens(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("tokens")
        key = ("counter", hash(shared.value[0]))
        if key not in cache:
            cache[key] = PieceCounter(*shared.value)
        counter = cache[key]
        for batch in slices(batches, SLICE):
            counts = counter.count(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col)
    )
    kind = docs.schema[id_col].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
