"""Quality rules: counted base rules, then a calibrated logistic regression on hashed n-grams.

The model reads hashed word n-grams (one and two words) and character n-grams (three characters). It
is fitted on a bounded sample of labelled rows, calibrated on rows held out of it, and scores whole
texts in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SLICE, WORD, release_worker_cache, slices, text_of

# The base rules' marks and limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_BLANKS = " \t\n\x0b\x0c\r"
_WORDS = re.compile(WORD)
# Labelled rows that the model is fitted on at most, half of each class; they come to the driver as features.
SAMPLE_ROWS = 3_000
# Share of them that only calibrates.
HELD_OUT = 4  # one in so many
# Hashed features: so many for words and as many for characters.
BUCKETS = 1 << 12
# Numbers of the sample that are multiplied together: they fit into a processor's cache.
PART = 1 << 16
# A text is kept when it is good with this probability at least.
KEEP_FROM = 0.5
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _numbered(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """The words as numbers, and the distinct words in that order."""
    seen: dict[str, int] = {}
    numbers = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, len(words))
    return numbers, list(seen)


def repeated_words(numbers: np.ndarray, distinct: int) -> int:
    """Words that stand in a window of three which the text has twice or more."""
    if len(numbers) < 4:
        return 0
    _, pairs = np.unique(numbers[:-1] * distinct + numbers[1:], return_inverse=True)
    _, windows, counts = np.unique(
        pairs[:-1].astype(np.int64) * distinct + numbers[2:], return_inverse=True, return_counts=True
    )
    again = counts[windows] > 1
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[str], numbers: np.ndarray, distinct: int) -> tuple[int, ...]:
    """The columns of ``BASE_COLUMNS``."""
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return (
        len(words), sum(map(len, words)), sum(text.count(mark) for mark in SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(numbers, distinct),
    )


def features(text: str, numbers: np.ndarray, distinct: list[str]) -> np.ndarray:
    """Hashed n-gram counts, square-rooted and scaled to length one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    found = np.zeros(2 * BUCKETS, np.float32)
    if len(numbers):
        hashes = np.fromiter((zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in distinct), np.uint32, len(distinct))
        single = hashes[numbers]
        double = single[:-1] * np.uint32(0x9E3779B1) + single[1:]
        mixed = np.concatenate([single, double]) * np.uint32(0x85EBCA6B)
        found[:BUCKETS] = np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)
    if len(codes) > 2:
        mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        found[BUCKETS:] = np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)
    for part in (found[:BUCKETS], found[BUCKETS:]):
        np.sqrt(part, out=part)
        length = np.sqrt(part @ part)
        if length:
            part /= length
    return found


@dataclass
class QualityModel:
    """Weights, and the line that turns a score into the log-odds of being good."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, row: np.ndarray) -> float:
        score = float(row @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -50, 50))))


class _Lines:
    """Lines of a matrix by their non-zero numbers, for products with a vector; the matrix is never dense.

    Held in parts of about ``PART`` numbers, so that what a product makes on the way stays small.
    """

    def __init__(self, lengths: np.ndarray, places: np.ndarray, values: np.ndarray):
        self.lines, self.parts = len(lengths), []
        filled = np.flatnonzero(lengths)
        starts = np.cumsum(lengths[filled]) - lengths[filled]
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(places), PART)))
        cuts = cuts[cuts < len(filled)]
        for first, end in zip(cuts, [*cuts[1:], len(filled)]):
            its = slice(starts[first], starts[end] if end < len(filled) else len(places))
            # Copies: a view would keep the whole collected table.
            self.parts.append((filled[first:end], starts[first:end] - its.start, places[its].copy(), values[its].copy()))

    def times(self, vector: np.ndarray) -> np.ndarray:
        found = np.zeros(self.lines, np.float32)
        for lines, starts, places, values in self.parts:
            found[lines] = np.add.reduceat(vector.take(places, mode="clip") * values, starts)
        return found


def _by_row_and_column(table: pa.Table) -> tuple[_Lines, _Lines]:
    """The rows' features, and turned over: for each feature the rows that have it."""
    places, values = (table.column(name).combine_chunks() for name in ("places", "values"))
    lengths = np.diff(places.offsets.to_numpy())
    places, values = places.flatten().to_numpy(), values.flatten().to_numpy()
    order = np.argsort(places, kind="stable")
    row = np.repeat(np.arange(table.num_rows, dtype=np.int32), lengths)
    columns = _Lines(np.bincount(places, minlength=2 * BUCKETS), row[order], values[order])
    return _Lines(lengths, places, values), columns


def _descend(rows: _Lines, columns: _Lines, good: np.ndarray, weight: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a small ridge, by accelerated gradient steps."""
    at = np.zeros(columns.lines, np.float32)
    bias = speed_bias = 0.0
    speed = np.zeros_like(at)
    weight = (weight / weight.sum()).astype(np.float32)
    rate, ridge = 4.0, 1e-5
    for _ in range(steps):
        ahead, ahead_bias = at + 0.9 * speed, bias + 0.9 * speed_bias
        off = weight * (1 / (1 + np.exp(-np.clip(rows.times(ahead) + ahead_bias, -50, 50))) - good)
        speed = 0.9 * speed - rate * (columns.times(off) + ridge * ahead)
        speed_bias = 0.9 * speed_bias - rate * float(off.sum())
        at, bias = at + speed, bias + speed_bias
    return at, bias


def _calibrate(scores: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the log-odds by Newton steps; the targets are smoothed as usual for small samples."""
    positive, negative = (good > 0.5).sum(), (good <= 0.5).sum()
    target = np.where(good > 0.5, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.stack([scores, np.ones_like(scores)], 1).astype(np.float64)
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -50, 50)))
        gradient = design.T @ (weight * (p - target)) + 1e-6 * line
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        line = line - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return (float(line[0]), float(line[1])) if line[0] > 0 else (1.0, 0.0)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, SLICE):
        places, values = [], []
        for text in batch.column(2).to_pylist():
            numbers, distinct = _numbered(_WORDS.findall(text))
            row = features(text, numbers, distinct)
            places.append(np.flatnonzero(row).astype(np.int16))
            values.append(row[places[-1]])
        columns = [batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, ["tag", "good", "places", "values"])


def train_quality_model(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> QualityModel | None:
    """The model fitted on at most ``sample_rows`` labelled rows; None when a class has no row.

    ``labels`` has (doc_id, quality 0 or 1); other values and null are left out. The sample is the
    rows with the smallest hash of the id, half of each class, so it does not change with the
    partitions. Classes are weighted back to their share among all labels.
    """
    known = labels.filter("quality IN (0, 1)").select(
        F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good")
    ).filter("id IS NOT NULL")
    totals = {row.good: row["count"] for row in known.groupBy("good").count().collect()}
    if len(totals) < 2:
        return None
    ids = known.dropDuplicates(["id"]).withColumn("tag", F.xxhash64("id", F.lit("quality")))
    half = sample_rows // 2
    chosen = ids.filter("good").orderBy("tag", "id").limit(half).unionByName(
        ids.filter("NOT good").orderBy("tag", "id").limit(half)
    )
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # Broadcast: ``sample_rows`` ids at most.
    rows = texts.join(F.broadcast(chosen), "id").select("tag", "good", "text")
    found = rows.mapInArrow(_feature_rows, "tag long, good boolean, places array<short>, values array<float>")
    table = found.dropDuplicates(["tag"]).toArrow().sort_by("tag")
    good = table.column("good").to_numpy().astype(np.float32)
    if not 0 < good.sum() < len(good):
        return None
    weight = np.where(good > 0.5, totals[True] / good.sum(), totals[False] / (1 - good).sum()).astype(np.float64)
    held = np.arange(len(good)) % HELD_OUT == 0
    if len(set(good[held])) < 2 or len(set(good[~held])) < 2:
        held[:] = False
    fitted, calibrated = table.filter(pa.array(~held)), table.filter(pa.array(held))
    del table
    (rows, columns), (rest, _) = _by_row_and_column(fitted), _by_row_and_column(calibrated)
    del fitted, calibrated
    weights, bias = _descend(rows, columns, good[~held], np.where(good > 0.5, 1 / good.sum(), 1 / (1 - good).sum())[~held])
    slope, shift = (1.0, 0.0)
    if held.any():
        slope, shift = _calibrate(rest.times(weights) + bias, good[held], weight[held])
    return QualityModel(weights, bias, slope, shift)


def score_quality(
    docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False
) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept, p_good) per row; with ``keep_row`` the row as well.

    A null or empty text has no words and fails. Without a model the base rules alone decide and
    ``p_good`` is null. Ids may be null or repeated. No shuffle.
    """
    # As plain values, so that a worker needs no copy of this module to read them. Size: the weights.
    shared = docs.sparkSession.sparkContext.broadcast(model and astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_cache()
        judge = shared.value and QualityModel(*shared.value)
        for batch in slices(batches, SLICE):
            counts, failed, chances = [], [], []
            for text in batch.column(1).to_pylist():
                words = _WORDS.findall(text)
                numbers, distinct = _numbered(words)
                row = base_counts(text, words, numbers, len(distinct))
                counts.append(row)
                failed.append(row[0] < MIN_WORDS or 100 * row[4] > MAX_REPEAT_PERCENT * row[0])
                chances.append(None if judge is None else judge.probability(features(text, numbers, distinct)))
            kept = [not bad and (chance is None or chance >= KEEP_FROM) for bad, chance in zip(failed, chances)]
            columns = [batch.column(0), *[pa.array(list(column), pa.int64()) for column in zip(*counts)]]
            columns += [pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(chances, pa.float64())]
            names = ["id", *BASE_COLUMNS, "base_failed", "kept", "p_good"]
            if keep_row:
                columns, names = [*columns, batch.column(2)], [*names, "whole_row"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col))
    counts = ", ".join(f"{name} long" for name in BASE_COLUMNS)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, {counts}, base_failed boolean, kept boolean, p_good double"
    if keep_row:
        whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("whole_row")
        rows = docs.select(F.col(id_col).alias("id"), text_of(text_col), whole)
        schema += f", whole_row {docs.schema.simpleString()}"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def drop_low_quality(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    return score_quality(docs, model, id_col, text_col, keep_row=True).filter("kept").select("whole_row.*")
