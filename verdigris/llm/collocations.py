"""Phrase collocations from one FM-index of word ids per shard.

1. *Index.* A task deals its texts to shards. A shard's words of one language become ids, a border
   stands between pieces, and the positions are sorted by the words that follow: a stable pass over
   the preceding words sorts by one word more. What is kept is the transform, the word in front of
   each position in that order, and the shard's words. It is written to shared storage.
2. *Extension.* A phrase is an interval of the order. The transform inside it holds the words that
   stand in front; each gives the interval of the phrase that is longer by that word, by counting.
   All intervals of a length are extended at once.
3. *Sums.* Shards sum up by language and phrase. No phrase is more frequent than its parts, so a shard
   extends an interval only if it is frequent in all shards together, and keeps the result only if it is
   frequent without its last word as well. Which are frequent goes to the shards as a bitmap of hashes of
   bounded size. A false hit costs a row; sums alone decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import slices, text_of
from verdigris.sources.storage import stored

# Words of a shard, about: what one index holds in memory.
SHARD_WORDS = 500_000
# Bits of a filter: 16 for each frequent phrase, this many at most (32 MB).
MOST_BITS = 1 << 28
NO_LANGUAGE = "und"
# Where pieces end, and a multiplier that mixes bits.
_ENDS = "[.,;:!?\\x0A-\\x0D]"
_BORDER = "\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(texts: pa.Array) -> pa.Array:
    """The words of all texts, with a border behind each piece."""
    spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _ENDS, f" {_BORDER} ")
    spaced = pc.binary_join_element_wise(pc.replace_substring(spaced, "\t", " "), _BORDER, " ")
    words = pc.split_pattern(spaced, " ").flatten()
    return words.filter(pc.not_equal(words, ""))


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The id in front of each position, positions sorted by ``depth`` ids from there on, in a circle."""
    size = len(ids)
    order = np.arange(size, dtype=np.int64)
    for _ in range(depth):
        before = (order - 1) % size
        order = before[np.sort(ids[before].astype(np.int64) << 32 | np.arange(size)) & 0xFFFFFFFF]
    return ids[(order - 1) % size]


def _index_rows(language: str, parts: list[pa.Array], depth: int) -> tuple | None:
    coded = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    words = coded.dictionary
    order = pc.sort_indices(words).to_numpy()
    words = words.take(pa.array(order))
    border = pc.index(words, _BORDER).as_py()
    # Border is 0, the words follow in order.
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order)) + (np.arange(len(order)) < border)
    number[order[border]] = 0
    ids = number[coded.indices.to_numpy()]
    kept = pa.concat_arrays([words.slice(0, border), words.slice(border + 1)])
    front = transform(ids, depth)
    width = np.uint16 if len(kept) < 1 << 16 else np.uint32
    return language, int(np.count_nonzero(ids)), kept.to_pylist(), front.astype(width).tobytes()


def build_index(docs: DataFrame, depth: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, n_words, words, front) per shard and language; null text is empty, null language ``und``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for language, parts in held.items():
                columns = [[value] for value in _index_rows(language, parts, depth)]
                kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds)], ["lang", "n_words", "words", "front"]
                )

        for batch in slices(batches, 128):
            languages = batch.column(0).dictionary_encode()
            for number, language in enumerate(languages.dictionary.to_pylist()):
                words = split_words(batch.column(1).filter(pc.equal(languages.indices, number)))
                held.setdefault(language, []).append(words)
                size += len(words)
            if size >= SHARD_WORDS:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)), text_of(text_col))
    return rows.mapInArrow(run, "lang string, n_words long, words array<string>, front binary")


def word_hashes(language: str, words: list[str]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(language.encode())
    return np.array([xxhash.xxh64_intdigest(word.encode(), seed) for word in words], np.uint64)


def phrase_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase from those of its words, first words first."""
    found = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        found = (found ^ column) * _MIX
        found ^= found >> np.uint64(29)
    return found


class PhraseFilter:
    """Says of a hash whether its phrase may be frequent; never denies one that is."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes & np.uint64(self.bits - 1)
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def make_filter(frequent: DataFrame) -> PhraseFilter:
    """The filter of a table (lang, phrase); 16 bits a phrase, ``MOST_BITS`` at most, whatever the table's size."""
    bits = 1 << 12
    count = frequent.count()
    while bits < min(16 * count, MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                int(phrase_hashes([each.reshape(1) for each in word_hashes(language, phrase.split(" "))])[0])
                for language, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array([each & (bits - 1) for each in found], pa.int64())], ["bit"])

    hit = frequent.select("lang", "phrase").mapInArrow(run, "bit long")
    slots = hit.groupBy(F.shiftright("bit", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")
    )
    table = slots.toArrow()  # bits / 64 rows at most
    words = np.zeros(bits // 64, np.uint64)
    words[table.column("slot").to_numpy()] = table.column("word").to_numpy().view(np.uint64)
    return PhraseFilter(bits, words)


def enumerate_phrases(front: np.ndarray, hashes: np.ndarray, length: int, filters: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Phrases of ``length`` words that a shard holds, as one array of ids per place, and their counts.

    ``hashes`` has the words' hashes, word i at i - 1. ``filters[n]`` holds the frequent phrases of n + 1
    words; those for the lengths below ``length`` are used.
    """
    sizes = np.bincount(front, minlength=len(hashes) + 1)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # Place of each entry of the transform among the entries of its word: the step that extends to the left.
    step = np.empty(len(front), np.int64)
    step[np.sort(front.astype(np.int64) << 32 | np.arange(len(front))) & 0xFFFFFFFF] = np.arange(len(front))
    words = [np.arange(1, len(hashes) + 1)]
    begin, count = starts[1:-1], sizes[1:]
    for reached in range(1, length):
        # Frequent so far? What has been extended to the left is so without its first word, by construction.
        alive = filters[reached - 1].may_hold(phrase_hashes([hashes[column - 1] for column in words])) & (count > 0)
        words, begin, count = [column[alive] for column in words], begin[alive], count[alive]
        # All entries of the living intervals, and the interval of each.
        owner = np.repeat(np.arange(len(begin)), count)
        entry = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        inner = front[entry] > 0
        owner, entry = owner[inner], entry[inner]
        # By word in front, then by place: entries of one word and interval are neighbours.
        order = np.argsort(step[entry], kind="stable")
        owner, entry = owner[order], entry[order]
        new = front[entry]
        heads = np.flatnonzero(np.concatenate([[True], (new[1:] != new[:-1]) | (owner[1:] != owner[:-1])])) if len(new) else new.astype(np.int64)
        count = np.diff(np.append(heads, len(new)))
        begin = step[entry[heads]]
        words = [new[heads].astype(np.int64), *(column[owner[heads]] for column in words)]
        whole = filters[reached - 1].may_hold(phrase_hashes([hashes[column - 1] for column in words[:-1]]))
        words, begin, count = [column[whole] for column in words], begin[whole], count[whole]
    return words, count


def count_phrases(index: DataFrame, length: int, filters: list[PhraseFilter]) -> DataFrame:
    """(lang, phrase, f): sums over all shards; complete for what is frequent without its first and its last word."""
    shared = index.sparkSession.sparkContext.broadcast(filters)  # 32 MB each at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            language, words, front = (batch.column(name)[0] for name in ("lang", "words", "front"))
            words = words.values
            width = np.uint16 if len(words) < 1 << 16 else np.uint32
            hashes = word_hashes(language.as_py(), words.to_pylist())
            places, counts = enumerate_phrases(np.frombuffer(front.as_py(), width), hashes, length, shared.value)
            held = counts > 0
            columns = [words.take(pa.array(place[held] - 1)) for place in places]
            phrases = pc.binary_join_element_wise(*columns, " ") if length > 1 else columns[0]
            for start in range(0, len(phrases), 100_000):
                part = phrases.slice(start, 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(language, len(part)), part, pa.array(counts[held][start : start + 100_000], pa.int64())],
                    ["lang", "phrase", "f"],
                )

    found = index.select("lang", "words", "front").mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(index: DataFrame, most_words: int, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of up to ``most_words`` words found ``least`` times or more."""
    filters: list[PhraseFilter] = []
    found = None
    for size in range(1, most_words + 1):
        level = stored(count_phrases(index, size, filters).filter(F.col("f") >= least), f"phrases-{size}")
        if size < most_words:
            filters.append(make_filter(level))
        level = level.withColumn("size", F.lit(size))
        found = level if found is None else found.unionByName(level)
    return found


def _part(words: str, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, most_words: int = 4, least: int = 30, covered_percent: int = 80, scale: int = 2_000_000, top: int = 2_000,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    ``a`` counts a phrase of 2 to ``most_words`` words, ``l`` and ``r`` the parts of its lowest-scoring cut
    (the first of equal ones), ``n`` all words of the language; the score is floor(scale * a / (l + r)). A
    phrase whose words stand inside a longer one with ``covered_percent`` of its count or more is dropped.
    Equal scores go by count, then by the phrase's bytes.

    Null text is empty, a null language counts as ``und``. Repeated rows count each time; ids are not looked
    at. An empty table gives no rows. Texts of any length are taken whole.
    """
    index = stored(build_index(docs, most_words - 1, lang_col, text_col), "phrase-index")
    frequent = frequent_phrases(index, most_words, least)
    totals = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    exact = F.col("a").cast("decimal(38,0)")
    candidates = frequent.filter("size > 1").select("lang", "phrase", "size", F.split("phrase", " ", -1).alias("words"), F.col("f").alias("a"))
    # Each cut meets the counts of its two parts; a part is never rarer than the whole, so it is there.
    cuts = candidates.select("lang", "phrase", "a", "words", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("first"),
        _part("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(38,0)) * {scale}) div (cast(l as decimal(20,0)) + r)"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The largest count among the longer phrases that hold a phrase.
    inner = candidates.filter("size > 2").select(
        "lang", "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.expr("sequence(2, size - 1)"),
                    lambda length: F.transform(F.sequence(F.lit(1), F.col("size") - length + 1), lambda at: _part("words", at, length)),
                )
            )
        ).alias("phrase"),
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < exact * covered_percent)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
