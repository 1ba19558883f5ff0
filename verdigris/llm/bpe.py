"""Byte-pair encoding without replaying merges, and decoding by an offset table.

A sequence of tokens is what the merges make of its bytes exactly if each token is what they make of
its own bytes, and no two neighbours would have been merged across their border. Both are facts about
the vocabulary:

* A token passes through parts as it grows. Those that touch its right end, each with the rank of the
  merge that takes it away, are its right edge; the left edge likewise. Two neighbours are compatible
  unless some pair of parts, one of either edge, has a merge that comes before both are gone. The parts
  of a merge are older than the merge, so both are there when its turn comes. Of equal merges the left
  one goes first: a part of the left token must outlive the merge, one of the right token need only
  reach it.
* A token is reachable unless such a pair breaks in before its own last merge.

An Aho-Corasick automaton over the reachable tokens cuts text into longest matches. Where neighbours are
compatible, that is the encoding. Elsewhere the encoder goes back one token and takes the next shorter
one. The encoding of a prefix is unique, so a place that failed once is never tried again, and the
number of steps follows the length. Nothing is merged at any point.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import slices, text_of, worker_cache
from verdigris.llm.tokens import _BYTE_PIECES, BYTE_PATTERN, byte_letters, forget_half, read_vocabulary

# Texts that a task encodes or decodes together.
TEXTS = 256
# What a worker remembers of pieces, pre-tokens and pairs before it forgets the older half: bounds on memory.
PIECES, PARTS, PAIRS = 300_000, 200_000, 300_000
# A letter that no byte stands for: it parts pre-tokens in front of the automaton.
_BORDER = "Ā"
_NEVER = 1 << 62


def token_bytes(described: dict) -> dict[int, bytes]:
    letters = byte_letters()
    return {token: bytes(letters[letter] for letter in string) for string, token in described["model"]["vocab"].items()}


class PairTable:
    """Which tokens are reachable, and which may stand next to each other."""

    def __init__(self, described: dict):
        ids = described["model"]["vocab"]
        self.bytes = token_bytes(described)
        self.ranks: dict[tuple[int, int], int] = {}
        made: dict[int, list[tuple[int, int, int]]] = {}
        for rank, (left, right) in enumerate(described["model"]["merges"]):
            if self.ranks.setdefault((ids[left], ids[right]), rank) == rank:
                made.setdefault(ids[left + right], []).append((ids[left], ids[right], rank))
        # Parts at the left and right end, the token itself first: (part, rank of the merge that takes it away).
        self.left = {token: [(token, _NEVER)] for token, string in self.bytes.items() if len(string) == 1}
        self.right = {token: list(edge) for token, edge in self.left.items()}
        # By age: the parts of a merge come before it. A token with an unreachable part is unreachable as well.
        for token in sorted(made, key=lambda token: made[token][0][2]):
            for left, right, rank in made[token]:
                if left not in self.left or right not in self.left:
                    continue
                inner = [(left, rank), *self.right[left][1:]], [(right, rank), *self.left[right][1:]]
                if not self._breaks(*inner, rank):
                    self.left[token] = [(token, _NEVER), (left, rank), *self.left[left][1:]]
                    self.right[token] = [(token, _NEVER), (right, rank), *self.right[right][1:]]
                    break
        self.reachable = list(self.left)
        self.known: dict[int, bool] = {}

    def _breaks(self, right_edge, left_edge, before: int = _NEVER) -> bool:
        ranks = self.ranks
        for part, gone in right_edge:
            for other, other_gone in left_edge:
                rank = ranks.get((part, other), _NEVER)
                if rank < before and rank < gone and rank <= other_gone:
                    return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        if pair not in self.known:
            forget_half(self.known, PAIRS)
            self.known[pair] = not self._breaks(self.right[left], self.left[right])
        return self.known[pair]


class Encoder:
    """Encodes with one byte-level vocabulary. One per worker; see ``coder_for``."""

    def __init__(self, vocabulary: str):
        described = json.loads(vocabulary)
        if described["pre_tokenizer"]["type"] != "ByteLevel" or described["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("the encoder is for byte-level vocabularies that add no blank in front")
        self.pairs = PairTable(described)
        # Bytes as letters of the same number, so that places in a string are places in its bytes.
        self.ids = {self.pairs.bytes[token].decode("latin-1"): token for token in self.pairs.reachable}
        # The longest token that a token begins with, other than itself, and its length.
        self.shorter = {token: self._prefix(string) for string, token in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for string, token in self.ids.items():
            self.automaton.add_word(string, (token, len(string)))
        self.automaton.make_automaton()
        self.specials = {token["content"]: token["id"] for token in described.get("added_tokens") or []}
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _prefix(self, string: str) -> tuple[int, int] | None:
        for length in range(len(string) - 1, 0, -1):
            if string[:length] in self.ids:
                return self.ids[string[:length]], length
        return None

    def backtrack(self, word: str) -> list[int]:
        """The ids of a word given as one letter per byte."""
        taken: list[tuple[int, int]] = []
        failed, at, tried = set(), 0, None
        compatible, shorter = self.pairs.compatible, self.shorter
        while at < len(word):
            found = next(self.automaton.iter_long(word, at))[1] if tried is None else shorter[tried]
            while found and (at + found[1] in failed or taken and not compatible(taken[-1][0], found[0])):
                found = shorter[found[0]]
            if found:
                taken.append(found)
                at, tried = at + found[1], None
            else:
                # Nothing goes on from here: a shorter token in place of the last one.
                failed.add(at)
                tried, length = taken.pop()
                at -= length
        return [token for token, _ in taken]

    def _match(self, words: list[str]) -> list[bytes]:
        """The ids of words, one letter per byte: longest matches where these fit together."""
        flat = np.fromiter(
            chain.from_iterable((end, token, length) for end, (token, length) in self.automaton.iter_long(_BORDER.join(words))), np.int64
        ).reshape(-1, 3)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        owner = np.searchsorted(starts, flat[:, 0], "right") - 1
        covered = np.bincount(owner, flat[:, 2], len(words))
        fits = covered == sizes
        inside = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else owner
        keys, place = np.unique(flat[inside, 1] << 32 | flat[inside + 1, 1], return_inverse=True)
        good = np.array([self.pairs.compatible(key >> 32, key & 0xFFFFFFFF) for key in keys.tolist()], bool)
        fits[owner[inside][~good[place]]] = False
        ids, bounds = flat[:, 1].astype("<u4"), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
        return [
            ids[bounds[n] : bounds[n + 1]].tobytes() if fit else np.array(self.backtrack(words[n]), "<u4").tobytes()
            for n, fit in enumerate(fits.tolist())
        ]

    def _learn(self, pieces: list[str]) -> None:
        forget_half(self.parts, PARTS)
        cut = [BYTE_PATTERN.findall(piece) for piece in pieces]
        new = list({part for parts in cut for part in parts} - self.parts.keys())
        self.parts.update(zip(new, self._match([part.encode("utf-8").decode("latin-1") for part in new])))
        for piece, parts in zip(pieces, cut):
            self.pieces[piece] = self.parts[parts[0]] if len(parts) == 1 else b"".join(map(self.parts.__getitem__, parts))

    def _segments(self, text: str) -> Iterator[str | int]:
        """The text in parts between special strings, and the ids of these."""
        while text:
            found = min(((text.find(mark), -len(mark), mark) for mark in self.specials if mark in text), default=None)
            if found is None:
                yield text
                return
            if found[0]:
                yield text[: found[0]]
            yield self.specials[found[2]]
            text = text[found[0] + len(found[2]) :]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        forget_half(self.pieces, PIECES)
        cut = [
            [part if isinstance(part, int) else _BYTE_PIECES.findall(part) for part in self._segments(text)] for text in texts
        ]
        new = {piece for parts in cut for part in parts if not isinstance(part, int) for piece in part} - self.pieces.keys()
        self._learn(list(new))
        get = self.pieces.__getitem__
        return [
            b"".join(part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(get, part)) for part in parts)
            for parts in cut
        ]


class Decoder:
    """Decodes ids of one byte-level vocabulary."""

    def __init__(self, vocabulary: str):
        described = json.loads(vocabulary)
        # Bytes of all tokens end to end; token i has those from offsets[i] to offsets[i + 1].
        strings = token_bytes(described) | {token["id"]: token["content"].encode() for token in described.get("added_tokens") or []}
        lengths = np.zeros(max(strings) + 1, np.int64)
        lengths[list(strings)] = [len(string) for string in strings.values()]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.table = np.frombuffer(b"".join(strings[token] for token in sorted(strings)), np.uint8)

    def decode(self, encoded: list[bytes]) -> list[str]:
        """The text of each list of ids; bytes that are no UTF-8 become the replacement character."""
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # Where each byte of the output lies in the table.
        source = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - ends[:-1], lengths)
        raw = self.table[source].tobytes()
        bounds = ends[np.concatenate([[0], np.cumsum([len(each) // 4 for each in encoded], dtype=np.int64)])].tolist()
        return [raw[start:end].decode("utf-8", "replace") for start, end in zip(bounds, bounds[1:])]


def coder_for(kind: type, vocabulary: str) -> Encoder | Decoder:
    """The worker's encoder or decoder."""
    cache = worker_cache("tokens")
    key = (kind.__name__, hash(vocabulary))
    if key not in cache:
        cache[key] = kind(vocabulary)
    return cache[key]


def encode_texts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) per row: the ids of the whole text as little-endian unsigned 32-bit integers.

    Null text counts as empty and has no ids. Ids of rows may be null or repeated; they are passed on,
    and every row is encoded by itself. Special strings in a text become their ids. No shuffle.
    """
    # Broadcast: the vocabulary, whatever the size of the table.
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(Encoder, shared.value)
        for batch in slices(batches, TEXTS):
            ids = coder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = docs.select(F.col(id_col).alias("id"), text_of(text_col)).mapInArrow(run, f"id {kind}, ids binary")
    return encoded.select(F.col("id").alias(id_col), "ids")


def decode_texts(encoded: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, text) per row of ids as ``encode_texts`` makes them; null ids give the empty text.

    Special ids give their strings. An id that the vocabulary does not have is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_for(Decoder, shared.value)
        for batch in slices(batches, TEXTS):
            texts = coder.decode([ids or b"" for ids in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, ids binary, text string").withColumnRenamed("id", id_col)
