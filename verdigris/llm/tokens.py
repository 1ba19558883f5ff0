"""Whole texts to token ids with the public vocabularies, each distinct piece encoded once.

A text is cut where the vocabulary's own pre-tokenizer cuts it in any case: between a piece of
non-white characters, with the one blank before it, and the white space around, and between a plain
letter and a mark. Ids of a piece do not depend on its neighbours, so they are remembered; only pieces
not seen before go to the library. The texts of a batch are cut together, on their bytes, and the
distinct pieces of the batch are looked up once. A text that holds a special string goes to the library whole.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import regex

from verdigris.llm.common import worker_cache

# White space as the vocabularies' patterns understand it, and the pattern of the byte-level one.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BYTE_PIECES = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_WORD_PIECES = re.compile(f"[^{_WHITE}]+")
BYTE_PATTERN = regex.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+"
    f"| ?[^{_WHITE}\\p{{L}}\\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
# A piece that is one word of Latin letters, with a blank before and marks behind it or not: its pre-tokens are
# the word with the blank and the marks, and neither normalisation nor case folding does more than lower().
_PLAIN = re.compile("( ?)([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*&%$#|()]*)")
# The same white space in bytes: single ones, and characters of two and three as numbers.
_WHITE_BYTE = np.isin(np.arange(256), [*range(0x09, 0x0E), 0x20])
_WHITE_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_WHITE_TWO = np.array([0xC285, 0xC2A0])
_WHITE_THREE = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
_UPPER_BYTE = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
_LETTER_BYTE = _UPPER_BYTE | np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1))
_MARK_BYTE = np.isin(np.arange(256), list(b".,;:!?*&%$#|()"))
# Pieces remembered by a worker before it forgets the older half: a bound on memory, not on the work.
REMEMBERED = 500_000


def read_vocabulary(path: str) -> str:
    """The tokenizer file as text, for a broadcast: its size is that of the vocabulary."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def vocabulary_size(vocabulary: str) -> int:
    """One more than the largest id."""
    described = json.loads(vocabulary)
    added = [token["id"] for token in described.get("added_tokens") or []]
    return max([*described["model"]["vocab"].values(), *added]) + 1


def byte_letters() -> dict[str, int]:
    """Letter to byte, by the rule of byte-level vocabularies: printable bytes stand for themselves,
    the others for the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + place): byte for place, byte in enumerate(others)}


def forget_half(known: dict, most: int) -> None:
    """Drop the older half of a full memory."""
    if len(known) > most:
        for key in list(islice(known, len(known) // 2)):
            del known[key]


class PieceEncoder:
    """Encodes texts piece by piece. One per worker and vocabulary; see ``encoder_for``."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        described = json.loads(vocabulary)
        self.library = Tokenizer.from_str(vocabulary)
        self.specials = [token["content"] for token in described.get("added_tokens") or []]
        # Byte-level vocabularies keep white space; those with word ends drop it.
        self.keeps_white = described["pre_tokenizer"]["type"] == "ByteLevel"
        self.pieces = _BYTE_PIECES if self.keeps_white else _WORD_PIECES
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The letter that stands for each byte in the vocabulary's own strings.
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.table = "".join(self.letters[byte] for byte in range(256))
        self.marks: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(each.ids, "<u4").tobytes() for each in found]

    def _learn(self, pieces: list[str]) -> None:
        """Plain words go to the model alone, everything else through the whole library."""
        known, rest, model = self.known, [], self.library.model.tokenize
        keeps, table, blank = self.keeps_white, self.table, self.letters[ord(" ")]
        for piece in pieces:
            marks, word = "", piece
            letters = piece[1:] if piece[0] == " " else piece
            if not (letters.isascii() and letters.isalpha()):
                plain = _PLAIN.fullmatch(piece)
                if plain is None:
                    rest.append(piece)
                    continue
                if plain[3]:
                    marks, word = plain[3], piece[: plain.start(3)]
            # The ids of one word, straight from the vocabulary's model, in which a letter stands for each byte.
            if not keeps:
                word = word.lstrip(" ").lower()
            if not word.isascii():
                word = codecs.charmap_decode(word.encode("utf-8"), "strict", table)[0]
            elif word[0] == " ":
                word = blank + word[1:]
            ids = array("I", [token.id for token in model(word)]).tobytes()
            if marks:
                if marks not in self.marks:
                    forget_half(self.marks, REMEMBERED)
                    self.marks[marks] = self.whole([marks])[0]
                ids += self.marks[marks]
            known[piece] = ids
        known.update(zip(rest, self.whole(rest)))

    def _remembered(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece. What was asked for since half of the memory was filled outlives the rest."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        holes = [place for place, ids in enumerate(found) if ids is None]
        if holes:
            asked = [pieces[place] for place in holes]
            before = list(map(self.older.get, asked))
            self.known.update((piece, ids) for piece, ids in zip(asked, before) if ids is not None)
            self._learn([piece for piece, ids in zip(asked, before) if ids is None])
            for place, piece in zip(holes, asked):
                found[place] = self.known[piece]
        return found

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where pieces of the texts that begin at ``starts`` begin in ``data``, ascending."""
        white = _WHITE_BYTE[data]
        longer = np.flatnonzero(_WHITE_LEAD[data])
        if len(longer):
            padded = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int32)
            two = (padded[longer] << 8) | padded[longer + 1]
            three = longer[np.isin((two << 8) | padded[longer + 2], _WHITE_THREE)]
            two = longer[np.isin(two, _WHITE_TWO)]
            for step, places in ((0, two), (1, two), (0, three), (1, three), (2, three)):
                white[places + step] = True
        begins = np.zeros(len(data), bool)
        begins[starts] = True
        word = np.flatnonzero(white[:-1] & ~white[1:] & ~begins[1:]) + 1
        # The last white character before a word stands alone, or with the word if it is a blank.
        before = data[word - 1]
        begins[word[before != ord(" ")]] = True
        length = np.where(before < 0x80, 1, np.where(data[word - 2] == 0xC2, 2, 3))
        begins[word - length] = True
        begins[1:] |= ~white[:-1] & white[1:]
        begins[1:] |= _LETTER_BYTE[data[:-1]] & _MARK_BYTE[data[1:]]
        return np.flatnonzero(begins)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
        # Whole texts for the library, by number: also where a special string would come about by lowering.
        odd = {number: text for number, text in enumerate(texts) if any(mark in text or mark in text.lower() for mark in self.specials)}
        raw = [b"" if number in odd else text.encode("utf-8") for number, text in enumerate(texts)]
        bounds = np.concatenate([[0], np.cumsum([len(each) for each in raw], dtype=np.int64)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return self._with_whole([b""] * len(texts), odd)
        if not self.keeps_white:
            # A letter before one of several bytes stays: with what follows it may be another letter.
            lowered = _UPPER_BYTE[data]
            lowered[:-1] &= data[1:] < 0x80
            data = data | (lowered.astype(np.uint8) << 5)
        cuts = self._cuts(data, bounds[:-1][bounds[:-1] < bounds[1:]])
        ends = np.append(cuts, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        found = self._remembered(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(found, pa.large_binary()).take(pieces.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[np.searchsorted(ends, bounds)]
        held = memoryview(ids.buffers()[2] or b"")
        return self._with_whole([bytes(held[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], odd)

    def _with_whole(self, found: list[bytes], odd: dict[int, str]) -> list[bytes]:
        for number, text in odd.items():
            found[number] = self.whole([text])[0]
        return found


def encoder_for(vocabulary: str) -> PieceEncoder:
    cache = worker_cache("tokens")
    key = ("encoder", hash(vocabulary))
    if key not in cache:
        cache[key] = PieceEncoder(vocabulary)
    return cache[key]
