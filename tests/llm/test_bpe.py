import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from verdigris.llm import bpe, tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = list(" \n\t\r\x1c\x85\xa0 aAbéÉ1２'!.<|>endoftextΣ̈ß😀　")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(tokens.read_vocabulary(BYTE))


@pytest.fixture(scope="module")
def decoder():
    return bpe.Decoder(tokens.read_vocabulary(BYTE))


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(3)
    texts = ["".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 60))) for _ in range(3_000)]
    texts += ["".join(pick.choices("aeinorst", k=pick.randint(1, 40))) for _ in range(3_000)]
    texts += ["a" * n for n in range(1, 200)] + ["ab" * 99, "-" * 1_000, " " * 333, "é" * 777]
    return texts + ["<|endoftext|> a  <|endoftext|>", "x<|endoftext|><|endoftext|>y", "<|endoftext", ""]


def numbers(encoded):
    return [np.frombuffer(ids, "<u4").tolist() for ids in encoded]


def test_ids_are_those_of_the_library_and_text_comes_back(library, coder, decoder, odd_texts):
    encoded = coder.encode(odd_texts)
    want = [each.ids for each in library.encode_batch(odd_texts, add_special_tokens=False)]
    assert numbers(encoded) == want
    assert decoder.decode(encoded) == odd_texts == library.decode_batch(want, skip_special_tokens=False)


def test_backtracking_alone(library, coder):
    """Without longest matches at first, every word by going back."""
    pick = random.Random(4)
    words = ["".join(pick.choices("abcdeghilmnorstuy", k=pick.randint(1, 30))) for _ in range(3_000)]
    assert [coder.backtrack(word) for word in words] == [each.ids for each in library.encode_batch(words)]


def test_longest_matches_do_not_always_fit(coder):
    """Words whose longest matches are no encoding exist and take the way back."""
    pick = random.Random(5)
    taken = 0
    for _ in range(500):
        word, at, longest = "".join(pick.choices("aeinorst", k=12)), 0, []
        while at < len(word):
            size = next(n for n in range(len(word) - at, 0, -1) if word[at : at + n] in coder.ids)
            longest.append(coder.ids[word[at : at + size]])
            at += size
        taken += longest != coder.backtrack(word)
    assert taken > 20


def test_every_reachable_token_is_its_own_encoding(library, coder):
    some = [token for token in coder.pairs.reachable if coder.pairs.bytes[token].isascii()][::61]
    words = [coder.pairs.bytes[token].decode() for token in some]
    assert [coder.backtrack(word) for word in words] == [[token] for token in some]
    assert len(coder.pairs.reachable) > 49_000


def merged(word, ranks):
    """Merges by rank, the left one first: the definition."""
    parts = list(word)
    while True:
        found = min(((ranks[pair], n) for n, pair in enumerate(zip(parts, parts[1:])) if pair in ranks), default=None)
        if found is None:
            return parts
        parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]


def test_small_vocabularies_with_tokens_that_no_merge_reaches():
    for seed in range(40):
        pick = random.Random(seed)
        pieces, merges = list("abc"), []
        for _ in range(14):
            pair = (pick.choice(pieces), pick.choice(pieces))
            if pair[0] + pair[1] not in pieces:
                pieces.append(pair[0] + pair[1])
                merges.append(list(pair))
        described = {
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "added_tokens": [],
            "model": {"vocab": {piece: n for n, piece in enumerate(pieces)}, "merges": merges},
        }
        coder = bpe.Encoder(json.dumps(described))
        ranks = {tuple(pair): n for n, pair in enumerate(merges)}
        words = ["".join(pick.choices("abc", k=pick.randint(1, 14))) for _ in range(200)]
        want = [[pieces.index(part) for part in merged(word, ranks)] for word in words]
        assert [coder.backtrack(word) for word in words] == want
        assert numbers(coder._match(words)) == want


def test_invalid_bytes_are_replaced_as_in_the_library(library, decoder):
    pick = random.Random(6)
    lists = [[pick.randrange(50_257) for _ in range(pick.randint(0, 12))] for _ in range(500)]
    assert decoder.decode([np.array(ids, "<u4").tobytes() for ids in lists]) == library.decode_batch(lists, skip_special_tokens=False)


def test_forgetting_changes_nothing(library, odd_texts, monkeypatch):
    for bound in ("PIECES", "PARTS", "PAIRS"):
        monkeypatch.setattr(bpe, bound, 20)
    coder = bpe.Encoder(tokens.read_vocabulary(BYTE))
    found = [numbers(coder.encode([text]))[0] for text in odd_texts[:300]]
    assert found == [each.ids for each in library.encode_batch(odd_texts[:300], add_special_tokens=False)]


def test_tables(make_docs, odd_rows, library):
    encoded = bpe.encode_texts(make_docs(odd_rows, clashing=True), BYTE)
    found = [(row.doc_id, np.frombuffer(row.ids, "<u4").tolist(), row.text) for row in bpe.decode_texts(encoded, BYTE).collect()]
    want = [(row[0], library.encode(row[1] or "", add_special_tokens=False).ids, row[1] or "") for row in odd_rows]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert bpe.decode_texts(bpe.encode_texts(make_docs([]), BYTE), BYTE).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (None, bytearray(b""))], "doc_id long, ids binary")
    assert sorted(map(str, (row.text for row in bpe.decode_texts(rows, BYTE).collect()))) == ["", ""]
