import gc
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verdigris.llm import jaccard, packing, token_counts, token_files, tokens
from verdigris.sources.storage import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = list(" \n\t\r\x1c\x85\xa0 aAbéÉ1２'!.<|>endoftextΣ̈ß😀　")


def library_ids(path, texts):
    return [each.ids for each in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(1)
    texts = ["".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 60))) for _ in range(3_000)]
    return texts + ["<|endoftext|> a  <|endoftext|>", "x  <|startoftext|> y", "a  \n <|endoftext|>b"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_library(path, odd_texts):
    encoder = tokens.PieceEncoder(tokens.read_vocabulary(path))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(odd_texts)] == library_ids(path, odd_texts)


def test_forgetting_changes_nothing(odd_texts, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = tokens.PieceEncoder(tokens.read_vocabulary(BYTE))
    found = [np.frombuffer(encoder.encode([text])[0], "<u4").tolist() for text in odd_texts[:300]]
    assert found == library_ids(BYTE, odd_texts[:300])


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_texts_cut_together_give_the_ids_of_the_library(path):
    """White space of one to three bytes, letters that lowering or a mark behind would change, special strings in any case."""
    pick = random.Random(2)
    marks = [" ", "  ", "\n", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "J\u030c", "K", "H\u0331", "it's", "IT'S", ",", ".)", "'", "_", "é", "İ", "Σ", "ß", "7", "ﬁ", "word"]
    texts = ["".join(pick.choice(marks) for _ in range(pick.randint(0, 12))) for _ in range(4_000)]
    texts += ["<|STARTOFTEXT|> a", "x<|endOFtext|>,y", "a <|endoftext|>b", "", "J", "\u030cx"]
    encoder = tokens.PieceEncoder(tokens.read_vocabulary(path))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == library_ids(path, texts)


def test_a_word_is_remembered_once_whatever_marks_follow_and_looked_up_once_a_batch():
    encoder = tokens.PieceEncoder(tokens.read_vocabulary(WORD))
    asked = []

    class Known(dict):
        def get(self, piece, default=None):
            asked.append(piece)
            return super().get(piece, default)

    encoder.known = Known()
    encoder.encode(["One one, ONE! one one;"] * 50)
    assert sorted(asked) == [" one", "!", ",", ";", "one"] and sorted(encoder.known) == sorted(asked)


def test_a_step_of_another_purpose_gives_the_vocabulary_back():
    """Else a worker holds what the packing and the join of one pipeline remember, side by side."""
    held = weakref.ref(tokens.encoder_for(tokens.read_vocabulary(BYTE)))
    assert held() is tokens.encoder_for(tokens.read_vocabulary(BYTE))
    jaccard.shingles("a b c", 2)
    gc.collect()
    assert held() is None


def test_whole_tokens_are_proved(odd_texts):
    whole = token_counts.whole_tokens(tokens.read_vocabulary(BYTE))
    some = sorted(whole)[::97]
    assert all(len(ids) == 1 for ids in library_ids(BYTE, some)) and len(whole) > 40_000
    counter = token_counts.PieceCounter(tokens.read_vocabulary(BYTE), whole)
    assert counter.count(odd_texts) == [len(ids) for ids in library_ids(BYTE, odd_texts)]


def test_counts(make_docs, odd_rows):
    found = token_counts.count_tokens(make_docs(odd_rows, clashing=True), BYTE, 3).collect()
    want = [(r[0], len((r[1] or "").encode()), len(ids), len(ids) > 3) for r, ids in zip(odd_rows, library_ids(BYTE, [r[1] for r in odd_rows]))]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(make_docs([]), BYTE, 3).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 15, 16, 17, 20, 25])
def test_packed_ids_come_back(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1_001).astype(np.uint32)
    payload = token_files.pack(ids, bits)
    assert len(payload) == -(-1_001 * bits // 8)
    assert (token_files.unpack(payload, bits, 1_001) == ids).all()
    assert (token_files.unpack(payload, bits, 5, 500) == ids[500:505]).all()
    assert len(token_files.unpack(payload, bits, 0)) == 0


def test_width():
    assert [token_files.width_of(size) for size in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def test_token_files_round_trip(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 5)
    rows = [row for row in odd_rows if row[0] is not None]
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(make_docs(rows, clashing=True), path, WORD, 2)
    blocks = spark.read.parquet(path)
    assert {row.bits for row in blocks.select("bits").collect()} == {16}
    found = sorted(map(tuple, token_files.read_token_files(blocks).collect()), key=lambda r: r[1])
    want, start = [], 0
    for row, ids in sorted(zip(rows, library_ids(WORD, [r[1] for r in rows])), key=lambda pair: pair[0][0]):
        want.append((row[0], start, len(ids) + 1, crc(ids + [2])))
        start += len(ids) + 1
    assert found == want


def test_token_files_of_nothing_and_of_null_ids(spark, make_docs):
    for rows in ([], [(None, "a"), (None, None), (3, "b")]):
        path = scratch_path(spark, "tokens")
        token_files.write_token_files(make_docs(rows), path, WORD, 2)
        found = token_files.read_token_files(spark.read.parquet(path)).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("bits", [16, 17])
def test_reading_anywhere(spark, make_docs, odd_rows, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    monkeypatch.setattr(token_files, "vocabulary_size", lambda vocabulary: (1 << bits) - 5)
    rows = [row for row in odd_rows if row[0] is not None]
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(make_docs(rows, clashing=True), path, WORD, 2)
    blocks = spark.read.parquet(path)
    assert {row.bits for row in blocks.select("bits").collect()} == {bits}
    read = {(r.start, r.n_tokens): r.doc_id for r in token_files.read_token_files(blocks).collect()}
    texts = dict(zip([row[0] for row in rows], library_ids(WORD, [row[1] for row in rows])))
    whole = [each for start, n in sorted(read) for each in texts[read[start, n]] + [2]]
    for first, count in [(0, 3), (4, 1), (1, 70), (len(whole) - 2, 9), (len(whole), 5), (0, len(whole)), (60, 0)]:
        parts = sorted((r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_id_range(blocks, first, count).collect())
        assert [each for _, ids in parts for each in ids] == whole[first : first + count]
        assert not parts or parts[0][0] == first
    wanted = spark.createDataFrame([(5,), (6,), (6,), (1,), (77,), (None,)], "doc_id long")
    found = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_documents(blocks, wanted).collect())
    assert found == sorted((n, texts[n] + [2]) for n in (1, 5, 5, 6))


def test_null_and_repeated_ids_spread(spark, make_docs):
    """A third of the rows has no id, a third has one id: no shard holds them all."""
    path = scratch_path(spark, "tokens")
    docs = make_docs([(None if n % 3 == 0 else 7 if n % 3 == 1 else n, f"text {n}") for n in range(3_000)])
    token_files.write_token_files(docs, path, WORD, 2)
    blocks = spark.read.parquet(path)
    sizes = [row.n for row in blocks.groupBy("shard").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 1_200 and len(sizes) == 4
    starts = sorted((r.start, r.n_tokens, r.doc_id if r.doc_id is not None else -1) for r in token_files.read_token_files(blocks).collect())
    assert [n for *_, n in starts] == sorted(n for *_, n in starts)
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:]))


def check_packing(rows, pieces, capacity):
    ids = {}
    for row, found in zip(rows, library_ids(BYTE, [r[1] for r in rows])):
        ids.setdefault(row[0], []).append(found + [0])
    for piece in pieces:
        assert any(crc(found[piece.start : piece.start + piece.length]) == piece.ids_crc32 for found in ids[piece.doc_id])
    assert sum(p.length for p in pieces) == sum(len(f) for found in ids.values() for f in found)
    by_sequence = {}
    for piece in pieces:
        by_sequence.setdefault(piece.sequence_id, []).append((piece.offset, piece.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("per_task", [50_000, 3])
def test_packing(make_docs, odd_rows, per_task, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", per_task)
    pick = random.Random(2)
    rows = odd_rows + [(100 + i, "x y " * pick.randint(0, 40)) for i in range(60)]
    pieces = packing.pack(packing.token_pieces(make_docs(rows, clashing=True), BYTE, 0, 64).withColumnRenamed("id", "doc_id"), 64).collect()
    used = check_packing(rows, pieces, 64)
    assert used <= 1.15 * sum(p.length for p in pieces) / 64 + 2


@pytest.mark.parametrize("per_task", [2, 7, 40])
def test_many_tasks_pack_as_well_as_one(spark, per_task, monkeypatch):
    """The end does not depend on the number of tasks: no two bins that would fit together are left at any size."""
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", per_task)
    pick = random.Random(per_task)
    lengths = [pick.choice([60, 61, 62, 63, 70, 95, 3, 20, 35]) for _ in range(300)] + [55] * 200
    rows = spark.createDataFrame([(n, 0, 0, length, 0) for n, length in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(rows, 100).collect()
    assert sorted(p.doc_id for p in found) == list(range(500))
    fills = {}
    for piece in found:
        fills[piece.sequence_id] = fills.get(piece.sequence_id, 0) + piece.length
    ordered = sorted(fills.values())
    assert ordered[-1] <= 100 and ordered[0] + ordered[1] > 100
    one_task = len(packing.best_fit(lengths, 100))
    assert len(fills) <= one_task * 1.05 + 1


def test_packing_of_nothing(make_docs):
    assert packing.pack(packing.token_pieces(make_docs([]), BYTE, 0, 64).withColumnRenamed("id", "doc_id"), 64).count() == 0


def test_cutting_and_best_fit():
    assert packing.cut_lengths(10, 4) == [2, 4, 4] and packing.cut_lengths(8, 4) == [4, 4] and packing.cut_lengths(3, 4) == [3]
    assert sorted(map(sorted, packing.best_fit([6, 5, 4, 3, 2], 10))) == [[0, 2], [1, 3, 4]]


def test_what_is_asked_for_again_outlives_what_is_not(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    encoder, learned = tokens.PieceEncoder(tokens.read_vocabulary(BYTE)), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: (learned.extend(pieces), learn(pieces)))
    for number in range(40):
        encoder.encode(["often " + " ".join("abcdefghij"[number % 10] * (number // 10 + 1) + letter for letter in "klmnopqr")])
        assert len(encoder.known) + len(encoder.older) <= 40 + 2 * 9
    assert learned.count("often") == 1 and len(learned) > 300
