import collections
import hashlib
import random

import numpy as np
import pytest

from verdigris.llm import suffix_dedup


def brute(rows, length):
    raw = [(row[0], (row[1] or "").encode()) for row in rows]
    seen = collections.Counter(text[i : i + length] for _, text in raw for i in range(len(text) - length + 1))
    out = []
    for doc_id, text in raw:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        runs = int(np.diff(np.concatenate([[0], gone.astype(int), [0]])).clip(0).sum())
        out.append((doc_id, len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    pick = random.Random(seed)
    shared = ["".join(pick.choice("ab cd") for _ in range(900)) for _ in range(3)]
    rows = []
    for i in range(60):
        text = "".join(pick.choice("abcdefgh ") for _ in range(pick.randint(0, 500)))
        for _ in range(pick.randint(0, 3)):
            passage, start = pick.choice(shared), pick.randint(0, 500)
            text += passage[start : start + pick.randint(100, 700)] + "".join(pick.choice("xyz") for _ in range(pick.randint(0, 300)))
        rows.append((i, text))
    return rows + [
        (1000, "a" * 1500), (1001, "ab" * 300), (1002, "x" * 399), (1003, ""), (1004, "é" * 300), (1005, "b" * 400), (1006, rows[3][1]),
        (1007, rows[3][1]), (1007, rows[3][1]), (None, rows[4][1]), (1008, None), (1009, "c" * 401),
    ]


@pytest.mark.parametrize("most", [400, 3])
def test_against_brute_force(make_docs, most, monkeypatch):
    """With few segments per anchor allowed, crowded anchors are split, down to single windows."""
    monkeypatch.setattr(suffix_dedup, "MERGED_SEGMENTS", most)
    rows = passages(3)
    found = suffix_dedup.remove_repeats(make_docs(rows, clashing=True)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, 400)


def test_kept_bytes(make_docs):
    rows = [(1, "p" + "q" * 10 + "0123456789" * 50 + "end"), (2, "0123456789" * 50), (3, "short")]
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(make_docs(rows), keep_bytes=True).collect()}
    assert kept == {1: b"pqqqqqqqqqqend", 2: b"", 3: b"short"}


def test_empty_table(make_docs):
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0


def test_long_text(make_docs):
    pick = random.Random(5)
    text = "".join(pick.choice("abcdefghij") for _ in range(400_000))
    found = suffix_dedup.remove_repeats(make_docs([(1, text), (2, text[200_000:200_500])])).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in found} == {1: (500, 1), 2: (500, 1)}


def test_merged_transforms_are_the_sorted_suffixes():
    """The interleave of three shards is the order of all suffixes, and the common prefixes are theirs."""
    pick = random.Random(7)
    strings = [[pick.randint(1, 3) for _ in range(pick.randint(1, 12))] for _ in range(30)]
    parts = [strings[:10], strings[10:17], strings[17:]]
    shards = [suffix_dedup.Shard(np.array([x for s in part for x in [*s, 0]])) for part in parts]
    rows, common = suffix_dedup.merge_transforms(shards, 13)
    texts = [[x for s in part for x in [*s, 0]] for part in parts]
    suffixes = []
    for text, shard in zip(texts, shards):
        for at in shard.order:
            rest = text[at:]
            suffixes.append(tuple(rest[: rest.index(0)]))
    merged = [suffixes[row] for row in rows]
    assert merged == sorted(suffixes)
    for before, after, shared in zip(merged, merged[1:], common[1:]):
        want = next((k for k, (x, y) in enumerate(zip(before, after)) if x != y), min(len(before), len(after)))
        assert shared == want
