import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from verdigris.llm import collocations, queries
from verdigris.verification.compare import difference, register_tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most_words=4, least=30, percent=80, scale=2_000_000, top=2_000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [word for word in re.split("[ \t]+", piece) if word]
            totals[lang] += len(words)
            for size in range(1, most_words + 1):
                counts[lang].update(tuple(words[at : at + size]) for at in range(len(words) - size + 1))
    found = []
    for lang, counted in counts.items():
        frequent = {phrase: n for phrase, n in counted.items() if len(phrase) > 1 and n >= least}
        dropped = set()
        for longer, n in frequent.items():
            for size in range(2, len(longer)):
                for at in range(len(longer) - size + 1):
                    inner = longer[at : at + size]
                    if 100 * n >= percent * frequent[inner]:
                        dropped.add(inner)
        scored = []
        for phrase, a in frequent.items():
            cuts = [(counted[phrase[:k]], counted[phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, left, right = min((scale * a // (left + right), k, left, right) for left, right, k in cuts)
            if phrase not in dropped:
                scored.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


@pytest.fixture
def make(spark):
    def build(rows):
        schema = "doc_id long, text string, lang string, words string, f long, size int, n long, front string, phrase int"
        return spark.createDataFrame([(n, *row, "w", 1, 2, 3, "f", 4) for n, row in enumerate(rows)], schema)

    return build


@pytest.fixture
def odd():
    pick = random.Random(1)
    words = ["the", "The", "of", "é", "É", "x\x00y", "a b", "日本", "w1", "w2", "\x01", "\U0001f600"]
    texts = [
        "".join(pick.choice(words) + pick.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]) for _ in range(pick.randint(0, 60)))
        for _ in range(200)
    ]
    rows = [(text, pick.choice(["en", "en", "en", "de", None, "und", ""])) for text in texts]
    long = " ".join(f"word{n % 37} of" for n in range(30_000))
    return rows + [(None, "en"), ("", None), (" \t. ,", "fr"), ("new york city", "en")] + [("new york city hall", "fr")] * 5 + [(long, "de")]


def rows_of(found):
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("shard", [500_000, 40])
def test_all_rows_against_brute_force(make, odd, shard, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    docs = make(odd).repartition(3)
    assert rows_of(collocations.collocations(docs, least=5)) == brute(odd, least=5)
    assert rows_of(collocations.collocations(docs, 3, 2, 50, 1_000, 7)) == brute(odd, 3, 2, 50, 1_000, 7)


def test_a_full_filter_changes_nothing(make, odd, monkeypatch):
    """At its largest size the filter may let everything through."""
    monkeypatch.setattr(collocations, "MOST_BITS", 1)
    monkeypatch.setattr(collocations.PhraseFilter, "may_hold", lambda self, hashes: np.ones(len(hashes), bool))
    assert rows_of(collocations.collocations(make(odd), least=5)) == brute(odd, least=5)


def test_nothing(make):
    assert collocations.collocations(make([])).count() == 0
    assert collocations.collocations(make([(None, None), ("", "en")])).count() == 0


def test_transform_extends_intervals():
    """Every phrase of a random sequence is found with its count, borders crossed by none."""
    pick = np.random.default_rng(2)
    ids = np.append(pick.integers(0, 5, 400), 0)
    front = collocations.transform(ids, 3)
    hashes = np.arange(1, 5, dtype=np.uint64)
    everything = type("All", (), {"may_hold": lambda self, found: np.ones(len(found), bool)})()
    for size in range(1, 5):
        words, counts = collocations.enumerate_phrases(front, hashes, size, [everything] * 3)
        found = {phrase: n for *phrase_, n in zip(*(column.tolist() for column in words), counts.tolist()) if n for phrase in [tuple(phrase_)]}
        want = Counter(tuple(ids[at : at + size].tolist()) for at in range(len(ids) - size + 1))
        assert found == {phrase: n for phrase, n in want.items() if 0 not in phrase}


def test_filter_never_denies(spark):
    rows = [("en", f"a{n} b{n % 7}") for n in range(3_000)]
    made = collocations.make_filter(spark.createDataFrame(rows, "lang string, phrase string"))
    hashes = [collocations.phrase_hashes([each.reshape(1) for each in collocations.word_hashes(*row[:1], row[1].split(" "))]) for row in rows]
    assert made.may_hold(np.concatenate(hashes)).all()
    others = np.random.default_rng(3).integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert made.may_hold(others).mean() < 0.1


def test_query_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    database = duckdb.connect()
    register_tables(database, sf_dir)
    found = queries.op12_collocations(spark, sf_dir).toPandas()
    assert len(found) > 20 and difference(found, database.sql(queries.oracle_sql()["op12_collocations"]).df()) is None
