import random
import re
import tracemalloc

import numpy as np
import pytest

from verdigris.llm import quality


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    symbols = sum(letter in "#*$%&|<>" for letter in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def sample_rows(seed, n):
    pick = random.Random(seed)
    good, bad = [], []
    for i in range(n):
        words = [pick.choice(["river", "stone", "house", "green", "walk", "often", "under"]) + pick.choice(["", "s", "ed"]) for _ in range(80)]
        good.append((i, " ".join(words).capitalize() + "."))
        bad.append((n + i, " ".join(word.upper() + "!!" for word in words)))
    return good, bad


@pytest.fixture
def labelled(spark, make_docs):
    good, bad = sample_rows(1, 40)
    labels = [(k, 1) for k, _ in good[:30]] + [(k, 0) for k, _ in bad[:30]] + [(None, 1), (999, 0), (5, None), (6, 7)]
    return make_docs(good + bad, clashing=True), spark.createDataFrame(labels, "doc_id long, quality int"), good, bad


def test_base_counts(make_docs, odd_rows):
    pick = random.Random(4)
    rows = [row for row in odd_rows if row[0] not in (6, 7)] + [
        (50 + i, "".join(pick.choice(["a ", "b ", "c\n", "# ", "*|", "dd\t", "\x0b", "é "]) for _ in range(pick.randint(0, 150)))) for i in range(40)
    ]
    found = quality.score_quality(make_docs(rows, clashing=True), None).collect()
    want = [(row[0], *brute(row[1])) for row in rows]
    assert sorted([tuple(r)[:7] for r in found], key=str) == sorted(want, key=str)
    assert all(r.kept != r.base_failed and r.p_good is None for r in found)


def test_very_long_text_and_many_distinct_words(make_docs, odd_rows):
    long = [row for row in odd_rows if row[0] == 6]
    row = quality.score_quality(make_docs(long), None).first()
    assert (row.n_words, row.n_repeat_words, row.base_failed) == (60_000, 60_000, True)


def test_held_out_accuracy(labelled):
    docs, labels, good, bad = labelled
    model = quality.train_quality_model(docs, labels)
    kept = {r.doc_id: r.kept for r in quality.score_quality(docs, model).collect()}
    assert all(kept[k] for k, _ in good[30:]) and not any(kept[k] for k, _ in bad[30:])
    rest = quality.drop_low_quality(docs, model)
    assert rest.columns == docs.columns and rest.count() == len(good)


def test_sample_is_bounded_and_stable(labelled):
    docs, labels, *_ = labelled
    one = quality.train_quality_model(docs, labels, sample_rows=20)
    two = quality.train_quality_model(docs.repartition(7), labels.repartition(3), sample_rows=20)
    assert abs(one.weights - two.weights).max() < 1e-5


def test_no_model_without_both_classes(spark, labelled, make_docs):
    docs, labels, *_ = labelled
    assert quality.train_quality_model(docs, labels.filter("quality = 1")) is None
    assert quality.train_quality_model(make_docs([]), labels) is None
    assert quality.score_quality(make_docs([]), None).count() == 0


def test_accuracy_on_the_tables(spark, sf_dir):
    """Trained on half of the labels, right on nearly all of the other half that pass the base rules."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train_quality_model(docs, labels.filter("doc_id % 2 = 0"))
    found = quality.score_quality(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").collect()
    assert sum(r.kept == bool(r.quality) for r in found) >= 0.9 * len(found) and found


def test_products_of_lines_equal_dense_ones():
    pick = np.random.default_rng(3)
    # Empty lines, one that is longer than a part, and the end of a part within a line.
    lengths = np.array([0, 3, quality.PART + 9, 0, 40, quality.PART - 20, 100, 1, 2 * quality.PART, 0])
    places = [np.sort(pick.choice(4 * quality.PART, n, replace=False)) for n in lengths]
    values = [pick.random(n).astype(np.float32) for n in lengths]
    vector = pick.random(4 * quality.PART).astype(np.float32)
    found = quality._Lines(lengths, np.concatenate(places), np.concatenate(values)).times(vector)
    assert np.allclose(found, [vector[p] @ v for p, v in zip(places, values)], rtol=1e-3)


def test_fitting_never_holds_the_sample_dense(spark, make_docs):
    """The driver holds the features that rows have, not rows by features."""
    docs = make_docs([(n, " ".join(f"w{(n * k) % 97}" for k in range(60)) + (" good" if n % 2 else " #bad")) for n in range(600)])
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(600)], "doc_id long, quality int, toxic int")
    tracemalloc.start()
    try:
        assert quality.train_quality_model(docs, labels) is not None
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 600 * 2 * quality.BUCKETS * 4 / 2
