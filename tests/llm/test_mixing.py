import math

from verdigris.llm import mixing


def poisson_quantile(rate, level):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= level and k < 64:
        k += 1
        term *= rate / k
        total += term
    return k


def test_counts_invert_the_distribution(spark, make_docs):
    import hashlib

    rows = [(i, "x", "a") for i in range(500)]
    rates = spark.createDataFrame([("a", 2.5)], "source string, rate double")
    found = {r.row.doc_id: r.n_copies for r in mixing.replicate(make_docs(rows), rates, seed=3).select("row", "n_copies").collect()}
    for i in range(500):
        level = int(hashlib.md5(f"3|{i}|0".encode()).hexdigest()[:13], 16) / 2**52
        assert found.get(i, 0) == poisson_quantile(2.5, level)


def test_large_means_are_sums_of_parts(spark, make_docs):
    rates = spark.createDataFrame([("a", 100.0)], "source string, rate double")
    found = mixing.replicate(make_docs([(i, "x", "a") for i in range(300)]), rates).groupBy("row.doc_id").count().collect()
    mean = sum(r["count"] for r in found) / 300
    variance = sum((r["count"] - mean) ** 2 for r in found) / 300
    assert abs(mean - 100) < 3 and 70 < variance < 135


def test_rates_meet_the_weights(spark, make_docs):
    rows = [(i, "x" * 9, "big") for i in range(90)] + [(100 + i, "x" * 9, "small") for i in range(9)] + [(200, None, None)]
    docs = make_docs(rows, clashing=True)
    rates = {r.source: r.rate for r in mixing.source_rates(docs, {"big": 1.0, "small": 1.0}).collect()}
    assert abs(rates["big"] * 900 - rates["small"] * 90) < 1e-6 and rates[None] == 0
    default = {r.source: r.rate for r in mixing.source_rates(docs).collect()}
    assert default["big"] < 1 < default["small"] < default[None]
    assert abs(sum(r * s for r, s in ((default["big"], 900), (default["small"], 90), (default[None], 1))) - 991) < 1e-6


def test_copies_are_whole_rows_and_do_not_depend_on_partitions(make_docs, odd_rows):
    rows = [(row[0], row[1], source) for row, source in zip(odd_rows * 3, ["a", "b", None] * 13)]
    docs = make_docs(rows, clashing=True)
    one, two = mixing.mix(docs, seed=5), mixing.mix(docs.repartition(5), seed=5)
    assert one.columns == docs.columns
    texts = lambda df: sorted(str((r.doc_id, r.text, r.source)) for r in df.collect())
    assert texts(one) == texts(two)


def test_order_is_a_shuffle(spark, make_docs):
    rates = spark.createDataFrame([("a", 3.0)], "source string, rate double")
    copies = mixing.replicate(make_docs([(i, "x", "a") for i in range(200)]), rates).collect()
    keys = [r.shuffle_key for r in copies]
    assert len(set(keys)) == len(keys)
    ids = [r.row.doc_id for r in sorted(copies, key=lambda r: r.shuffle_key)]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.65 * len(ids)


def test_rows_without_an_id_are_drawn_each_for_itself(spark, make_docs):
    docs = make_docs([(None, f"text {i}", "a") for i in range(400)] + [(None, "text 0", "b")])
    rates = spark.createDataFrame([("a", 0.5), ("b", 3.0)], "source string, rate double")
    copies = mixing.replicate(docs, rates).select("row.text", "row.source", "shuffle_key").collect()
    assert 150 < sum(r.source == "a" for r in copies) < 250
    assert len({r.shuffle_key for r in copies}) == len(copies)
    again = mixing.replicate(docs.repartition(5), rates).select("row.text", "row.source", "shuffle_key").collect()
    assert sorted(copies) == sorted(again)


def test_no_python_in_the_plan(make_docs):
    plan = mixing.mix(make_docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_empty_table_and_no_weight(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs([(1, "x")]), {}).count() == 0
