import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from verdigris.llm import queries
from verdigris.verification.compare import difference, register_tables


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, sf_dir, name):
    database = duckdb.connect()
    register_tables(database, sf_dir)
    found = entry.queries()[name](spark, sf_dir).toPandas()
    assert difference(found, database.sql(entry.oracle_sql()[name]).df()) is None


def test_every_operator_has_one_query():
    names = [name.split("_")[0] for name in queries.all_queries()]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_stages_in_turn(spark, sf_dir):
    """Each stage keeps the columns, works on what the one before kept, and loses nothing at the end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        path = corpus_pipeline.scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 < counts[4]
    packed = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    rows = docs.collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [0] for r in rows}
    assert sum(p.length for p in packed) == sum(len(ids[r.doc_id]) for r in rows)
    for p in packed:
        assert zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32


def test_empty_tables(spark, tmp_path, make_docs):
    docs = make_docs([])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_through_all_stages(spark, tmp_path, make_docs, odd_rows):
    """Null ids, texts and sources, very long texts, repeated rows and clashing columns; clean documents stay."""
    pick = random.Random(1)
    words = ["river", "stone", "walks", "under", "green", "light", "music", "table", "quiet", "seven", "north", "bread", "cloud", "paper"]
    clean = lambda: " ".join("".join(pick.choices(words, k=2)) for _ in range(90))
    junk = lambda: " ".join("#$%" * pick.randint(1, 4) + str(pick.randint(0, 10**9)) for _ in range(90))
    good = [(n, clean()) for n in range(100, 180)]
    bad = [(n, junk()) for n in range(200, 280)]
    alone = [(None, clean(), None), (None, clean(), "t"), (300, clean(), None), (300, clean(), "t")]
    copies = [good[0], good[0], (301, good[1][1] + "  "), (302, good[2][1] + " end"), (303, " ".join([clean() for _ in range(300)]))]
    make_docs(odd_rows + good + bad + alone + copies, clashing=True).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(n, 1, 0) for n, _ in good] + [(n, 0, 0) for n, _ in bad] + [(None, None, None), (6, None, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, counts = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = corpus_pipeline.scratch_path(spark, name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
    kept = [(row.doc_id, row.text) for row in docs.collect()]
    # Of copies and near copies one stays, and so does every clean text, with an id or without.
    assert sorted(n for n, _ in kept if n is not None and n < 200) == list(range(100, 180))
    assert {text for _, text, _ in alone} <= {text for _, text in kept} and 303 in {n for n, _ in kept}
    assert not {n for n, _ in kept if n is not None} & {*range(200, 280), 301, 302} and len(kept) == len(set(kept))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert packed and {p.doc_id for p in packed} <= {n for n, _ in kept}
