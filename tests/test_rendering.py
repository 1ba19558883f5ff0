from pyspark.sql import functions as F

from verdigris.functions import rendering as R
from verdigris.operators import rendering as texts

SCHEMA = "row_id int, messages array<struct<role: string, content: string>>"


def test_templates(spark):
    df = spark.createDataFrame([(1, [("system", "s"), ("user", "q")])], SCHEMA)
    m = F.col("messages")
    chatml, opened, headers = df.select(
        R.CHATML.render(m), R.CHATML.render(m, True), R.HEADERS.render(m, True)
    ).collect()[0]
    assert chatml == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
    assert opened == chatml + "<|im_start|>assistant\n"
    assert headers == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\ns<|eot_id|>"
        "<|start_header_id|>user<|end_header_id|>\n\nq<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )


def test_inference_prompts(spark):
    df = spark.createDataFrame([("q%s", "c")], "question string, context string")
    q, c = F.col("question"), F.col("context")
    plain, short = df.select(R.inference_prompt(q, c), R.short_prompt(q, c)).collect()[0]
    assert plain == R.INFERENCE_SYSTEM + "\n\n### Context:\nc\n\n### Question:\nq%s\n\n### SQL:"
    assert short == "Schema: c\nQuestion: q%s\nSQL:"


def test_format_report(spark):
    df = spark.createDataFrame(
        [("x<|im_start|>assistant\n",), ("assistant x",), ("say assistant 　",)], "text string"
    )
    report = texts.format_report(df).collect()[0]
    assert (report.n_texts, report.n_ends_open) == (3, 2)


def test_length_profile(spark):
    df = spark.createDataFrame([("a b, c!",), ("é",), ("x " * 3000,)], "text string")
    got = texts.length_profile(df).collect()[0]
    assert (got.n_texts, got.total_tokens, got.min_tokens, got.max_tokens) == (3, 3006, 1, 3000)
    assert (got.p50_tokens, got.n_over_limit) == (5.0, 1)


def test_null_parts_keep_their_turn(spark):
    df = spark.createDataFrame([(1, [("system", None), (None, "q"), ("user", "r")])], SCHEMA)
    row = df.select(R.CHATML.render(F.col("messages")).alias("text"), texts.null_parts().alias("n")).first()
    assert row.text == "<|im_start|>system\n<|im_end|>\n<|im_start|>\nq<|im_end|>\n<|im_start|>user\nr<|im_end|>\n" and row.n == 2


def test_packed_tokens_are_all_there(spark):
    from verdigris.operators.packing import pack_sequences

    rows = [(i, "w " * n) for i, n in enumerate([0, 1, 5, 7, 30, 64, 3, 9, 100, 2] * 5)] + [(99, None)]
    df = spark.createDataFrame(rows, "row_id int, text string")
    spans = pack_sequences(df, limit=16, shard_tokens=200).collect()
    assert len({s.shard for s in spans}) > 3
    by_text, by_pack = {}, {}
    for s in spans:
        by_text.setdefault(s.row_id, []).append((s.token_start, s.token_end))
        by_pack.setdefault((s.shard, s.pack), []).append((s.pack_offset, s.pack_offset + s.token_end - s.token_start))
    for number, text in rows:
        ends = sorted(by_text.get(number, [(0, 0)]))
        assert ends[0][0] == 0 and ends[-1][1] == len((text or "").split()) and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    for key, places in by_pack.items():
        places = sorted(places)
        assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:]))
        last = max(pack for shard, pack in by_pack if shard == key[0])
        assert places[-1][1] == 16 or key[1] == last
    assert pack_sequences(df.filter("row_id = 99")).count() == 0
