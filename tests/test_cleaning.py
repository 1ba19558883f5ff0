import random
import re

from pyspark.sql import functions as F

from verdigris.functions import cleaning
from verdigris.functions.cleaning import cut_at_role_word, extract_sql, stop_markers

GOLDEN = [
    (None, ""),
    ("SELECT 1; drop", "SELECT 1;"),
    (" ; ", ";"),
    ("SELECT name FROM user WHERE id = 1", "SELECT name FROM"),
    ("SELECT id FROM users", "SELECT id FROM users"),
    ("```sql\nSELECT 1\n```", "SELECT 1"),
    ("```SQL\nSELECT 1\n```", "SELECT 1"),
    ("system\ns\nuser\nq\nassistant\nSELECT 1", "SELECT 1"),
    (
        "You are a helpful assistant that converts text.user\nq\nassistant\nSELECT 1",
        "that converts text.",
    ),
    ("assistants SELECT 1", "assistants SELECT 1"),
    ("SELECT 1<|im_end|>x", "SELECT 1"),
    ("Which one; Note: x", ""),
    ("SELECT a\nFROM t Here you go. Note: You are", "SELECT a\nFROM t Here you go. Note:"),
    ("SELECT heredity FROM t", "SELECT"),
    ("SELECT a WHERE b here", "SELECT a WHERE b"),
    ("SELECT whereabouts, a FROM t", "SELECT whereabouts, a FROM t"),
    ("SELECT where HEREin", "SELECT where"),
    ("SELECT 'é' FROM t", "SELECT '"),
    ("SELECT a\n\nwhy", "SELECT a"),
    ("SELECT a FROM t\n---\nx", "SELECT a FROM t"),
    ("SELECT a FROM t\n### x", "SELECT a FROM t"),
    ("SELECT a FROM tſer", "SELECT a FROM t"),
    ("SELECT a FROM ſystem x", "SELECT a FROM"),
    ("SELECT a FROM uſer", "SELECT a FROM"),
    ("SELECT a Marİlyn b", "SELECT a"),
    ("SELECT a thıs ı am b", "SELECT a th"),
    ("SELECT a WhİcH b", "SELECT a"),
    ("　SELECT a\x1f", "SELECT a"),
    ("SELECT a FROM t The QUERY is", "SELECT a FROM t"),
    ("SELECT a FROM t Theory", "SELECT a FROM t Theory"),
]


def test_extract_sql_golden(spark):
    cases = spark.createDataFrame(
        [(i, raw, want) for i, (raw, want) in enumerate(GOLDEN)], "i int, raw string, want string"
    )
    rows = cases.withColumn("got", extract_sql(F.col("raw"))).orderBy("i").collect()
    assert [(r.raw, r.got) for r in rows] == [(r.raw, r.want) for r in rows]


def test_filter_on_the_result_does_not_blow_up_the_plan(spark):
    raw = spark.createDataFrame([("SELECT 1;",), ("Which",)], "raw string")
    cleaned = raw.withColumn("sql", extract_sql(F.col("raw"))).filter("sql <> '' AND sql LIKE 'S%'")
    assert [r.sql for r in cleaned.collect()] == ["SELECT 1;"]
    assert len(cleaned._jdf.queryExecution().optimizedPlan().toString()) < 60_000


def test_role_word_flag(spark):
    raw = spark.createDataFrame(
        [("SELECT a FROM user",), ("SELECT a FROM users",), (None,)], "raw string"
    )
    assert [r[0] for r in raw.select(cut_at_role_word(F.col("raw"))).collect()] == [True, False, False]


def test_stop_markers(spark):
    raw = spark.createDataFrame(
        [
            ("SELECT a FROM t Note: The end",),
            ("The a",),
            ("SELECT a FROM té x",),
            ("SELECT a FROM the thing",),
            (None,),
        ],
        "raw string",
    )
    got = [r[0] for r in raw.select(stop_markers(F.col("raw"))).collect()]
    assert got == [["Note:", "The "], [], ["non_ascii"], [], []]


def stop_by_steps(text):
    """The definition: look at the text after every token from the fifth on."""
    ends = [match.end() for match in re.finditer(r"\w+|[^\w\s]", text)]
    for n, end in enumerate(ends, 1):
        part = text[:end]
        found = [phrase for phrase in cleaning.STOP_PHRASES if phrase in part]
        if n >= cleaning.MIN_TOKENS and (found or not part.isascii()):
            return n, found[0] if found else cleaning.NON_ASCII, part, len(ends), len(ends) - n
    return None, None, text, len(ends), 0


def test_generation_stop(spark):
    pick = random.Random(7)
    words = ["SELECT", " a", " ", "The ", "The", "This", "Which one", "Note:", "Here", "é", "I am", "I  am", "assistants", ";", "(", ")", "\n", "_x1", "ThisThe ", "  "]
    texts = ["".join(pick.choices(words, k=pick.randint(0, 14))) for _ in range(800)]
    texts += ["The a b c d e", "a b c d The", "a b c d The ", "a b c d The  e", "a b c d é e", "é", "éa b c d e f", "a b c d e f Here", "Note: a"]
    rows = spark.createDataFrame([(text,) for text in texts] + [(None,)], "raw string")
    found = [tuple(row.stop) for row in rows.select(cleaning.generation_stop(F.col("raw")).alias("stop")).collect()]
    assert found == [stop_by_steps(text) for text in texts] + [stop_by_steps("")]
