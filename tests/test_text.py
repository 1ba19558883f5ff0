"""Text helpers against Python's own string methods, on texts over an awkward alphabet."""

import random
import re

import pytest
from pyspark.sql import functions as F

from verdigris.functions import text as T

ALPHABET = list("aB;'\" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0é") + list(T.WHITESPACE) + ["ſ", "ß", "漢", "😀", "FROM", "--"]


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(7)
    drawn = ["".join(draw.choices(ALPHABET, k=draw.randrange(12))) for _ in range(3000)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(drawn)], "i int, t string").cache()


def compare(texts, column, expected):
    rows = texts.select("t", column.alias("got")).collect()
    wrong = [(r.t, r.got, expected(r.t)) for r in rows if r.got != expected(r.t)]
    assert not wrong, wrong[:3]


def test_whitespace_set_is_that_of_python():
    assert set(T.WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize(
    "column, expected",
    [
        (T.strip, str.strip),
        (T.collapse_whitespace, lambda t: re.sub(r"\s+", " ", t)),
        (T.has_non_ascii, lambda t: not t.isascii()),
        (lambda t: T.before(t, ";"), lambda t: t.split(";")[0]),
        (lambda t: T.after_first(t, "FROM"), lambda t: t.split("FROM")[1] if "FROM" in t else ""),
        (lambda t: T.comma_items(F.replace(t, F.lit(";"), F.lit(","))),
         lambda t: [item.strip() for item in t.replace(";", ",").split(",")]),
        (lambda t: T.contains_any(t, ["FROM", "é"]), lambda t: "FROM" in t or "é" in t),
        (lambda t: T.literals_found(t, ["é", "FROM", "B"]), lambda t: [w for w in ("é", "FROM", "B") if w in t]),
        (lambda t: T.first_literal_found(t, ["FROM", "B"]),
         lambda t: "FROM" if "FROM" in t else "B" if "B" in t else None),
        (lambda t: T.cut_from(t, "[;'é]"), lambda t: re.split("[;'é]", t)[0]),
    ],
)
def test_against_python(texts, column, expected):
    compare(texts, column(F.col("t")), expected)


def test_let_computes_its_value_once(spark):
    drawn = spark.range(200).select(T.let(F.rand(1), lambda v: v == v).alias("same"), T.let(F.rand(1), lambda v: v - v).alias("zero"))
    assert all(r.same and r.zero == 0 for r in drawn.collect())
