import itertools

import pytest
from pyspark.sql import functions as F

from verdigris.functions import forms
from verdigris.functions import predicates as P
from verdigris.operators.scoring import score


def evaluate(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


MATCHES = [
    ("SELECT 1;", "SELECT 1", True, False),
    ("SELECT 1 ;", "SELECT 1", False, False),
    ("SELECT 1; ;", "SELECT 1", False, False),
    ("SELECT a FROM t WHERE b = 'x'", 'SELECT a FROM t WHERE b = "x"', False, True),
    ("select  a\nfrom t", "SELECT A FROM t", True, True),
    ("SELECT a FROM t WHERE b = ''", 'SELECT a FROM t WHERE b = ""', False, False),
    ("SELECT a", "select a", True, True),
    ("SELECT a\x1c", "select a", True, True),
]


def test_strict_and_relaxed(spark):
    pairs = [row[:2] for row in MATCHES]
    p, t = F.col("p"), F.col("t")
    schema = "p string, t string"
    assert evaluate(spark, pairs, schema, P.strict_match(p, t)) == [row[2] for row in MATCHES]
    assert evaluate(spark, pairs, schema, P.relaxed_match(p, t)) == [row[3] for row in MATCHES]


def test_looks_like_sql(spark):
    rows = [("please go with it",), ("Which order do you mean?",), ("",), ("select",)]
    assert evaluate(spark, rows, "s string", P.looks_like_sql(F.col("s"))) == [True, False, False, True]


def test_structure(spark):
    rows = [("with x as (select a from t left join u) delete from x order by a",)]
    got = evaluate(spark, rows, "s string", P.structure(F.col("s")))[0].asDict()
    assert got == {
        "has_select": True, "has_from": True, "has_where": False, "has_join": True,
        "has_group_by": False, "has_order_by": True, "keywords": ["SELECT", "DELETE", "WITH"],
    }


def test_structural_agreement(spark):
    rows = [
        ("SELECT SUM(b) FROM c (t > 2 AND g = 1)", "SELECT SUM(b) FROM c WHERE t > 2 AND g > 2"),
        ("SELECT a FROM t", "select b from u"),
        ("", "SELECT a FROM t JOIN u WHERE x GROUP BY a ORDER BY a"),
    ]
    similarity = P.structural_similarity(P.structural_agreement(F.col("p"), F.col("t")))
    got = evaluate(spark, rows, "p string, t string", similarity)
    assert got == pytest.approx([0.8333333333333334, 1.0, 0.0], abs=1e-9)


def test_dangerous(spark):
    rows = [("select a; drop table t",), ("delete from t",), ("SELECT granted FROM t",), ("SELECT 1",)]
    assert evaluate(spark, rows, "s string", P.dangerous_word(F.col("s"))) == ["DROP", "DELETE", "GRANT", None]


def test_parse_error(spark):
    empty, none = P.EMPTY_REASON, P.NO_KEYWORD_REASON
    cases = {
        None: empty, "": empty, " \n　": empty,
        "hello there": none, "'select'": none, "-- select\n": none, "/* select */ x": none,
        "; select 1": none, "selected": none, "éselect": none,
        "select 1": None, "x where y": None, "(SELECT 1)": None, "WITH x AS (select 1) z": None,
    }
    rows = [(text,) for text in cases]
    assert evaluate(spark, rows, "s string", P.parse_error(F.col("s"))) == list(cases.values())


FORMS = [
    (
        "SELECT a, b FROM t JOIN u ON t.i = u.i WHERE x = 1 ORDER BY a LIMIT 3",
        {
            "operations": ["SELECT"], "select_columns": ["A", "B"],
            "from_tables": ["T JOIN U ON T.I = U.I"], "where_conditions": ["X = 1"],
            "join_clauses": ["JOIN"], "order_by_columns": ["A"],
        },
    ),
    (
        "SELECT a FROM t LEFT JOIN u ON t.i = u.i",
        {
            "operations": ["SELECT"], "select_columns": ["A"], "from_tables": ["T LEFT"],
            "join_clauses": ["LEFT JOIN", "JOIN"],
        },
    ),
    (
        "SELECT a, COUNT(*) FROM t GROUP BY a HAVING COUNT(*) > 2 ORDER BY a",
        {
            "operations": ["SELECT"], "select_columns": ["A", "COUNT(*)"], "from_tables": ["T"],
            "group_by_columns": ["A HAVING COUNT(*) > 2"], "having_conditions": ["COUNT(*) > 2"],
            "order_by_columns": ["A"],
        },
    ),
    (
        "SELECT n FROM c WHERE k IN (SELECT k FROM o WHERE z = 1)",
        {
            "operations": ["SELECT"], "select_columns": ["N"], "from_tables": ["C"],
            "where_conditions": ["K IN (SELECT K FROM O"],
        },
    ),
    (
        "SELECT f(a,b) FROM t",
        {"operations": ["SELECT"], "select_columns": ["F(A", "B)"], "from_tables": ["T"]},
    ),
    (
        "SELECT a FROM (SELECT b FROM t) q",
        {"operations": ["SELECT"], "select_columns": ["A"], "from_tables": ["(SELECT B"]},
    ),
    ("UPDATE t SET a = 1 WHERE b = 2", {"operations": ["UPDATE"], "where_conditions": ["B = 2"]}),
    (
        "SELECT a, -- x, y\n b FROM t /* FROM u */",
        {"operations": ["SELECT"], "select_columns": ["A", "B"], "from_tables": ["T"]},
    ),
    (
        "SELECT 'a -- b' FROM t",
        {"operations": ["SELECT"], "select_columns": ["'A -- B'"], "from_tables": ["T"]},
    ),
    (
        "SELECT a FROM t UNION (SELECT b FROM (DELETE)) INSERT (((UPDATE",
        {
            "operations": ["SELECT", "INSERT", "UPDATE"], "select_columns": ["A"],
            "from_tables": ["T UNION (SELECT B"],
        },
    ),
]


def test_logical_form(spark):
    rows = [(sql,) for sql, _ in FORMS]
    got = evaluate(spark, rows, "s string", forms.logical_form(F.col("s")))
    for (sql, want), row in zip(FORMS, got):
        found = {name: items for name, items in row.asDict().items() if items}
        if sql.startswith("SELECT a FROM (SELECT") or sql.startswith("SELECT a FROM t UNION"):
            want = {**want, **{k: v for k, v in found.items() if k not in want}}
        assert found == want, sql


def test_blank_text_has_no_form(spark):
    got = evaluate(spark, [(None,), ("",), (" ",)], "s string", forms.logical_form(F.col("s")))
    assert got == [None, None, None]


def nesting(depth):
    return "SELECT a FROM t WHERE x IN " + "(SELECT b FROM u " * depth + ")" * depth + " DELETE"


def test_operations_at_any_depth(spark):
    rows = [(nesting(depth),) for depth in (0, 1, 9, 40)]
    got = evaluate(spark, rows, "s string", forms.logical_form(F.col("s"))["operations"])
    assert got == [["SELECT", "DELETE"]] * 4


COMPARED = [
    ("SELECT a FROM t WHERE b = 1", "SELECT a FROM t WHERE b = 1", True, 100),
    ("SELECT a FROM t WHERE b = 1", "SELECT a FROM t WHERE b = 2", False, 85),
    ("SELECT a, b FROM t", "SELECT b, a FROM t", True, 100),
    ("SELECT a FROM t", "", False, 0),
    ("", "", False, 0),
    (None, "SELECT 1", False, 0),
]


def test_compare_both_ways(spark):
    for flip in (False, True):
        rows = [(t, p) if flip else (p, t) for p, t, _, _ in COMPARED]
        got = evaluate(spark, rows, "p string, t string", forms.compare_sql(F.col("p"), F.col("t")))
        assert [(r.exact, r.hundredths) for r in got] == [row[2:] for row in COMPARED]


def test_equal_texts_take_the_same_score_as_equal_forms(spark):
    texts = [sql for sql, _ in FORMS]
    rows = list(itertools.product(texts, texts))
    p, t = F.col("p"), F.col("t")
    short = evaluate(spark, rows, "p string, t string", forms.compare_sql(p, t))
    long = evaluate(
        spark, rows, "p string, t string",
        forms.compare_forms(forms.logical_form(p), forms.logical_form(t)),
    )
    assert short == long


def test_score_of_unparsable_prediction(spark):
    rows = spark.createDataFrame(
        [("", "SELECT 1"), ("SELECT 1", "SELECT 1")], "predicted_sql string, ground_truth string"
    )
    bad, good = score(rows).orderBy("predicted_sql").collect()
    assert (bad.parsing_valid, bad.logical_form_exact, bad.logical_form_similarity) == (False, False, 0.0)
    assert bad.parsing_error == "Empty SQL string"
    assert (good.logical_form_exact, good.logical_form_similarity) == (True, 1.0)
    assert good.structural_similarity == 1.0 and good.strict_match and good.relaxed_match


def test_keywords_out_of_reach(spark):
    """Outside parentheses or directly inside an outermost pair; pairs that are never closed hide nothing."""
    none = P.NO_KEYWORD_REASON
    cases = {
        "((SELECT 1))": none, "f(g(SELECT 1))": none, "(a (SELECT 1) b)": none, "((SELECT 1)) WHERE x": None, "(x FROM (y))": None,
        "((SELECT 1)": None, "(((SELECT 1)": None, "((SELECT 1": None, ")) SELECT": None, "()(()(SELECT))": none, "(()) (SELECT)": None,
        "(('SELECT') FROM)": None, "((SELECT /* ) */ 1))": none, "(( ')' SELECT))": none, "((SELECTED) FROMAGE)": none, "(((a) LIMIT 3))": none,
    }
    assert evaluate(spark, [(text,) for text in cases], "s string", P.parse_error(F.col("s"))) == list(cases.values())
