"""Logical form of a SQL text: eight lists found by splitting on clause words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigris.functions import text as T
from verdigris.functions.predicates import COMMENT, COMMENT_MARKS, QUOTED, blank_out

# Stop words are tried in this order, not in the order of the text.
FROM_STOPS = ["WHERE", "GROUP BY", "ORDER BY", "HAVING", "LIMIT", "JOIN"]
WHERE_STOPS = ["GROUP BY", "ORDER BY", "HAVING", "LIMIT"]
GROUP_STOPS = ["ORDER BY", "HAVING", "LIMIT"]
ORDER_STOPS = ["LIMIT"]
HAVING_STOPS = ["ORDER BY", "LIMIT"]
JOIN_WORDS = ["INNER JOIN", "LEFT JOIN", "RIGHT JOIN", "FULL JOIN", "CROSS JOIN", "JOIN"]
OPERATION_WORDS = ["SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "DROP", "ALTER"]

# Weights in hundredths. Integers keep the score free of rounding in the sum.
WEIGHTS = {
    "operations": 20,
    "select_columns": 20,
    "from_tables": 20,
    "where_conditions": 15,
    "join_clauses": 10,
    "group_by_columns": 5,
    "order_by_columns": 5,
    "having_conditions": 5,
}
COMPARED_AS_LISTS = {"where_conditions", "having_conditions"}


def without_comments(sql: Column) -> Column:
    """Upper-cased text with comments removed and literals kept."""
    kept = F.regexp_replace(sql, f"({QUOTED})|{COMMENT}", "$1")
    return F.upper(F.when(T.contains_any(sql, COMMENT_MARKS), kept).otherwise(sql))


def until_stop(part: Column, stops: Sequence[str]) -> Column:
    """Cut at the first stop word of the list that occurs anywhere in the part."""
    return T.let(
        T.first_literal_found(part, stops),
        lambda stop: F.when(stop.isNull(), part).otherwise(F.split_part(part, stop, F.lit(1))),
    )


def clause(text: Column, word: str, stops: Sequence[str]) -> Column:
    """Text between the first and the second clause word, cut at a stop; null without the word."""
    part = T.let(T.after_first(text, word), lambda rest: until_stop(rest, stops))
    return F.when(text.contains(word), part)


def clause_items(text: Column, word: str, stops: Sequence[str]) -> Column:
    return F.coalesce(T.comma_items(clause(text, word, stops)), T.no_strings())


def clause_whole(text: Column, word: str, stops: Sequence[str]) -> Column:
    part = T.strip(clause(text, word, stops))
    return F.filter(F.array(part), lambda whole: whole.isNotNull())


def operations_outside_parentheses(blanked: Column) -> Column:
    """Operation words outside every closed pair of parentheses.

    The fold keeps one list per open parenthesis. A closing one drops the words of its pair; a
    parenthesis that is never closed hides nothing.
    """
    words = "|".join(OPERATION_WORDS)
    tokens = F.regexp_extract_all(blanked, F.lit(rf"[()]|\b(?:{words})\b"), F.lit(0))
    nothing = F.array(T.no_strings())

    def step(open_lists: Column, token: Column) -> Column:
        outer = F.slice(open_lists, F.lit(1), F.size(open_lists) - 1)
        inner = F.concat(F.element_at(open_lists, -1), F.array(token))
        return (
            F.when(token == "(", F.concat(open_lists, nothing))
            .when((token == ")") & (F.size(open_lists) > 1), outer)
            .when(token == ")", open_lists)
            .otherwise(F.concat(outer, F.array(inner)))
        )

    return F.flatten(F.aggregate(tokens, nothing, step))


def top_level_operations(blanked: Column) -> Column:
    """Operation words at the top level, in text order.

    The fold runs only on text with an operation word behind a parenthesis.
    """
    words = "|".join(OPERATION_WORDS)

    def choose(text: Column, head: Column) -> Column:
        tail = F.substring(text, F.length(head) + 1, F.length(text))
        plain = F.regexp_extract_all(head, F.lit(rf"\b(?:{words})\b"), F.lit(0))
        return F.when(
            T.contains_any(tail, OPERATION_WORDS), operations_outside_parentheses(text)
        ).otherwise(plain)

    return T.let(
        blanked, lambda text: T.let(T.before(text, "("), lambda head: choose(text, head))
    )


def logical_form(sql: Column) -> Column:
    """Struct of eight lists; null for blank or null text."""

    def build(text: Column) -> Column:
        lists = {
            "operations": top_level_operations(blank_out(sql)),
            "select_columns": clause_items(text, "SELECT", ["FROM"]),
            "from_tables": F.filter(
                clause_items(text, "FROM", FROM_STOPS), lambda table: table != ""
            ),
            "where_conditions": clause_whole(text, "WHERE", WHERE_STOPS),
            "join_clauses": T.literals_found(text, JOIN_WORDS),
            "group_by_columns": clause_items(text, "GROUP BY", GROUP_STOPS),
            "order_by_columns": clause_items(text, "ORDER BY", ORDER_STOPS),
            "having_conditions": clause_whole(text, "HAVING", HAVING_STOPS),
        }
        return F.struct(*[lists[name].alias(name) for name in WEIGHTS])

    return F.when(T.strip(sql) != "", T.let(without_comments(sql), build))


def same_component(name: str, predicted: Column, truth: Column) -> Column:
    if name in COMPARED_AS_LISTS:
        return predicted == truth
    same_set = F.sort_array(F.array_distinct(predicted)) == F.sort_array(F.array_distinct(truth))
    return (predicted == truth) | same_set


def compare_forms(predicted_form: Column, truth_form: Column) -> Column:
    """Struct of one match flag per component, ``exact`` and the score in ``hundredths``.

    A form that is null matches nothing.
    """

    def flags(mine: Column, theirs: Column) -> Column:
        return F.struct(
            *[
                F.coalesce(same_component(name, mine[name], theirs[name]), F.lit(False)).alias(
                    f"{name}_match"
                )
                for name in WEIGHTS
            ]
        )

    def verdict(matches: Column) -> Column:
        fields = [matches[f"{name}_match"] for name in WEIGHTS]
        exact, hundredths = F.lit(True), F.lit(0)
        for matched, weight in zip(fields, WEIGHTS.values()):
            exact = exact & matched
            hundredths = hundredths + F.when(matched, F.lit(weight)).otherwise(0)
        return F.struct(
            *[field.alias(f"{name}_match") for name, field in zip(WEIGHTS, fields)],
            exact.alias("exact"),
            hundredths.alias("hundredths"),
        )

    matches = T.let(F.array(predicted_form, truth_form), lambda two: flags(two[0], two[1]))
    return T.let(matches, verdict)


def compare_sql(predicted: Column, truth: Column) -> Column:
    """``compare_forms`` of two texts; equal texts have equal forms, which then stay unbuilt."""
    all_equal = F.struct(
        *[F.lit(True).alias(f"{name}_match") for name in WEIGHTS],
        F.lit(True).alias("exact"),
        F.lit(sum(WEIGHTS.values())).alias("hundredths"),
    )

    def compare(two: Column) -> Column:
        built = T.let(F.transform(two, logical_form), lambda both: compare_forms(both[0], both[1]))
        same_text = (two[0] == two[1]) & (T.strip(two[1]) != "")
        return F.when(same_text, all_equal).otherwise(built)

    return T.let(F.array(predicted, truth), compare)
