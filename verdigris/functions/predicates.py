"""Per-row comparisons and screens on SQL text, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigris.functions import text as T

# Word lists that decide the results.
SQL_WORDS = [
    "SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "WITH", "FROM", "WHERE",
]
STATEMENT_WORDS = ["SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "WITH"]
DANGEROUS_WORDS = ["DROP", "DELETE", "TRUNCATE", "ALTER", "GRANT"]
STRUCTURE_FLAGS = {
    "has_select": "SELECT",
    "has_from": "FROM",
    "has_where": "WHERE",
    "has_join": "JOIN",
    "has_group_by": "GROUP BY",
    "has_order_by": "ORDER BY",
}
# The reasons.
EMPTY_REASON = "Empty SQL string"
NO_KEYWORD_REASON = "No SQL keywords found"

# Words that make a statement count as SQL in the parse-validity screen.
PARSE_WORDS = [
    "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "DROP", "ALTER", "TRUNCATE",
    "FROM", "WHERE", "JOIN", "GROUP", "ORDER", "HAVING", "LIMIT", "UNION", "VALUES", "INTO", "SET",
]

QUOTED = r"""'[^']*'|"[^"]*"|`[^`]*`"""
COMMENT = r"(?:--|# )[^\n]*|/\*(?s:.*?)\*/"
# Marks of which one must occur for the patterns above to match.
QUOTE_MARKS = ["'", '"', "`"]
COMMENT_MARKS = ["--", "# ", "/*"]


def strict_form(sql: Column) -> Column:
    """Strip, drop the semicolons at the end, lower, collapse whitespace; nothing is stripped again."""
    return T.collapse_whitespace(F.lower(F.rtrim(T.strip(sql), F.lit(";"))))


def relaxed_form(sql: Column) -> Column:
    """Lower, take the quotes off quoted values, collapse whitespace, strip; semicolons stay."""
    unquoted = F.regexp_replace(F.lower(sql), r"""["']([^"']+)["']""", "$1")
    return T.strip(T.collapse_whitespace(unquoted))


def strict_match(predicted: Column, truth: Column) -> Column:
    return T.let(
        predicted, lambda mine: (mine == truth) | (strict_form(mine) == strict_form(truth))
    )


def relaxed_match(predicted: Column, truth: Column) -> Column:
    """Neither implies nor follows from ``strict_match``."""
    return T.let(
        predicted, lambda mine: (mine == truth) | (relaxed_form(mine) == relaxed_form(truth))
    )


def looks_like_sql(sql: Column) -> Column:
    """Any statement or clause word occurs as a substring of the upper-cased text."""
    return T.let(F.upper(sql), lambda upper: T.contains_any(upper, SQL_WORDS))


def structure_flags(upper_sql: Column) -> dict[str, Column]:
    return {name: upper_sql.contains(word) for name, word in STRUCTURE_FLAGS.items()}


def structure(sql: Column) -> Column:
    """Struct of the six structure flags and the statement words found."""

    def build(upper: Column) -> Column:
        flags = [flag.alias(name) for name, flag in structure_flags(upper).items()]
        return F.struct(*flags, T.literals_found(upper, STATEMENT_WORDS).alias("keywords"))

    return T.let(F.upper(sql), build)


def structural_agreement(predicted: Column, truth: Column) -> Column:
    """Number of the six flags on which both texts agree."""

    def count(mine: Column, theirs: Column) -> Column:
        agreed = F.filter(
            F.lit(list(STRUCTURE_FLAGS.values())),
            lambda word: F.contains(mine, word) == F.contains(theirs, word),
        )
        return F.when(mine == theirs, len(STRUCTURE_FLAGS)).otherwise(F.size(agreed))

    return T.let(
        F.upper(predicted), lambda mine: T.let(F.upper(truth), lambda theirs: count(mine, theirs))
    )


def structural_similarity(agreement: Column) -> Column:
    return agreement / F.lit(len(STRUCTURE_FLAGS))


def dangerous_word(sql: Column) -> Column:
    """First word of the danger list found in the upper-cased text; null means it may pass."""
    return T.let(F.upper(sql), lambda upper: T.first_literal_found(upper, DANGEROUS_WORDS))


def blank_out(sql: Column) -> Column:
    """Upper-cased first statement with literals, quoted names and comments blanked out."""
    blanked = F.when(
        T.contains_any(sql, QUOTE_MARKS + COMMENT_MARKS),
        F.regexp_replace(sql, f"{QUOTED}|{COMMENT}", " "),
    ).otherwise(sql)
    return F.upper(T.before(blanked, ";"))


# A word as the screen sees it, in upper case.
WORD_CHARACTERS = r"[A-Z0-9_\x{80}-\x{10ffff}]"


def keyword_in_reach(blanked: Column) -> Column:
    """True when a word of the list stands outside parentheses or directly inside an outermost pair.

    A fold over words and parentheses keeps for every open pair whether it holds a word itself and
    whether a pair directly inside it does. A closed pair tells the pair around it about its own words
    only. A parenthesis that is never closed hides nothing.
    """
    listed = F.lit(PARSE_WORDS)

    def level(own: Column, inner: Column) -> Column:
        return F.struct(own.alias("own"), inner.alias("inner"))

    nothing = F.array(level(F.lit(False), F.lit(False)))

    def step(levels: Column, token: Column) -> Column:
        last = F.element_at(levels, -1)
        outer = F.slice(levels, F.lit(1), F.size(levels) - 1)

        def with_last(around: Column, held: Column, own: Column, inner: Column) -> Column:
            return F.concat(around, F.array(level(held["own"] | own, held["inner"] | inner)))

        closed = F.slice(levels, F.lit(1), F.size(levels) - 2), F.element_at(levels, -2)
        return (
            F.when(token == "(", F.concat(levels, nothing))
            .when((token == ")") & (F.size(levels) > 1), with_last(*closed, F.lit(False), last["own"]))
            .when(token == ")", levels)
            .otherwise(with_last(outer, last, F.lit(True), F.lit(False)))
        )

    def tokens(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(f"[()]|{WORD_CHARACTERS}+"), F.lit(0))
        return F.filter(found, lambda token: token.isin("(", ")") | F.array_contains(listed, token))

    def search(text: Column) -> Column:
        # Most statements begin with their word; the fold is for those that do not.
        head = F.exists(tokens(T.before(text, "(")), lambda token: F.lit(True))
        folded = F.exists(F.aggregate(tokens(text), nothing, step), lambda held: held["own"] | held["inner"])
        return head | (F.contains(text, F.lit("(")) & folded)

    return T.let(blanked, search)


def parse_error(sql: Column) -> Column:
    """Reason why the text fails the parse-validity screen; null when it passes."""
    return F.when(F.coalesce(T.strip(sql), F.lit("")) == "", F.lit(EMPTY_REASON)).when(
        ~keyword_in_reach(blank_out(sql)), F.lit(NO_KEYWORD_REASON)
    )
