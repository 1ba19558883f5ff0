"""Get one SQL statement out of raw model text, and flag the talk around it."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdigris.functions import text as T

# Patterns that end a statement, tried in this order, each with a word without which
# it cannot match. "Here" has no closing word boundary.
TAIL_PATTERNS = [
    (r"\bMarilyn\b", "marilyn"),
    (r"\bI am\b", "i am"),
    (r"\bYou are\b", "you are"),
    (r"\bThe (answer|query|SQL|result)\b", "the "),
    (r"\bWhat (is|was|are)\b", "what "),
    (r"\bWhich\b", "which"),
    (r"\bNote:", "note:"),
    (r"\bHere", "here"),
]
# Phrases that show a model talking on after the statement; case matters.
STOP_PHRASES = [
    "Marilyn", "assistant", "Note:", "The ", "What ", "Which ", "I am", "You are", "Here", "This",
]
NON_ASCII = "non_ascii"
# Fixed value: texts shorter than this many tokens are never flagged.
MIN_TOKENS = 5

Rule = Callable[[Column], Column]


def fold(text: Column) -> Column:
    """Lower case, with the letters that a case-insensitive pattern takes for ASCII ones made ASCII.

    These are the dotless i, the long s, the Kelvin sign and the dotted capital I, the last of which
    lowers to an i and a combining dot.
    """
    folded = F.translate(F.lower(text), "\u0131\u017f\u0307", "is")
    return F.when(T.has_non_ascii(text), folded).otherwise(F.lower(text))


def keep_reply(text: Column) -> Column:
    """What follows the first whole word ``assistant``."""
    reply = T.strip(F.regexp_replace(text, r"(?siU)\A.*?\bassistant\b", ""))
    return F.when(F.lower(text).contains("assistant"), reply).otherwise(text)


def drop_marker_tail(text: Column) -> Column:
    tail_off = T.strip(T.cut_from(text, r"<\|[^|]*\|>"))
    return F.when(text.contains("<|"), tail_off).otherwise(text)


def drop_role_tail(text: Column) -> Column:
    """Cut at a whole word ``system`` or ``user``, also where it names a table."""
    tail_off = T.strip(T.cut_from(text, r"\b(?:system|user)\b", "siU"))
    possible = T.let(fold(text), lambda folded: T.contains_any(folded, ["system", "user"]))
    return F.when(possible, tail_off).otherwise(text)


def drop_fences(text: Column) -> Column:
    fences_off = T.strip(F.regexp_replace(text, "(?iu)```(?:sql)?", ""))
    return F.when(text.contains("```"), fences_off).otherwise(text)


def drop_talk_tail(text: Column) -> Column:
    """Cut at the first pattern of the list that occurs anywhere in the text."""

    def cut(folded: Column) -> Column:
        result = text
        for pattern, word in reversed(TAIL_PATTERNS):
            found = folded.contains(word) & text.rlike(f"(?iU){pattern}")
            tail_off = T.strip(T.cut_from(text, pattern, "siU"))
            result = F.when(found, tail_off).otherwise(result)
        possible = T.contains_any(folded, [word for _, word in TAIL_PATTERNS])
        return F.when(possible, result).otherwise(text)

    # Nearly all SQL holds "where", which is no "here" at a word boundary and hides none.
    return T.let(F.replace(fold(text), F.lit("where"), F.lit("")), cut)


def drop_non_ascii_tail(text: Column) -> Column:
    tail_off = T.strip(T.cut_from(text, r"[^\x00-\x7F]"))
    return F.when(T.has_non_ascii(text), tail_off).otherwise(text)


def first_statement(text: Column) -> Column:
    """Up to the first semicolon; without one, up to the first blank line or ruler."""
    paragraph = text
    for separator in ["\n\n", "\n---\n", "\n###"]:
        paragraph = T.strip(T.before(paragraph, separator))
    statement = F.concat(T.strip(T.before(text, ";")), F.lit(";"))
    return F.when(text.contains(";"), statement).otherwise(paragraph)


RULES: list[Rule] = [
    keep_reply, drop_marker_tail, drop_role_tail, drop_fences, drop_talk_tail,
    drop_non_ascii_tail, first_statement,
]


def apply_rules(raw: Column, rules: Iterable[Rule]) -> Column:
    text = T.strip(F.coalesce(raw, F.lit("")))
    for rule in rules:
        text = T.let(text, rule)
    return text


def extract_sql(raw: Column) -> Column:
    """The SQL statement in a raw completion text; empty when there is none."""
    return apply_rules(raw, RULES)


def cut_at_role_word(raw: Column) -> Column:
    """True when the rule for ``system`` and ``user`` shortens the text, maybe wrongly."""
    before_rule = apply_rules(raw, RULES[: RULES.index(drop_role_tail)])
    return T.let(before_rule, lambda text: drop_role_tail(text) != text)


def token_count(text: Column) -> Column:
    """Approximate token count: runs of word characters, and single other marks."""
    return F.regexp_count(text, F.lit(r"(?U)\w+|[^\w\s]"))


# A token with the white space in front of it.
SPACED_TOKEN = r"(?U)\s*(?:\w+|[^\w\s])"


def _first_marker_end(text: Column) -> Column:
    """Number of characters after which some marker is complete for the first time; null without one."""
    phrases = T.literals_found(text, STOP_PHRASES)
    ends = F.transform(phrases, lambda phrase: F.instr(text, phrase) + F.length(phrase) - 1)
    other = F.when(T.has_non_ascii(text), F.regexp_instr(text, F.lit(r"[^\x00-\x7F]")))
    return F.array_min(F.concat(ends, F.array(other)))


def generation_stop(raw: Column) -> Column:
    """Where generation token by token would have stopped: struct(stop_token, stop_marker, kept_text, n_tokens, tokens_saved).

    From the fifth token on the text so far is looked at after every token; the first one that completes
    a marker is the last one kept. A marker that ends with a space is complete with the next token. Of
    several markers in the kept text the first of the list is named. Without a stop the first two are
    null, the text is kept whole and nothing is saved; null counts as empty.
    """

    def stop(text: Column, end: Column, total: Column) -> Column:
        start = F.substring(text, F.lit(1), end)
        at_space = F.rlike(F.substring(text, end, F.lit(1)), F.lit(r"(?U)\A\s"))
        # The token that holds the marker's last character, or the one behind it.
        token = token_count(start) + F.when(at_space, 1).otherwise(0)
        rest = F.substring(text, end + 1, F.length(text))
        # What is left of that token behind the marker: nothing for a single mark.
        in_word = F.rlike(F.substring(text, end, F.lit(1)), F.lit(r"(?U)\A\w"))
        tail = F.when(at_space, F.regexp_extract(rest, rf"\A{SPACED_TOKEN}", 0)).when(
            in_word, F.regexp_extract(rest, r"(?U)\A\w*", 0)
        ).otherwise("")
        early = F.regexp_extract(text, rf"\A(?:{SPACED_TOKEN}){{{MIN_TOKENS}}}", 0)
        kept = F.when(token <= MIN_TOKENS, early).otherwise(F.concat(start, tail))
        stopped = F.greatest(token, F.lit(MIN_TOKENS))
        return T.let(
            F.when(end.isNotNull() & (stopped <= total), F.struct(stopped.alias("token"), kept.alias("text"))),
            lambda found: F.struct(
                found["token"].alias("stop_token"),
                F.when(found.isNotNull(), F.coalesce(T.first_literal_found(found["text"], STOP_PHRASES), F.lit(NON_ASCII))).alias("stop_marker"),
                F.coalesce(found["text"], text).alias("kept_text"),
                total.alias("n_tokens"), F.coalesce(total - found["token"], F.lit(0)).alias("tokens_saved"),
            ),
        )

    def build(text: Column) -> Column:
        return T.let(_first_marker_end(text), lambda end: T.let(token_count(text), lambda total: stop(text, end, total)))

    return T.let(F.coalesce(raw, F.lit("")), build)


def stop_markers(raw: Column) -> Column:
    """Stop phrases found in the text, then ``non_ascii``; empty below five tokens."""

    def found(text: Column) -> Column:
        other = F.when(T.has_non_ascii(text), F.array(F.lit(NON_ASCII))).otherwise(T.no_strings())
        markers = F.concat(T.literals_found(text, STOP_PHRASES), other)
        return F.when(token_count(text) >= MIN_TOKENS, markers).otherwise(T.no_strings())

    return T.let(F.coalesce(raw, F.lit("")), found)
