"""Turn (context, question, answer) rows into chat records, and chat records back into columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.functions import text as T


@dataclass(frozen=True)
class ConversationStyle:
    """System text with a ``{schema}`` slot, and whether the answer is stripped."""

    system_template: str
    strip_answer: bool


# The two system texts in use.
STRIPPED = ConversationStyle(
    "You are an text to SQL query translator. Users will ask you questions in English and you will "
    "generate a SQL query based on the provided SCHEMA.\nSCHEMA:\n{schema}",
    strip_answer=True,
)
VERBATIM = ConversationStyle(
    "You are a text-to-SQL query translator. Users will ask questions in English and you will "
    "generate a SQL query based on the provided SCHEMA.\nSCHEMA:\n{schema}",
    strip_answer=False,
)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def conversation(style: ConversationStyle = VERBATIM) -> Column:
    """System, user and assistant message of a row with context, question and answer."""
    system = F.replace(F.lit(style.system_template), F.lit("{schema}"), F.col("context"))
    answer = T.strip(F.col("answer")) if style.strip_answer else F.col("answer")
    return F.array(
        message("system", system),
        message("user", F.col("question")),
        message("assistant", answer),
    )


def to_conversations(
    df: DataFrame, style: ConversationStyle = VERBATIM, keep: tuple[str, ...] = ("row_id",)
) -> DataFrame:
    """Chat records; every column but ``keep`` is dropped."""
    return df.select(*keep, conversation(style).alias("messages"))


def group_turns(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(key, messages): a table with one row per turn as chat records, turns in order.

    A record is one row, as it is everywhere else; equal numbers are put in order by role and text. A
    turn without a key belongs to no conversation: it is a record of its own, and needs no shuffle.
    """
    in_order = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(role), F.col(text))))
    grouped = turns.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.transform(in_order, lambda t: F.struct(t[role].alias("role"), t[text].alias("content"))).alias("messages")
    )
    alone = F.array(F.struct(F.col(role).alias("role"), F.col(text).alias("content"))).alias("messages")
    return grouped.unionByName(turns.filter(F.col(key).isNull()).select(key, alone))


def unpack_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Add ``system``, ``question`` and ``ground_truth``: first, last but one and last message.

    Positions that a short record does not have give null.
    """
    positions = {"system": 1, "question": -2, "ground_truth": -1}
    return df.withColumns(
        {
            name: F.try_element_at(messages, F.lit(position))["content"]
            for name, position in positions.items()
        }
    )


# Fixed value: shown where no schema is found.
EXAMPLE_SCHEMA = "CREATE TABLE example (id INT, name VARCHAR(100));"


def first_schema(messages: Column) -> Column:
    """First CREATE TABLE text behind ``SCHEMA:`` in the first system message that names a schema."""
    systems = F.filter(
        messages,
        lambda m: (m["role"] == "system") & F.contains(m["content"], F.lit("SCHEMA")),
    )
    part = T.strip(T.after_first(F.get(systems, F.lit(0))["content"], "SCHEMA:"))
    return T.let(
        part,
        lambda text: F.when(
            text.contains("CREATE TABLE"), F.concat(T.before(text, ";"), F.lit(";"))
        ),
    )


def size_class(n_rows: Column) -> Column:
    """Label of a corpus size. The labels and their limits."""
    return (
        F.when(n_rows < 1_000, "n<1K")
        .when(n_rows < 10_000, "1K<n<10K")
        .when(n_rows < 100_000, "10K<n<100K")
        .otherwise("n>100K")
    )


def corpus_profile(df: DataFrame, messages: str = "messages") -> DataFrame:
    """One row: size, example schema, question length in words, share of multi-table schemas."""
    unpacked = unpack_messages(df, messages)
    words = F.regexp_count(T.collapse_whitespace(T.strip(F.col("question"))), F.lit("[^ ]+"))
    tables = F.regexp_count(F.col("system"), F.lit("CREATE TABLE"))
    totals = unpacked.select(
        words.alias("words"), tables.alias("tables"), first_schema(F.col(messages)).alias("schema")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("schema").alias("schema"),
        F.sum("words").alias("question_words"),
        F.min("words").alias("min_question_words"),
        F.max("words").alias("max_question_words"),
        F.count_if(F.col("tables") == 1).alias("single_table_rows"),
        F.count_if(F.col("tables") > 1).alias("multi_table_rows"),
    )
    return totals.select(
        "n_rows",
        size_class(F.col("n_rows")).alias("size_class"),
        F.coalesce("schema", F.lit(EXAMPLE_SCHEMA)).alias("example_schema"),
        F.try_divide("question_words", "n_rows").alias("avg_question_words"),
        "min_question_words",
        "max_question_words",
        "single_table_rows",
        "multi_table_rows",
    )
