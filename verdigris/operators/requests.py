"""Normalise batch requests, answer each distinct one once, keep the first valid attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.functions import predicates as P
from verdigris.functions import text as T

BLANK_QUESTION = "blank_question"
TOO_FEW_MESSAGES = "too_few_messages"
NO_KNOWN_KEY = "no_known_key"

# Marks in a user message that carries its own schema.
CONTEXT_MARK = "### Context:"
QUESTION_MARK = "### Question:"
SQL_MARK = "### SQL:"
SCHEMA_WORD = "CREATE TABLE"


def _read_messages(messages: Column) -> Column:
    """Struct (question, context, ground_truth) of a message list; the last of a role wins."""

    def fields(question: Column, context: Column, ground_truth: Column) -> Column:
        return F.struct(
            question.alias("question"), context.alias("context"), ground_truth.alias("ground_truth")
        )

    def from_user(seen: Column, content: Column) -> Column:
        parts = F.split(content, QUESTION_MARK)
        carries_schema = T.contains_any(content, [CONTEXT_MARK, SCHEMA_WORD])
        in_two = fields(
            T.strip(F.replace(F.get(parts, F.lit(1)), F.lit(SQL_MARK), F.lit(""))),
            T.strip(F.replace(F.get(parts, F.lit(0)), F.lit(CONTEXT_MARK), F.lit(""))),
            seen["ground_truth"],
        )
        return F.when(carries_schema & (F.size(parts) == 2), in_two).otherwise(
            fields(content, seen["context"], seen["ground_truth"])
        )

    def step(seen: Column, message: Column) -> Column:
        content = F.coalesce(message["content"], F.lit(""))
        return (
            F.when(
                message["role"] == "system",
                fields(seen["question"], content, seen["ground_truth"]),
            )
            .when(message["role"] == "user", from_user(seen, content))
            .when(
                message["role"] == "assistant", fields(seen["question"], seen["context"], content)
            )
            .otherwise(seen)
        )

    nothing = fields(F.lit(""), F.lit(""), F.lit(None).cast("string"))
    return F.aggregate(messages, nothing, step)


def _is_variant(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "variant"


def parse_requests(requests: DataFrame) -> DataFrame:
    """Add ``request`` (question, context, ground_truth) and ``reject_reason``.

    A record with a ``question`` key is of the first format whatever else it holds, so a blank
    question rejects it. Blank is what has no truth by the type of the value: null, false, 0, an empty
    text, list or object; the text ``"0"`` is a question. Rejected records stay, with a reason.
    """
    plain_question = F.col("question").cast("string")
    context = F.when(F.col("context").isNull(), F.lit("")).otherwise(
        F.col("context").cast("string")
    )
    plain = F.struct(
        plain_question.alias("question"), context.alias("context"),
        F.col("query").alias("ground_truth"),
    )
    is_plain = F.col("question").isNotNull()
    parsed = requests.withColumn(
        "request", F.when(is_plain, plain).otherwise(_read_messages(F.col("messages")))
    )
    kind = F.schema_of_variant(F.col("question")) if _is_variant(requests, "question") else F.lit("STRING")
    plain_text = F.coalesce(plain_question, F.lit(""))
    untrue = (
        F.when(kind == "STRING", plain_text == "")
        .when(kind == "BOOLEAN", plain_text == "false")
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), plain_text.isin("[]", "{}", ""))
        .when(kind == "VOID", True)
        .otherwise(plain_text.cast("double") == 0)
    )
    blank = F.when(is_plain, untrue).otherwise(F.coalesce(F.col("request.question"), F.lit("")) == "")
    reason = (
        F.when(~is_plain & F.col("messages").isNull(), NO_KNOWN_KEY)
        .when(~is_plain & (F.size("messages") < 2), TOO_FEW_MESSAGES)
        .when(blank, BLANK_QUESTION)
    )
    return parsed.withColumn("reject_reason", reason)


def accepted(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*keep, "request.*")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Records per reject reason; ``accepted`` for those without one."""
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


CACHE_KEY = ["question_md5", "context_md5"]


def with_cache_key(requests: DataFrame) -> DataFrame:
    """Add the hashes of question and context; a null text has a key of its own, which no hash is."""
    return requests.withColumns(
        {
            "question_md5": F.coalesce(F.md5("question"), F.lit("null")),
            "context_md5": F.coalesce(F.md5("context"), F.lit("null")),
        }
    )


def distinct_requests(requests: DataFrame) -> DataFrame:
    """(question, context, n_requests, question_md5, context_md5), one row per distinct request.

    Grouping by the texts equals grouping by their hashes and keeps the aggregation hash-based;
    copies of a frequent request collapse in every task before the shuffle.
    """
    counted = requests.groupBy("question", "context").agg(F.count(F.lit(1)).alias("n_requests"))
    return with_cache_key(counted)


def cache_report(requests: DataFrame) -> DataFrame:
    """One row: requests, distinct requests, requests that a cache would answer, and their share."""
    totals = distinct_requests(requests).agg(
        F.coalesce(F.sum("n_requests"), F.lit(0)).alias("n_requests"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.max("n_requests"), F.lit(0)).alias("n_most_frequent"),
    )
    hits = F.col("n_requests") - F.col("n_distinct")
    return totals.select(
        "n_requests", "n_distinct", "n_most_frequent", hits.alias("n_hits"),
        F.try_divide(hits, "n_requests").alias("hit_rate"),
    )


# A request is hot when it makes up more than this share of all rows, so fewer than 65,536 are.
HOT_SHARE = 1 << 16
# Rows of one request that a salt should get.
ROWS_PER_SALT = 100_000


def hot_requests(sizes: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(cache key, _salts): requests whose rows are dealt over several salts, as many as their size asks for.

    Fewer than ``HOT_SHARE`` rows by the definition of hot. A request below that share has so few rows
    that adaptive execution can split them: 15 million at 10^12.
    """
    total = sizes.agg(F.sum("n_requests")).scalar()
    salts = F.ceil(F.col("n_requests") / rows_per_salt).cast("int")
    hot = (F.col("n_requests") * HOT_SHARE > total) & (salts > 1)
    return sizes.filter(hot).select(*CACHE_KEY, salts.alias("_salts"))


def salted(requests: DataFrame, hot: DataFrame, spread_by: str) -> DataFrame:
    """Requests with their cache key and ``_salt``: the hash of ``spread_by`` over the salts of the request."""
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1)).cast("bigint")).cast("int")
    keyed = with_cache_key(requests).join(F.broadcast(hot), CACHE_KEY, "left")
    return keyed.withColumn("_salt", salt).drop("_salts")


def answer_from_cache(
    requests: DataFrame, answers: DataFrame, sizes: DataFrame, spread_by: str, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Give every request the answer of its distinct form.

    ``sizes`` is the output of ``distinct_requests``. The rows of a hot request are dealt over its
    salts and its one answer is copied to each; every other request has one salt.
    """
    hot = hot_requests(sizes, rows_per_salt)
    all_salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copied = answers.join(F.broadcast(hot), CACHE_KEY, "left").withColumn("_salt", F.explode(all_salts)).drop("_salts")
    return salted(requests, hot, spread_by).join(copied, [*CACHE_KEY, "_salt"]).drop("_salt")


# Fixed value: attempts at a request.
MAX_ATTEMPTS = 3


def first_valid_attempt(
    attempts: DataFrame, sql: str = "predicted_sql", max_attempts: int = MAX_ATTEMPTS
) -> DataFrame:
    """Per request the first of its first attempts that passes the parse screen.

    (request_id, attempt, predicted_sql, n_attempts, failed). The minimum is combined in every task
    before the shuffle, so a request with very many attempts sends one row per task.
    """
    tried = attempts.filter(F.col("attempt") <= max_attempts).withColumn(
        "_valid", F.when(P.parse_error(F.col(sql)).isNull(), F.col("attempt"))
    )
    best = tried.groupBy("request_id").agg(
        F.min("_valid").alias("attempt"),
        F.min_by(sql, "_valid").alias("predicted_sql"),
        F.count(F.lit(1)).alias("n_attempts"),
    )
    return best.withColumn("failed", F.col("attempt").isNull())
