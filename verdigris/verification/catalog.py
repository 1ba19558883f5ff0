"""Every operator as a query over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.functions import forms
from verdigris.functions import predicates as P
from verdigris.functions import rendering as R
from verdigris.functions.cleaning import cut_at_role_word, extract_sql, generation_stop, stop_markers
from verdigris.functions.templates import TextTemplate
from verdigris.operators import batching, corpus, markers, packing, reporting, requests, sampling
from verdigris.operators import rendering as texts
from verdigris.operators.scoring import add_prediction, score
from verdigris.plans import evaluation
from verdigris.plans.batch_inference import answer_requests
from verdigris.plans.preparation import prepare_corpus
from verdigris.sources import corpus as corpus_files
from verdigris.sources import requests as request_files
from verdigris.sources import runs
from verdigris.sources.storage import scratch_path, stored
from verdigris.streaming import admission, attempts, monitoring
from verdigris.verification.fixtures import generations, pairs
from verdigris.verification.predictors import schema_reader

Query = Callable[[SparkSession, str], DataFrame]

BASELINE, TUNED = "base", "tuned"
SAMPLE_ROWS, TEST_ROWS, EVAL_ROWS, SEED = 10_000, 2_500, 1_000, 42
LIST_SEPARATOR = " | "


def joined(items: Column) -> Column:
    return F.array_join(items, LIST_SEPARATOR)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_prediction(generations(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.to_conversations(pairs(spark, sf_dir))


# --- cleaning and per-row scores ---------------------------------------------------------------


def q_extract_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_text")
    return generations(spark, sf_dir).select(
        "row_id", "model_id", extract_sql(raw).alias("predicted_sql"),
        cut_at_role_word(raw).alias("role_word_cut"),
    )


def q_strict_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select(
        "row_id", "model_id",
        P.strict_match(F.col("predicted_sql"), F.col("ground_truth")).alias("strict_match"),
    )


def q_accuracy_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.accuracy_by_model(q_strict_match(spark, sf_dir))


def q_relaxed_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select(
        "row_id", "model_id",
        P.relaxed_match(F.col("predicted_sql"), F.col("ground_truth")).alias("relaxed_match"),
    )


def q_looks_like_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select(
        "row_id", "model_id", P.looks_like_sql(F.col("predicted_sql")).alias("valid_sql")
    )


def q_structure_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        predictions(spark, sf_dir)
        .select("row_id", "model_id", P.structure(F.col("predicted_sql")).alias("s"))
        .select(
            "row_id", "model_id", *[f"s.{flag}" for flag in P.STRUCTURE_FLAGS],
            joined(F.col("s.keywords")).alias("keywords"),
        )
    )


def q_structural_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    agreement = P.structural_agreement(F.col("predicted_sql"), F.col("ground_truth"))
    return predictions(spark, sf_dir).select(
        "row_id", "model_id", P.structural_similarity(agreement).alias("structural_similarity")
    )


def q_dangerous_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens the statements, and the statements with one of the words, or none, for their verb."""
    verbs = F.lit(["drop", "Delete", "TRUNCATE", "alter", "GRANT", "SELECT"])
    verb = F.element_at(verbs, (F.col("row_id") % 6 + 1).cast("int"))
    risky = F.replace(F.col("predicted_sql"), F.lit("SELECT"), verb)
    return predictions(spark, sf_dir).select(
        "row_id", "model_id", P.dangerous_word(F.col("predicted_sql")).alias("dangerous_word"),
        P.dangerous_word(risky).alias("risky_word"),
    )


def q_parse_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens the cleaned statement, and the raw text with its literals and comments."""
    return predictions(spark, sf_dir).select(
        "row_id", "model_id",
        P.parse_error(F.col("predicted_sql")).alias("parsing_error"),
        P.parse_error(F.col("raw_text")).alias("raw_parsing_error"),
    )


def q_logical_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = forms.logical_form(F.col("predicted_sql"))
    return (
        predictions(spark, sf_dir)
        .select("row_id", "model_id", form.alias("form"))
        .select("row_id", "model_id", *[joined(F.col(f"form.{n}")).alias(n) for n in forms.WEIGHTS])
    )


def q_logical_form_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    comparison = forms.compare_sql(F.col("predicted_sql"), F.col("ground_truth"))
    return (
        predictions(spark, sf_dir)
        .select("row_id", "model_id", comparison.alias("c"))
        .select(
            "row_id", "model_id", *[f"c.{name}_match" for name in forms.WEIGHTS],
            F.col("c.exact").alias("logical_form_exact"),
            (F.col("c.hundredths") / 100).alias("logical_form_similarity"),
        )
    )


# --- reports -----------------------------------------------------------------------------------


def q_model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.model_summary(score(predictions(spark, sf_dir)))


def q_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.improvement(q_accuracy_by_model(spark, sf_dir), BASELINE, TUNED)


def q_comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that a line does not have are null; the query says so and fills them to keep one type."""
    table = reporting.comparison_table(q_model_summary(spark, sf_dir), BASELINE, TUNED)
    totals = ["baseline_total", "tuned_total"]
    return table.withColumns({f"has_{name}": F.col(name).isNotNull() for name in totals}).fillna(0, totals)


def q_rank_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every variant of raw text is taken as a checkpoint of its own."""
    matched = predictions(spark, sf_dir).select(
        F.concat_ws("-", "model_id", F.col("variant").cast("string")).alias("model_id"),
        P.strict_match(F.col("predicted_sql"), F.col("ground_truth")).alias("strict_match"),
    )
    return reporting.rank_models(reporting.accuracy_by_model(matched), 20)


def q_improvement_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.improvement_band(q_improvement(spark, sf_dir))


def q_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of every variant of raw text, taken as a data set of its own, for both models."""
    matched = predictions(spark, sf_dir).select(
        "variant", "model_id", P.strict_match(F.col("predicted_sql"), F.col("ground_truth")).alias("strict_match")
    )
    rates = matched.groupBy("variant").agg(
        *[
            F.try_divide(
                F.count_if((F.col("model_id") == model) & F.col("strict_match")), F.count_if(F.col("model_id") == model)
            ).alias(model)
            for model in (BASELINE, TUNED)
        ]
    )
    return rates.select(
        "variant", BASELINE, TUNED,
        *[reporting.rating(F.col(BASELINE), name).alias(name.lower()) for name in reporting.RATING_BANDS],
        reporting.custom_rating(F.col(TUNED), F.col(BASELINE)).alias("custom"),
    )


def q_error_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.corpus_error_examples(generations(spark, sf_dir), pairs(spark, sf_dir), seed=SEED)


def q_sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.corpus_sample_predictions(generations(spark, sf_dir), pairs(spark, sf_dir), seed=SEED)


def q_random_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generations(spark, sf_dir)
    drawn = reporting.random_examples(rows, 3, SEED, ["row_id", "model_id"])
    return drawn.select("row_id", "model_id", "predicted_sql", "ground_truth", "strict_match")


def q_drawn_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = reporting.drawn_examples(generations(spark, sf_dir), 20, SEED, ["row_id", "model_id"])
    return drawn.select("draw", "row_id", "model_id", "predicted_sql", "ground_truth", "strict_match")


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows of the evaluation sample, both written so that neither is made twice."""
    sample = stored(evaluation.evaluation_sample(records(spark, sf_dir), EVAL_ROWS, SEED), "sample")
    return stored(evaluation.score_generations(sample, generations(spark, sf_dir)), "scored")


def q_evaluate_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.model_summary(evaluated(spark, sf_dir))


# --- corpus preparation ------------------------------------------------------------------------


def q_read_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    pairs(spark, sf_dir).write.json(path)
    return corpus_files.read_corpus(spark, path, "json")


def q_to_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pairs(spark, sf_dir).select(
        "row_id",
        corpus.conversation(corpus.VERBATIM).alias("verbatim"),
        corpus.conversation(corpus.STRIPPED).alias("stripped"),
    )
    return both.select(
        "row_id", F.to_json("verbatim").alias("verbatim"), F.to_json("stripped").alias("stripped")
    )


def q_sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(pairs(spark, sf_dir), SAMPLE_ROWS, SEED)


def q_split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sampling.split_train_test(pairs(spark, sf_dir), TEST_ROWS, SEED)
    return split.select("row_id", "question", "split")


def q_prepare_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare_corpus(pairs(spark, sf_dir), SAMPLE_ROWS, TEST_ROWS, SEED)
    return prepared.select("row_id", "split", F.to_json("messages").alias("messages"))


def q_eval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = evaluation.evaluation_sample(records(spark, sf_dir), EVAL_ROWS, SEED)
    return sample.select("row_id", "sample_rank", "question", "ground_truth")


def q_unpack_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.unpack_messages(records(spark, sf_dir)).drop("messages")


# --- rendering ---------------------------------------------------------------------------------


def q_render_training_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(
        "row_id",
        R.CHATML.render(F.col("messages")).alias("chatml"),
        R.HEADERS.render(F.col("messages")).alias("headers"),
    )


# Templates as a tokenizer might carry them.
CHATML_TEXT = (
    "{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
)
INSTRUCT_TEXT = """{{- bos_token -}}
{% for message in messages %}
{% if message['role'] == 'user' %}
{{- '[INST] ' + message['content'] | trim + ' [/INST]' -}}
{% elif loop.last %}
{{- ' ' + message['content'] + eos_token -}}
{% else %}
{{- message['content'] | upper }}
{% endif %}
{% endfor %}"""


def q_render_given_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = F.col("messages")
    return records(spark, sf_dir).select(
        "row_id", TextTemplate(CHATML_TEXT).render(messages, add_generation_prompt=True).alias("chatml"),
        TextTemplate(INSTRUCT_TEXT, "<s>", "</s>").render(messages).alias("instruct"),
    )


def q_render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = corpus.unpack_messages(records(spark, sf_dir))
    return texts.evaluation_prompts(unpacked).select("row_id", "prompt")


def q_batches_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as prompts: their lengths differ most."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    batched = batching.batches_by_length(documents, "doc_id", "text")
    return batched.select("doc_id", "n_tokens", *batching.BATCH)


def q_padding_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return batching.padding_report(batching.batches_by_length(documents, "doc_id", "text"))


def q_render_inference_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    question, context = F.col("question"), F.col("context")
    return pairs(spark, sf_dir).select(
        "row_id",
        R.inference_prompt(question, context).alias("plain"),
        R.inference_prompt(question, context, R.CHATML).alias("chatml"),
        R.short_prompt(question, context).alias("short"),
    )


def q_format_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts texts that end open among training texts, all sound, and open prompts, all not."""
    sound = texts.training_texts(records(spark, sf_dir)).withColumn("kind", F.lit("training"))
    prompts = q_render_prompt(spark, sf_dir).withColumnRenamed("prompt", "text")
    both = sound.unionByName(prompts.withColumn("kind", F.lit("prompt")))
    checked = texts.format_check(both)
    return checked.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_texts"), F.count_if("ends_open").alias("n_ends_open")
    )


def q_length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.length_profile(texts.training_texts(records(spark, sf_dir)))


def q_group_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of any length, with and without a system turn, ending on either role."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    unpacked = corpus.unpack_messages(corpus.group_turns(turns))
    return unpacked.select(
        "conv_id", F.size("messages").cast("bigint").alias("n_messages"), F.to_json("messages").alias("messages"),
        "system", "question", "ground_truth",
    )


def q_format_check_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rendered whole, and open where the last turn is the user's."""
    grouped = corpus.group_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    asks = F.element_at("messages", -1)["role"] == "user"
    text = F.when(asks, R.CHATML.render(F.col("messages"), True)).otherwise(R.CHATML.render(F.col("messages")))
    return texts.format_report(grouped.select(text.alias("text")))


def q_render_null_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a null system text, question or answer: every turn stays."""
    row = F.col("row_id")
    gaps = pairs(spark, sf_dir).select(
        "row_id", F.when(row % 4 != 1, F.col("context")).alias("context"),
        F.when(row % 4 != 2, F.col("question")).alias("question"), F.when(row % 4 != 3, F.col("answer")).alias("answer"),
    )
    made = corpus.to_conversations(gaps)
    prompts = texts.evaluation_prompts(corpus.unpack_messages(made))
    return prompts.select(
        "row_id", R.CHATML.render(F.col("messages")).alias("text"), "prompt",
        texts.null_parts().cast("bigint").alias("n_null_parts"),
    )


def q_length_profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.length_profile(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def q_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and rendered pairs together, with shards small enough that there are several."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("d"), "doc_id").alias("key"), "text"
    )
    rendered = texts.training_texts(records(spark, sf_dir)).select(F.concat(F.lit("p"), "row_id").alias("key"), "text")
    return packing.pack_sequences(documents.unionByName(rendered), "key", shard_tokens=200_000)


def q_corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.corpus_profile(records(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------------------------


def q_roundtrip_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "prepared")
    prepared = prepare_corpus(pairs(spark, sf_dir), SAMPLE_ROWS, TEST_ROWS, SEED)
    corpus_files.write_prepared(prepared, path)
    both = [corpus_files.read_prepared(spark, path, split) for split in ("train", "test")]
    return corpus.unpack_messages(both[0].unionByName(both[1])).select("row_id", "split", "question", "ground_truth")


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, line): a JSON request per pair, in eight shapes that include the rejected ones."""
    row, question, context = F.col("row_id"), F.col("question"), F.col("context")
    answer = F.col("answer")
    system = corpus.message("system", context)
    user = corpus.message("user", question)
    whole = corpus.message("user", R.inference_user_text(question, context))
    schema_only = corpus.message("user", F.concat(context, F.lit(" "), question))
    reply = corpus.message("assistant", answer)

    def as_messages(*messages: Column) -> Column:
        return F.to_json(F.struct(F.array(*messages).alias("messages")))

    shapes = [
        F.to_json(F.struct(question, context, answer.alias("query"))),
        as_messages(system, user, reply),
        as_messages(whole, reply),
        as_messages(user),
        F.to_json(F.struct(F.lit("").alias("question"), context)),
        F.to_json(
            F.struct(F.lit(None).cast("string").alias("question"), F.array(user).alias("messages")),
            {"ignoreNullFields": "false"},
        ),
        as_messages(system, schema_only),
        F.to_json(F.struct(question)),
    ]
    line = F.lit(None).cast("string")
    for number, shape in enumerate(shapes):
        line = F.when(row % len(shapes) == number, shape).otherwise(line)
    return pairs(spark, sf_dir).select("row_id", line.alias("line"))


def q_parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = requests.parse_requests(
        request_lines(spark, sf_dir)
        .withColumn("record", request_files.parse_line(F.col("line")))
        .select("row_id", "record.*")
    )
    kept = F.col("reject_reason").isNull()
    return parsed.select(
        "row_id",
        *[
            F.when(kept, F.col(f"request.{name}")).alias(name)
            for name in ("question", "context", "ground_truth")
        ],
        "reject_reason",
    )


def q_read_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "requests")
    request_lines(spark, sf_dir).select("line").write.text(path)
    return requests.reject_counts(
        requests.parse_requests(request_files.read_requests(spark, path))
    )


def q_read_request_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as pretty-printed arrays, one file for 20,000 of them, about."""
    path = scratch_path(spark, "request-arrays")
    lines = request_lines(spark, sf_dir)
    files = -(-lines.count() // 20_000) or 1
    dealt = lines.withColumn("file", F.pmod(F.xxhash64("row_id"), F.lit(files)))
    order = Window.partitionBy("file").orderBy("row_id")
    opening = F.when(F.lag("row_id").over(order).isNull(), "[").otherwise(",")
    closing = F.when(F.lead("row_id").over(order).isNull(), "\n]").otherwise("")
    texts = dealt.select("file", "row_id", F.concat(opening, F.lit("\n  "), "line", closing).alias("text"))
    texts.sortWithinPartitions("file", "row_id").select("file", "text").write.partitionBy("file").text(path)
    return requests.reject_counts(requests.parse_requests(request_files.read_requests(spark, path, "array")))


def q_write_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "results")
    results = predictions(spark, sf_dir).join(
        pairs(spark, sf_dir).select("row_id", "question", "context"), "row_id"
    )
    empty_as_null = F.when(F.col("predicted_sql") != "", F.col("predicted_sql"))
    request_files.write_results(
        results.withColumns(
            {"predicted_sql": empty_as_null, "ground_truth_sql": F.col("ground_truth")}
        ),
        path,
    )
    return request_files.read_results(spark, path)


def _run_document(spark: SparkSession, sf_dir: str, run_id: str) -> DataFrame:
    table = evaluated(spark, sf_dir)
    config = evaluation.RunConfig(run_id, EVAL_ROWS, BASELINE, TUNED, settings=(("seed", str(SEED)),))
    return evaluation.run_document(table, config, BASELINE, TUNED, "2025-01-01T00:00:00")


def q_run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    document = stored(_run_document(spark, sf_dir, "r1"), "document")
    for _ in range(2):  # the second time replaces the first
        runs.append_run(document, path)
    return runs.read_runs(spark, path).select(
        "run_id", F.col("evaluation_config.num_samples").alias("num_samples"), "evaluation_config.batch_size",
        "evaluation_config.temperature", "evaluation_config.base_model", "evaluation_config.adapter_path",
        F.element_at("config", "seed").alias("seed"), F.col("baseline.timestamp").alias("timestamp"),
        F.col("baseline.accuracy").alias("baseline_accuracy"),
        F.col("fine_tuned.accuracy").alias("tuned_accuracy"),
        F.col("fine_tuned.avg_logical_form_similarity").alias("tuned_logical_form"),
        F.size("baseline.error_examples").cast("bigint").alias("n_errors"),
        joined(F.col("fine_tuned.sample_predictions")).alias("tuned_samples"),
        joined(F.col("baseline.error_examples.question")).alias("error_questions"),
        "improvement.absolute_improvement", "improvement.correct_gain",
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of today's shape, and one whose file has two documents as an earlier program wrote them."""
    path = scratch_path(spark, "history")
    document = stored(_run_document(spark, sf_dir, "new"), "document")
    runs.append_run(document, path)

    def older(side: str) -> Column:
        # The fields of that time; measures of parsing and logical form did not exist.
        names = [
            "accuracy", "relaxed_accuracy", "num_samples", "num_correct", "num_relaxed_correct", "num_incorrect",
            "valid_sql_count", "valid_sql_percentage", "avg_structural_similarity", "sample_predictions",
            "sample_ground_truths", "timestamp",
        ]
        return F.struct(*[F.col(f"{side}.{name}").alias(name) for name in names]).alias(side)

    text = F.to_json(F.struct("evaluation_config", older("baseline"), older("fine_tuned"), "improvement"))
    twice = document.select(F.explode(F.array(text, text)).alias("value"))
    twice.coalesce(1).write.text(f"{path}/run_id=old")
    return runs.read_runs(spark, path)


def q_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.summary_history(_history(spark, sf_dir), "fine_tuned").drop("source_file")


def q_improvement_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.improvement_history(_history(spark, sf_dir)).drop("source_file")


# --- requests ----------------------------------------------------------------------------------


def repeated_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with hot copies: a third of all rows asks one and the same question."""
    hot = F.col("row_id") % 3 == 0
    return pairs(spark, sf_dir).select(
        "row_id",
        F.when(hot, F.lit("How many orders are there?")).otherwise(F.col("question")).alias("question"),
        F.when(hot, F.lit("CREATE TABLE orders (o_orderkey INT)"))
        .otherwise(F.col("context"))
        .alias("context"),
        F.col("answer").alias("ground_truth"),
    )


def q_request_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.cache_report(repeated_requests(spark, sf_dir))


def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = answer_requests(
        repeated_requests(spark, sf_dir), schema_reader, "row_id",
        partitions=spark.sparkContext.defaultParallelism,
    )
    return answered.select(
        "row_id", "question", "predicted_sql", "predict_error", "parsing_error", "dangerous_word"
    )


def q_stop_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generations(spark, sf_dir).select(
        "row_id", "model_id", joined(stop_markers(F.col("raw_text"))).alias("stop_markers")
    )


def q_stop_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = generations(spark, sf_dir).select("row_id", "model_id", generation_stop(F.col("raw_text")).alias("stop"))
    return found.select(
        "row_id", "model_id", F.col("stop.stop_token").isNotNull().alias("stopped"),
        F.coalesce("stop.stop_token", "stop.n_tokens").alias("kept_tokens"), "stop.stop_marker", "stop.kept_text", "stop.tokens_saved",
    )


def q_stop_marker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.stop_marker_counts(generations(spark, sf_dir))


def q_first_valid_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four neighbouring generations are the attempts at one request."""
    attempt = (F.col("row_id") % 2) * 2 + F.when(F.col("model_id") == BASELINE, 1).otherwise(2)
    attempts = predictions(spark, sf_dir).select(
        F.floor(F.col("row_id") / 2).alias("request_id"), attempt.alias("attempt"), "predicted_sql"
    )
    return requests.first_valid_attempt(attempts)


# --- monitoring --------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _edges_as_text(df: DataFrame) -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    return df.withColumns(
        {edge: F.date_format(edge, pattern) for edge in ("window_start", "window_end")}
    )


def q_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit of three per day, since no client of the table comes near ten per minute."""
    limited = monitoring.rate_limit(events(spark, sf_dir), "ts", "user_id", 3, "1 day")
    return _edges_as_text(limited)


def q_admit_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = admission.admit_requests(events(spark, sf_dir), "ts", "user_id", "event_id", 3, "1 day")
    return decided.select("event_id", "user_id", "admitted")


def q_stream_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users ask one thing per type of event."""
    cached = admission.cached_requests(events(spark, sf_dir), "ts", "event_id", ["user_id", "event_type"], "12 hours")
    return cached.select("event_id", "hit", "answered_by")


def q_cache_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = admission.cached_requests(events(spark, sf_dir), "ts", "event_id", ["user_id", "event_type"], "12 hours")
    return _edges_as_text(admission.cache_hit_rate(cached, "ts", "1 day"))


def q_resolve_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four neighbouring events are the attempts at one request."""
    text = F.when(F.col("event_type") == "view", "SELECT 1").when(F.col("event_type") == "signup", "select a from t").otherwise("no answer")
    tried = events(spark, sf_dir).select(
        F.floor(F.col("event_id") / 4).alias("request_id"), (F.col("event_id") % 4 + 1).alias("attempt"), "ts", text.alias("predicted_sql")
    )
    resolved = attempts.resolve_attempts(tried)
    return resolved.withColumn("retry_at", F.unix_millis("retry_at").cast("string"))


def q_generation_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges_as_text(
        monitoring.generation_histogram(events(spark, sf_dir), "ts", "value", "1 hour")
    )


def q_service_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    metrics = monitoring.service_metrics(
        events(spark, sf_dir), "ts", "value",
        is_error=kind == "error",
        is_valid=kind.isin("purchase", "signup"),
        is_cache_hit=kind == "view",
        cost=F.get_json_object("props", "$.k").cast("bigint"),
        per="1 day", slide="12 hours",
    )
    return _edges_as_text(metrics)


def q_latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges_as_text(monitoring.latency_quantiles(events(spark, sf_dir), "ts", "value", per="1 day", slide="12 hours"))


def all_queries() -> dict[str, Query]:
    return {
        name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")
    }
