"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.llm import bpe, chat, collocations, exact_dedup, hard_negatives, jaccard, mixing, packing, pii, quality, suffix_dedup, token_counts, token_files
from verdigris.llm.common import table
from verdigris.sources.storage import scratch_path

# Fixed values of the contracts.
WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 2
BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 0
TOKEN_LIMIT, SEQUENCE = 1024, 2048
REPEATED_BYTES = 400
JOIN_WORDS, JOIN_PERCENT = 3, 90


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(exact_dedup.normalised("text"), 256)
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    documents = table(spark, sf_dir, "documents")
    token_files.write_token_files(documents, path, public_tokenizers.path(WORD_VOCABULARY), WORD_END)
    return token_files.read_token_files(spark.read.parquet(path))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), REPEATED_BYTES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.train_quality_model(documents, table(spark, sf_dir, "labels"))
    return quality.score_quality(documents, model).drop("p_good")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(documents, public_tokenizers.path(BYTE_VOCABULARY), TOKEN_LIMIT)


def op6_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = chat.gather_turns(table(spark, sf_dir, "conversations"))
    formatted = chat.format_preferences(chat.weakened_pairs(conversations), ["conv_id"])

    def trained(name: str) -> Column:
        return F.aggregate(name, F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])

    return formatted.select(
        "conv_id", "n_prompt_turns", F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen_text", 256).alias("chosen_sha256"), F.sha2("rejected_text", 256).alias("rejected_sha256"),
        trained("chosen_spans").alias("chosen_loss_chars"), trained("rejected_spans").alias("rejected_loss_chars"), "usable",
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), JOIN_WORDS, JOIN_PERCENT)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(documents, public_tokenizers.path(BYTE_VOCABULARY), BYTE_END, SEQUENCE)
    packed = packing.pack(pieces.withColumnRenamed("id", "doc_id"), SEQUENCE)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    copies = mixing.replicate(documents, mixing.source_rates(documents))
    # The digest stands above the shuffle: whole rows are dealt out.
    return copies.select(
        "row.doc_id", "row.source", "copy", "n_copies", "shuffle_key", F.md5(F.coalesce("row.text", F.lit(""))).alias("text_md5")
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda span: span["base"])
    counts = [
        F.size(F.filter(base, lambda span: span["kind"] == number)).cast("long").alias(f"n_{kind}")
        for number, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(BYTE_VOCABULARY)
    coded = bpe.decode_texts(bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


_NORM = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"

OP1_SQL = f"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256({_NORM}) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY {_NORM})
"""

_WRITTEN = "'<|turn|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10)"
_LOSS = "list_sum([0] || [length(coalesce(t.text, '')) + 8 for t in {} if t.role = 'assistant'])::BIGINT"

OP6_SQL = f"""
WITH gathered AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
  UNION ALL SELECT conv_id, [{{'role': role, 'text': text}}] FROM conversations WHERE conv_id IS NULL
), replies AS (
  SELECT *, [i for i in range(1, len(turns) + 1) if turns[i].role = 'assistant'] AS spots FROM gathered
), chosen AS (
  SELECT *, CASE WHEN len(spots) = 0 THEN turns ELSE turns[1:spots[-1]] END AS chosen FROM replies
), sides AS (
  SELECT conv_id, chosen, CASE WHEN len(spots) = 0 THEN chosen ELSE chosen[1:len(chosen) - 1] || [{{'role': 'assistant', 'text':
    CASE WHEN turns[spots[1]].text IS NOT DISTINCT FROM turns[spots[-1]].text THEN '' ELSE coalesce(turns[spots[1]].text, '') END}}] END AS rejected
  FROM chosen
), shared AS (
  SELECT *, coalesce(list_min([i for i in range(1, least(len(chosen), len(rejected)) + 1) if chosen[i] IS DISTINCT FROM rejected[i]]) - 1,
    least(len(chosen), len(rejected)))::INTEGER AS n_prompt_turns FROM sides
), cut AS (
  SELECT conv_id, n_prompt_turns, chosen[1:n_prompt_turns] AS p, chosen[n_prompt_turns + 1:] AS c, rejected[n_prompt_turns + 1:] AS r FROM shared
)
SELECT conv_id, n_prompt_turns, sha256(array_to_string([{_WRITTEN} for t in p], '')) AS prompt_sha256,
  sha256(array_to_string([{_WRITTEN} for t in c], '')) AS chosen_sha256, sha256(array_to_string([{_WRITTEN} for t in r], '')) AS rejected_sha256,
  {_LOSS.format('c')} AS chosen_loss_chars, {_LOSS.format('r')} AS rejected_loss_chars,
  len([t for t in c if t.role = 'assistant']) > 0 AND len([t for t in r if t.role = 'assistant']) > 0 AS usable
FROM cut
"""

OP9_SQL = """
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, pow(size, 0.7) / (SELECT sum(pow(size, 0.7)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes
), parts AS (
  SELECT d.doc_id, d.source, md5(coalesce(d.text, '')) AS text_md5, rate / greatest(ceil(rate / 8.0), 1) AS mean,
    unnest(range(greatest(ceil(rate / 8.0), 1)::BIGINT)) AS part
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), levels AS (
  SELECT *, ('0x' || substr(md5('0|' || doc_id || '|' || part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS level FROM parts
), counted AS (
  SELECT doc_id, source, text_md5, list_reduce(range(1, 65), lambda s, k: CASE WHEN s.total > level THEN s ELSE
    {'term': s.term * mean / k, 'total': s.total + s.term * mean / k, 'k': s.k + 1} END,
    {'term': exp(-mean), 'total': exp(-mean), 'k': 0}).k AS n FROM levels
), totals AS (
  SELECT doc_id, source, text_md5, sum(n)::INTEGER AS n_copies FROM counted GROUP BY ALL
), copies AS (SELECT *, unnest(range(1, n_copies + 1))::INTEGER AS copy FROM totals)
SELECT doc_id, source, copy, n_copies, md5('0|shuffle|' || doc_id || '|' || copy) AS shuffle_key, text_md5 FROM copies
"""


OP11_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) for x in embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.row, a.vec_id AS anchor_id, b.row AS other, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.row <> b.row
), positives AS (
  SELECT row, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, other_id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.row, positive ORDER BY score DESC, other_id NULLS LAST)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.row = p.row AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda word: word <> '') AS words FROM pieces
), sized AS (
  SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM worded
), placed AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM sized
), grams AS (
  SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM placed GROUP BY ALL
), totals AS (
  SELECT lang, sum(len(words))::BIGINT AS n FROM worded GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM grams WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000 * c.a) // (x.f + y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(words[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), lengths AS (
  SELECT *, unnest(range(2, size)) AS length FROM candidates
), spots AS (
  SELECT *, unnest(range(1, size - length + 2)) AS place FROM lengths
), around AS (
  SELECT lang, array_to_string(words[place:place + length - 1], ' ') AS phrase, max(a) AS longer FROM spots GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE longer IS NULL OR 100 * longer < 80 * s.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: found for name, found in globals().items() if name.startswith("op") and callable(found)}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op6_chat_preferences": OP6_SQL, "op9_mixing": OP9_SQL, "op11_hard_negatives": OP11_SQL, "op12_collocations": OP12_SQL}
