"""DuckDB SQL per query, written against the same tables and independent of the Spark code.

Patterns are spelled for RE2: word boundaries are ASCII there, which the derived texts allow. Word
lists, weights, labels and prompt texts are the same fixed values as in the package, written out again.
"""

from __future__ import annotations

from verdigris.verification.fixtures import GENERATIONS_DUCKDB, PAIRS_DUCKDB

# The characters that Python counts as white space, and the same as a pattern.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
QUOTED = "''[^'']*''|\"[^\"]*\"|`[^`]*`"
COMMENT = r"(?:--|# )[^\n]*|/\*(?s:.*?)\*/"


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def with_ctes(body: str, *names: str) -> str:
    """``body`` after the CTEs named and those they read."""
    ctes = {
        "pairs": PAIRS_DUCKDB,
        "generations": GENERATIONS_DUCKDB,
        "predictions": _predictions(),
        "forms": _forms(),
        "scored": _scored(),
        "summary": _summary("scored", "model_id"),
        "sampled": "SELECT s.*, sample_rank, question FROM scored s JOIN ranked USING (row_id) WHERE sample_rank <= 1000",
        "sample_summary": _summary("sampled", "model_id"),
        "ranked": "SELECT row_id, question, row_number() OVER (ORDER BY md5(concat('42|', row_id))) AS sample_rank FROM pairs",
        "records": _records(),
        "repeated": _repeated(),
    }
    needs = {
        "generations": ["pairs"],
        "predictions": ["generations"],
        "forms": ["predictions"],
        "scored": ["forms"],
        "summary": ["scored"],
        "sampled": ["scored", "ranked"],
        "sample_summary": ["sampled"],
        "ranked": ["pairs"],
        "records": ["pairs"],
        "repeated": ["pairs"],
    }
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in needs.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    parts = ", ".join(f"{name} AS ({ctes[name]})" for name in wanted)
    return f"WITH {parts} {body}" if parts else body


def _predictions() -> str:
    tails = [
        r"\bMarilyn\b", r"\bI am\b", r"\bYou are\b", r"\bThe (answer|query|SQL|result)\b",
        r"\bWhat (is|was|are)\b", r"\bWhich\b", r"\bNote:", r"\bHere",
    ]
    cases = " ".join(
        f"WHEN regexp_matches(t, '{p}', 'i') THEN {strip(f'''regexp_replace(t, '{p}.*', '', 'si')''')}"
        for p in tails
    )
    keep = "row_id, model_id, variant, ground_truth, raw_text"
    paragraph = strip("split_part(t, chr(10) || chr(10), 1)")
    for mark in ("---", "###"):
        literal = "chr(10) || '---' || chr(10)" if mark == "---" else "chr(10) || '###'"
        paragraph = strip(f"split_part({paragraph}, {literal}, 1)")
    steps = [
        f"SELECT {keep}, {strip('''coalesce(raw_text, '')''')} AS t FROM generations",
        rf"SELECT {keep}, CASE WHEN contains(lower(t), 'assistant') THEN {strip(r'''regexp_replace(t, '\A.*?\bassistant\b', '', 'si')''')} ELSE t END AS t FROM p0",
        rf"SELECT {keep}, {strip(r'''regexp_replace(t, '<\|[^|]*\|>.*', '', 's')''')} AS t FROM p1",
        rf"SELECT {keep}, t AS before_role, {strip(r'''regexp_replace(t, '\b(system|user)\b.*', '', 'si')''')} AS t FROM p2",
        f"SELECT {keep}, t <> before_role AS role_word_cut, {strip('''regexp_replace(t, '```(sql)?', '', 'gi')''')} AS t FROM p3",
        f"SELECT {keep}, role_word_cut, CASE {cases} ELSE t END AS t FROM p4",
        rf"SELECT {keep}, role_word_cut, {strip(r'''regexp_replace(t, '[^\x00-\x7F].*', '', 's')''')} AS t FROM p5",
        f"SELECT {keep}, role_word_cut, CASE WHEN contains(t, ';') THEN {strip('''split_part(t, ';', 1)''')} || ';' ELSE {paragraph} END AS predicted_sql FROM p6",
    ]
    ctes = ", ".join(f"p{i} AS ({sql})" for i, sql in enumerate(steps[:-1]))
    return f"WITH {ctes} {steps[-1]}"


def strict(x: str) -> str:
    return f"regexp_replace(lower(rtrim({strip(x)}, ';')), '{WS}+', ' ', 'g')"


def relaxed(x: str) -> str:
    unquoted = f"regexp_replace(lower({x}), '[\"'']([^\"'']+)[\"'']', '\\1', 'g')"
    return strip(f"regexp_replace({unquoted}, '{WS}+', ' ', 'g')")


def any_word(upper: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({upper}, '{word}')" for word in words) + ")"


# Word lists, and the weights of the eight lists of a logical form.
SQL_WORDS = ["SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "WITH", "FROM", "WHERE"]
FLAGS = {
    "has_select": "SELECT", "has_from": "FROM", "has_where": "WHERE", "has_join": "JOIN",
    "has_group_by": "GROUP BY", "has_order_by": "ORDER BY",
}


def agreement(p: str, t: str) -> str:
    return " + ".join(
        f"CAST(contains(upper({p}), '{w}') = contains(upper({t}), '{w}') AS INTEGER)"
        for w in FLAGS.values()
    )


def blanked(x: str) -> str:
    return f"split_part(upper(regexp_replace({x}, '{QUOTED}|{COMMENT}', ' ', 'g')), ';', 1)"


def parse_error(x: str) -> str:
    words = (
        "SELECT|INSERT|UPDATE|DELETE|MERGE|CREATE|DROP|ALTER|TRUNCATE|FROM|WHERE|JOIN|GROUP|ORDER|"
        "HAVING|LIMIT|UNION|VALUES|INTO|SET"
    )
    edge = r"[^A-Z0-9_\x{80}-\x{10ffff}]"
    inner = r"[^A-Z0-9_\x{80}-\x{10ffff}()]"
    # From the inside out each pair becomes a mark: one with a word of its own is seen from outside, others are
    # not. The tables nest pairs less than four deep.
    reached = blanked(x)
    for _ in range(4):
        reached = rf"regexp_replace({reached}, '\((?:[^()]*{inner})?(?:{words})(?:{inner}[^()]*)?\)', ' ' || chr(1) || ' ', 'g')"
        reached = rf"regexp_replace({reached}, '\([^()]*\)', ' ' || chr(2) || ' ', 'g')"
    return (
        f"CASE WHEN {strip(f'''coalesce({x}, '')''')} = '' THEN 'Empty SQL string' "
        f"WHEN NOT regexp_matches({reached}, '\\x01|(?:^|{edge})(?:{words})(?:$|{edge})') THEN 'No SQL keywords found' END"
    )


LISTS = [
    "operations", "select_columns", "from_tables", "where_conditions", "join_clauses",
    "group_by_columns", "order_by_columns", "having_conditions",
]
WEIGHTS = [20, 20, 20, 15, 10, 5, 5, 5]


def _form_lists(x: str, prefix: str) -> str:
    """Select list of the eight lists of text ``x``; null lists for blank text."""
    text = f"upper(regexp_replace({x}, '({QUOTED})|{COMMENT}', '\\1', 'g'))"

    def cut(part: str, stops: list[str]) -> str:
        cases = " ".join(f"WHEN contains({part}, '{s}') THEN split_part({part}, '{s}', 1)" for s in stops)
        return f"CASE {cases} ELSE {part} END"

    def clause(word: str, stops: list[str]) -> str:
        return cut(f"split_part({text}, '{word}', 2)", stops)

    def items(word: str, stops: list[str]) -> str:
        each = f"list_transform(string_split({clause(word, stops)}, ','), lambda c: {strip('c')})"
        return f"CASE WHEN contains({text}, '{word}') THEN {each} ELSE [] END"

    def whole(word: str, stops: list[str]) -> str:
        return f"CASE WHEN contains({text}, '{word}') THEN [{strip(clause(word, stops))}] ELSE [] END"

    words = "SELECT|INSERT|UPDATE|DELETE|MERGE|CREATE|DROP|ALTER"
    tokens = rf"regexp_extract_all({blanked(x)}, '[()]|\b(?:{words})\b')"

    def opened(mark: str) -> str:
        return f"len(list_filter(({tokens})[1:i], lambda o: o = '{mark}'))"

    operations = (
        f"list_filter({tokens}, lambda w, i: w NOT IN ('(', ')') AND {opened('(')} = {opened(')')})"
    )
    joins = ["INNER JOIN", "LEFT JOIN", "RIGHT JOIN", "FULL JOIN", "CROSS JOIN", "JOIN"]
    lists = {
        "operations": operations,
        "select_columns": items("SELECT", ["FROM"]),
        "from_tables": f"list_filter({items('FROM', ['WHERE', 'GROUP BY', 'ORDER BY', 'HAVING', 'LIMIT', 'JOIN'])}, lambda f: f <> '')",
        "where_conditions": whole("WHERE", ["GROUP BY", "ORDER BY", "HAVING", "LIMIT"]),
        "join_clauses": f"list_filter({joins!r}, lambda j: contains({text}, j))",
        "group_by_columns": items("GROUP BY", ["ORDER BY", "HAVING", "LIMIT"]),
        "order_by_columns": items("ORDER BY", ["LIMIT"]),
        "having_conditions": whole("HAVING", ["ORDER BY", "LIMIT"]),
    }
    return ", ".join(
        f"CASE WHEN {strip(x)} <> '' THEN {sql} END AS {prefix}{name}" for name, sql in lists.items()
    )


def _forms() -> str:
    return (
        f"SELECT *, {_form_lists('predicted_sql', 'p_')}, {_form_lists('ground_truth', 't_')} "
        "FROM predictions"
    )


def same(name: str) -> str:
    p, t = f"p_{name}", f"t_{name}"
    if name in ("where_conditions", "having_conditions"):
        return f"coalesce({p} = {t}, false)"
    return f"coalesce(list_sort(list_distinct({p})) = list_sort(list_distinct({t})), false)"


def hundredths() -> str:
    return " + ".join(f"CASE WHEN {same(n)} THEN {w} ELSE 0 END" for n, w in zip(LISTS, WEIGHTS))


def _scored() -> str:
    exact = " AND ".join(same(name) for name in LISTS)
    return f"""
SELECT row_id, model_id, variant, ground_truth, predicted_sql,
  {strict('predicted_sql')} = {strict('ground_truth')} AS strict_match,
  {relaxed('predicted_sql')} = {relaxed('ground_truth')} AS relaxed_match,
  {any_word('upper(predicted_sql)', SQL_WORDS)} AS valid_sql,
  {agreement('predicted_sql', 'ground_truth')} AS agreement,
  {parse_error('predicted_sql')} AS parsing_error,
  {parse_error('predicted_sql')} IS NULL AS parsing_valid,
  {parse_error('predicted_sql')} IS NULL AND {exact} AS form_exact,
  CASE WHEN {parse_error('predicted_sql')} IS NULL THEN {hundredths()} ELSE 0 END AS form_hundredths
FROM forms"""


def _summary(source: str, by: str) -> str:
    return f"""
SELECT {by},
  count_if(strict_match) / count(*) AS accuracy,
  count_if(relaxed_match) / count(*) AS relaxed_accuracy,
  count(*) AS num_samples,
  CAST(count_if(strict_match) AS BIGINT) AS num_correct,
  CAST(count_if(relaxed_match) AS BIGINT) AS num_relaxed_correct,
  CAST(count(*) - count_if(strict_match) AS BIGINT) AS num_incorrect,
  CAST(count_if(valid_sql) AS BIGINT) AS valid_sql_count,
  count_if(valid_sql) / count(*) AS valid_sql_percentage,
  sum(agreement) / (6 * count(*)) AS avg_structural_similarity,
  CAST(count_if(parsing_valid) AS BIGINT) AS parsing_valid_count,
  count_if(parsing_valid) / count(*) AS parsing_valid_rate,
  CAST(count(*) - count_if(parsing_valid) AS BIGINT) AS parsing_invalid_count,
  CAST(count_if(form_exact) AS BIGINT) AS logical_form_exact_matches,
  coalesce(count_if(form_exact) / nullif(count_if(parsing_valid), 0), 0) AS logical_form_accuracy,
  sum(form_hundredths) / (100 * count(*)) AS avg_logical_form_similarity
FROM {source} GROUP BY {by}"""


SYSTEM_TAIL = "generate a SQL query based on the provided SCHEMA.\nSCHEMA:\n"
VERBATIM = "You are a text-to-SQL query translator. Users will ask questions in English and you will " + SYSTEM_TAIL
STRIPPED = "You are an text to SQL query translator. Users will ask you questions in English and you will " + SYSTEM_TAIL
INFERENCE_SYSTEM = "You are a helpful assistant that converts natural language questions into SQL queries."


def _records() -> str:
    return f"SELECT row_id, '{VERBATIM}' || context AS system, question, answer AS ground_truth FROM pairs"


def messages_json(system: str, answer: str) -> str:
    def message(role: str, content: str) -> str:
        return f"'{{\"role\":\"{role}\",\"content\":' || CAST(to_json({content}) AS VARCHAR) || '}}'"

    return (
        f"'[' || {message('system', system)} || ',' || {message('user', 'question')} || ',' || "
        f"{message('assistant', answer)} || ']'"
    )


def rank_below(n: int, key: str = "concat('42|', row_id)", source: str = "pairs") -> str:
    return (
        f"(SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY md5({key})) AS r "
        f"FROM {source}) WHERE r <= {n})"
    )


SPLIT_KEY = "concat('42|split|', row_id)"


def _prepared() -> str:
    return (
        f"sampled AS (SELECT * FROM pairs WHERE row_id IN {rank_below(10_000)}), "
        "prepared AS (SELECT *, CASE WHEN row_id IN "
        f"{rank_below(2_500, SPLIT_KEY, 'sampled')} THEN 'test' ELSE 'train' END AS split FROM sampled)"
    )


def chat(open_: str, middle: str, close: str, messages: list[tuple[str, str]]) -> str:
    return " || ".join(f"'{open_}{role}{middle}' || {content} || '{close}'" for role, content in messages)


def chatml(messages: list[tuple[str, str]]) -> str:
    return chat("<|im_start|>", "\n", "<|im_end|>\n", messages)


THREE = [("system", "system"), ("user", "question"), ("assistant", "ground_truth")]
OPEN_REPLY = "'<|im_start|>assistant\n'"
USER_TEXT = "'### Context:\n' || context || '\n\n### Question:\n' || question || '\n\n### SQL:'"
TOKENS = r"CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS BIGINT)"


def _repeated() -> str:
    return (
        "SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'How many orders are there?' ELSE question END AS question, "
        "CASE WHEN row_id % 3 = 0 THEN 'CREATE TABLE orders (o_orderkey INT)' ELSE context END AS context FROM pairs"
    )


# Stop phrases.
PHRASES = ["Marilyn", "assistant", "Note:", "The ", "What ", "Which ", "I am", "You are", "Here", "This"]


def _stop_position(keyed: str) -> str:
    """After each token from the fifth on the text so far is looked at; the first hit counts."""
    listed = "[" + ", ".join(f"'{p}'" for p in PHRASES) + "]"
    token = r"\s*(?:[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"
    hit = rf"len(list_filter({listed}, lambda p: contains(part, p))) > 0 OR regexp_matches(part, '[^\x00-\x7F]')"
    return (
        f", counted AS (SELECT {keyed}, raw_text, regexp_extract_all(raw_text, '{token}') AS tokens FROM generations), "
        f"parts AS (SELECT *, array_to_string(tokens[1:step], '') AS part FROM ("
        "SELECT *, unnest(range(5, len(tokens) + 1))::INTEGER AS step FROM counted)), "
        f"stops AS (SELECT row_id, model_id, min(step) AS stop_token, arg_min(part, step) AS kept FROM parts WHERE {hit} GROUP BY ALL) "
        "SELECT row_id, model_id, stop_token IS NOT NULL AS stopped, coalesce(stop_token, len(tokens))::INTEGER AS kept_tokens, CASE WHEN stop_token IS NOT NULL THEN "
        f"coalesce(list_filter({listed}, lambda p: contains(kept, p))[1], 'non_ascii') END AS stop_marker, "
        "coalesce(kept, raw_text) AS kept_text, coalesce(len(tokens) - stop_token, 0)::INTEGER AS tokens_saved "
        "FROM counted LEFT JOIN stops USING (row_id, model_id)"
    )


def _markers() -> str:
    listed = "[" + ", ".join(f"'{p}'" for p in PHRASES) + "]"
    tokens = TOKENS.replace("text", "raw_text")
    return (
        f"CASE WHEN {tokens} >= 5 THEN list_concat(list_filter({listed}, lambda p: contains(raw_text, p)), "
        r"CASE WHEN regexp_matches(raw_text, '[^\x00-\x7F]') THEN ['non_ascii'] ELSE [] END) ELSE [] END"
    )


def _first_rows(where: str, k: int, columns: str) -> str:
    return (
        f"SELECT model_id, sample_rank, {columns}, CAST(position AS INTEGER) AS position FROM ("
        f"SELECT s.*, agreement / 6 AS structural_similarity, form_hundredths / 100 AS logical_form_similarity, "
        f"question, sample_rank, row_number() OVER (PARTITION BY model_id ORDER BY sample_rank) AS position "
        f"FROM scored s JOIN ranked USING (row_id) WHERE {where}) WHERE position <= {k}"
    )


# Lines of the comparison table, where each comes from, and its total.
COMPARISON = [
    ("Accuracy (strict)", "accuracy * 100", "0"),
    ("Accuracy (relaxed)", "relaxed_accuracy * 100", "0"),
    ("Correct predictions", "num_correct", "num_samples"),
    ("Incorrect predictions", "num_incorrect", "0"),
    ("Parsing valid %", "parsing_valid_rate * 100", "0"),
    ("Parsing valid count", "parsing_valid_count", "num_samples"),
    ("Parsing invalid count", "parsing_invalid_count", "0"),
    ("Logical form accuracy", "logical_form_accuracy * 100", "0"),
    ("Logical form exact matches", "logical_form_exact_matches", "parsing_valid_count"),
    ("Avg logical form similarity", "avg_logical_form_similarity * 100", "0"),
    ("Valid SQL %", "valid_sql_percentage * 100", "0"),
    ("Avg structural similarity", "avg_structural_similarity * 100", "0"),
]


def _sample_rows(where: str, k: int) -> str:
    """First rows per model of the evaluation sample."""
    return (
        "SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY sample_rank) AS position "
        f"FROM sampled WHERE {where} QUALIFY position <= {k}"
    )


def _comparison() -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{label}' AS metric, CAST(b.{value} AS DOUBLE) AS baseline, "
        f"CAST({'0' if total == '0' else 'b.' + total} AS BIGINT) AS baseline_total, "
        f"CAST(t.{value} AS DOUBLE) AS tuned, "
        f"CAST({'0' if total == '0' else 't.' + total} AS BIGINT) AS tuned_total, "
        f"{total != '0'} AS has_baseline_total, {total != '0'} AS has_tuned_total "
        "FROM summary b JOIN summary t ON b.model_id = 'base' AND t.model_id = 'tuned'"
        for i, (label, value, total) in enumerate(COMPARISON, start=1)
    )
    return f"SELECT *, tuned - baseline AS delta FROM ({rows})"


def _improvement(extra: str = "") -> str:
    return f"""
SELECT t.accuracy - b.accuracy AS absolute_improvement,
  CASE WHEN b.accuracy > 0 THEN (t.accuracy - b.accuracy) / b.accuracy * 100 ELSE 0.0 END AS relative_improvement_pct,
  t.num_correct - b.num_correct AS correct_gain {extra}
FROM summary b JOIN summary t ON b.model_id = 'base' AND t.model_id = 'tuned'"""


BAND = """, CASE WHEN (t.accuracy - b.accuracy) * 100 < 0 THEN 'negative' WHEN (t.accuracy - b.accuracy) * 100 < 10 THEN 'small'
  WHEN (t.accuracy - b.accuracy) * 100 <= 20 THEN 'moderate' ELSE 'large' END AS band"""

# The eight request shapes of the query, as what each must parse to.
PARSED = """
SELECT row_id,
  CASE WHEN row_id % 8 IN (0, 1, 2, 7) THEN question
       WHEN row_id % 8 = 6 THEN context || ' ' || question END AS question,
  CASE WHEN row_id % 8 IN (0, 1, 2, 6) THEN context WHEN row_id % 8 = 7 THEN '' END AS context,
  CASE WHEN row_id % 8 IN (0, 1, 2) THEN answer END AS ground_truth,
  CASE WHEN row_id % 8 = 3 THEN 'too_few_messages' WHEN row_id % 8 IN (4, 5) THEN 'blank_question' END AS reject_reason
FROM pairs"""


def _windows(unit: str) -> str:
    """Both 24-hour windows that slide by 12 hours and hold an event."""
    half = "date_trunc('day', ts) + CASE WHEN hour(ts) >= 12 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END"
    return (
        f"SELECT *, {half} AS window_start FROM events UNION ALL "
        f"SELECT *, {half} - INTERVAL 12 HOUR AS window_start FROM events"
    )


def as_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


# The same bounds written out: ten to a decade, over seven decades.
BATCHES = f"""
WITH counted AS (SELECT doc_id, ({TOKENS})::INTEGER AS n_tokens FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
stepped AS (SELECT *, greatest(n_tokens, 1)::BIGINT AS n, 1::BIGINT << greatest(length(bin(greatest(n_tokens, 1))) - 4, 0) AS step FROM counted),
classed AS (SELECT doc_id, n_tokens, (n + step - 1) // step * step AS length_class, 0::BIGINT AS salt FROM stepped),
batched AS (SELECT *, (row_number() OVER (PARTITION BY length_class ORDER BY n_tokens, doc_id) - 1) // greatest(4096 // length_class, 1) AS batch FROM classed)
"""

CACHED = """
WITH followed AS (
  SELECT *, max(epoch_us(ts) // 1000) OVER (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used
  FROM events
), marked AS (SELECT *, coalesce((epoch_us(ts) // 1000) - used <= 12 * 3600 * 1000, false) AS hit FROM followed),
cached AS (SELECT *, last_value(CASE WHEN NOT hit THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS answered_by FROM marked)
"""

LATENCIES = "[" + ", ".join(
    f"{mantissa / 10 * 10**power / 1000!r}::DOUBLE" for power in range(7) for mantissa in (10, 12, 16, 20, 25, 32, 40, 50, 63, 80)
) + ", 10000.0::DOUBLE]"


def oracle_sql() -> dict[str, str]:
    keyed = "row_id, model_id"
    form_columns = ", ".join(f"array_to_string(p_{name}, ' | ') AS {name}" for name in LISTS)
    flags = ", ".join(f"contains(upper(predicted_sql), '{w}') AS {n}" for n, w in FLAGS.items())
    statement_words = "['SELECT', 'INSERT', 'UPDATE', 'DELETE', 'CREATE', 'DROP', 'ALTER', 'WITH']"
    verb = "['drop', 'Delete', 'TRUNCATE', 'alter', 'GRANT', 'SELECT'][row_id % 6 + 1]"

    def danger(text: str) -> str:
        words = ["DROP", "DELETE", "TRUNCATE", "ALTER", "GRANT"]
        return "CASE " + " ".join(f"WHEN contains(upper({text}), '{w}') THEN '{w}'" for w in words) + " END"

    exact = " AND ".join(same(name) for name in LISTS)
    accuracy = (
        "SELECT {key}, count(*) AS num_samples, CAST(count_if(strict_match) AS BIGINT) AS num_correct, "
        "count_if(strict_match) / count(*) AS accuracy FROM ({source}) GROUP BY {key}"
    )
    strict_rows = (
        f"SELECT {keyed}, variant, {strict('predicted_sql')} = {strict('ground_truth')} AS strict_match FROM predictions"
    )
    text_rows = f"SELECT row_id, {chatml(THREE)} AS text FROM records"
    error_columns = (
        "question, predicted_sql, ground_truth, structural_similarity, parsing_valid, parsing_error, "
        "logical_form_similarity"
    )
    table_answer = (
        "CASE WHEN contains(question, '5-LOW') THEN NULL ELSE "
        r"'SELECT * FROM ' || regexp_extract(context, 'CREATE TABLE (\w+)', 1) || ';' END"
    )
    figures = [
        "accuracy", "num_samples", "num_correct", "num_incorrect",
    ]
    later = [
        "relaxed_accuracy", "valid_sql_percentage", "avg_structural_similarity",
        "parsing_valid_count", "parsing_valid_rate", "parsing_invalid_count",
        "logical_form_exact_matches", "logical_form_accuracy", "avg_logical_form_similarity",
    ]
    # Later figures that the earlier program had already.
    known = ["relaxed_accuracy", "valid_sql_percentage", "avg_structural_similarity"]
    sql = {
        "extract_sql": with_ctes(
            f"SELECT {keyed}, predicted_sql, role_word_cut FROM predictions", "predictions"),
        "strict_match": with_ctes(
            f"SELECT {keyed}, strict_match FROM ({strict_rows})", "predictions"),
        "accuracy_by_model": with_ctes(
            accuracy.format(key="model_id", source=strict_rows), "predictions"),
        "relaxed_match": with_ctes(
            f"SELECT {keyed}, {relaxed('predicted_sql')} = {relaxed('ground_truth')} AS relaxed_match FROM predictions",
            "predictions"),
        "looks_like_sql": with_ctes(
            f"SELECT {keyed}, {any_word('upper(predicted_sql)', SQL_WORDS)} AS valid_sql FROM predictions",
            "predictions"),
        "structure_flags": with_ctes(
            f"SELECT {keyed}, {flags}, array_to_string(list_filter({statement_words}, "
            "lambda w: contains(upper(predicted_sql), w)), ' | ') AS keywords FROM predictions",
            "predictions"),
        "structural_similarity": with_ctes(
            f"SELECT {keyed}, ({agreement('predicted_sql', 'ground_truth')}) / 6 AS structural_similarity FROM predictions",
            "predictions"),
        "dangerous_screen": with_ctes(
            f"SELECT {keyed}, {danger('predicted_sql')} AS dangerous_word, "
            f"{danger(f'''replace(predicted_sql, 'SELECT', {verb})''')} AS risky_word FROM predictions", "predictions"),
        "parse_validity": with_ctes(
            f"SELECT {keyed}, {parse_error('predicted_sql')} AS parsing_error, "
            f"{parse_error('raw_text')} AS raw_parsing_error FROM predictions", "predictions"),
        "logical_form": with_ctes(f"SELECT {keyed}, {form_columns} FROM forms", "forms"),
        "logical_form_compare": with_ctes(
            f"SELECT {keyed}, " + ", ".join(f"{same(n)} AS {n}_match" for n in LISTS)
            + f", {exact} AS logical_form_exact, ({hundredths()}) / 100 AS logical_form_similarity FROM forms",
            "forms"),
        "model_summary": with_ctes("SELECT * FROM summary", "summary"),
        "improvement": with_ctes(_improvement(), "summary"),
        "comparison_table": with_ctes(_comparison(), "summary"),
        "rank_models": with_ctes(
            "SELECT *, CAST(row_number() OVER (ORDER BY accuracy DESC, model_id) AS INTEGER) AS position FROM ("
            + accuracy.format(key="model_id", source=f"SELECT concat(model_id, '-', variant) AS model_id, strict_match FROM ({strict_rows})")
            + ") QUALIFY position <= 20", "predictions"),
        "improvement_band": with_ctes(_improvement(BAND), "summary"),
        "error_examples": with_ctes(_first_rows("NOT strict_match", 5, error_columns), "scored", "ranked"),
        "sample_predictions": with_ctes(
            _first_rows("true", 10, "predicted_sql, ground_truth"), "scored", "ranked"),
        "random_examples": with_ctes(
            f"SELECT {keyed}, predicted_sql, ground_truth, strict_match FROM scored "
            "ORDER BY md5(concat('42|', row_id, '|', model_id)) LIMIT 3", "scored"),
        "drawn_examples": with_ctes(
            "", "scored").rstrip() + ", ordered AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', row_id, '|', model_id))) AS place FROM scored), "
            "draws AS (SELECT range AS draw, ('0x' || substr(md5('42|draw|' || range), 1, 13))::BIGINT::HUGEINT AS level FROM range(1, 21)) "
            "SELECT draw, row_id, model_id, predicted_sql, ground_truth, strict_match FROM draws "
            "JOIN ordered ON place = level * (SELECT count(*) FROM scored) // 4503599627370496 + 1",
        "batches_by_length": BATCHES + " SELECT doc_id, n_tokens, length_class, salt, batch FROM batched",
        "padding_report": (
            BATCHES + " SELECT count(*) AS n_batches, sum(n)::BIGINT AS n_prompts, sum(t)::BIGINT AS n_tokens, sum(n * m)::BIGINT AS padded_tokens, "
            "(sum(n * m) - sum(t)) / sum(n * m) AS padding_share FROM (SELECT count(*) AS n, sum(n_tokens) AS t, max(n_tokens) AS m FROM batched "
            "GROUP BY length_class, salt, batch)"),
        "latency_quantiles": (
            f"SELECT {as_text('window_start')} AS window_start, {as_text('window_start + INTERVAL 1 DAY')} AS window_end, count(*) AS n_values, "
            + ", ".join(f"quantile_disc(CASE WHEN value = 0 THEN 0 ELSE floor(abs(value) / u + 0.5) * u * sign(value) END, {p}) AS {name}"
                        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
            + f" FROM (SELECT *, pow(10.0::DOUBLE, floor(log10(nullif(abs(value), 0))) - 2) AS u FROM ({_windows('12')})) GROUP BY window_start"),
        "evaluate_models": with_ctes(
            _summary("(SELECT s.* FROM scored s JOIN ranked USING (row_id) WHERE sample_rank <= 1000)", "model_id"),
            "scored", "ranked"),
        "read_corpus": with_ctes("SELECT row_id, context, question, answer FROM pairs", "pairs"),
        "to_conversation": with_ctes(
            f"SELECT row_id, {messages_json(f'''('{VERBATIM}' || context)''', 'answer')} AS verbatim, "
            f"{messages_json(f'''('{STRIPPED}' || context)''', strip('answer'))} AS stripped FROM pairs", "pairs"),
        "sample_exact": with_ctes(f"SELECT * FROM pairs WHERE row_id IN {rank_below(10_000)}", "pairs"),
        "split_train_test": with_ctes(
            f"SELECT row_id, question, CASE WHEN row_id IN {rank_below(2_500, SPLIT_KEY)} THEN 'test' "
            "ELSE 'train' END AS split FROM pairs", "pairs"),
        "prepare_corpus": with_ctes("", "pairs").rstrip() + f", {_prepared()} SELECT row_id, split, "
            + messages_json(f"('{VERBATIM}' || context)", "answer") + " AS messages FROM prepared",
        "eval_sample": with_ctes(
            "SELECT row_id, sample_rank, r.question, ground_truth FROM ranked r JOIN records USING (row_id) "
            "WHERE sample_rank <= 1000", "ranked", "records"),
        "unpack_messages": with_ctes("SELECT * FROM records", "records"),
        "render_training_text": with_ctes(
            f"SELECT row_id, {chatml(THREE)} AS chatml, '<|begin_of_text|>' || "
            + chat("<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>", THREE)
            + " AS headers FROM records", "records"),
        "render_given_templates": with_ctes(
            f"SELECT row_id, {chatml(THREE)} || {OPEN_REPLY} AS chatml, "
            f"'<s>' || upper(system) || '\n' || '[INST] ' || {strip('question')} || ' [/INST]' || ' ' || ground_truth || '</s>' AS instruct FROM records",
            "records"),
        "render_prompt": with_ctes(
            f"SELECT row_id, {chatml(THREE[:2])} || {OPEN_REPLY} AS prompt FROM records", "records"),
        "render_inference_prompt": with_ctes(
            f"SELECT row_id, '{INFERENCE_SYSTEM}\n\n' || {USER_TEXT} AS plain, "
            + chatml([("system", f"'{INFERENCE_SYSTEM}'"), ("user", f"({USER_TEXT})")])
            + f" || {OPEN_REPLY} AS chatml, 'Schema: ' || context || '\nQuestion: ' || question || '\nSQL:' AS short FROM pairs",
            "pairs"),
        "format_check": with_ctes(
            "SELECT kind, count(*) AS n_texts, CAST(count_if(ends_with(" + strip("text") + ", 'assistant')) AS BIGINT) AS n_ends_open "
            f"FROM (SELECT 'training' AS kind, {chatml(THREE)} AS text FROM records UNION ALL "
            f"SELECT 'prompt' AS kind, {chatml(THREE[:2])} || {OPEN_REPLY} AS text FROM records) GROUP BY kind",
            "records"),
        "length_profile": with_ctes(
            "SELECT count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS total_tokens, CAST(min(n) AS INTEGER) AS min_tokens, "
            "quantile_cont(n, 0.5) AS p50_tokens, quantile_cont(n, 0.95) AS p95_tokens, quantile_cont(n, 0.99) AS p99_tokens, "
            "CAST(max(n) AS INTEGER) AS max_tokens, CAST(count_if(n > 2048) AS BIGINT) AS n_over_limit "
            f"FROM (SELECT {TOKENS} AS n FROM ({text_rows}))", "records"),
        "corpus_profile": with_ctes(
            "SELECT n_rows, CASE WHEN n_rows < 1000 THEN 'n<1K' WHEN n_rows < 10000 THEN '1K<n<10K' "
            "WHEN n_rows < 100000 THEN '10K<n<100K' ELSE 'n>100K' END AS size_class, "
            "example_schema, question_words / n_rows AS avg_question_words, min_question_words, "
            "max_question_words, single_table_rows, multi_table_rows FROM ("
            "SELECT count(*) AS n_rows, min(split_part(context, ';', 1) || ';') AS example_schema, "
            "sum(len(string_split(question, ' '))) AS question_words, "
            "CAST(min(len(string_split(question, ' '))) AS INTEGER) AS min_question_words, "
            "CAST(max(len(string_split(question, ' '))) AS INTEGER) AS max_question_words, "
            "CAST(count_if(len(string_split(context, 'CREATE TABLE')) = 2) AS BIGINT) AS single_table_rows, "
            "CAST(count_if(len(string_split(context, 'CREATE TABLE')) > 2) AS BIGINT) AS multi_table_rows FROM pairs)",
            "pairs"),
        "roundtrip_prepared": with_ctes("", "pairs").rstrip() + f", {_prepared()} "
            "SELECT row_id, split, question, answer AS ground_truth FROM prepared",
        "parse_requests": with_ctes(PARSED, "pairs"),
        "read_requests": with_ctes(
            f"SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_records FROM ({PARSED}) GROUP BY 1", "pairs"),
        "read_request_arrays": with_ctes(
            f"SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_records FROM ({PARSED}) GROUP BY 1", "pairs"),
        "write_results": with_ctes(
            "SELECT q.question, q.context, nullif(predicted_sql, '') AS predicted_sql, ground_truth AS ground_truth_sql "
            "FROM predictions JOIN pairs q USING (row_id)", "predictions"),
        "run_documents": with_ctes(
            "SELECT 'r1' AS run_id, b.num_samples, 8::BIGINT AS batch_size, 0.0::DOUBLE AS temperature, 'base' AS base_model, "
            "'tuned' AS adapter_path, '42' AS seed, '2025-01-01T00:00:00' AS timestamp, "
            "b.accuracy AS baseline_accuracy, t.accuracy AS tuned_accuracy, "
            "t.avg_logical_form_similarity AS tuned_logical_form, "
            f"(SELECT count(*) FROM ({_sample_rows('NOT strict_match', 5)}) WHERE model_id = 'base') AS n_errors, "
            f"(SELECT string_agg(predicted_sql, ' | ' ORDER BY position) FROM ({_sample_rows('true', 10)}) WHERE model_id = 'tuned') AS tuned_samples, "
            f"(SELECT string_agg(question, ' | ' ORDER BY position) FROM ({_sample_rows('NOT strict_match', 5)}) WHERE model_id = 'base') AS error_questions, "
            "t.accuracy - b.accuracy AS absolute_improvement, t.num_correct - b.num_correct AS correct_gain "
            "FROM sample_summary b JOIN sample_summary t ON b.model_id = 'base' AND t.model_id = 'tuned'",
            "sample_summary"),
        "run_history": with_ctes(
            f"SELECT 'new' AS run_id, {', '.join(figures + later)} FROM sample_summary WHERE model_id = 'tuned' UNION ALL "
            f"SELECT 'old' AS run_id, {', '.join(figures)}, {', '.join(f if f in known else '0' for f in later)} FROM sample_summary, range(2) "
            "WHERE model_id = 'tuned'", "sample_summary"),
        "improvement_history": with_ctes(
            f"SELECT run_id, i.* FROM ({_improvement().replace('summary', 'sample_summary')}) i, (VALUES ('new'), ('old'), ('old')) r(run_id)",
            "sample_summary"),
        "rating": with_ctes(
            "SELECT *, " + ", ".join(
                f"CASE WHEN base * 100 >= {top} THEN 'state_of_the_art' WHEN base * 100 >= {excellent} THEN 'excellent' "
                f"WHEN base * 100 >= {good} THEN 'good' END AS {name}"
                for name, (good, excellent, top) in {"spider": (70, 80, 85), "wikisql": (85, 90, 95), "bird": (50, 65, 75)}.items()
            ) + ", CASE WHEN (tuned - base) * 100 >= 30 THEN 'state_of_the_art' WHEN (tuned - base) * 100 >= 20 THEN 'excellent' "
            "WHEN (tuned - base) * 100 >= 10 THEN 'good' END AS custom FROM (SELECT variant, "
            "count_if(strict_match AND model_id = 'base') / nullif(count_if(model_id = 'base'), 0) AS base, "
            "count_if(strict_match AND model_id = 'tuned') / nullif(count_if(model_id = 'tuned'), 0) AS tuned "
            f"FROM ({strict_rows}) GROUP BY variant)", "predictions"),
        "group_turns": (
            "SELECT conv_id, count(*) AS n_messages, '[' || string_agg('{\"role\":' || to_json(role)::VARCHAR || ',\"content\":' || "
            "to_json(text)::VARCHAR || '}', ',' ORDER BY turn) || ']' AS messages, arg_min(text, turn) AS system, "
            "max(text) FILTER (WHERE back = 2) AS question, arg_max(text, turn) AS ground_truth FROM ("
            "SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) GROUP BY conv_id"),
        "format_check_turns": (
            "SELECT count(*) AS n_texts, CAST(count_if(last_role = 'user' OR ends_with(" + strip("last_text") + " || '<|im_end|>', 'assistant')) AS BIGINT) "
            "AS n_ends_open FROM (SELECT arg_max(role, turn) AS last_role, arg_max(text, turn) AS last_text FROM conversations GROUP BY conv_id)"),
        "render_null_messages": with_ctes(
            f"SELECT row_id, {chatml(THREE)} AS text, {chatml(THREE[:2])} || {OPEN_REPLY} AS prompt, "
            "CAST(row_id % 4 <> 0 AS BIGINT) AS n_null_parts FROM (SELECT row_id, "
            "CASE WHEN row_id % 4 = 1 THEN '' ELSE system END AS system, CASE WHEN row_id % 4 = 2 THEN '' ELSE question END AS question, "
            "CASE WHEN row_id % 4 = 3 THEN '' ELSE ground_truth END AS ground_truth FROM records)", "records"),
        "length_profile_documents": (
            "SELECT count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS total_tokens, CAST(min(n) AS INTEGER) AS min_tokens, "
            "quantile_cont(n, 0.5) AS p50_tokens, quantile_cont(n, 0.95) AS p95_tokens, quantile_cont(n, 0.99) AS p99_tokens, "
            "CAST(max(n) AS INTEGER) AS max_tokens, CAST(count_if(n > 2048) AS BIGINT) AS n_over_limit "
            f"FROM (SELECT {TOKENS} AS n FROM documents)"),
        "pack_sequences": with_ctes("", "records").rstrip() + f""", texts AS (
            SELECT 'd' || doc_id AS key, text FROM documents UNION ALL SELECT 'p' || row_id AS key, {chatml(THREE)} AS text FROM records
          ), counted AS (SELECT key, {TOKENS} AS n, md5('42|' || key) AS h FROM texts),
          total AS (SELECT ceil(sum(n) / 200000)::BIGINT AS shards FROM counted),
          placed AS (SELECT *, ('0x' || substr(h, 1, 12))::BIGINT % shards AS shard FROM counted, total WHERE n > 0),
          started AS (SELECT *, (sum(n) OVER (PARTITION BY shard ORDER BY h, key) - n)::BIGINT AS s FROM placed),
          spans AS (SELECT *, unnest(range(s // 2048, (s + n - 1) // 2048 + 1)) AS pack FROM started)
          SELECT shard, pack, key, greatest(s, pack * 2048) - pack * 2048 AS pack_offset, greatest(s, pack * 2048) - s AS token_start,
            least(s + n, (pack + 1) * 2048) - s AS token_end FROM spans""",
        "request_cache": with_ctes(
            "SELECT CAST(sum(n) AS BIGINT) AS n_requests, count(*) AS n_distinct, max(n) AS n_most_frequent, "
            "CAST(sum(n) - count(*) AS BIGINT) AS n_hits, (sum(n) - count(*)) / sum(n) AS hit_rate "
            "FROM (SELECT md5(question), md5(context), count(*) AS n FROM repeated GROUP BY 1, 2)", "repeated"),
        "score_batch": with_ctes(
            f"SELECT row_id, question, {table_answer} AS predicted_sql, "
            "CASE WHEN contains(question, '5-LOW') THEN 'ValueError: question refused' END AS predict_error, "
            "CASE WHEN contains(question, '5-LOW') THEN 'Empty SQL string' END AS parsing_error, "
            "CAST(NULL AS VARCHAR) AS dangerous_word FROM repeated", "repeated"),
        "stop_markers": with_ctes(
            f"SELECT {keyed}, array_to_string({_markers()}, ' | ') AS stop_markers FROM generations", "generations"),
        "stop_position": with_ctes("", "generations").rstrip() + _stop_position(keyed),
        "stop_marker_counts": with_ctes(
            f"SELECT model_id, n_rows, n_flagged, marker, CAST(count_if(list_contains(found, marker)) AS BIGINT) AS n_marked FROM ("
            f"SELECT model_id, found, count(*) OVER (PARTITION BY model_id) AS n_rows, "
            f"CAST(count_if(len(found) > 0) OVER (PARTITION BY model_id) AS BIGINT) AS n_flagged, "
            f"unnest({PHRASES + ['non_ascii']!r}) AS marker FROM (SELECT model_id, {_markers()} AS found FROM generations)) "
            "GROUP BY ALL", "generations"),
        "first_valid_attempt": with_ctes(
            "SELECT request_id, min(attempt) FILTER (WHERE valid) AS attempt, "
            "arg_min(predicted_sql, attempt) FILTER (WHERE valid) AS predicted_sql, count(*) AS n_attempts, "
            "count_if(valid) = 0 AS failed FROM (SELECT CAST(floor(row_id / 2) AS BIGINT) AS request_id, "
            "(row_id % 2) * 2 + CASE WHEN model_id = 'base' THEN 1 ELSE 2 END AS attempt, predicted_sql, "
            f"{parse_error('predicted_sql')} IS NULL AS valid FROM predictions) WHERE attempt <= 3 GROUP BY request_id",
            "predictions"),
        "rate_limit": (
            f"SELECT {as_text('w')} AS window_start, {as_text('w + INTERVAL 1 DAY')} AS window_end, client, n_requests, "
            "n_requests > 3 AS over_limit, greatest(n_requests - 3, 0) AS excess FROM ("
            "SELECT date_trunc('day', ts) AS w, user_id AS client, count(*) AS n_requests FROM events GROUP BY ALL)"),
        "admit_requests": (
            "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id) <= 3 AS admitted FROM events"),
        "stream_cache": f"{CACHED} SELECT event_id, hit, answered_by FROM cached",
        "cache_hit_rate": (
            f"{CACHED} SELECT {as_text('w')} AS window_start, {as_text('w + INTERVAL 1 DAY')} AS window_end, count(*) AS n_requests, "
            "CAST(count_if(hit) AS BIGINT) AS n_hits, count_if(hit) / count(*) AS hit_rate FROM ("
            "SELECT date_trunc('day', ts) AS w, hit FROM cached) GROUP BY w"),
        "resolve_attempts": (
            "WITH tried AS (SELECT event_id // 4 AS request_id, CAST(event_id % 4 + 1 AS INTEGER) AS attempt, epoch_us(ts) // 1000 AS millis, CASE event_type "
            "WHEN 'view' THEN 'SELECT 1' WHEN 'signup' THEN 'select a from t' ELSE 'no answer' END AS predicted_sql FROM events), "
            "ends AS (SELECT request_id, min(attempt) FILTER (WHERE predicted_sql <> 'no answer') AS good, max(attempt) AS last, "
            "arg_min(predicted_sql, attempt) FILTER (WHERE predicted_sql <> 'no answer') AS text FROM tried WHERE attempt <= 3 GROUP BY request_id) "
            "SELECT request_id, CASE WHEN good IS NULL THEN 'failed' ELSE 'valid' END AS outcome, coalesce(good, last) AS attempt, "
            "text AS predicted_sql, NULL::VARCHAR AS retry_at FROM ends UNION ALL SELECT request_id, 'retry', attempt, NULL, "
            "CAST(millis + 500 * (1 << attempt) AS VARCHAR) FROM tried JOIN ends USING (request_id) WHERE attempt < least(3, coalesce(good, 3))"),
        "generation_histogram": (
            f"SELECT {as_text('w')} AS window_start, {as_text('w + INTERVAL 1 HOUR')} AS window_end, count(*) AS n_generations, "
            "CAST(sum(CAST(round(value * 1000000) AS BIGINT)) AS BIGINT) AS duration_micros, "
            + ", ".join(
                f"CAST(count_if(value <= {b}::DOUBLE) AS BIGINT) AS le_{str(b).replace('.', '_')}" for b in BOUNDS)
            + " FROM (SELECT date_trunc('hour', ts) AS w, value FROM events) GROUP BY w"),
        "service_metrics": (
            f"SELECT {as_text('window_start')} AS window_start, {as_text('window_start + INTERVAL 1 DAY')} AS window_end, "
            "count(*) AS n_requests, "
            + ", ".join(f"list_min(list_filter({LATENCIES}, lambda b: b >= quantile_disc(value, {p}))) AS {name}"
                        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
            + ", count_if(event_type = 'error') / count(*) AS error_rate, "
            "count_if(event_type IN ('purchase', 'signup')) / count(*) AS validation_rate, "
            "count_if(event_type = 'view') / count(*) AS cache_hit_rate, "
            r"sum(CAST(regexp_extract(props, '\d+') AS BIGINT)) / count(*) AS cost_per_request "
            f"FROM ({_windows('12')}) GROUP BY window_start"),
    }
    return sql
