"""Question-to-SQL tables derived from ``orders``: the inputs of tests, queries and bench.

The recipes are plain SQL that Spark and DuckDB read alike: quotes come from ``chr(34)`` and
``chr(39)``, other alphabets stand as literals, and only integers are turned into text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAIRS = """
SELECT o_orderkey AS row_id,
  CASE o_orderkey % 6
    WHEN 0 THEN concat('What is the total price of order ', cast(o_orderkey AS string), '?')
    WHEN 1 THEN concat('How many ', o_orderpriority, ' orders has customer ', cast(o_custkey AS string), ' placed?')
    WHEN 2 THEN concat('Which statuses have more than ', cast(o_custkey AS string), ' orders?')
    WHEN 3 THEN concat('Who placed order ', cast(o_orderkey AS string), '?')
    WHEN 4 THEN concat('List the latest 3 orders of customer ', cast(o_custkey AS string), '.')
    ELSE concat('Name the customer behind order ', cast(o_orderkey AS string), '.') END AS question,
  CASE WHEN o_orderkey % 6 IN (3, 5)
    THEN 'CREATE TABLE customer (c_custkey INT, c_name VARCHAR); CREATE TABLE orders (o_orderkey INT, o_custkey INT)'
    ELSE 'CREATE TABLE orders (o_orderkey INT, o_custkey INT, o_orderstatus VARCHAR, o_orderpriority VARCHAR, o_totalprice DOUBLE, o_orderdate DATE)' END AS context,
  CASE o_orderkey % 6
    WHEN 0 THEN concat('SELECT o_totalprice FROM orders WHERE o_orderkey = ', cast(o_orderkey AS string))
    WHEN 1 THEN concat('SELECT COUNT(*) FROM orders WHERE o_orderpriority = ', chr(34), o_orderpriority, chr(34), ' AND o_custkey = ', cast(o_custkey AS string))
    WHEN 2 THEN concat('SELECT o_orderstatus, COUNT(*) FROM orders GROUP BY o_orderstatus HAVING COUNT(*) > ', cast(o_custkey AS string), ' ORDER BY o_orderstatus')
    WHEN 3 THEN concat('SELECT T1.c_name FROM customer AS T1 JOIN orders AS T2 ON T1.c_custkey = T2.o_custkey WHERE T2.o_orderkey = ', cast(o_orderkey AS string))
    WHEN 4 THEN concat('SELECT o_orderkey FROM orders WHERE o_custkey = ', cast(o_custkey AS string), ' ORDER BY o_orderdate DESC LIMIT 3')
    ELSE concat('SELECT c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey = ', cast(o_orderkey AS string), ')') END AS answer
FROM orders
"""

_MODELS_SPARK = "explode(array(named_struct('model_id', 'base', 'k', 0), named_struct('model_id', 'tuned', 'k', 1)))"
_MODELS_DUCKDB = "unnest([{'model_id': 'base', 'k': 0}, {'model_id': 'tuned', 'k': 1}])"

_GENERATIONS = """
SELECT row_id, model_id, variant, answer AS ground_truth,
  CASE variant
    WHEN 0 THEN answer
    WHEN 1 THEN concat(answer, ';')
    WHEN 2 THEN concat(answer, ' ;')
    WHEN 3 THEN lower(answer)
    WHEN 4 THEN replace(answer, chr(34), chr(39))
    WHEN 5 THEN replace(answer, ' FROM ', concat(chr(10), '  FROM '))
    WHEN 6 THEN concat('```sql', chr(10), answer, chr(10), '```')
    WHEN 7 THEN concat('system', chr(10), 'schema', chr(10), 'user', chr(10), 'q', chr(10), 'assistant', chr(10), answer)
    WHEN 8 THEN concat(answer, '<|im_end|>', chr(10), 'more')
    WHEN 9 THEN concat(answer, chr(10), chr(10), 'Explanation follows')
    WHEN 10 THEN concat(answer, ' Note: checked')
    WHEN 11 THEN 'Which order do you mean?'
    WHEN 12 THEN replace(answer, 'o_orderkey', 'order_id')
    WHEN 13 THEN concat(answer, ' -- by key')
    WHEN 14 THEN replace(answer, ' WHERE ', ' ')
    ELSE concat(answer, 'ཁ tail') END AS raw_text
FROM (SELECT row_id, answer, model_id, CASE WHEN model_id = 'tuned' AND v IN (11, 14) THEN 0 ELSE v END AS variant
      FROM (SELECT row_id, answer, m.model_id AS model_id,
                   (row_id * 7 + m.k * 5 + CAST(floor(row_id / 16) AS BIGINT)) % 16 AS v
            FROM (SELECT row_id, answer, {models} AS m FROM pairs) e) g) g2
"""

PAIRS_DUCKDB = PAIRS
GENERATIONS_DUCKDB = _GENERATIONS.replace("{models}", _MODELS_DUCKDB)
_GENERATIONS_SPARK = _GENERATIONS.replace("{models}", _MODELS_SPARK)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, question, context, answer), one row per order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(PAIRS.replace("FROM orders\n", "FROM {orders}\n"), orders=orders)


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, model_id, variant, ground_truth, raw_text), two rows per order."""
    return spark.sql(
        _GENERATIONS_SPARK.replace("FROM pairs", "FROM {pairs}"), pairs=pairs(spark, sf_dir)
    )
