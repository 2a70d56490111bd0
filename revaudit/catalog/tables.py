"""Review-shaped views over the test tables.

The SQL runs unchanged on Spark and DuckDB. ``{documents}`` and ``{orders}`` stand for the
source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEWS = """
SELECT
  CASE WHEN doc_id % 97 = 13 THEN NULL
       WHEN doc_id % 211 = 7 THEN 'R000007'
       WHEN doc_id < 1000000 THEN concat('R', lpad(CAST(doc_id AS STRING), 6, '0'))
       ELSE concat('R', CAST(doc_id AS STRING)) END AS review_id,
  CASE WHEN doc_id % 61 = 3 THEN NULL
       ELSE concat('B', lpad(CAST(doc_id % 23 AS STRING), 4, '0')) END AS business_id,
  concat('U', lpad(CAST(doc_id % 131 AS STRING), 5, '0')) AS user_id,
  CASE WHEN doc_id % 100 = 42 THEN NULL
       WHEN doc_id % 50 = 9 THEN 'Best food, poor staff!'
       WHEN doc_id % 83 = 11 THEN '@#$' ELSE text END AS text,
  CAST(CASE WHEN doc_id % 71 = 5 THEN NULL WHEN doc_id % 16 < 2 THEN 1
            WHEN doc_id % 16 < 4 THEN 2 WHEN doc_id % 16 < 7 THEN 3
            WHEN doc_id % 16 < 11 THEN 4 ELSE 5 END AS BIGINT) AS rating,
  CASE WHEN doc_id % 53 = 2 THEN NULL
       ELSE DATE '2024-01-01' + CAST(doc_id % 365 AS INT) END AS date,
  CASE WHEN doc_id % 67 = 4 THEN NULL WHEN doc_id % 50 = 17 THEN 300
       ELSE ((doc_id % 7) * (doc_id % 7)) % 7 END AS useful_votes,
  CASE WHEN doc_id % 43 = 6 THEN NULL ELSE doc_id % 3 END AS funny_votes,
  (doc_id * 5) % 4 AS cool_votes,
  CAST(length(text) AS BIGINT) AS text_length,
  CASE WHEN doc_id % 29 = 1 THEN NULL ELSE lang END AS business_category,
  doc_id % 10 > 6 AS has_owner_response,
  source AS platform
FROM {documents}
"""

REPEATED_USER = "user_id = 'U00009'"

ORDER_REVIEWS = """
SELECT o_orderkey AS review_id, o_custkey AS business_id,
       CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS rating,
       CAST(o_orderdate AS DATE) AS date,
       CAST(floor(o_totalprice / 10000) AS BIGINT) AS useful_votes,
       o_orderstatus AS business_category
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REVIEWS, documents=table(spark, sf_dir, "documents"))


def reviews_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews and, once more, those of one user: exact duplicate rows."""
    once = reviews(spark, sf_dir)
    return once.unionByName(once.filter(REPEATED_USER))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDER_REVIEWS, orders=table(spark, sf_dir, "orders"))
