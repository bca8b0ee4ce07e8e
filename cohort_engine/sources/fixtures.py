"""Fixture cohorts built from the driver tables.

The driver tables hold no biomarker cohort, so these joins and aggregates stand in
for one.  Each builder has an SQL twin (``*_SQL``) that DuckDB runs on the same
parquet files; ``__spark_entry__.oracle_sql`` composes the twins with the SQL of
each operator.

C1  orders cohort: non-negative features, NULLs, batches, age and sex
C2  embedding cohort: 64 features with negatives, strong imbalance
C6  products of embedding coordinates: 2,080 features, as column blocks
C3  document cohort: text statistics, batch = source, carries signal
C4  score table: fixed labels / scores / predictions for metric checks
C5  signal cohort: C1 restricted to orders with line items, response = many lines
CD  dirty copy of the orders cohort for the violation report
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.operators.blocks import BlockMatrix, from_arrays
from cohort_engine.session import ensure_checkpoint_dir
from cohort_engine.sources.tables import read_csvs, read_table

ID = "patient_id"
RESPONSE = "response"

C1_FEATURES = ["age", "totalprice", "qty", "price", "disc", "tax", "lines", "constant_col"]
C2_FEATURES = [f"f{i:02d}" for i in range(64)]
C3_FEATURES = ["n_chars", "n_words", "distinct_ratio", "digit_share"]
C5_FEATURES = ["age", "totalprice", "qty", "price", "disc", "tax", "constant_col"]


def _line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("price"),
        (F.avg("l_discount") + F.lit(0.0)).alias("disc"),
        (F.max("l_tax") + F.lit(0.0)).alias("tax"),
        F.count(F.lit(1)).cast("double").alias("lines"),
    )


def _orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .join(n, F.col("c_nationkey") == n["n_nationkey"]))


def c1_orders(spark: SparkSession, sf_dir: str, inner: bool = False, batch: str = "n_regionkey") -> DataFrame:
    base = _orders_base(spark, sf_dir)
    li = _line_stats(spark, sf_dir)
    joined = base.join(li, base["o_orderkey"] == li["l_orderkey"], "inner" if inner else "left")
    return joined.select(
        F.col("o_orderkey").alias(ID),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(RESPONSE),
        (F.col("o_custkey") % 121).cast("double").alias("age"),
        F.when(F.col("o_custkey") % 2 == 0, "M").otherwise("F").alias("sex"),
        F.col(batch).cast("double").alias("batch"),
        F.col("o_totalprice").alias("totalprice"),
        "qty", "price", "disc", "tax", "lines",
        F.lit(7.0).alias("constant_col"),
    )


C1_SQL = """
SELECT o.o_orderkey AS patient_id,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS response,
       CAST(o.o_custkey % 121 AS DOUBLE) AS age,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
       CAST(n.n_regionkey AS DOUBLE) AS batch,
       o.o_totalprice AS totalprice,
       l.qty, l.price, l.disc, l.tax, l.lines,
       CAST(7.0 AS DOUBLE) AS constant_col
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS qty, SUM(l_extendedprice) AS price,
                  AVG(l_discount) + 0.0 AS disc, MAX(l_tax) + 0.0 AS tax,
                  CAST(COUNT(*) AS DOUBLE) AS lines
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def c2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias(ID),
        F.when(F.col("label") == 0, 1).otherwise(0).alias(RESPONSE),
        *[F.col("embedding")[i].cast("double").alias(f"f{i:02d}") for i in range(64)],
    )


C2_SQL = ("SELECT vec_id AS patient_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS response, "
          + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i:02d}" for i in range(64))
          + " FROM embeddings")

C6_FEATURES = [f"q{i:02d}_{j:02d}" for i in range(64) for j in range(i, 64)]


def c6_products(spark: SparkSession, sf_dir: str) -> BlockMatrix:
    """A wide cohort: all 2,080 products of two embedding coordinates, with holes, as column blocks."""
    e = read_table(spark, sf_dir, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    hole = lambda i, j: (F.col("vec_id") + i + j) % 23 == 0
    cells = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.transform(
        F.sequence(i, F.lit(63)), lambda j: F.when(~hole(i, j), F.get("e", i) * F.get("e", j)))))
    rows = e.select(F.col("vec_id").alias(ID), F.when(F.col("label") == 0, 1).otherwise(0).alias(RESPONSE),
                    (F.col("vec_id") % 5).cast("double").alias("batch"), cells.alias("cells"))
    return from_arrays(rows, [ID, RESPONSE, "batch"], "cells", C6_FEATURES)


#: The same in long form: ``(patient_id, response, batch, feature, value)``.
C6_SQL = """
SELECT vec_id AS patient_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS response, CAST(vec_id % 5 AS DOUBLE) AS batch,
       'q' || lpad(CAST(i AS VARCHAR), 2, '0') || '_' || lpad(CAST(j AS VARCHAR), 2, '0') AS feature,
       CASE WHEN (vec_id + i + j) % 23 <> 0 THEN CAST(embedding[i + 1] AS DOUBLE) * CAST(embedding[j + 1] AS DOUBLE) END AS value
FROM embeddings, range(64) a(i), range(64) b(j) WHERE i <= j
"""

# Word separators used by the document statistics (both engines read this class alike).
_WS = "[ \\t\\n\\r\\f]+"


def c3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    doc = read_table(spark, sf_dir, "documents")
    words = F.filter(F.split(F.col("text"), _WS), lambda w: w != "")
    j = lab.join(doc, "doc_id")
    return j.select(
        F.col("doc_id").alias(ID),
        F.col("quality").alias(RESPONSE),
        F.col("source").alias("batch"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        F.try_divide(F.size(F.array_distinct(words)).cast("double"), F.size(words).cast("double"))
        .alias("distinct_ratio"),
        F.try_divide(F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double"),
                     F.length("text").cast("double")).alias("digit_share"),
    )


C3_SQL = """
SELECT l.doc_id AS patient_id, l.quality AS response, d.source AS batch,
       CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(len(list_filter(string_split_regex(d.text, '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS DOUBLE) AS n_words,
       CAST(len(list_distinct(list_filter(string_split_regex(d.text, '[ \\t\\n\\r\\f]+'), lambda w: w <> ''))) AS DOUBLE)
         / NULLIF(CAST(len(list_filter(string_split_regex(d.text, '[ \\t\\n\\r\\f]+'), lambda w: w <> '')) AS DOUBLE), 0)
         AS distinct_ratio,
       CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS DOUBLE) / NULLIF(CAST(length(d.text) AS DOUBLE), 0)
         AS digit_share
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def c4_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed (label, score, prediction) rows: many tied scores on purpose."""
    o = read_table(spark, sf_dir, "orders")
    score = (F.floor(F.col("o_totalprice") / F.lit(6000.0)).cast("double") / F.lit(100.0))
    return o.select(
        F.col("o_orderkey").alias(ID),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        score.alias("score"),
    ).withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))


C4_SQL = """
SELECT patient_id, label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM (SELECT o_orderkey AS patient_id,
             CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
             CAST(floor(o_totalprice / 6000.0) AS DOUBLE) / 100.0 AS score
      FROM orders)
"""


def c5_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    c1 = c1_orders(spark, sf_dir, inner=True)
    return (c1.withColumn(RESPONSE, F.when(F.col("lines") >= 6, 1).otherwise(0))
            .drop("lines"))


C5_SQL = """
SELECT o.o_orderkey AS patient_id,
       CASE WHEN l.lines >= 6 THEN 1 ELSE 0 END AS response,
       CAST(o.o_custkey % 121 AS DOUBLE) AS age,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
       CAST(n.n_regionkey AS DOUBLE) AS batch,
       o.o_totalprice AS totalprice,
       l.qty, l.price, l.disc, l.tax,
       CAST(7.0 AS DOUBLE) AS constant_col
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT l_orderkey, SUM(l_quantity) AS qty, SUM(l_extendedprice) AS price,
             AVG(l_discount) + 0.0 AS disc, MAX(l_tax) + 0.0 AS tax,
             CAST(COUNT(*) AS DOUBLE) AS lines
      FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cohort as raw strings and codes, with invalid values on purpose.

    response is the raw status code (P -> 2, and NULL for urgent-ish P orders),
    age is -50 on urgent orders, sex is 'X' on low-priority orders, and
    ``priority`` is text that fails numeric coercion on medium-priority orders.
    """
    o = read_table(spark, sf_dir, "orders")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias(ID),
        F.when((st == "P") & (pr == "2-HIGH"), F.lit(None).cast("int"))
        .when(st == "F", 1).when(st == "O", 0).otherwise(2).alias(RESPONSE),
        F.when(pr == "1-URGENT", F.lit(-50.0)).otherwise((F.col("o_custkey") % 121).cast("double")).alias("age"),
        F.when(pr == "5-LOW", "X").when(F.col("o_custkey") % 2 == 0, "M").otherwise("F").alias("sex"),
        F.when(pr == "3-MEDIUM", "medium").otherwise(F.substring(pr, 1, 1)).alias("priority"),
        F.col("o_totalprice").alias("totalprice"),
    )


DIRTY_SQL = """
SELECT o_orderkey AS patient_id,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN CAST(NULL AS INTEGER)
            WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 ELSE 2 END AS response,
       CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(-50.0 AS DOUBLE)
            ELSE CAST(o_custkey % 121 AS DOUBLE) END AS age,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'X' WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'medium' ELSE substr(o_orderpriority, 1, 1) END AS priority,
       o_totalprice AS totalprice
FROM orders
"""

BUILDERS = {
    "c1": (c1_orders, C1_SQL, C1_FEATURES),
    "c2": (c2_embeddings, C2_SQL, C2_FEATURES),
    "c3": (c3_documents, C3_SQL, C3_FEATURES),
    "c5": (c5_signal, C5_SQL, C5_FEATURES),
}


def marked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a CSV user brings them: every cell text, missing cells marked in several ways."""
    o = read_table(spark, sf_dir, "orders")
    pr, key = F.col("o_orderpriority"), F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("Patient_ID"),
        F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").otherwise("2").alias("RESPONSE"),
        F.when(pr == "1-URGENT", "NA").when(pr == "4-NOT SPECIFIED", "nan").otherwise((key % 130).cast("string")).alias("age"),
        F.when(pr == "5-LOW", "null").when(key % 2 == 0, "M").otherwise("F").alias("sex"),
        F.when(pr == "3-MEDIUM", "n/a").when(pr == "2-HIGH", "high").otherwise(F.substring(pr, 1, 1)).alias("priority"),
    )


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``marked_orders`` written as CSV to the shared folder and read as S1 does."""
    path = f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}.csv"
    marked_orders(spark, sf_dir).write.option("header", True).csv(path)
    return read_csvs(spark, path)


CSV_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS patient_id,
       CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 ELSE 2 END AS response,
       CASE WHEN o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED') THEN NULL ELSE CAST(o_custkey % 130 AS DOUBLE) END AS age,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'high'
            ELSE substr(o_orderpriority, 1, 1) END AS priority
FROM orders
"""
