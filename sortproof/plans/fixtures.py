"""Record views of the driver tables.

* orders -> one record per order: ``key`` = first 10 bytes of md5(o_orderkey),
  ``value`` = ``o_custkey|o_orderstatus|o_orderpriority`` padded to 90 bytes.
  Unique keys.
* lineitem -> key = first 10 bytes of md5(l_orderkey|l_linenumber): tied keys.
* events -> "files" by ``event_type``, ``pos`` = ``event_id``, key = first 10
  bytes of md5(user_id): real misorders inside files and at file boundaries.

Only built-in column functions; the parquet scans keep column pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def md5_key(text) -> F.Column:
    """First 10 bytes of md5(text) as BINARY."""
    return F.unhex(F.substring(F.md5(text), 1, 2 * R.KEY_LENGTH))


def padded_value(*parts) -> F.Column:
    return F.rpad(F.concat_ws("|", *[p.cast("string") for p in parts]),
                  R.VALUE_LENGTH, " ").cast("binary")


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, key, value) from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        md5_key(F.col("o_orderkey").cast("string")).alias("key"),
        padded_value(F.col("o_custkey"), F.col("o_orderstatus"),
                     F.col("o_orderpriority")).alias("value"))


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber, key, value) from ``lineitem``; keys repeat."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        md5_key(F.concat_ws("|", F.col("l_orderkey").cast("string"),
                            F.col("l_linenumber").cast("string"))).alias("key"),
        padded_value(F.col("l_partkey"), F.col("l_suppkey"),
                     F.col("l_returnflag")).alias("value"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, pos, key, value) from ``events``; file = event_type."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("file"),
        F.col("event_id").alias("pos"),
        md5_key(F.col("user_id").cast("string")).alias("key"),
        padded_value(F.col("event_id"), F.col("user_id"), F.col("event_type")).alias("value"))


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, key) from ``documents``: the whole text as UTF-8 bytes; texts repeat."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("text").cast("binary").alias("key"))
