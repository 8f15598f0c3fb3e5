"""Dataset inventory (A8): every data file under a path, its size and record count.

Uses Spark's ``binaryFile`` source with only ``path`` and ``length`` selected,
so file contents are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.functions.counts import int_div


def inventory(spark: SparkSession, path: str,
              record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """``(path, length, records, remainder)`` per data file (hidden files skipped).

    ``remainder`` > 0 marks a truncated last record.
    """
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "[!_.]*")
             .load(path)
             .select("path", "length"))
    return files.select("path", "length",
                        int_div(F.col("length"), record_length).alias("records"),
                        F.pmod(F.col("length"), F.lit(record_length)).cast("bigint")
                        .alias("remainder"))


def inventory_total(spark: SparkSession, path: str,
                    record_length: int = R.RECORD_LENGTH) -> DataFrame:
    """``(files, bytes, records, remainder)`` summed over the dataset."""
    inv = inventory(spark, path, record_length)
    return inv.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                   F.sum("records").alias("records"), F.sum("remainder").alias("remainder"))
