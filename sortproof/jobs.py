"""The three programs of the sort workflow as plain functions over a session.

* ``generate_job``  -- N records to fixed-width files, checksum observed while writing;
* ``sort_job``      -- fixed-width files -> totally ordered files ``part-00000`` ...;
* ``validate_job``  -- order + checksum report, optionally written as JSON lines.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sortproof.functions import records as R
from sortproof.operators import generate as G
from sortproof.operators import partition as P
from sortproof.operators import quantiles as QS
from sortproof.operators import sort as S
from sortproof.operators import validate as V
from sortproof.sources import fixed_record as FR



def generate_job(spark: SparkSession, num_rows: int, out_path: str, start: int = 0,
                 ascii: bool = False, num_partitions: Optional[int] = None,
                 mode: str = "errorifexists") -> dict:
    """Write records ``start .. start+num_rows-1``; return ``{rows, checksum}``.

    The checksum (sum of record CRC-32s, exact) is taken by ``observe`` during
    the write itself -- no second pass over the data.
    """
    recs = G.generate_records(spark, num_rows, start, ascii, num_partitions)
    obs = Observation("generate")
    observed = recs.observe(obs, F.count(F.lit(1)).alias("rows"),
                            R.checksum_sum(R.crc_record()).alias("checksum"))
    FR.write_fixed_records(observed, out_path, mode=mode)
    got = obs.get
    return {"rows": int(got["rows"]), "checksum": int(got["checksum"] or 0)}


def sort_job(spark: SparkSession, in_path: str, out_path: str,
             num_partitions: Optional[int] = None, method: str = "sampled",
             sample_blocks: int = P.DEFAULT_SAMPLE_BLOCKS,
             sample_size: Optional[int] = None,
             mode: str = "errorifexists", sampler: str = "spread",
             splits_path: Optional[str] = None) -> dict:
    """Totally sort a fixed-record dataset into ordered files; return ``{rows, checksum}``.

    ``num_partitions`` defaults to the number of input splits.  ``sampled``
    reads only its sample to pick split points: ``sampler='spread'`` takes a few
    records from every input split (robust to input that is already ordered),
    ``sampler='blocks'`` is the systematic sample of a few whole blocks;
    ``sampler='sketch'`` reads all keys once and takes the split points from a quantile
    sketch, whose error is known and does not depend on the order of the input.
    ``splits_path`` names a stored split-point table: it is used if it exists
    (and must fit ``num_partitions``) and written otherwise.  File and position of each input
    record salt hot keys.  Rows and checksum of what was written are observed
    during the write, to be compared with ``generate_job``'s (F15) without
    another pass.
    """
    # file and pos identify a record (they salt copies of a hot record); the JVM scan has
    # the path at hand, for the Python source an integer is far cheaper to produce
    place = ["file" if FR.scans_in_jvm(spark, in_path) else "file_id", "pos"]
    data = FR.read_fixed_records(spark, in_path, columns=["key", "value", *place])
    if num_partitions is None:
        num_partitions = max(1, FR.split_count(in_path))
    if FR.same_path(in_path, out_path):
        raise ValueError(f"input and output are both {in_path}")
    sample, splits = None, None
    if sample_size is None:
        # 100,000 keys, but 20 per partition for big sorts (P.MAX_RANKED at most: more raise)
        sample_size = max(P.DEFAULT_SAMPLE_SIZE, 20 * num_partitions)
    if method == "sampled":
        if sampler == "spread":
            sample = P.file_spread_sample(spark, in_path, sample_size=sample_size)
        elif sampler == "blocks":
            sample = P.file_block_sample(spark, in_path, num_samples=sample_blocks,
                                         sample_size=sample_size)
        elif sampler != "sketch":
            raise ValueError("sampler must be 'blocks', 'spread' or 'sketch'")

        def take():
            if sampler == "sketch":
                # 64 keys a partition on every step of the ladder
                keys = FR.read_fixed_records(spark, in_path, columns=["key"])
                return QS.split_points(keys, num_partitions, k=max(QS.DEFAULT_K, 64 * num_partitions))
            return P.split_points(sample, num_partitions)
        splits = take() if splits_path is None else _stored_splits(spark, splits_path, num_partitions, take)
    out = S.total_order_sort(data, num_partitions, method, splits=splits,
                             salt_columns=place).select("key", "value")
    obs = Observation("sort")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                      R.checksum_sum(R.crc_record()).alias("checksum"))
    FR.write_fixed_records(out, out_path, mode=mode)
    got = obs.get
    return {"rows": int(got["rows"]), "checksum": int(got["checksum"] or 0)}


def _stored_splits(spark: SparkSession, path: str, num_partitions: int, take: Callable[[], list]) -> list:
    """Split points from ``path``; taken and stored there if it is new."""
    if FR.exists(path):
        splits = P.load_split_points(spark, path)
        if len(splits) != num_partitions - 1:
            raise ValueError(f"{path} holds {len(splits)} split points, not {num_partitions - 1}")
        return splits
    splits = take()
    table = spark.createDataFrame([(i, bytearray(k)) for i, k in enumerate(splits, 1)], "idx int, key binary")
    P.save_split_points(table, path)
    return splits


def validate_job(spark: SparkSession, path: str, report_path: Optional[str] = None,
                 columns: str = "record", raise_on_error: bool = False,
                 report_format: str = "json", expected: Optional[dict] = None) -> DataFrame:
    """Validate a sorted dataset; write the report if asked.

    ``report_format``: ``json`` (one object per row) or ``text`` (one
    ``kind<TAB>file<TAB>detail`` line per row).  Returns the report DataFrame
    ``(kind, file, detail)``.  A clean dataset gives one checksum row; a badly
    ordered one can give a row per record, so the report keeps its
    partitioning when written rather than going through one task.  ``expected``
    (``{rows, checksum}`` of the generate or sort job) adds an error row if the
    dataset holds other rows or another checksum (F15).
    """
    # integer file ids through the scan; the names join the few rows of the report
    data = FR.read_fixed_records(spark, path, columns=["key", "value", "file_id", "pos"])
    runs = V.scan_runs(data, file="file_id", columns=columns)
    report = V.report_from_runs(runs, FR.file_names(spark, path))
    if expected is not None:
        got = V.summary_from_runs(runs).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("checksum"), F.lit(0)).cast("decimal(38,0)").alias("checksum")).first()
        if (got["rows"], int(got["checksum"])) != (expected["rows"], int(expected["checksum"])):
            text = (f"expected {expected['rows']} rows with checksum {int(expected['checksum']):x}, "
                    f"found {got['rows']} with {int(got['checksum']):x}")
            report = report.unionByName(spark.createDataFrame(
                [("error", None, text)], "kind string, file string, detail string"))
    if report_path is not None:
        w = report
        if report_format == "text":
            w.select(F.concat_ws("\t", "kind", F.coalesce("file", F.lit("")), "detail")
                     .alias("value")).write.mode("errorifexists").text(report_path)
        elif report_format == "json":
            w.write.mode("errorifexists").json(report_path)
        else:
            raise ValueError("report_format must be 'json' or 'text'")
    if raise_on_error:
        bad = report.where(F.col("kind") == "error").limit(1).collect()
        if bad:
            raise ValueError("Data validation failed: " + bad[0]["detail"])
    return report
