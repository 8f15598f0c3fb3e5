"""A tree of digests over key ranges: where two datasets differ, found from the top down.

The key space is cut at split points into leaves; a node of a higher level covers
``fanout`` nodes of the one below.  A node's digest is its number of rows and two exact sums
of 62-bit row hashes, so it depends on the rows (repeats included) and not on their order
or partitions, and a parent's digest is the sum of its children's.  Two datasets with the
same split points are compared level by level: only the children of unequal nodes are
looked at, and only the rows of unequal leaves are read again.

Stored trees (``save_tree``) make that a comparison of small tables: a dataset is read
once, when its tree is built, however often it is compared.

Rows are equal if all their columns are; nulls equal nulls, a null key lies in the first
leaf.  Different rows whose sums agree in 124 bits would be missed; hashes are not a
defence against rows made to collide.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof.operators import partition as PT
from sortproof.operators.reconcile import changed_by_counting

#: Children of a node; ranges that are named when rows are read again (more are joined, below).
FANOUT, MOST_RANGES = 16, 64
_DIGEST = ("rows", "a", "b")


@dataclass
class DigestTree:
    """``nodes``: (level, node, rows, a, b), level 0 the leaves, only nodes with rows."""
    nodes: DataFrame
    splits: list
    fanout: int
    columns: list

    @property
    def height(self) -> int:
        """Level of the root."""
        level, width = 0, len(self.splits) + 1
        while width > 1:
            level, width = level + 1, -(-width // self.fanout)
        return level


def digest_tree(df: DataFrame, splits: Sequence[bytes], columns: Optional[Sequence[str]] = None,
                key: str = "key", fanout: int = FANOUT) -> DigestTree:
    """The tree of a table; leaf i holds splits[i - 1] <= key < splits[i].

    One aggregate over the rows, combined map-side to at most one row a leaf and task;
    all higher levels are summed from the leaves.  ``columns`` (all by default) make up a
    row.  Split points must rise; equal keys always share a leaf.
    """
    splits = [bytes(s) for s in splits]
    if any(x >= y for x, y in zip(splits, splits[1:])):
        raise ValueError("split points must rise")
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    columns = list(columns or df.columns)
    half = F.lit((1 << 62) - 1)
    cells = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    hashes = [F.xxhash64(F.lit(seed), *cells).bitwiseAND(half).alias(f"_{n}") for seed, n in ((3, "a"), (4, "b"))]
    d = df.select(F.col(key).alias("_key"), *hashes)
    d = PT.assign_partition(d, len(splits) + 1, "sampled", key="_key", splits=splits, out="_leaf",
                            spread_hot_keys=False)
    wide = lambda c, n: F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").alias(n)
    leaves = d.groupBy("_leaf").agg(F.count(F.lit(1)).alias("rows"), wide("_a", "a"), wide("_b", "b"))
    tree = DigestTree(leaves, splits, fanout, columns)
    at = [F.struct(F.lit(level).alias("level"), F.expr(f"cast(_leaf as bigint) div {fanout ** level}").alias("node"))
          for level in range(tree.height + 1)]
    up = leaves.select(F.explode(F.array(*at)).alias("at"), *_DIGEST).groupBy("at.level", "at.node")
    tree.nodes = up.agg(F.sum("rows").alias("rows"), wide("a", "a"), wide("b", "b"))
    return tree


def save_tree(tree: DigestTree, path: str) -> None:
    """Store a tree under a new path: nodes by level, split points, and what was hashed.

    The description is written last, so a tree that was interrupted does not load.
    """
    spark = tree.nodes.sparkSession
    tree.nodes.repartition("level").sortWithinPartitions("node").write.partitionBy("level").parquet(f"{path}/nodes")
    points = spark.createDataFrame([(i, bytearray(k)) for i, k in enumerate(tree.splits, 1)], "idx int, key binary")
    PT.save_split_points(points, f"{path}/splits")
    spark.createDataFrame([(tree.fanout, tree.columns)], "fanout int, columns array<string>").coalesce(1).write.parquet(
        f"{path}/tree")


def load_tree(spark: SparkSession, path: str) -> DigestTree:
    """A tree stored by ``save_tree``."""
    about = spark.read.parquet(f"{path}/tree").first()
    nodes = spark.read.schema("node bigint, rows bigint, a decimal(38,0), b decimal(38,0), level int").parquet(
        f"{path}/nodes")
    return DigestTree(nodes, PT.load_split_points(spark, f"{path}/splits"), about["fanout"], list(about["columns"]))


def differing_leaves(before: DigestTree, after: DigestTree) -> DataFrame:
    """``(leaf, lo, hi, rows_before, rows_after)`` of the leaves whose rows differ.

    Goes down from the root: a level's nodes are read only below unequal parents.  ``lo``
    is inclusive, ``hi`` exclusive, null where open.  ``ValueError`` if the trees were not
    cut and hashed alike.
    """
    if (before.splits, before.fanout, before.columns) != (after.splits, after.fanout, after.columns):
        raise ValueError("the trees differ in split points, fanout or columns")
    spark = before.nodes.sparkSession

    def level_of(level):
        """Both trees' nodes of a level, those of ``before`` counted against those of ``after``."""
        def side(tree, sign):
            return tree.nodes.where(F.col("level") == level).select("node", "rows", "a", "b", F.lit(sign).alias("sign"))
        return side(before, -1).unionAll(side(after, 1))

    unequal = None
    for level in range(before.height, -1, -1):
        d = level_of(level)
        if unequal is not None:
            above = unequal.select(F.col("node").alias("parent"))
            d = d.join(above, F.expr(f"node div {before.fanout}") == F.col("parent"), "left_semi")
        signed = [F.sum(F.col(c) * F.col("sign")).alias(f"d{c}") for c in _DIGEST]
        of = [F.coalesce(F.sum(F.when(F.col("sign") == s, F.col("rows"))), F.lit(0)).alias(f"rows_{n}")
              for s, n in ((-1, "before"), (1, "after"))]
        unequal = d.groupBy("node").agg(*signed, *of).where("drows <> 0 or da <> 0 or db <> 0")
    bounds = [None, *before.splits, None]
    ranges = spark.createDataFrame([(i, None if lo is None else bytearray(lo), None if hi is None else bytearray(hi))
                                    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:]))],
                                   "leaf bigint, lo binary, hi binary")
    return unequal.withColumnRenamed("node", "leaf").join(ranges, "leaf").select(
        "leaf", "lo", "hi", "rows_before", "rows_after")


def merged_ranges(leaves: DataFrame, most: int = MOST_RANGES) -> list:
    """At most ``most`` ranges ``(lo, hi)`` that cover the differing leaves.

    Neighbouring leaves become one range; while there are too many, the ranges with the
    fewest equal leaves between them are joined, so a cover may hold equal leaves too.
    The driver sees one row a run of neighbours (at most half as many as leaves).
    """
    w = Window.orderBy("leaf")             # differing leaves only, one row each
    runs = (leaves.select("leaf", "lo", "hi", (F.col("leaf") - F.row_number().over(w)).alias("_run"))
                  .groupBy("_run").agg(F.min("leaf").alias("first"), F.max("leaf").alias("last"),
                                       F.min_by("lo", "leaf").alias("lo"), F.max_by("hi", "leaf").alias("hi"))
                  .orderBy("first").collect())
    gaps = sorted(range(1, len(runs)), key=lambda i: (runs[i]["first"] - runs[i - 1]["last"], i))
    joined = set(gaps[:max(0, len(runs) - most)])
    out: list = []
    for i, r in enumerate(runs):
        if i in joined:
            out[-1] = (out[-1][0], r["hi"])
        else:
            out.append((r["lo"], r["hi"]))
    return [tuple(None if x is None else bytes(x) for x in r) for r in out]


def _within(key: str, lo: Optional[bytes], hi: Optional[bytes]):
    test = F.lit(True) if lo is None else F.col(key) >= F.lit(lo)
    if hi is not None:
        test = test & (F.col(key) < F.lit(hi))
    return test | F.col(key).isNull() if lo is None else test


def changed_in_ranges(before: DataFrame | Callable, after: DataFrame | Callable, leaves: DataFrame,
                      columns: Sequence[str], key: str = "key", most: int = MOST_RANGES) -> DataFrame:
    """``(side, <columns>, copies)`` of the rows that differ, reading differing ranges only.

    ``leaves`` comes from ``differing_leaves``.  A side is a table, whose scan gets the
    ranges as predicates on ``key``, or a function of a list of ranges ``(lo, hi)`` that
    reads them by other means (``key_index.read_key_ranges``); rows outside them are
    dropped here.  Rows of a null key lie in the first leaf.
    """
    ranges = merged_ranges(leaves, most)
    test = F.lit(False)
    for lo, hi in ranges:
        test = test | _within(key, lo, hi)
    before, after = [(side(ranges) if callable(side) else side).where(test).select(*columns)
                     for side in (before, after)]
    return changed_by_counting(before, after, columns)
