"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of the mix by weight; a target stops at ``cap`` times its
source's size and the excess is shared again by weight (water filling, in closed
form over the table of sources).  target / size copies of every document are
expected: whole copies are certain, and the rest is a sample of fixed size in
words, drawn by Pareto order sampling: documents are ranked by random odds
u / (1 - u) over their inclusion odds, and the first ones are taken until the
words that are left are reached (a document goes in if over half of it fits).
The random number is a hash of seed, id and text, so reruns agree.

The rank is never computed over a whole source: two histograms of the rank value,
256 bins a source and then 256 within the bin where the target is reached, leave
a 65,536th of a source to order exactly.  DataFrame functions only.  The table of
sources has one row a source, like the weights that a user lists, and its order
(weights go round by source name) is one window over that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortproof.llm.frames import WORD, cut

_BINS = 256
_DEAL = 10_000          # rows that one step of dealing out equal rows makes at most


def _random(seed: int):
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")),
                          F.coalesce("text", F.lit(""))).cast("binary"))
    n = F.conv(F.substring(h, 1, 13), 16, 10).cast("long")
    return (n + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) of rows (source, size): the words of each
    source and of its part of the mix.  Sources by code point, null last, take the
    weights in turn."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    every = Window.partitionBy(F.lit(1))
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # level if all sources before this one stop at their cap and it and the others share the rest
    s = s.withColumn("k", F.row_number().over(order)).withColumn(
        "level", (F.sum("source_size").over(every) * F.lit(float(share))
                  - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("k", "level"))
    level = F.min(fits).over(every)["level"]
    return s.withColumn("filled", level).select(
        "source", "source_size",
        F.coalesce(F.least("cap", F.col("filled") * F.col("w")), F.col("cap")).alias("target"))


def _crossing(rows: DataFrame, per: DataFrame, bin_col: str) -> DataFrame:
    """per with (``bin_col``_at, before): the bin where a source's words pass ``left``
    and the words before it; past the last bin if they never do."""
    h = rows.groupBy("source", bin_col).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy(bin_col)
    h = h.withColumn("upto", F.sum("words").over(run)).join(
        per.select(F.col("source").alias("s"), "left", "before"),
        F.col("source").eqNullSafe(F.col("s")))
    at = h.where(F.col("before") + F.col("upto") > F.col("left")).groupBy("s").agg(
        F.min(F.struct(F.col(bin_col).alias("bin"),
                       (F.col("before") + F.col("upto") - F.col("words")).alias("before"))).alias("x"))
    at = at.select("s", F.col("x.bin").alias(f"{bin_col}_at"), F.col("x.before").alias("at_before"))
    return per.join(at, F.col("source").eqNullSafe(F.col("s")), "left").select(
        *[c for c in per.columns if c != "before"],
        F.coalesce(f"{bin_col}_at", F.lit(1 << 30)).alias(f"{bin_col}_at"),
        F.coalesce("at_before", F.col("before")).alias("before"))


def shares(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight_col: str | None = None) -> DataFrame:
    """One row per id, text, source (and weight): (id, source, text_key, size, source_size,
    target, rows, sure, more): each of its ``rows`` equal rows is taken ``sure`` times, and
    ``more`` of them once more.

    size: words of the text (null: 0); text_key: its hash.  ``weight_col`` multiplies a
    document's inclusion odds (null counts as 1, 0 or less comes last).  A document
    without words has no copy unless all of its source is certain.
    """
    weight = F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0)) if weight_col else F.lit(1.0)
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                    F.col(text_col).cast("string").alias("text"), weight.alias("weight"))
    u = F.col("u")
    odds = u / ((1 - u) * F.col("weight"))
    d = d.select("id", "source", F.xxhash64("text").alias("text_key"), "weight",
                 F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                 _random(seed).alias("u"))
    rank = F.when(F.col("weight") > 0, odds / (1 + odds)).otherwise(F.lit(1.0))
    # equal rows tie: they are ranked once, as ``rows`` of one size, and dealt out at the end
    one = ["id", "source", "text_key", "one_size", "y"]
    d = cut(d.select("id", "source", "text_key", F.col("size").alias("one_size"), rank.alias("y")).groupBy(*one).agg(
        F.count("*").alias("rows"))).withColumn("size", F.col("one_size") * F.col("rows"))
    d = d.withColumn("b1", F.least(F.floor(F.col("y") * _BINS), F.lit(_BINS - 1)).cast("int")) \
        .withColumn("b2", F.least(F.floor(F.col("y") * _BINS * _BINS), F.lit(_BINS * _BINS - 1)).cast("int"))
    s = targets(d, weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    s = s.withColumn("sure", F.floor(ratio).cast("long")) \
        .withColumn("left", F.col("target") - F.col("sure") * F.col("source_size")) \
        .withColumn("before", F.lit(0).cast("long"))
    s = _crossing(d, cut(s), "b1")
    inner = d.join(s.select(F.col("source").alias("s"), "b1_at"), F.col("source").eqNullSafe(F.col("s"))) \
        .where("b1 = b1_at").drop("s", "b1_at")
    s = cut(_crossing(inner, s, "b2"))
    j = d.join(s.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    edge = F.col("b2") == F.col("b2_at")
    # documents of the last bin, in exact order; the others are in or out as a bin
    run = Window.partitionBy("source").orderBy("y", "id", "text_key") \
        .rowsBetween(Window.unboundedPreceding, -1)
    # of equal rows the first ones go in: row k (from 0) if ahead + k size + size / 2 <= left
    room = F.expr("cast(floor(2 * left) as bigint) - one_size - 2 * ahead")
    fit = F.when(room < 0, F.lit(0)).when(F.col("one_size") == 0, F.col("rows")).otherwise(
        F.least(F.col("rows"), F.expr("(cast(floor(2 * left) as bigint) - one_size - 2 * ahead) div (2 * one_size) + 1")))
    last = j.where(edge).withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0))) \
        .withColumn("more", F.when(F.col("left") > 0, fit).otherwise(F.lit(0)).cast("long"))
    rest = j.where(~edge).withColumn("ahead", F.lit(0).cast("long")).withColumn(
        "more", F.when((F.col("left") > 0) & (F.col("b2") < F.col("b2_at")), F.col("rows")).otherwise(F.lit(0)).cast("long"))
    return rest.unionByName(last).select("id", "source", "text_key", F.col("one_size").alias("size"), "source_size",
                                         "target", "rows", "sure", "more")


def _each(df: DataFrame, n: str, out: str) -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``out``; in two steps, as ``n`` may be large."""
    d = df.withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {_DEAL}"))))
    return d.withColumn(out, F.explode(F.expr(
        f"sequence({out} * {_DEAL}, least({n}, ({out} + 1) * {_DEAL}) - 1)")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: (id, source, text_key, size, source_size, target, copies, taken).

    size: words of the text (null: 0); taken: copies * size.  Options are those of
    ``shares``.  Rows that are equal in id, text and source tie; ``more`` of them, and it
    makes no difference which, have one copy above the others.  Null ids and sources are
    values of their own; other columns are ignored; an empty table gives an empty one.
    """
    d = _each(shares(docs, **options), "rows", "k")
    copies = F.col("sure") + (F.col("k") < F.col("more")).cast("long")
    return d.select("id", "source", "text_key", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns kept.

    Copies go by id, text and source, nulls included; of rows that are equal in these but
    not in other columns, those with the least hash of all columns have the copies above
    the others.  Columns may have any name; an empty table stays one.
    """
    names = [options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))]
    m = shares(docs, **options).groupBy(F.col("id").alias("i"), F.col("text_key").alias("t"), F.col("source").alias("s")).agg(
        F.sum("rows").alias("rows"), F.first("sure").alias("sure"), F.sum("more").alias("more"))
    named = lambda c: F.col(f"`{c}`")
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"), named(names[0]).cast("long").alias("id"),
                       F.xxhash64(named(names[1]).cast("string")).alias("text_key"),
                       named(names[2]).cast("string").alias("source"))
    j = rows.join(m, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t"))
                  & F.col("source").eqNullSafe(F.col("s"))).drop("i", "t", "s")
    # a tie matters only where some of it have a copy more: there, rows that are equal
    # throughout are counted, and the counts dealt out in order of their hash
    split = (F.col("more") > 0) & (F.col("more") < F.col("rows"))
    plain = j.where(~split).withColumn("copies", F.col("sure") + (F.col("more") > 0).cast("long"))
    tie = ["id", "text_key", "source"]
    tied = j.where(split).groupBy(*tie, F.xxhash64(F.to_json("row")).alias("h")).agg(
        F.first("row").alias("row"), F.count("*").alias("n"), F.first("sure").alias("sure"), F.first("more").alias("more"))
    before = Window.partitionBy(*tie).orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    extra = F.greatest(F.lit(0), F.least(F.col("n"), F.col("more") - F.coalesce(F.sum("n").over(before), F.lit(0))))
    tied = tied.withColumn("copies", F.col("sure") * F.col("n") + extra)
    both = plain.select("row", "copies").unionAll(tied.select("row", "copies")).where("copies > 0")
    return _each(both, "copies", "k").select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)
      AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS w FROM s0),
s2 AS (
  SELECT *, row_number() OVER o AS k,
    ((SELECT sum(source_size) FROM s0)::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s1 WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
s3 AS (
  SELECT source, source_size, coalesce(least(cap, w * (SELECT arg_min(level, k) FROM s2 WHERE level * w <= cap)), cap)
    AS target FROM s2),
s4 AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS sure FROM s3),
r AS (
  SELECT d.doc_id, d.size, s4.source_size, s4.target, s4.sure, s4.target - s4.sure * s4.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source
      ORDER BY (u / (1 - u)) / (1 + u / (1 - u)), d.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST((sure + CASE WHEN rest > 0 AND ahead + size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""
