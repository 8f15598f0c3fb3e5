"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: of the lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` of the whole
text, every run of ``shingle`` words joined by spaces (fewer words: the whole
sequence) is hashed with XXH64 (seed 42); a bit is 1 if set in over half of the
hashes, repeats counted.

Links: two fingerprints at ``max_bits`` or fewer differing bits.  The 64 bits are
cut into ``max_bits // 2 + 1`` segments, so in a linked pair one segment differs
by at most one bit.  Each distinct fingerprint is indexed by every segment as it
is and by the segment's variants with one bit deleted; fingerprints whose deleted
bit is 0 meet those where it is 1, so a pair meets once per segment.  As the rest
of a pair then differs in few bits, the rest is cut into one piece more than that
many, one of which is equal and joins the key: a large family of texts that share
a segment is not compared all against all.  An equality join on the signature and
the exact bit count of every candidate follow.  Copies are folded into one
fingerprint beforehand, and no partner or bucket is capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortproof.llm.components import connected_components
from sortproof.llm.frames import cut, map_arrow, slices

SEED = 42


def fingerprint_of(data: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one UTF-8 text; 0 without words or null."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh
    if not data:
        return 0
    w = data.lower().split()        # bytes: A-Z only, ASCII white space only
    n = len(w)
    if n == 0:
        return 0
    joined = b" ".join(w)
    if n <= shingle:
        h = np.array([xxh(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, n) + 1) - 1
        starts = np.empty(n, np.int64)
        starts[0] = 0
        starts[1:] = ends[:-1] + 1
        h = np.fromiter((xxh(joined[a:b], SEED) for a, b in zip(
            starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())),
            np.uint64, n - shingle + 1)
    return _majority(h)


def _majority(h) -> int:
    import numpy as np
    global _LANES
    if _LANES is None:              # byte -> its 8 bits in the 8 bytes of a word
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        _LANES = np.ascontiguousarray(bits).view("<u8")[:, 0]
    lanes = _LANES[h.astype("<u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)   # lanes hold up to 255
    counts = sums.astype("<u8").view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<u8")[0])


_LANES = None


def _fingerprinter(text: str, shingle: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in (part for whole in batches for part in slices(whole, text)):
            at = b.schema.get_field_index(text)
            data = b.column(at).cast(pa.binary()).to_pylist()
            fp = np.fromiter((fingerprint_of(x, shingle) for x in data), np.uint64, len(data))
            rest = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(fp.view(np.int64))],
                names=[*(n for i, n in enumerate(b.schema.names) if i != at), "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, fp): the signed 64-bit fingerprint of every row; null texts have 0."""
    d = docs.select(F.col(id_col).cast("long").alias("id"),
                    F.col(text_col).cast("string").alias("text"))
    return map_arrow(d, _fingerprinter("text", shingle), "id long, fp long")


def _variants(classes: DataFrame, max_bits: int) -> DataFrame:
    """(sig, wild, side, fp): signatures of the distinct fingerprints."""
    m = max_bits // 2 + 1
    w = -(-64 // m)
    rest = 64 - w
    v = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(m * (w + 1) - 1))).alias("v"))
    v = v.selectExpr("fp", f"v div {w + 1} as s", f"cast(v % {w + 1} as int) as j")
    low = "-1L" if w == 64 else f"{(1 << w) - 1}L"
    v = v.selectExpr(
        "fp", "s", f"j < {w} as wild", "j",
        f"shiftrightunsigned(fp, cast(s * {w} as int)) & {low} as seg",
        "0L as rest" if rest == 0 else
        f"(shiftrightunsigned(fp, cast(((s + 1) * {w}) % 64 as int)) | "
        f"(case when ((s + 1) * {w}) % 64 = 0 then 0L else "
        f"shiftleft(fp, cast(64 - ((s + 1) * {w}) % 64 as int)) end)) & {(1 << rest) - 1}L as rest")
    v = v.where(f"wild or j = {w}").where(f"s * {w} + j < 64 or not wild")
    if max_bits == 0:
        v = v.where("not wild")
    # the rest differs by max_bits bits at most, by one less where the deleted bit differs
    exact, loose = max(1, min(max_bits + 1, rest)), max(1, min(max_bits, rest))
    v = v.withColumn("p", F.explode(F.expr(
        f"case when wild then sequence(0, {loose - 1}) else sequence(0, {exact - 1}) end")))
    def piece(n):
        width = max(1, -(-rest // n)) if rest else 1
        return f"shiftrightunsigned(rest, p * {width}) & {(1 << min(width, 62)) - 1}L"
    v = v.selectExpr(
        "fp", "wild",
        "case when wild then cast(shiftrightunsigned(seg, j) & 1L as int) else 0 end as side",
        "case when wild then seg & ~shiftleft(1L, j) else seg end as seg",
        "s", "j", "p",
        f"case when wild then {piece(loose)} else {piece(exact)} end as piece")
    return v.selectExpr("xxhash64(s, j, seg, p, piece) as sig", "wild", "side", "fp")


def links(classes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): pairs of distinct fingerprints (column ``fp``) at up to ``max_bits``."""
    v = _variants(classes, max_bits)
    left = v.where("not wild or side = 0").selectExpr("sig", "wild", "fp as a")
    right = v.where("not wild or side = 1").selectExpr("sig", "wild as wild_r", "fp as b")
    pairs = left.join(right, on=[
        left.sig == right.sig, left.wild == right.wild_r,
        F.expr(f"bit_count(a ^ b) <= {int(max_bits)}"), F.expr("wild or a < b")])
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
        .dropDuplicates(["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: (id, fp, component_id).

    component_id is the smallest id of the texts reachable by links, itself
    included.  Null and wordless texts have fingerprint 0 and link like any
    other; a null id gets its group's component (null if the group has none
    else); repeated rows give repeated results; an empty table gives none;
    other columns are ignored.  At most 63 ``max_bits``.
    """
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be in 0..63")
    fps = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(fps.groupBy("fp").agg(F.min("id").alias("least")))
    comp = cut(connected_components(links(classes, max_bits)))
    named = classes.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("fp", "least", F.coalesce("component", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.withColumn("k", F.bitwise_not("root")).join(      # ~root: see components
        lowest.select(F.bitwise_not("root").alias("k"), "component_id"), "k") \
        .select("fp", "component_id")
    return fps.join(of, "fp").select("id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each group, all columns kept: the one with the smallest id.

    Null ids come last; of equal ids, and in a group without any, the row with the
    least hash of its columns stays.  Rows are told apart by group and content, never
    by id: unrelated texts that share an id, or have none, stay each.  Columns may have
    any name; maps inside other types do not tell rows apart.  An empty table stays one.
    """
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be in 0..63")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    # a null alone does not change a hash; a map is hashed as its entries in order
    flat = [F.array_sort(F.map_entries(f"`{c}`")) if t.startswith("map<") else F.col(f"`{c}`") for c, t in docs.dtypes]
    every = [x for c in flat if "map<" not in docs.select(c).dtypes[0][1] for x in (c, c.isNull())]
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(*every).alias("h1"), F.xxhash64(F.lit(1), *every).alias("h2"))
    fps = map_arrow(rows.select("id", "h1", "h2", "text"), _fingerprinter("text", shingle),
                    "id long, h1 long, h2 long, fp long", trim=True)
    classes = cut(fps.groupBy("fp").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "h1", "h2")).alias("least")))
    comp = cut(connected_components(links(classes, max_bits)))
    best = classes.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .groupBy(F.coalesce("component", "fp").alias("root")).agg(F.min("least").alias("least")) \
        .select("root", "least.h1", "least.h2")
    # rows that are equal in every column are left once
    return rows.select("row", "h1", "h2").join(best, ["h1", "h2"]).dropDuplicates(["root"]).select("row.*")
