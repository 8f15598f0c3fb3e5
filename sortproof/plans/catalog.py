"""Every registered query: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query runs the library operators over whole driver tables; its oracle in
``oracle.py`` recomputes the same columns in DuckDB.  Binary values are shown as upper-case hex, exact sums as decimal text.
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof import incremental as IC
from sortproof import jobs
from sortproof.functions import counts as C
from sortproof.functions import records as R
from sortproof.operators import digests as DG
from sortproof.operators import generate as G
from sortproof.operators import hotkeys as HK
from sortproof.operators import inversions as IV
from sortproof.operators import partition as PT
from sortproof.operators import quantiles as QS
from sortproof.operators import reconcile as RC
from sortproof.operators import sort as S
from sortproof.operators import validate as V
from sortproof.plans import fixtures as X
from sortproof.plans import params as Q
from sortproof.session import new_output_path
from sortproof.sources import fixed_record as FR
from sortproof.sources import inventory as INV
from sortproof.sources import key_index as KI


def _hex(col: str, name: str):
    return F.hex(F.col(col)).alias(name)


def _sum_text(col: str):
    return F.col(col).cast("decimal(38,0)").cast("string")


def _order_rows(spark, sf_dir, offset: int = 0) -> DataFrame:
    o = X.read_table(spark, sf_dir, "orders")
    return o.select((F.col("o_orderkey") + F.lit(offset)).alias("row"))


def _filler_digits(value_col: str, offset: int, digits: int):
    filler = F.substring(F.col(value_col), offset + 1, 4 * digits).cast("string")
    return F.regexp_replace(filler, "(.)...", "$1")


# generator ------------------------------------------------------------------------

def range_splits(spark, sf_dir):
    """Generated records by the split of the row cut they belong to (A1)."""
    g = G.with_records(_order_rows(spark, sf_dir), "row")
    total = _order_rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    cut = G.range_splits(total, Q.P).select("split", "first_row", "row_count")
    # split i starts at ceil(N i / p), so row r lies in split floor(r p / N)
    n = total.first()["n"]
    mine = g.groupBy(F.expr(f"cast(row * {Q.P} div {max(n, 1)} as int)").alias("split")).agg(
        F.min("row").alias("first_row"), F.count("key").alias("row_count"))
    return mine.join(cut, ["split", "first_row", "row_count"])


def gen_lcg(spark, sf_dir):
    g = G.with_records(_order_rows(spark, sf_dir), "row")
    state = F.concat(F.hex("key"), _filler_digits("value", R.BINARY_FILLER_OFFSET - 10, 12))
    return g.select("row", state.alias("state"))


def gen_binary(spark, sf_dir):
    g = G.with_records(_order_rows(spark, sf_dir), "row")
    return g.select("row", _hex("key", "key_hex"), _hex("value", "value_hex"))


def gen_ascii(spark, sf_dir):
    g = G.with_records(_order_rows(spark, sf_dir), "row", ascii=True)
    return g.select("row", F.col("key").cast("string").alias("key_text"),
                    _hex("value", "value_hex"))


def gen_offset(spark, sf_dir):
    g = G.with_records(_order_rows(spark, sf_dir, Q.GEN_OFFSET), "row")
    return g.select("row", _hex("key", "key_hex"), _hex("value", "value_hex"))


def gen_checksum(spark, sf_dir):
    g = G.with_records(_order_rows(spark, sf_dir), "row")
    c = G.generation_checksum(g)
    return c.select("rows", _sum_text("checksum").alias("checksum"))


# record expressions ----------------------------------------------------------------

def record_fields(spark, sf_dir):
    o = X.order_records(spark, sf_dir).select("o_orderkey", R.join_record().alias("rec"))
    return o.select(
        "o_orderkey",
        F.hex(R.record_key("rec")).alias("key_hex"),
        R.to_text(R.record_value("rec")).alias("value_text"),
        F.length("rec").alias("rec_length"),
        F.length(R.record_key("rec")).alias("key_length"),
        F.length(R.record_value("rec")).alias("value_length"))


def row_hex(spark, sf_dir):
    o = X.read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", R.row_hex("o_orderkey").alias("row_hex"))


def parse_counts(spark, sf_dir):
    p = X.read_table(spark, sf_dir, "part")
    suffix = F.element_at(F.array(*[F.lit(s) for s in ["", "k", "m", "b", "t", "K", "T", "x"]]),
                          (F.col("p_partkey") % 8).cast("int") + 1)
    t = p.select("p_partkey", F.concat(F.col("p_partkey").cast("string"), suffix).alias("text"))
    return t.select("p_partkey", "text", C.parse_human_count("text").alias("count"),
                    R.parse_decimal_strict("text").cast("bigint").alias("plain"))


def parse_edges(spark, sf_dir):
    """Numbers at and beyond the limits: null, never an error."""
    p = X.read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    suffix = F.element_at(F.array(*[F.lit(x) for x in ["", "k", "t", " "]]), (k % 4).cast("int") + 1)
    t = p.select("p_partkey", F.concat(F.repeat(F.lit("9"), (k % 30).cast("int") + 15), suffix).alias("text"),
                 F.repeat(F.lit("f"), (k % 34).cast("int") + 1).alias("hex"))
    return t.select("p_partkey", "text", C.parse_human_count("text").alias("count"),
                    R.parse_decimal_strict("text").cast("string").alias("plain"),
                    R.hex_to_decimal("hex").cast("string").alias("hex_value"))


def format_sizes(spark, sf_dir):
    o = X.read_table(spark, sf_dir, "orders")
    size = (F.floor("o_totalprice").cast("bigint") *
            F.pow(F.lit(10), F.col("o_orderkey") % 10).cast("bigint"))
    t = o.select("o_orderkey", size.alias("size"))
    return t.select("o_orderkey", "size", C.format_size("size").alias("text"))


def key_bytes(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    t = o.select("o_orderkey", "key", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("idx"))
    return t.select("o_orderkey", F.col("idx").cast("int").alias("idx"),
                    R.byte_at("key", F.col("idx")).alias("byte"))


def key_byte_list(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    return o.select("o_orderkey", F.array_join(R.key_byte_values("key"), ",").alias("bytes"))


def crc_record(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    return o.select("o_orderkey", R.crc_record().alias("crc"))


def crc_key(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    return o.select("o_orderkey", R.crc_key().alias("crc"))


# partitioning -------------------------------------------------------------------------

def _prefix_summary(method):
    def q(spark, sf_dir):
        o = PT.assign_partition(X.order_records(spark, sf_dir), Q.P, method)
        return o.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"),
                                    F.hex(F.min("key")).alias("min_key"),
                                    F.hex(F.max("key")).alias("max_key"))
    return q


def _orders_sample(spark, sf_dir) -> DataFrame:
    o = X.order_records(spark, sf_dir).select(
        F.lit("orders").alias("file"), F.col("o_orderkey").alias("pos"), "key")
    files = o.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("orders").alias("file"), "rows")
    return PT.block_sample(o, files, Q.BLOCK_ROWS, num_samples=Q.SAMPLE_BLOCKS,
                           sample_size=Q.SAMPLE_SIZE)


def block_sample(spark, sf_dir):
    s = _orders_sample(spark, sf_dir)
    return s.select("block", "pos", _hex("key", "key"))


def split_points(spark, sf_dir):
    t = PT.split_point_table(_orders_sample(spark, sf_dir), Q.P)
    return t.select("idx", _hex("key", "key"))


def split_points_store(spark, sf_dir):
    path = new_output_path(spark, "splits")
    PT.save_split_points(PT.split_point_table(_orders_sample(spark, sf_dir), Q.P), path)
    return spark.read.parquet(path).select("idx", _hex("key", "key"))


def _splits(spark, sf_dir):
    return PT.split_points(_orders_sample(spark, sf_dir), Q.P)


def range_partition(spark, sf_dir):
    o = PT.assign_partition(X.order_records(spark, sf_dir), Q.P, "sampled",
                            splits=_splits(spark, sf_dir))
    return o.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"))


def _sorted_orders(spark, sf_dir, method):
    o = X.order_records(spark, sf_dir)
    splits = _splits(spark, sf_dir) if method == "sampled" else None
    return S.total_order_sort(o, Q.P, method, splits=splits, with_position=True)


def _sort_query(method):
    def q(spark, sf_dir):
        s = _sorted_orders(spark, sf_dir, method)
        return s.select("o_orderkey", _hex("key", "key_hex"), "pid", "pos")
    return q


def global_position(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    s = S.sort_with_global_position(o, Q.P, "sampled", splits=_splits(spark, sf_dir))
    return s.select("o_orderkey", "global_pos")


def sort_range_global(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    s = S.sort_with_global_position(o, Q.P, "range")
    return s.select("o_orderkey", "global_pos")


def sort_tie_breaker(spark, sf_dir):
    li = X.lineitem_records(spark, sf_dir)
    s = S.total_order_sort(li, Q.P, "prefix7", tie_breaker=["l_orderkey", "l_linenumber"],
                           with_position=True)
    return s.select("l_orderkey", "l_linenumber", _hex("key", "key_hex"), "pid", "pos")


def _stats_columns(st):
    return st.select("pid", "rows", F.col("key_groups").alias("distinct_keys"),
                     _hex("first_key", "first_key"), _hex("last_key", "last_key"),
                     _sum_text("checksum").alias("checksum"))


def sort_ties_summary(spark, sf_dir):
    li = X.lineitem_records(spark, sf_dir)
    s = S.total_order_sort(li, Q.P, "prefix7", with_position=True)
    return _stats_columns(V.partition_stats(s))


# validation ---------------------------------------------------------------------------

def _hot_lineitem(spark, sf_dir):
    """lineitem keyed by md5(l_returnflag): three keys, one holding about half the rows."""
    li = X.read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     X.md5_key(F.col("l_returnflag")).alias("key"),
                     X.padded_value(F.col("l_orderkey"), F.col("l_linenumber")).alias("value"))


def _hot_splits(spark, sf_dir):
    li = _hot_lineitem(spark, sf_dir)
    recs = li.select(F.lit("lineitem").alias("file"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), "key")
    files = recs.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("lineitem").alias("file"),
                                                             "rows")
    sample = PT.block_sample(recs, files, Q.BLOCK_ROWS, num_samples=Q.SAMPLE_BLOCKS,
                             sample_size=Q.SAMPLE_SIZE)
    return li, PT.split_points(sample, Q.P)


def sort_hot_keys(spark, sf_dir):
    """Sampled sort of a hot-key table: equal keys spread over several partitions.

    Which rows share a partition depends on the row hash, so the result states
    what does not: all rows and keys are there, partitions are in order, and no
    partition holds all rows of the hot key.
    """
    li, splits = _hot_splits(spark, sf_dir)
    s = S.total_order_sort(li, Q.P, "sampled", splits=splits,
                           salt_columns=["l_orderkey", "l_linenumber"], with_position=True)
    per = s.groupBy("pid", "key").agg(F.count(F.lit(1)).alias("n"))
    key = per.groupBy("key").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min("pid").alias("a"),
                                 F.max("pid").alias("z"))
    w = Window.partitionBy(F.lit(1)).orderBy("key")     # one row per key
    key = key.withColumn("before", F.lag("z").over(w)).withColumn(
        "hot", F.col("n") == F.max("n").over(Window.partitionBy(F.lit(1))))
    return key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                   F.bool_and(F.coalesce(F.col("before") <= F.col("a"), F.lit(True))).alias("ordered"),
                   F.bool_and(~F.col("hot") | (F.col("most") < F.col("n"))).alias("hot_key_split"))


def sort_hot_ties(spark, sf_dir):
    """A hot key with a tie breaker: (key, tie) order holds across its partitions."""
    li, splits = _hot_splits(spark, sf_dir)
    s = S.sort_with_global_position(li, Q.P, "sampled", splits=splits,
                                    tie_breaker=["l_orderkey", "l_linenumber"])
    return s.select("l_orderkey", "l_linenumber", "global_pos")


def range_partition_urls(spark, sf_dir):
    """Split lookup of keys that share long prefixes, more splits than one level holds."""
    p = X.read_table(spark, sf_dir, "pages").select("page_id", F.col("url").cast("binary").alias("key"))
    return PT.assign_partition(p, Q.URL_P, "sampled", splits=PT.split_points(p, Q.URL_P),
                               spread_hot_keys=False).select("page_id", "pid")


def _sorted_documents(spark, sf_dir):
    d = X.document_keys(spark, sf_dir)
    recs = d.select(F.lit("documents").alias("file"), F.col("doc_id").alias("pos"), "key")
    files = recs.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("documents").alias("file"), "rows")
    sample = PT.block_sample(recs, files, Q.DOC_BLOCK_ROWS, num_samples=Q.SAMPLE_BLOCKS,
                             sample_size=Q.DOC_SAMPLE_SIZE)
    splits = PT.split_points(sample, Q.P)
    return S.total_order_sort(d, Q.P, "sampled", splits=splits, tie_breaker=["doc_id"],
                              with_position=True)


def sort_documents(spark, sf_dir):
    return _sorted_documents(spark, sf_dir).select("doc_id", "pid", "pos")


def documents_summary(spark, sf_dir):
    s = _sorted_documents(spark, sf_dir)
    return s.groupBy("pid").agg(
        F.count(F.lit(1)).alias("rows"),
        # digests with lengths: whole texts would fill the memory of the tasks that tell them apart
        F.count_distinct(F.sha2("key", 256), F.octet_length("key")).alias("distinct_texts"),
        F.min_by("doc_id", "pos").alias("first_doc"),
        F.max_by("doc_id", "pos").alias("last_doc"))


def file_bounds(spark, sf_dir):
    e = X.event_records(spark, sf_dir)
    b = V.file_summary(e, method="scan")
    return b.select("file", _hex("first_key", "first_key"), _hex("last_key", "last_key"), "rows")


def file_bounds_agg(spark, sf_dir):
    e = X.event_records(spark, sf_dir)
    b = V.file_summary(e, method="agg")
    return b.select("file", _hex("first_key", "first_key"), _hex("last_key", "last_key"), "rows")


def misorder_in_file(spark, sf_dir):
    e = X.event_records(spark, sf_dir)
    m = V.misorders(e)
    return m.select("file", "pos", _hex("prev_key", "prev_key"), _hex("key", "key"), "detail")


def boundary_check(spark, sf_dir):
    b = V.boundary_table(V.file_bounds(X.event_records(spark, sf_dir)))
    return b.select("file", "prev_file", _hex("prev_last_key", "prev_last_key"),
                    _hex("first_key", "first_key"), _hex("last_key", "last_key"), "bad")


def checksum_per_file(spark, sf_dir):
    s = V.file_summary(X.event_records(spark, sf_dir))
    return s.select("file", "rows", _sum_text("checksum").alias("checksum"))


def checksum_total(spark, sf_dir):
    t = V.checksum_total(X.order_records(spark, sf_dir))
    return t.select("rows", _sum_text("checksum").alias("checksum"), "checksum_hex")


def partition_summary(spark, sf_dir):
    s = V.partition_summary(_sorted_orders(spark, sf_dir, "prefix7"))
    return s.select("pid", "rows", _hex("first_key", "first_key"), _hex("last_key", "last_key"),
                    _sum_text("checksum").alias("checksum"))


def partition_checks(spark, sf_dir):
    return V.partition_checks(V.partition_summary(_sorted_orders(spark, sf_dir, "prefix7")))


def validate_report(spark, sf_dir):
    return V.validate(X.event_records(spark, sf_dir))


def validate_report_window(spark, sf_dir):
    return V.validate(X.event_records(spark, sf_dir), method="window")


def misorder_scan(spark, sf_dir):
    m = V.misorders_from_runs(V.scan_runs(X.event_records(spark, sf_dir)))
    return m.select("file", "pos", _hex("prev_key", "prev_key"), _hex("key", "key"), "detail")


def _part_name(pid_col):
    return F.format_string("part-%010d", F.col(pid_col))


def validate_sorted(spark, sf_dir):
    s = _sorted_orders(spark, sf_dir, "prefix7").withColumn("file", _part_name("pid"))
    return V.validate(s, file="file", pos="pos", method="scan")


def checksum_compare(spark, sf_dir):
    o = X.order_records(spark, sf_dir)
    s = S.total_order_sort(o, Q.P, "prefix7")
    c = V.compare_checksums(o, s)
    return c.select("rows_before", _sum_text("checksum_before").alias("checksum_before"),
                    "rows_after", _sum_text("checksum_after").alias("checksum_after"), "equal")


# sources and sinks ----------------------------------------------------------------------

def _written_sorted_orders(spark, sf_dir) -> str:
    out = new_output_path(spark, "orders-sorted")
    FR.write_fixed_records(S.total_order_sort(X.order_records(spark, sf_dir), Q.P, "prefix7"), out)
    return out


def fixed_scan_roundtrip(spark, sf_dir):
    r = FR.read_fixed_records(spark, _written_sorted_orders(spark, sf_dir))
    return r.select(_hex("key", "key_hex"), F.col("value").cast("string").alias("value_text"))


def file_order(spark, sf_dir):
    r = FR.read_fixed_records(spark, _written_sorted_orders(spark, sf_dir))
    file_no = F.regexp_extract("file", r"part-(\d+)$", 1).cast("int")
    return r.select(file_no.alias("file_no"), "pos", _hex("key", "key_hex"))


def file_block_sample(spark, sf_dir):
    path = _written_sorted_orders(spark, sf_dir)
    s = PT.file_block_sample(spark, path, Q.BLOCK_ROWS, Q.SAMPLE_BLOCKS, Q.SAMPLE_SIZE)
    file_no = F.regexp_extract("file", r"part-(\d+)$", 1).cast("int")
    return s.select(file_no.alias("file_no"), "block", "pos", _hex("key", "key_hex"))


def global_position_files(spark, sf_dir):
    g = FR.global_positions(spark, _written_sorted_orders(spark, sf_dir))
    return g.select(_hex("key", "key_hex"), "global_pos")


def dataset_inventory(spark, sf_dir):
    inv = INV.inventory(spark, _written_sorted_orders(spark, sf_dir))
    return inv.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length").alias("bytes"), "records", "remainder")


def _refused(action, text: str) -> bool:
    """Does the action fail with this message?  Any other failure is none of the refusal's."""
    try:
        action()
    except Exception as e:
        if text not in str(e):
            raise
        return True
    return False


def _rows(spark, sf_dir, table: str) -> DataFrame:
    return X.read_table(spark, sf_dir, table).agg(F.count(F.lit(1)).alias("rows"))


def truncated_tail(spark, sf_dir):
    """A partial last record fails the read."""
    path = _written_sorted_orders(spark, sf_dir)
    rows = FR.read_fixed_records(spark, path).count()
    FR.append_bytes(path, FR.part_name(Q.P), b"x" * 37)
    raised = all([_refused(lambda: FR.read_fixed_records(spark, path, engine=e).count(),
                           "ends with a partial record of 37 bytes") for e in ("jvm", "python")])
    return spark.createDataFrame([(rows, raised)], "rows bigint, raised boolean")


def output_refused(spark, sf_dir):
    """A missing output path (A11) and an existing output (A12) are refused."""
    path = _written_sorted_orders(spark, sf_dir)
    d = FR.read_fixed_records(spark, path)
    no_path = _refused(lambda: d.select("key", "value").write.format(FR.FORMAT).mode("append").save(),
                       "output path is required")
    existing = _refused(lambda: FR.write_fixed_records(d, path), "exists; choose another output")
    return d.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(no_path).alias("without_path"), F.lit(existing).alias("existing_output"))


def report_file(spark, sf_dir):
    """The written validation report, read back."""
    out = new_output_path(spark, "report")
    jobs.validate_job(spark, _written_sorted_orders(spark, sf_dir), report_path=out)
    return spark.read.schema("kind string, detail string").json(out)


def too_few_keys(spark, sf_dir):
    """More partitions than sampled keys are refused (D3)."""
    keys = X.order_records(spark, sf_dir).select("key")
    n = keys.count()
    raised = _refused(lambda: PT.split_points(keys, n + 1), f"{n + 1} partitions need at least as many sampled keys")
    return keys.agg(F.count(F.lit(1)).alias("keys")).withColumn("raised", F.lit(raised))


def default_partitions(spark, sf_dir):
    """The sort job's default partition count, the input splits (D10): those that all records come in."""
    d = FR.read_fixed_records(spark, _written_sorted_orders(spark, sf_dir), engine="python", columns=["pos"],
                              split_bytes=Q.BLOCK_ROWS * R.RECORD_LENGTH)
    return d.groupBy(F.spark_partition_id().alias("split")).agg(F.count("pos").alias("rows")).agg(
        F.count("split").alias("splits"))


def validate_raises(spark, sf_dir):
    """A failed validation raises when asked to."""
    e = X.event_records(spark, sf_dir)
    raised = _refused(lambda: V.validate(e, raise_on_error=True), "Data validation failed: ")
    return _rows(spark, sf_dir, "events").withColumn("raised", F.lit(raised))


def empty_dataset(spark, sf_dir):
    """A dataset without records is read, filtered and summed like any other."""
    none = X.order_records(spark, sf_dir).where("o_orderkey < 0")
    path = new_output_path(spark, "empty")
    FR.write_fixed_records(none, path)
    d = FR.read_fixed_records(spark, path)
    written = none.agg(F.count(F.lit(1)).alias("written"), F.lit(1).alias("k"))
    read = d.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("pos") > 5).alias("none_matching"),
                 F.lit(1).alias("k"))
    total = V.checksum_total(d).select("checksum_hex", F.lit(1).alias("k"))
    return written.join(read, "k").join(total, "k").drop("k")


def gen_sorted_report(spark, sf_dir):
    """Generate -> range sort -> write files -> read back -> validate."""
    g = G.with_records(_order_rows(spark, sf_dir), "row")
    out = new_output_path(spark, "gen-sorted")
    FR.write_fixed_records(S.total_order_sort(g, Q.P, "range"), out)
    return V.validate(FR.read_fixed_records(spark, out), method="scan").select(
        "kind", F.regexp_extract("file", r"([^/]*)$", 1).alias("file"), "detail")


# look-ups, sketches, differences ------------------------------------------------------

def _indexed_orders(spark, sf_dir) -> str:
    path = _written_sorted_orders(spark, sf_dir)
    KI.build_key_index(spark, path, block_rows=Q.INDEX_ROWS)
    return path


def key_range(spark, sf_dir):
    """Records of a key range of a sorted dataset, through its sparse index."""
    d = KI.read_key_range(spark, _indexed_orders(spark, sf_dir), bytes.fromhex(Q.KEY_FROM), bytes.fromhex(Q.KEY_TO))
    return d.select(_hex("key", "key_hex"), F.col("value").cast("string").alias("value_text"))


def key_lookup(spark, sf_dir):
    """Records whose keys are in a table (those of the customers' numbers), through the index."""
    keys = X.read_table(spark, sf_dir, "customer").select(X.md5_key(F.col("c_custkey").cast("string")).alias("key"))
    d = KI.lookup(spark, _indexed_orders(spark, sf_dir), keys)
    return d.select(_hex("key", "key_hex"), F.col("value").cast("string").alias("value_text"))


def split_points_sketch(spark, sf_dir):
    """Split points of all line items by a quantile sketch: where each should be, and whether
    its true ranks lie within the sketch's own bound of that place."""
    li = X.lineitem_records(spark, sf_dir).select("key")
    points = QS.sketch_split_points(QS.key_sketch(li, k=Q.SKETCH_K), Q.P).orderBy("idx").collect()
    ranks = li.agg(*[f.alias(f"{n}{r['idx']}") for r in points for n, f in (
        ("below", F.count_if(F.col("key") < F.lit(bytes(r["key"])))),
        ("upto", F.count_if(F.col("key") <= F.lit(bytes(r["key"])))))], F.count(F.lit(1)).alias("n"))
    return ranks.select(F.explode(F.array(*[F.struct(
        F.lit(r["idx"]).alias("idx"), F.expr(f"(2 * n * {r['idx']} + {Q.P}) div {2 * Q.P}").alias("target"),
        ((F.col(f"below{r['idx']}") - r["error"] <= r["target"]) & (F.lit(r["target"]) < F.col(f"upto{r['idx']}") + r["error"])
         ).alias("within_bound"), (F.lit(r["error"] * 20) <= F.col("n")).alias("bound_below_a_twentieth"))
        for r in points])).alias("x")).select("x.*")


def hot_keys(spark, sf_dir):
    """Keys in over a fiftieth of the documents, the key being language and source."""
    d = X.read_table(spark, sf_dir, "documents").select(F.concat_ws("|", "lang", "source").cast("binary").alias("key"))
    return HK.hot_keys(d, Q.HOT_SHARE).select(F.col("key").cast("string").alias("key"), "rows")


def changed_rows(spark, sf_dir):
    """The orders against a copy with rows left out, changed and repeated: what differs."""
    o = X.order_records(spark, sf_dir)
    return _shown_changes(RC.changed_rows(o, _changed_orders(o), ["key", "value"]))


def _changed_orders(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    changed = o.where(k % 1009 != 5).withColumn(
        "value", F.when(k % 1013 == 7, X.padded_value(k)).otherwise(F.col("value")))
    return changed.unionAll(changed.where(k % 1019 == 9))


def _shown_changes(d: DataFrame) -> DataFrame:
    return d.select("side", _hex("key", "key_hex"), F.col("value").cast("string").alias("value_text"), "copies")


def inversions(spark, sf_dir):
    """Pairs of events of a type whose keys fall, by merge counting."""
    d = IV.inversions(X.event_records(spark, sf_dir), group_rows=Q.INVERSION_ROWS, block_rows=Q.INVERSION_ROWS)
    return d.select("file", "rows", F.col("inversions").cast("string").alias("inversions"))


#: Leaves of the digest trees: one for every first byte of a key.
_FIRST_BYTES = [bytes([i]) for i in range(1, 256)]


def differing_ranges(spark, sf_dir):
    """Key ranges in which the orders and a changed copy differ, by their digest trees."""
    o = X.order_records(spark, sf_dir)
    trees = [DG.digest_tree(d.select("key", "value"), _FIRST_BYTES) for d in (o, _changed_orders(o))]
    return DG.differing_leaves(*trees).select("leaf", _hex("lo", "lo_hex"), _hex("hi", "hi_hex"), "rows_before",
                                              "rows_after")


def changed_rows_tree(spark, sf_dir):
    """The rows that differ between two sorted datasets, by stored trees and key indexes:
    only the ranges of unequal leaves are read again."""
    o = X.order_records(spark, sf_dir)
    paths, trees = [], []
    for d in (o, _changed_orders(o)):
        path = new_output_path(spark, "orders-sorted")
        FR.write_fixed_records(S.total_order_sort(d, Q.P, "prefix7"), path)
        KI.build_key_index(spark, path, block_rows=Q.INDEX_ROWS)
        stored = new_output_path(spark, "tree")
        DG.save_tree(DG.digest_tree(FR.read_fixed_records(spark, path, columns=["key", "value"]), _FIRST_BYTES), stored)
        paths.append(path)
        trees.append(DG.load_tree(spark, stored))
    before, after = [lambda ranges, path=path: KI.read_key_ranges(spark, path, ranges, columns=["key", "value"])
                     for path in paths]
    return _shown_changes(DG.changed_in_ranges(before, after, DG.differing_leaves(*trees), ["key", "value"]))


def validate_incremental(spark, sf_dir):
    """Report of a dataset that arrives in three batches, the last one out of order; every
    batch is read once, when it has arrived."""
    o = X.order_records(spark, sf_dir)
    out, state = new_output_path(spark, "batches"), new_output_path(spark, "state")
    report = None
    for batch, order in enumerate(("key", "key", "o_orderkey")):
        d = PT.assign_partition(o.where(F.col("o_orderkey") % 3 == batch), 2, "prefix7")
        d = PT.route(d, 2).sortWithinPartitions(order, "key")
        FR.write_fixed_records(d.select("key", "value"), f"{out}/{'abc'[batch]}")
        report = IC.validate_incremental(spark, out, state)
    base = ".*/sortproof-batches-[0-9a-f]*/"
    return report.select("kind", F.regexp_replace("file", base, "").alias("file"),
                         F.regexp_replace("detail", "[^ ]*/sortproof-batches-[0-9a-f]*/", "").alias("detail"))


def catalog() -> Dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "range_splits": range_splits,
        "gen_lcg": gen_lcg,
        "gen_binary": gen_binary,
        "gen_ascii": gen_ascii,
        "gen_offset": gen_offset,
        "gen_checksum": gen_checksum,
        "record_fields": record_fields,
        "row_hex": row_hex,
        "parse_counts": parse_counts,
        "format_sizes": format_sizes,
        "parse_edges": parse_edges,
        "key_bytes": key_bytes,
        "key_byte_list": key_byte_list,
        "crc_record": crc_record,
        "crc_key": crc_key,
        "prefix7_partition": _prefix_summary("prefix7"),
        "prefix3_partition": _prefix_summary("prefix3"),
        "block_sample": block_sample,
        "split_points": split_points,
        "split_points_store": split_points_store,
        "range_partition": range_partition,
        "sort_sampled": _sort_query("sampled"),
        "sort_prefix3": _sort_query("prefix3"),
        "sort_prefix7": _sort_query("prefix7"),
        "global_position": global_position,
        "sort_range_global": sort_range_global,
        "sort_tie_breaker": sort_tie_breaker,
        "sort_ties_summary": sort_ties_summary,
        "sort_documents": sort_documents,
        "sort_hot_keys": sort_hot_keys,
        "sort_hot_ties": sort_hot_ties,
        "range_partition_urls": range_partition_urls,
        "documents_summary": documents_summary,
        "file_bounds": file_bounds,
        "file_bounds_agg": file_bounds_agg,
        "misorder_in_file": misorder_in_file,
        "boundary_check": boundary_check,
        "checksum_per_file": checksum_per_file,
        "checksum_total": checksum_total,
        "partition_summary": partition_summary,
        "partition_checks": partition_checks,
        "validate_report": validate_report,
        "validate_report_window": validate_report_window,
        "misorder_scan": misorder_scan,
        "validate_sorted": validate_sorted,
        "checksum_compare": checksum_compare,
        "fixed_scan_roundtrip": fixed_scan_roundtrip,
        "file_order": file_order,
        "dataset_inventory": dataset_inventory,
        "file_block_sample": file_block_sample,
        "global_position_files": global_position_files,
        "gen_sorted_report": gen_sorted_report,
        "truncated_tail": truncated_tail,
        "output_refused": output_refused,
        "report_file": report_file,
        "too_few_keys": too_few_keys,
        "default_partitions": default_partitions,
        "validate_raises": validate_raises,
        "empty_dataset": empty_dataset,
        "key_range": key_range,
        "key_lookup": key_lookup,
        "split_points_sketch": split_points_sketch,
        "hot_keys": hot_keys,
        "changed_rows": changed_rows,
        "inversions": inversions,
        "differing_ranges": differing_ranges,
        "changed_rows_tree": changed_rows_tree,
        "validate_incremental": validate_incremental,
    }
