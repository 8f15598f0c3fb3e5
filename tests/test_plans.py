"""Plan-shape tests: the scale properties of the headline operators.

Static plans (AQE off) are inspected for the number and kind of exchanges,
pruned scans and the absence of interpreted or per-row Python steps.
"""

import re

import pytest
from pyspark.sql import functions as F

from sortproof.operators import generate as G
from sortproof.operators import partition as P
from sortproof.operators import sort as S
from sortproof.operators import validate as V
from sortproof.plans import fixtures as X
from sortproof.plans.catalog import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str):
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", text)


def test_generate_has_no_shuffle(static):
    p = plan(G.generate_records(static, 1000, num_partitions=3))
    assert exchanges(p) == [] and "MapInArrow" in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("method,kind", [("prefix7", "shufflepartitionidpassthrough"),
                                         ("prefix3", "shufflepartitionidpassthrough"),
                                         ("range", "rangepartitioning")])
def test_sort_is_one_exchange(static, method, kind):
    p = plan(S.total_order_sort(X.order_records(static, SF), 7, method))
    assert exchanges(p) == [kind]
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string," \
           "o_orderpriority:string>" in p  # only the columns the records need


def test_sampled_sort_lookup_stays_in_codegen(static):
    o = X.order_records(static, SF)
    splits = P.split_points(o.select("key"), 7)
    p = plan(S.total_order_sort(o, 7, "sampled", splits=splits))
    assert exchanges(p) == ["shufflepartitionidpassthrough"]
    assert "CASE WHEN" in p and "aggregate(" not in p and "filter(" not in p


def test_large_p_lookup_is_a_broadcast_join(static):
    o = X.order_records(static, SF)
    splits = P.split_points(o.select("key"), 400)
    p = plan(S.total_order_sort(o, 400, "sampled", splits=splits))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p
    assert exchanges(p) == ["shufflepartitionidpassthrough"]


def test_global_position_counts_before_the_shuffle(static):
    o = X.order_records(static, SF)
    splits = P.split_points(o.select("key"), 7)
    p = plan(S.sort_with_global_position(o, 7, "sampled", splits=splits))
    # one record shuffle; the counts are partially aggregated before theirs
    assert exchanges(p).count("shufflepartitionidpassthrough") == 1
    assert "partial_count(1)" in p and "BroadcastHashJoin" in p


def test_checksum_is_partial_then_final(static):
    p = plan(V.checksum_total(X.order_records(static, SF)))
    assert exchanges(p) == ["SinglePartition"] and "partial_sum" in p


def test_report_reads_the_run_table_not_the_records(static):
    rep = V.validate(X.event_records(static, SF), method="scan")
    p = plan(rep)
    assert "MapInArrow" not in p and "FileScan parquet" not in p


def test_window_form_shuffles_records_once(static):
    p = plan(V.misorders(X.event_records(static, SF)))
    assert p.count("FileScan parquet") == 1
    assert "ReusedExchange" in p or exchanges(p).count("hashpartitioning") <= 2


def test_documents_summary_tells_texts_apart_by_digests(spark, tmp_path):
    from collections import defaultdict
    texts = [f"{i * 7919 % 1000:04d} " + "x" * (i % 90) for i in range(900)] * 2 + ["", "\0", None, None]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    q = catalog()
    where = {r.doc_id: r.pid for r in q["sort_documents"](spark, str(tmp_path)).collect()}
    want = defaultdict(list)
    for i, t in rows:
        want[where[i]].append(t)
    df = q["documents_summary"](spark, str(tmp_path))
    got = {r.pid: (r.rows, r.distinct_texts) for r in df.collect()}
    assert got == {p: (len(ts), len({t for t in ts if t is not None})) for p, ts in want.items()}
    # no aggregate holds whole texts
    plan = df._jdf.queryExecution().executedPlan().toString()
    aggregates = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan) + re.findall(r"SortAggregate\(key=\[([^\]]*)\]", plan)
    assert any("sha2" in a for a in aggregates) and not any(re.search(r"(^|[ ,])key#", a) for a in aggregates)
