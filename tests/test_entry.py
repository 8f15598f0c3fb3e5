import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["pid", "rows", "first_key", "last_key", "checksum"]


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 30


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
@pytest.mark.parametrize("name", ["gen_binary", "crc_record", "split_points", "sort_sampled",
                                  "validate_report", "file_order", "partition_checks"])
def test_oracle_agrees(spark, name):
    import duckdb
    from tools.check_oracles import TABLES, _rows
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _rows(df.select(*cols).collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    assert got == _rows(rel.select(*[f'"{c}"' for c in cols]).fetchall())


def test_sort_hot_keys_facts(spark):
    import duckdb
    r = E.queries()["sort_hot_keys"](spark, SF).collect()[0]
    flags = [x[0] for x in duckdb.sql(
        f"SELECT l_returnflag FROM read_parquet('{SF}/lineitem.parquet')").fetchall()]
    assert (r.rows, r.keys, r.ordered, r.hot_key_split) == (len(flags), len(set(flags)), True, True)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="driver tables missing")
def test_orders_key_checksum_golden(spark):
    from pyspark.sql import functions as F

    from sortproof.operators import validate as V
    from sortproof.plans import fixtures as X
    o = X.order_records(spark, "/root/testdata/sf0.01")
    t = V.checksum_total(o, columns="key").collect()[0]
    assert (t.rows, int(t.checksum)) == (15000, 31874007275077)
    mm = o.agg(F.hex(F.min("key")).alias("a"), F.hex(F.max("key")).alias("b")).collect()[0]
    assert (mm.a, mm.b) == ("00003E3B9E5336685200", "FFFB8EF15DE06D87E6BA")
