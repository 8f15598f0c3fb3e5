"""The registered queries on the driver's small tables: SQL where it exists, contract facts else."""

import os
import zlib

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")


@pytest.mark.parametrize("name", ["op1_source_mix", "op2_line_clean", "op5_url_lists", "op11_conversation_repair",
                                  "op13_source_divergence"])
def test_sql(spark, name):
    import duckdb
    from tools.check_oracles import TABLES, _rows
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    assert _rows(df.select(*cols).collect()) == _rows(rel.select(*[f'"{c}"' for c in cols]).fetchall())


@pytest.mark.parametrize("name,columns,m,r", [
    ("op4_toxicity", {"score": "double", "predicted": "int"}, 5, 0),
    ("op7_language", {"lang_pred": "string", "score": "double"}, 3, 1),
    ("op10_lm_score", {"n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
                       "base_score": "double", "score": "double"}, 7, 2)])
def test_scores(spark, name, columns, m, r):
    df = E.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert kinds["doc_id"] == "bigint" and kinds["held_out"] == "boolean"
    assert all(kinds[c] == k for c, k in columns.items())
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % m == r) for x in rows)


def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in E.queries()["op7_language"](spark, SF).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_language_model_beats_the_word_base_out_of_training(spark):
    big = "/root/testdata/sf0.1"            # 2 MB of training text (sf0.01) are too few for its contexts
    if not os.path.exists(big):
        pytest.skip("driver tables missing")
    rows = [r for r in E.queries()["op10_lm_score"](spark, big).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_names():
    q = E.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and set(E.oracle_sql()) <= set(q)
