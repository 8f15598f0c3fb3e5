"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, mix, byte-level BPE.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir),
works on all rows its predecessor kept and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again as the next one's docs.
All but the last return the columns of ``docs``.

* toxicity: learns from ``labels`` of sf_dir as query op4 does; texts predicted
  toxic go.
* line_dedup: lines that an earlier line matches are cut out of the texts
  (n_chars follows); a text that loses all its lines stays, empty.
* simhash: of each group one row stays, that with the smallest id (null ids last).
* mix: every document comes as often as the mix takes it (0, 1 or 2 times).
* byte_bpe: ids as digests, and the decoded bytes' digest, of every row.

Nulls in any column are kept as they are by the stages that do not decide on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortproof.llm import bpe, linededup, mixing, queries, simhash, toxicity
from sortproof.llm.frames import table
from sortproof.session import new_output_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, sf_dir)
    scored = toxicity.score(model, docs, keep_columns=True)
    return scored.where("toxic_predicted = 0").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.clean(docs, threshold=0.8, chars_col="n_chars")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs, weights=(3, 1, 2), share=1.5, cap=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash", drop_copies),
          ("mix", mix_sources), ("byte_bpe", encode)]

#: Toxicity and the tokenizer have no SQL form; the tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_output_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
