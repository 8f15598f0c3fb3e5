"""One query per operator, each over its whole table, and the SQL that checks it.

Operators without an entry in ``ORACLE_SQL`` are held against brute force in
``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortproof.llm import convrepair, lineclean, mixing, sourceaudit, urllist
from sortproof.llm.frames import crc_mod, table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, cap=2.0)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineclean.clean(_documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_lines_removed", "words_left")


def op3_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import pq
    out = pq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                      (F.col("id") == F.col("component_id")).alias("kept"))


def toxicity_model(spark: SparkSession, sf_dir: str):
    """The toxicity model of the documents whose label may be learned."""
    from sortproof.llm import toxicity
    labels = table(spark, sf_dir, "labels").where(crc_mod("doc_id", 5) != 0)
    return toxicity.fit(_documents(spark, sf_dir), labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import toxicity
    out = toxicity.score(toxicity_model(spark, sf_dir), _documents(spark, sf_dir))
    return out.withColumnRenamed("id", "doc_id").withColumn("held_out", crc_mod("doc_id", 5) == 0)


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = urllist.judge(urllist.page_captures(pages), urllist.page_lists(pages))
    return out.select(F.col("id").alias("page_id"), F.unix_seconds("fetched").alias("fetched_s"), "blocked",
                      "list", "pattern", F.unix_seconds("valid_from").alias("valid_from_s"),
                      F.unix_seconds("valid_to").alias("valid_to_s"), "n_active")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import bpe
    return bpe.digests(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import langid
    docs = _documents(spark, sf_dir)
    model = langid.fit(docs.where(crc_mod("doc_id", 3) != 1))
    out = langid.predict(model, docs).withColumnRenamed("id", "doc_id")
    return out.withColumn("held_out", crc_mod("doc_id", 3) == 1)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import linededup
    out = linededup.removed_lines(_documents(spark, sf_dir), threshold=0.8)
    return out.select(F.col("id").alias("doc_id"), "n_lines",
                      F.size("removed").cast("long").alias("n_removed"),
                      F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import simhash
    out = simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, max_bits=2)
    return out.select(F.col("id").alias("doc_id"),
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import pst
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held = crc_mod("doc_id", 7) == 2
    model = pst.fit(docs.where(~held))
    out = pst.score(model, docs).withColumnRenamed("id", "doc_id")
    return out.withColumn("held_out", held)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = convrepair.repair(convrepair.damage(table(spark, sf_dir, "conversations")))
    return convrepair.summary(pieces).withColumnRenamed("conv", "conv_id")


def op12_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sortproof.llm import segbpe
    return segbpe.digests(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sourceaudit.audit(_documents(spark, sf_dir), min_df=10, top=10)


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_line_clean": op2_line_clean,
    "op3_embedding_pq": op3_embedding_pq,
    "op4_toxicity": op4_toxicity,
    "op5_url_lists": op5_url_lists,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_language": op7_language,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash": op9_simhash,
    "op10_lm_score": op10_lm_score,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_segment_tree_bpe": op12_segment_tree_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op1_source_mix": mixing.SQL,
    "op2_line_clean": lineclean.SQL,
    "op5_url_lists": urllist.SQL,
    "op11_conversation_repair": convrepair.SQL,
    "op13_source_divergence": sourceaudit.SQL,
}
