"""The dealt operators on the whole ``documents`` table, as the contract for each wants them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.llm import alignment, exact, extraction, grammar, language, lines, mixing, packing, quality, simhash, substrings, toxicity, whitening
from natspark.llm.common import documents, shared_dir, stored, word_count

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(stored(docs, "sizes"), F.col("size"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.grouped(documents(spark, sf_dir))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op5_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    grammar.write_ids(documents(spark, sf_dir), path)
    return grammar.read_ids(spark, path)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.decisions(documents(spark, sf_dir)).drop("n_chars")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(documents(spark, sf_dir)).drop("kept_text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = F.col("score")
    return toxicity.scored(docs, lexicon).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (score >= 0.5).cast("int").alias("predicted")
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identified(docs, language.learn(docs))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.align(documents(spark, sf_dir), digest).withColumnRenamed("groups", "groups_sha256")


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    texts = extraction.extract(pages, extraction.learn(pages))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def queries() -> dict[str, Query]:
    found = (
        op1_mixing, op2_line_dedup, op3_packing, op4_simhash, op5_grammar, op6_quality, op7_exact_dedup, op8_substrings, op9_toxicity, op10_language,
        op11_whitening, op12_alignment, op13_extraction,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": lines.ORACLE, "op6_quality": quality.oracle(), "op7_exact_dedup": exact.ORACLE, "op8_substrings": substrings.ORACLE, "op13_extraction": extraction.ORACLE}
