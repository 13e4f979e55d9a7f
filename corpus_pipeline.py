"""The corpus pipeline: quality, line dedup, near duplicates, benchmark decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.decontaminate import without_leaks
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.near_dup import near_duplicates
from parcelmart.llm.packing import pack
from parcelmart.llm.quality import classify
from parcelmart.llm.staging import staged, text_key

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chosen(docs: DataFrame, keys: DataFrame, once: bool = False) -> DataFrame:
    """Rows of docs whose doc_id and text are in keys (doc_id, _t1, _t2); once: the least of those that agree in both."""
    keys = keys.select(F.coalesce("doc_id", F.lit(-1)).alias("_d"), "_t1", "_t2").distinct()
    keyed = docs.withColumns(dict(zip(("_t1", "_t2"), text_key(F.col("text")), strict=True)))
    keyed = keyed.withColumn("_d", F.coalesce("doc_id", F.lit(-1)))
    found = keyed.join(keys, ["_d", "_t1", "_t2"], "left_semi")
    if once:
        row = F.struct(F.isnull("doc_id").alias("_n"), *docs.columns)
        found = found.groupBy("_d", "_t1", "_t2").agg(F.min(row).alias("_x")).select("_x.*")
    return found.select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model accepts; trusted are those labelled of good quality."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    return _chosen(docs, classify(docs, trusted).where("accepted"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated lines; those of which nothing is left go. n_chars follows the text."""
    left = dedup_lines(docs).where("n_removed = 0 or trim(text) != ''")
    chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return left.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest doc_id, then text hash; rows without words are no group."""
    first = F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "_t1", "_t2")).alias("x")
    one = near_duplicates(docs).where("n_shingles > 0").groupBy("_c").agg(first).select("x.doc_id", "x._t1", "x._t2")
    wordless = docs.where(~F.coalesce("text", F.lit("")).rlike(r"[^\x09-\x0D ]"))
    return _chosen(docs, one, once=True).unionByName(wordless)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 ids."""
    return pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dup", near_dup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The language model, the tokenizer and the packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is a table that the next one reads."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
