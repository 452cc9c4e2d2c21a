"""A corpus from documents: five stages, each of one operator, each written and read again before the next.

Rows that share a doc_id are texts of one document: near copies of either tie it to others, and it stays or goes
whole. Of rows that share id and text the longest stays. A null id is a document of its own in every row: it is judged
by its text and linked with nothing. Null and empty texts fail the quality rules. An empty table stays empty through
all stages. Every stage but the last returns the columns of documents, and other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import byte_bpe, exact_dedup, minhash_dedup, quality_rules, source_mix
from strandlake.session import settle

POLICY = "v2"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy accepts."""
    return quality_rules.accepted(docs, POLICY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    kept = exact_dedup.exact_groups(docs).where("kept").groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.count("*").alias("__n"))
    kept, _ = settle(kept, "kept")
    row = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__d"), exact_dedup.text_digest().alias("__s"), F.length("text").alias("__len"))
    once = row.join(kept, F.col("__d").eqNullSafe(F.col("__id")) & (F.col("__s") == F.col("__sha")))
    if kept.where("__n > 1").isEmpty():
        return once.select("__row.*")
    again = once.where("__n > 1").groupBy("__d", "__s").agg(F.max_by("__row", F.struct("__len", F.to_json("__row"))).alias("__row"))
    return once.where("__n = 1").select("__row").unionByName(again.select("__row")).select("__row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    kept = minhash_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    key = [F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size")]
    copies = source_mix.mix(docs).where("copies > 0").groupBy(*key).agg(F.max("copies").alias("__copies"))
    row = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__d"), F.col("source").cast("string").alias("__s"), source_mix.n_words(F.coalesce("text", F.lit(""))).alias("__n"))
    taken = row.join(copies, F.col("__d").eqNullSafe(F.col("__id")) & F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__n") == F.col("__size")))
    return taken.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("__row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return byte_bpe.digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mixed),
    ("byte_bpe", tokens),
]

#: The mix and the encoding are beyond SQL; tests run the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = settle(stage(spark, docs, sf_dir), name)
    return docs
