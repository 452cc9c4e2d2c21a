"""Exact dedup: group by a 128-bit content hash, keep one row by a stable order, compare bytes inside groups.

Texts are equal when identical after deleting ASCII white space; null counts as empty, so null, empty and
blank texts form one group. Of equal texts the row with the most code points in the original text stays,
then the smallest id; a null id comes last. Rows that repeat in id as well are each counted in group_size and kept
or dropped alike. An empty table gives an empty result; other columns are ignored, whatever their names.

Steps, all native: a digest of each row (hash, length, id: no text moves), then per hash the least and the
greatest normalised text: they are equal unless hashes collide. Partial aggregation folds copies before the
shuffle, so a hot group costs one row a task. Hashes that do collide are grouped again by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.text import SPACE, table, whole
from strandlake.session import settle


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def md5_bytes(norm: Column) -> Column:
    return F.unhex(F.md5(norm.cast("binary")))


def keep_one(digests: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: keep_id and group_size. Longest first, then smallest id; counts and minima combine map-side."""
    rank = F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"))
    return digests.groupBy(*keys).agg(F.min(rank)["c"].alias("keep_id"), F.count("*").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = md5_bytes) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    src = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text")).select("doc_id", F.length("text").alias("n_chars"), normalised(F.col("text")).alias("norm")).withColumn("h", content_hash(F.col("norm")))
    digests, _ = settle(src.select("doc_id", "n_chars", "h", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "digests")
    spread_of = src.groupBy("h").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    collided, _ = settle(spread_of.where("lo <> hi").select("h"), "collided")
    if collided.isEmpty():
        out = digests.join(keep_one(digests, ["h"]), "h")
    else:
        sound = digests.join(collided, "h", "left_anti")
        by_bytes = src.join(collided, "h", "left_semi").withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
        cols = ["doc_id", "text_sha256", "keep_id", "group_size"]
        out = sound.join(keep_one(sound, ["h"]), "h").select(*cols).unionByName(by_bytes.join(keep_one(by_bytes, ["h", "norm"]), ["h", "norm"]).select(*cols))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def text_digest(text_col: str = "text") -> Column:
    """text_sha256 of a row, as exact_groups() has it."""
    return F.sha2(normalised(whole(text_col)).cast("binary"), 256)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP4_SQL = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS norm FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
