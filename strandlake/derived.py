"""DNA derived from the given tables: a genome from documents, jobs from keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.session import spread

#: Fixed values of the derivation.
LETTERS, LETTER_BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
HEX, HEX_BASES = "0123456789abcdef", "ACGTACGTACGTACGT"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def genome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, seq."""
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return spread(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.translate(letters, LETTERS, LETTER_BASES).alias("seq"))


def jobs(spark: SparkSession, sf_dir: str, name: str = "orders", key: str = "o_orderkey") -> DataFrame:
    """job_id, seq of 96 bases."""
    k = F.col(key).cast("string")
    text = F.concat(F.md5(k), F.md5(F.concat(F.lit("a"), k)), F.md5(F.concat(F.lit("b"), k)))
    return spread(read(spark, sf_dir, name).select(key)).select(F.col(key).alias("job_id"), F.translate(text, HEX, HEX_BASES).alias("seq"))


#: The same for DuckDB, as WITH parts.
GENOME_SQL = f"genome AS (SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{LETTER_BASES}') AS seq FROM documents)"


def jobs_sql(name: str = "orders", key: str = "o_orderkey") -> str:
    return f"job AS (SELECT {key} AS job_id, translate(md5({key}::VARCHAR) || md5('a' || {key}::VARCHAR) || md5('b' || {key}::VARCHAR), '{HEX}', '{HEX_BASES}') AS seq FROM {name})"
