"""Structured Streaming: jobs as they arrive, message dedupe, idempotent batch commits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandlake.plans.ranges import digest
from strandlake.session import exists, settle
from strandlake.streaming.attempts import Handler, Ledger, attempt
from strandlake.streaming.attempts import screened as screened

#: Folders of a guard table.
GUARD_SHARDS = 256


def dedupe_messages(messages: DataFrame, keys: list[str], body: list[str]) -> DataFrame:
    """One row a key, with the body's digest and how many bodies conflict (1: none). Batch or within a batch."""
    sums = messages.withColumn("__d", digest(*body)).groupBy(*keys).agg(F.count("*").alias("deliveries"), F.countDistinct("__d").alias("bodies"), F.min("__d").alias("digest"))
    return sums


def batch_digest(rows: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """keys and digest of each batch's rows whatever their order: their number, and sums and exclusive ors of two hashes of
    each, all added up before the shuffle."""
    row = F.to_json(F.struct(*sorted(c for c in rows.columns if c not in keys)))
    hashes = rows.select(*keys, F.xxhash64(row).alias("a"), F.xxhash64(F.lit("second"), row).alias("b"))
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string")
    parts = [F.count("*").cast("string"), total("a"), total("b"), F.bit_xor("a").cast("string"), F.bit_xor("b").cast("string")]
    return hashes.groupBy(*keys).agg(F.sha2(F.concat_ws(":", *parts), 256).alias("digest"))


def shard(key: str) -> Column:
    """Folder of the guard table that a job's batches are in."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(GUARD_SHARDS)).cast("int")


def commit_batch(rows: DataFrame, path: str, guard_path: str, keys: tuple[str, str] = ("job_id", "batch_id"), quarantine: str | None = None) -> None:
    """Writes each (job, batch) once: a replay with the same digest changes nothing, another digest fails. With a
    quarantine folder, batches of another digest go there with a reason, and the sound ones are committed.

    The data partition is overwritten first and the guard row written last, so a batch that broke off in
    between is simply written again. Guard rows lie in GUARD_SHARDS folders by job; only those of the jobs at hand are read.
    """
    spark = rows.sparkSession
    sums, _ = settle(batch_digest(rows, keys).withColumn("shard", shard(keys[0])), "digests")
    shards = [r.shard for r in sums.select("shard").distinct().collect()]  # GUARD_SHARDS numbers at most
    there = [f"{guard_path}/shard={k}" for k in shards if exists(spark, f"{guard_path}/shard={k}")]
    if there:
        guard = spark.read.option("basePath", guard_path).parquet(*there).select(*keys, F.col("digest").alias("committed"))
        sums = sums.join(guard, list(keys), "left")
        clashes = sums.where("committed IS NOT NULL AND committed <> digest").select(*keys)
        clash = clashes.head()
        if clash and quarantine:
            rows.join(clashes, list(keys), "left_semi").withColumn("reason", F.lit("other_contents")).write.mode("append").parquet(quarantine)
        elif clash:
            raise ValueError(f"batch {tuple(clash)} was committed with other contents")
        sums, _ = settle(sums.where("committed IS NULL").drop("committed"), "digests")  # before the guard is written to
    if not sums.isEmpty():
        data = rows.join(sums.select(*keys), list(keys), "left_semi")
        data.write.partitionBy(*keys).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
        sums.write.partitionBy("shard").mode("append").parquet(guard_path)


def stream_commits(
    stream: DataFrame, path: str, guard_path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d, quarantine: str | None = None,
    ledger: Ledger | None = None, handler: Handler | None = None, rules: dict[str, Column] | None = None,
) -> StreamingQuery:
    """Runs transform on every micro-batch and commits it; ends when the input at hand is done.

    With a ledger, messages first go through its attempts: rows that break a rule or fail too often become dead letters, others come
    again when they are due, and what is done goes on to transform. With a quarantine folder no batch stops the stream."""

    def one(batch: DataFrame, epoch: int) -> None:
        done = attempt(batch, ledger, handler or (lambda d: d.withColumn("error", F.lit(None).cast("string"))), str(epoch), rules) if ledger else batch
        commit_batch(transform(done), path, guard_path, quarantine=quarantine)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_jobs(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """Job requests (JSON lines of job_id, sequence, genome) as files arrive in a folder."""
    return spark.readStream.schema("job_id string, sequence string, genome string").option("maxFilesPerTrigger", per_trigger).json(folder)
