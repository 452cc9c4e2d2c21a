"""Attempts at messages: errors caught a row, retries after a growing time, dead letters.

The ledger is a Parquet table of outcomes, a row for each attempt at a message, in folders run=<run>/attempt=<n>/status=<s>:
done, retry (with next_at) or dead (with the error). A run (micro-batch) that is replayed writes its folder anew. What
is due are rows to be retried that no later attempt follows; the many messages that succeed at once are never read for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandlake.session import names, settle

DONE, RETRY, DEAD = "done", "retry", "dead"
#: A handler marks every row with error (null: success); it sees the columns of the message and attempt.
Handler = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Ledger:
    path: str
    key: str = "message_id"
    most: int = 3
    base_seconds: float = 30.0
    longest_seconds: float = 3600.0

    def outcomes(self, spark: SparkSession) -> DataFrame | None:
        """All rows, or None before the first run with any."""
        runs = [f"{self.path}/{n}" for n in names(spark, self.path) if n.startswith("run=")]
        runs = [r for r in runs if any(n.startswith("attempt=") for n in names(spark, r))]
        return spark.read.option("basePath", self.path).parquet(*runs).withColumn("run", F.col("run").cast("string")) if runs else None

    def wait(self, attempt: Column) -> Column:
        """Seconds after a failed attempt: doubled each time, cut to longest_seconds, and between half and all of that by a
        hash of message and attempt, so that messages that failed together do not come back together."""
        share = 0.5 + F.pmod(F.xxhash64(self.key, attempt.cast("int")), F.lit(1 << 20)) / F.lit(float(1 << 21))
        return F.least(F.lit(self.base_seconds) * F.pow(F.lit(2.0), attempt - 1), F.lit(self.longest_seconds)) * share

    def due(self, spark: SparkSession, now: Column, run: str) -> DataFrame | None:
        """Messages to be tried again by now, with the number of that attempt; not by what the same run wrote before."""
        rows = self.outcomes(spark)
        if rows is None:
            return None
        rows = rows.where(F.col("run") != run)
        failed = rows.where((F.col("status") == RETRY) & (F.col("next_at") <= now))
        later = rows.where("attempt > 1").select(self.key, (F.col("attempt") - 1).alias("attempt"))
        return failed.join(later, [self.key, "attempt"], "left_anti").withColumn("attempt", F.col("attempt") + 1).drop("run", "status", "error", "next_at")


def screened(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and the others with reason: the first rule (name: condition of a bad row) that holds."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(rules.items()):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    marked = rows.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def caught(work: Callable[[dict], None]) -> Handler:
    """A handler that calls work with each row as a dict, within Spark's tasks, and takes what it raises for the row's error."""

    def handler(rows: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                errors = []
                for row in f.to_dict("records"):
                    try:
                        work(row)
                        errors.append(None)
                    except Exception as error:
                        errors.append(f"{type(error).__name__}: {error}")
                yield f.assign(error=pd.Series(errors, f.index, dtype=object))

        return rows.mapInPandas(run, StructType([*rows.schema, StructField("error", StringType())]))

    return handler


def attempt(messages: DataFrame, ledger: Ledger, handler: Handler, run: str, rules: dict[str, Column] | None = None, now: Column | None = None) -> DataFrame:
    """One run: new messages and those that are due go through the handler, outcomes are written to the ledger; the rows that are done.

    Messages that break a rule (name: condition of a bad row) are dead at once, with the rule as error."""
    spark = messages.sparkSession
    now = F.current_timestamp() if now is None else now
    sound, bad = screened(messages, rules or {})
    todo = sound.withColumn("attempt", F.lit(1))
    if (again := ledger.due(spark, now, run)) is not None:
        todo = todo.unionByName(again.select(*todo.columns))
    tried = handler(todo)
    status = F.when(F.col("error").isNull(), DONE).when(F.col("attempt") >= ledger.most, DEAD).otherwise(RETRY)
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ledger.wait(F.col("attempt")).cast("decimal(18,6)"))
    tried = tried.withColumn("status", status).withColumn("next_at", F.when(F.col("status") == RETRY, now + seconds))
    out = tried.unionByName(bad.withColumnRenamed("reason", "error").withColumn("attempt", F.lit(1)).withColumn("status", F.lit(DEAD)).withColumn("next_at", F.lit(None).cast("timestamp")))
    own, _ = settle(out, "outcomes")  # the handler runs once; then its rows are put in their place
    own.write.partitionBy("attempt", "status").mode("overwrite").parquet(f"{ledger.path}/run={run}")
    return own.where(F.col("status") == DONE).drop("error", "status", "next_at", "attempt")


def dead_letters(spark: SparkSession, ledger: Ledger) -> DataFrame | None:
    """Messages that no further attempt is made at, with the last error and the number of attempts."""
    rows = ledger.outcomes(spark)
    return None if rows is None else rows.where(F.col("status") == DEAD).drop("run", "status", "next_at")


def waiting(spark: SparkSession, ledger: Ledger) -> DataFrame | None:
    """Messages that wait for another attempt, however far ahead."""
    return ledger.due(spark, F.lit("9999-12-31").cast("timestamp"), "")
