"""Off-target catalogue, sliced index, and their checks."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.dna import SITE, bucket, pack
from strandlake.session import discard, exists, publish, scratch_path

Mask = tuple[int, ...]
#: Five blocks of four bases, and every pair of six blocks: both find all sites within four mismatches, the
#: second with far fewer candidates for each site found.
FIVE_BLOCKS: tuple[Mask, ...] = tuple(tuple(range(4 * k, 4 * k + 4)) for k in range(5))


def block_masks(blocks: int, kept: int) -> tuple[Mask, ...]:
    """Every choice of `kept` of `blocks` near-equal blocks; complete for blocks - kept mismatches."""
    edges = [k * SITE // blocks for k in range(blocks + 1)]
    parts = [tuple(range(a, b)) for a, b in itertools.pairwise(edges)]
    return tuple(tuple(p for part in chosen for p in part) for chosen in itertools.combinations(parts, kept))


PAIRS_OF_SIX = block_masks(6, 2)


def check_coverage(masks: Sequence[Mask], distance: int) -> None:
    """Raises unless every choice of `distance` mismatching positions leaves some mask untouched."""
    for wrong in itertools.combinations(range(SITE), distance):
        if all(set(wrong) & set(m) for m in masks):
            raise ValueError(f"mismatches at {wrong} are missed by every mask")


def catalogue(sites: DataFrame) -> DataFrame:
    """seq20, signature, occurrences, gg (how many of them have a PAM in GG, as a column gg of sites says; all where it
    is missing): counted before anything is sliced, so repeats cost one row a task."""
    gg = F.count_if("gg") if "gg" in sites.columns else F.count("*")
    return sites.groupBy("seq20").agg(F.count("*").alias("occurrences"), gg.alias("gg")).withColumn("signature", pack(F.col("seq20"))).select("seq20", "signature", "occurrences", "gg")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """One catalogue of two, counts added: both are counted already, so a site is two rows at most."""
    both = old.select("seq20", "signature", "occurrences", "gg").unionByName(new.select("seq20", "signature", "occurrences", "gg"))
    return both.groupBy("seq20", "signature").agg(F.sum("occurrences").alias("occurrences"), F.sum("gg").alias("gg"))


@dataclass(frozen=True)
class Numbered:
    """Sites in sorted order with dense ids from 0, stored by partitions of a range sort: part, place (within the part).

    starts: the id at which each part begins, a number for each partition."""

    rows: DataFrame
    starts: dict[int, int]

    def ids(self) -> DataFrame:
        """The sites with global_id; a look-up in a literal map, no join."""
        if not self.starts:
            return self.rows.select("*", F.lit(0).cast("long").alias("global_id")).drop("part", "place")
        start = F.create_map(*[F.lit(x) for pair in self.starts.items() for x in pair])
        return self.rows.withColumn("global_id", F.element_at(start, F.col("part")).cast("long") + F.col("place")).drop("part", "place")

    def count(self) -> int:
        last = self.rows.where(F.col("part") == max(self.starts, default=-1)).count()
        return self.starts[max(self.starts)] + last if self.starts else 0

    def between(self, first: int, end: int) -> Numbered:
        """Sites with first <= global_id < end. Parts outside are pruned by the statistics of their row groups, and so are
        places in the parts at both ends."""
        part, place, keep = F.col("part"), F.col("place"), F.lit(False)
        ordered = sorted(self.starts.items())
        inside = [p for p, s in ordered if s < end and s >= first]
        before = [p for p, s in ordered if s < first][-1:]
        for p in before + inside[-1:]:
            keep = keep | ((part == p) & (place >= first - self.starts[p]) & (place < end - self.starts[p]))
        if len(inside) > 1:
            keep = keep | ((part >= inside[0]) & (part < inside[-1]))
        return Numbered(self.rows.where(keep), self.starts)


def numbered(sites: DataFrame, path: str, by: str = "seq20") -> Numbered:
    """Sites numbered in sorted order without one task seeing all rows: a range sort, written once with each row's place in
    its partition, and the counts of the partitions. What is at path already is used."""
    spark = sites.sparkSession
    if not exists(spark, path):
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its low bits count a partition's rows
        aside = f"{path}-{uuid.uuid4().hex}"
        sites.repartitionByRange(F.col(by)).sortWithinPartitions(by).select("*", F.spark_partition_id().alias("part"), place.alias("place")).write.parquet(aside)
        if not publish(spark, aside, path):
            discard(spark, aside)
    rows, start, starts = spark.read.parquet(path), 0, {}
    for part, n in sorted(rows.groupBy("part").agg(F.count("*")).collect()):
        starts[part], start = start, start + n
    return Numbered(rows, starts)


def with_global_ids(sites: DataFrame, by: str = "seq20") -> DataFrame:
    """Sites with dense global_id from 0 in sorted order."""
    return numbered(sites, scratch_path(sites.sparkSession, "numbered"), by).ids()


def sliced(sites: DataFrame, masks: Sequence[Mask], signature: str = "signature") -> DataFrame:
    """A row for every mask: slice_id and bucket_id beside the columns of sites."""
    keys = F.array(*[F.struct(F.lit(k).alias("slice_id"), bucket(F.col(signature), m).alias("bucket_id")) for k, m in enumerate(masks)])
    return sites.withColumn("__k", F.explode(keys)).select("*", "__k.slice_id", "__k.bucket_id").drop("__k")


def bucket_histogram(manifest: DataFrame) -> DataFrame:
    """slice_id, bucket_id, entries, occurrences of the buckets in use, from the manifest of an index."""
    return manifest.where("entries > 0").groupBy("slice_id", "bucket_id").agg(F.sum("entries").alias("entries"), F.sum("occurrences").alias("occurrences"))


def index_stats(manifest: DataFrame) -> DataFrame:
    """Per slice: buckets in use, entries, largest bucket, all occurrences."""
    per = bucket_histogram(manifest).select("slice_id", "bucket_id", F.col("entries").alias("n"), F.col("occurrences").alias("o"))
    return per.groupBy("slice_id").agg(F.count("*").alias("buckets"), F.sum("n").alias("entries"), F.max("n").alias("largest"), F.sum("o").alias("occurrences"))


def resolve_overflow(entries: DataFrame, overflow: DataFrame) -> DataFrame:
    """Counts stored in one byte, 255 meaning: see the overflow table."""
    small = F.when(F.col("stored") < 255, F.col("stored"))
    return entries.join(overflow, "global_id", "left").withColumn("occurrences", F.coalesce(small, F.col("overflow_count"))).drop("overflow_count")


def delta_encode(ids: DataFrame, keys: list[str]) -> DataFrame:
    """delta: global_id less the one before it in the bucket (the first as it is)."""
    w = Window.partitionBy(*keys).orderBy("global_id")
    return ids.withColumn("delta", F.col("global_id") - F.coalesce(F.lag("global_id").over(w), F.lit(0)))


def delta_decode(deltas: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return deltas.withColumn("global_id", F.sum("delta").over(w))
