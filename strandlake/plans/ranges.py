"""Ranges: splitting, batching, merging, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_BYTES = 50_000_000
MERGE_GAP, MERGE_MOST = 256 * 1024, 16 * 1024 * 1024
BATCH = 95


def byte_ranges(files: DataFrame, part: int = PART_BYTES) -> DataFrame:
    """(file, size) -> file, part_number, first_byte, last_byte; files up to one part get one range."""
    numbers = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("size") / part) - 1))
    out = files.select("file", "size", F.explode(numbers).alias("part_number"))
    return out.select("file", "part_number", (F.col("part_number") * part).alias("first_byte"), (F.least((F.col("part_number") + 1) * part, F.col("size")) - 1).alias("last_byte"))


def complete_files(parts: DataFrame, expected: Column) -> DataFrame:
    """(file, part_number, etag) -> file, parts (ordered part:etag list) of files whose parts are all there."""
    listed = F.array_sort(F.collect_set(F.struct(F.col("part_number").cast("long").alias("part_number"), F.col("etag"))))
    out = parts.groupBy("file").agg(F.countDistinct("part_number").alias("n"), F.max(expected).alias("expected"), listed.alias("l")).where("n = expected")
    return out.select("file", F.array_join(F.transform("l", lambda p: F.concat_ws(":", p["part_number"].cast("string"), p["etag"])), ",").alias("parts"))


def ready_batches(markers: DataFrame) -> DataFrame:
    """(batch_id, part, expected) -> batch_id of batches that have every part from 0 to expected - 1."""
    seen = markers.where("part >= 0 AND part < expected").groupBy("batch_id").agg(F.countDistinct("part").alias("n"), F.max("expected").alias("expected"))
    return seen.where("n = expected").select("batch_id")


def batches(rows: DataFrame, keys: list[str], order: list[str], size: int = BATCH) -> DataFrame:
    """batch: rows in order, `size` at a time, within the keys."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("batch", F.floor((number - 1) / size))


def id_partitions(n: Column, parts: int) -> Column:
    """array of (part, start_id, end_id): proportional split of 0..n."""
    edge = lambda p: F.floor(p * n / parts).cast("long")
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.struct(p.alias("part"), edge(p).alias("start_id"), edge(p + 1).alias("end_id")))


def merged_ranges(ranges: DataFrame, key: str, gap: int = MERGE_GAP, most: int = MERGE_MOST) -> DataFrame:
    """(key, start_byte, end_byte) -> key, start_byte, end_byte, n: neighbours joined over gaps up to `gap`
    while the whole stays within `most`. The cap starts anew with each range, so the ranges of one key (a
    file) are folded in order; overlapping ranges are an error."""
    field = lambda *v: F.struct(*(x.cast("long").alias(n) for x, n in zip(v, ("s", "e", "n"), strict=True)))
    empty = F.expr("CAST(array() AS array<struct<s:bigint,e:bigint,n:bigint>>)")

    def step(out: Column, r: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        bad = (r["s"] < 0) | (r["e"] < r["s"]) | F.coalesce(r["s"] < last["e"], F.lit(False))
        joins = F.coalesce((r["s"] - last["e"] <= gap) & (r["e"] - last["s"] <= most), F.lit(False))
        grown = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(field(last["s"], r["e"], last["n"] + 1)))
        return F.when(bad, F.raise_error(F.lit("bad or overlapping range"))).when(joins, grown).otherwise(F.concat(out, F.array(field(r["s"], r["e"], F.lit(1)))))

    listed = F.array_sort(F.collect_list(field(F.col("start_byte"), F.col("end_byte"), F.lit(1))))
    folded = ranges.groupBy(key).agg(listed.alias("l")).select(key, F.explode(F.aggregate("l", empty, step)).alias("r"))
    return folded.select(key, F.col("r.s").alias("start_byte"), F.col("r.e").alias("end_byte"), F.col("r.n").alias("n"))


def coverage(fragments: DataFrame, key: str) -> DataFrame:
    """(key, start_id, end_id, records) -> key, contiguous (fragments tile 0..end without gap), records, end_id."""
    w = Window.partitionBy(key).orderBy("start_id")
    joined = fragments.withColumn("__ok", F.col("start_id") == F.coalesce(F.lag("end_id").over(w), F.lit(0)))
    return joined.groupBy(key).agg(F.min("__ok").alias("contiguous"), F.sum("records").alias("records"), F.max("end_id").alias("end_id"))


def footprint(index: DataFrame, row_bytes: int, budget: int) -> DataFrame:
    """Per slice: largest bucket and all buckets in bytes, and whether the largest fits the budget."""
    sizes = index.groupBy("slice_id", "bucket_id").agg((F.count("*") * row_bytes).alias("bytes"))
    return sizes.groupBy("slice_id").agg(F.max("bytes").alias("largest"), F.sum("bytes").alias("total")).withColumn("fits", F.col("largest") <= budget)


def digest(*columns: str) -> Column:
    """SHA-256 of the columns as JSON in the order given."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
