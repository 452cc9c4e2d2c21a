"""A stored index of off-target sites: parts built on demand, a manifest log, buckets of two levels.

The sites are a catalogue of their own, built once for a source, whatever the masks. Under a root, named by a digest of the source
and the masks:

* `builds/<id>/part=<p>`: immutable Parquet files. A part is a slice and the low bases of a bucket (its prefix), so the
  parts that some guides need are few and are read by name; nothing else of the index is listed or opened.
* `manifest/<n>`: a log. An entry has a row for each part, bucket and sub-bucket that one build wrote: entries,
  occurrences, a digest and the build. It is written aside and moved to the next free number at one stroke. Who finds
  the number taken reads the log anew, gives up the parts that are there by now, and tries again: every part has one
  build.

A bucket of more than `hot` rows has a second level: its rows are parted by further bases outside the mask, as
many as leave at most 8 free bases, so a sub-bucket has at most 65,536 sites. A guide goes to the sub-buckets whose bases
differ from its own in no more places than mismatches are allowed, which all pairs within the distance do: under a mask on which
they agree, further bases are among those that may differ.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.dna import SITE, bucket, hamming
from strandlake.operators.catalogue import Mask, check_coverage, sliced
from strandlake.session import discard, exists, names, publish, settle, shared_dir

#: Sites of a part of a slice that the number of parts aims at; rows beyond which a bucket has a second level; free bases that sub-buckets leave at most.
PART_ROWS, HOT_ROWS, FREE_BASES, MOST_PARTS = 1 << 18, 1 << 20, 8, 1024
#: Rows of guides and buckets that may be broadcast (about 64 bytes each); more are shuffled with the index.
MOST_CELLS = 2_000_000
#: Rows of a file of the catalogue, so that it is read by as many tasks as there are cores.
FILE_ROWS = 1 << 21
ENTRY = "slice_id int, bucket_id long, sub long, signature long, occurrences long, gg long"
MANIFEST = "part int, slice_id int, bucket_id long, sub long, entries long, occurrences long, digest long, build string"
WHOLE = -1


def further(mask: Mask) -> Mask:
    """Positions of the second level: the first ones outside the mask, so many that FREE_BASES stay free."""
    rest = [p for p in range(SITE) if p not in mask]
    return tuple(rest[: max(0, len(rest) - FREE_BASES)])


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    root: str
    masks: tuple[Mask, ...]
    parts: int  # of each slice, a power of four
    hot: int
    sites: str  # path of the catalogue

    def catalogue(self) -> DataFrame:
        return self.spark.read.parquet(self.sites)

    def manifest(self) -> DataFrame:
        paths = [f"{self.root}/manifest/{v}" for v in names(self.spark, f"{self.root}/manifest")]
        read = self.spark.read.schema(MANIFEST)
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], MANIFEST)

    def published(self) -> dict[int, str]:
        """Build of every part that is there: a row for each of len(masks) * parts at most."""
        return {r.part: r.build for r in self.manifest().select("part", "build").distinct().collect()}

    def cells(self, rows: DataFrame, signature: str) -> DataFrame:
        """A row for every mask: part, slice_id, bucket_id and own (bases of the second level) beside the columns of rows."""
        sig = F.col(signature)

        def cell(k: int, mask: Mask) -> Column:
            of = bucket(sig, mask)
            fine = further(mask)
            part = (F.lit(k * self.parts) + of.bitwiseAND(F.lit(self.parts - 1).cast("long"))).cast("int")
            return F.struct(part.alias("part"), F.lit(k).alias("slice_id"), of.alias("bucket_id"), (bucket(sig, fine) if fine else F.lit(0)).cast("long").alias("own"))

        keys = F.array(*[cell(k, m) for k, m in enumerate(self.masks)])
        return rows.withColumn("__k", F.explode(keys)).select("*", "__k.*").drop("__k")


def open_index(spark: SparkSession, key: str, sites: Callable[[], DataFrame], masks: Sequence[Mask], distance: int = 4, base: str | None = None, parts: int | None = None, hot: int = HOT_ROWS) -> Index:
    """The index of masks under base (spark.checkpoint.dir by default) by a key of its source. Its catalogue (signature, occurrences, gg) is
    built from sites() where it is not there; of two builders at once the first to finish is kept. ValueError if the masks are not complete for the
    distance, or the source has no site."""
    check_coverage(masks, distance)
    base, named = base or f"{shared_dir(spark)}/strandlake", lambda *x: hashlib.sha256(repr(x).encode()).hexdigest()[:24]
    root, place = f"{base}/index-{named(key, tuple(masks), parts, hot)}", f"{base}/catalogue-{named(key)}"
    if not exists(spark, place):
        aside = f"{place}-aside-{uuid.uuid4().hex}"
        sites().select("signature", "occurrences", "gg").write.option("maxRecordsPerFile", FILE_ROWS).parquet(aside)
        if spark.read.parquet(aside).isEmpty():
            discard(spark, aside)
            raise ValueError("the source has no site: no index is built of it")
        if not publish(spark, aside, place):
            discard(spark, aside)
    if parts is None:
        n, parts = spark.read.parquet(place).count(), 1
        while parts < MOST_PARTS and parts * PART_ROWS < n and all(parts * 4 <= 4 ** len(m) for m in masks):
            parts *= 4
    return Index(spark, root, tuple(masks), parts, hot, place)


def planned(index: Index, parts: Iterable[int] | None = None) -> DataFrame:
    """slice_id, bucket_id, entries, occurrences of the buckets in use of these parts (all by default), built or not: what the manifest says
    of them once they are built, counted from the catalogue, each task's buckets before the shuffle."""
    rows = sliced(index.catalogue().select("signature", "occurrences"), index.masks)
    if parts is not None:
        part = F.col("slice_id") * index.parts + F.col("bucket_id").bitwiseAND(F.lit(index.parts - 1).cast("long"))
        rows = rows.where(part.cast("int").isin(sorted(set(parts))))
    return rows.groupBy("slice_id", "bucket_id").agg(F.count("*").alias("entries"), F.sum("occurrences").alias("occurrences"))


def ensure(index: Index, needed: Iterable[int] | None = None) -> dict[int, str]:
    """Builds the parts (all by default) that the manifest lacks, and only those; the build of every part that is there."""
    wanted = set(range(len(index.masks) * index.parts) if needed is None else needed)
    have = index.published()
    if missing := sorted(wanted - set(have)):
        publish_build(index, *write_build(index, missing))
        have = index.published()
    return have


def write_build(index: Index, missing: list[int]) -> tuple[str, DataFrame]:
    """Files of the missing parts, under an id of their own, and their rows of the manifest; nothing is published yet."""
    spark, build = index.spark, uuid.uuid4().hex
    rows = index.cells(index.catalogue(), "signature")
    if len(missing) < len(index.masks) * index.parts:
        rows = rows.where(F.col("part").isin(missing))
    large, _ = settle(rows.groupBy("slice_id", "bucket_id").count().where(F.col("count") > index.hot).select("slice_id", "bucket_id", F.lit(True).alias("cut")), "hot")
    rows = rows.join(large, ["slice_id", "bucket_id"], "left").withColumn("sub", F.when(F.col("cut"), F.col("own")).otherwise(WHOLE))
    entry = [c.split(" ")[0] for c in ENTRY.split(", ")]
    order = ["part", "bucket_id", "sub", "signature"]
    rows.select("part", *entry).repartition(F.col("part"), F.col("sub")).sortWithinPartitions(*order).write.partitionBy("part").parquet(f"{index.root}/builds/{build}")
    written = spark.read.schema(ENTRY + ", part int").parquet(f"{index.root}/builds/{build}")
    sums = written.groupBy("part", "slice_id", "bucket_id", "sub").agg(F.count("*").alias("entries"), F.sum("occurrences").alias("occurrences"), F.bit_xor(F.xxhash64("signature", "occurrences", "gg")).alias("digest"))
    listed = spark.createDataFrame([(p,) for p in missing], "part int")  # a part without entries is known by a row of none
    none = listed.join(sums, "part", "left_anti").select("part", F.floor(F.col("part") / index.parts).cast("int").alias("slice_id"), F.lit(-1).cast("long").alias("bucket_id"), F.lit(WHOLE).cast("long").alias("sub"), *(F.lit(0).cast("long").alias(c) for c in ("entries", "occurrences", "digest")))
    return build, settle(sums.unionByName(none).withColumn("build", F.lit(build)), "manifest")[0]


def publish_build(index: Index, build: str, rows: DataFrame) -> list[int]:
    """Moves the rows into the log, less those of parts that others published meanwhile; these parts' files go. The parts given up."""
    spark, given_up = index.spark, []
    rows = rows.select(*(c.split(" ")[0] for c in MANIFEST.split(", ")))
    while True:
        log = names(spark, f"{index.root}/manifest")  # before the parts are read: what is published later takes this number
        taken = index.published()
        aside = f"{index.root}/aside-{uuid.uuid4().hex}"
        mine = {r.part for r in rows.select("part").distinct().collect()}
        if lost := sorted(mine & set(taken)):
            given_up += lost
            for p in lost:
                discard(spark, f"{index.root}/builds/{build}/part={p}")
            rows = rows.where(~F.col("part").isin(lost))
        if not mine - set(lost):
            return given_up
        rows.coalesce(1 + len(mine) // 256).write.parquet(aside)
        if publish(spark, aside, f"{index.root}/manifest/{int(log[-1]) + 1 if log else 1:08d}"):
            return given_up
        discard(spark, aside)


def entries(index: Index, parts: Iterable[int]) -> DataFrame:
    """ENTRY rows of these parts, which must be there: only their folders are listed and read."""
    spark, own = index.spark, index.published()
    filled = {r.part for r in index.manifest().where("entries > 0").select("part").distinct().collect()}
    by_build: dict[str, list[int]] = {}
    for p in sorted(set(parts) & filled):
        by_build.setdefault(own[p], []).append(p)
    columns = [c.split(" ")[0] for c in ENTRY.split(", ")]
    out = None
    for build, wanted in by_build.items():
        root = f"{index.root}/builds/{build}"
        read = spark.read.schema(ENTRY).parquet(*(f"{root}/part={p}" for p in wanted)).select(*columns)
        out = read if out is None else out.unionByName(read)
    return spark.createDataFrame([], ENTRY) if out is None else out


def of_slices(cells: DataFrame, slices: Sequence[int] | None) -> DataFrame:
    return cells if slices is None else cells.where(F.col("slice_id").isin(list(slices)))


def guide_cells(index: Index, guides: DataFrame, distance: int, slices: Sequence[int] | None = None) -> DataFrame:
    """The columns of guides (guide_sig among them), slice_id, bucket_id and sub of every bucket or sub-bucket that can hold a site within the distance."""
    fine = index.manifest().where(F.col("sub") != WHOLE).select("slice_id", "bucket_id", "sub")
    met = of_slices(index.cells(guides, "guide_sig"), slices).join(fine, ["slice_id", "bucket_id"], "left")
    near = F.col("sub").isNull() | (hamming(F.col("own"), F.col("sub")) <= distance)
    return met.where(near).withColumn("sub", F.coalesce("sub", F.lit(WHOLE).cast("long"))).drop("own")


def needed_parts(index: Index, guides: DataFrame, slices: Sequence[int] | None = None) -> list[int]:
    """Parts that the guides read: len(masks) * parts numbers at most, however many guides there are."""
    cells = of_slices(index.cells(guides.select("guide_sig"), "guide_sig"), slices)
    return sorted(r.part for r in cells.select("part").distinct().collect())


def meetings(index: Index, guides: DataFrame, distance: int, slices: Sequence[int] | None = None) -> DataFrame:
    """Every meeting of a guide and a site in a bucket or sub-bucket (of these slices, all by default): columns of guides, slice_id, bucket_id, signature, occurrences, gg.

    Missing parts are built first, others are not read. The guides' buckets are written once and counted: up to MOST_CELLS
    rows they are broadcast, so the index is not shuffled; more are shuffled with it, where Spark splits hot keys."""
    guides, _ = settle(guides, "guides")
    parts = needed_parts(index, guides, slices)
    ensure(index, parts)
    cells, _ = settle(guide_cells(index, guides, distance, slices).drop("part"), "cells")
    side = F.broadcast(cells) if cells.count() <= MOST_CELLS else cells
    return entries(index, parts).join(side, ["slice_id", "bucket_id", "sub"]).drop("sub")
