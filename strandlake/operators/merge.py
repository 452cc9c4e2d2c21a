"""A catalogue kept in cells, into which new records are merged.

A cell is the first bases of a site. Files are immutable: a merge writes the cells that the new sites touch into a folder
of its own, reading only these cells of the old ones, and adds an entry (cell, version) to a log. The newest version of
a cell counts. An entry is moved to its number at one stroke; a merge that finds it taken starts again from the log as it is
then, so none is lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.operators.catalogue import merged
from strandlake.session import discard, names, publish, settle

#: First bases that name a cell: 256 cells.
CELL_BASES = 4
COLUMNS = "seq20 string, signature long, occurrences long, gg long"
NAMES = [c.split(" ")[0] for c in COLUMNS.split(", ")]


def cells(spark: SparkSession, path: str) -> dict[str, str]:
    """Version of every cell: 4 ** CELL_BASES entries at most."""
    log = [f"{path}/log/{n}" for n in names(spark, f"{path}/log")]
    if not log:
        return {}
    newest = spark.read.schema("cell string, version string").parquet(*log).groupBy("cell").agg(F.max("version").alias("version"))
    return {r.cell: r.version for r in newest.collect()}


def read_cells(spark: SparkSession, path: str, versions: dict[str, str]) -> DataFrame:
    paths = [f"{path}/files/{version}/cell={cell}" for cell, version in versions.items()]
    return spark.read.schema(COLUMNS).parquet(*paths).select(*NAMES) if paths else spark.createDataFrame([], COLUMNS)


def load(spark: SparkSession, path: str) -> DataFrame:
    """seq20, signature, occurrences, gg."""
    return read_cells(spark, path, cells(spark, path))


def merge_into(spark: SparkSession, path: str, new: DataFrame) -> list[str]:
    """Merges a catalogue of new records into the stored one, counts added; the cells that were written."""
    new, settled = settle(new.select(*NAMES).withColumn("cell", F.substring("seq20", 1, CELL_BASES)), "new")
    touched = sorted(r.cell for r in new.select("cell").distinct().collect())
    while touched:
        log = names(spark, f"{path}/log")
        number = int(log[-1]) + 1 if log else 1
        version = f"{number:08d}-{uuid.uuid4().hex}"
        have = {c: v for c, v in cells(spark, path).items() if c in set(touched)}
        out = merged(read_cells(spark, path, have), new).withColumn("cell", F.substring("seq20", 1, CELL_BASES))
        out.repartition("cell").sortWithinPartitions("cell", "seq20").write.partitionBy("cell").parquet(f"{path}/files/{version}")
        aside = f"{path}/aside-{uuid.uuid4().hex}"
        spark.createDataFrame([(c, version) for c in touched], "cell string, version string").coalesce(1).write.parquet(aside)
        if publish(spark, aside, f"{path}/log/{number:08d}"):
            break
        for lost in (aside, f"{path}/files/{version}"):
            discard(spark, lost)
    discard(spark, settled)
    return touched


def store(sites: DataFrame, path: str) -> list[str]:
    """A first catalogue at path."""
    return merge_into(sites.sparkSession, path, sites)
