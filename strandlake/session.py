"""Session helpers: the folder all executors share, written intermediate tables, input spread."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a fresh local one if all
    executors are threads of the driver, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/strandlake/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, computes once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that settle() wrote, on whatever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a finished folder to its place at one stroke; False if that place is taken, and nothing is changed.

    Needs a file system whose rename is atomic and does not replace (HDFS, local)."""
    jvm = spark._jvm
    from_path, to_path = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    to_path.getFileSystem(conf).mkdirs(to_path.getParent())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(to_path.toUri(), conf).rename(from_path, to_path, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def input_key(df: DataFrame, *more: object) -> str:
    """Digest of the input files of df by name, size and time of change, and of more: names what is derived from them."""
    spark = df.sparkSession
    conf, states = spark._jsc.hadoopConfiguration(), []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        state = path.getFileSystem(conf).getFileStatus(path)
        states.append((name, state.getLen(), state.getModificationTime()))
    return hashlib.sha256(repr((states, more)).encode()).hexdigest()[:24]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows over all cores if the input came in fewer partitions than there are cores.

    A table of many files keeps its partitions, so there is no shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
