"""FASTA text, plain or gzipped, as (file, record, header, seq) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.operators.scan import LENGTH, PIECE
from strandlake.session import settle


def records(files: DataFrame) -> DataFrame:
    """Records of whole files (columns file, value), all of them, in file order.

    A line that begins with > starts a record; the others are stripped, joined and upper-cased. Text before
    the first header, or without one, is a record headed by the file's name. Blank lines are skipped.
    """
    parts = F.split(F.concat(F.lit("\n"), F.regexp_replace("value", "\r\n?", "\n")), "\n>")
    rows = files.select("file", F.posexplode(parts).alias("record", "part"))
    header = F.when(F.col("record") == 0, F.col("file")).otherwise(F.trim(F.regexp_extract("part", r"^([^\n]*)", 1)))
    body = F.when(F.col("record") == 0, F.col("part")).otherwise(F.regexp_replace("part", r"^[^\n]*", ""))
    out = rows.select("file", "record", header.alias("header"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("seq"))
    return out.where((F.col("record") > 0) | (F.col("seq") != ""))


def usable(sources: DataFrame, text: str = "value") -> DataFrame:
    """Source files with n_bases (long) and error: null, or empty where no base stands outside header lines. An empty
    or missing source must not become an empty index: check_usable() raises instead."""
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?m)^>[^\r\n]*", "")
    n = F.length(F.regexp_replace(body, r"\s+", "")).cast("long")
    return sources.withColumn("n_bases", n).withColumn("error", F.when(F.col("n_bases") == 0, "empty"))


def check_usable(sources: DataFrame, text: str = "value") -> DataFrame:
    """sources, once it is known that they hold bases; else ValueError."""
    if usable(sources, text).where("error IS NULL").isEmpty():
        raise ValueError("the source holds no bases")
    return sources


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One file a row; the codec follows from the suffix, so .gz needs nothing more."""
    return records(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value"))


def numbered_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lines of bases (file, record, at, seq; at: bases of the record before the line) and headers (file, record,
    header) of files of any size.

    Lines are numbered within their split of the file, which is the unit that a task reads; one row a split then
    tells what the splits before it leave open, so no task sees a whole file."""
    line = F.trim("value")
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n"), line.alias("line")).where("line <> ''")
    head = F.col("line").startswith(">")
    so_far = Window.partitionBy("file", "split").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    size = F.when(head, 0).otherwise(F.length("line")).cast("long")
    within = read.select("*", head.alias("head"), size.alias("size"))
    within = within.withColumn("before", F.sum("size").over(so_far) - F.col("size")).withColumn("heads", F.sum(F.col("head").cast("int")).over(so_far))
    within = within.withColumn("opened", F.max(F.when(F.col("head"), F.col("before"))).over(so_far))
    within, _ = settle(within, "lines")
    splits = within.groupBy("file", "split").agg(F.max("heads").alias("h"), F.sum("size").alias("total"), F.max("opened").alias("last"))
    order = Window.partitionBy("file").orderBy("split")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce("last", F.lit(0))  # bases after the last header of the split, all where it has none
    splits = splits.select("file", "split", F.coalesce(F.sum("h").over(earlier), F.lit(0)).alias("records"), F.sum((F.col("h") > 0).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("g"), left.alias("left"), "h")
    # a split's left belongs to its group g; one that has headers opens the group for those after it
    group = Window.partitionBy("file", "g").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.withColumn("in_group", F.coalesce(F.sum("left").over(group), F.lit(0)))
    opens = splits.groupBy("file", "g").agg(F.sum("left").alias("group_left"))
    carried = carried.join(opens.select("file", (F.col("g") + 1).alias("g"), "group_left"), ["file", "g"], "left")
    carry = F.when(F.col("h") > 0, F.coalesce("group_left", F.lit(0))).otherwise(F.col("in_group"))
    placed = within.join(carried.select("file", "split", "records", carry.alias("carry")), ["file", "split"])
    record = (F.col("records") + F.col("heads")).cast("long").alias("record")
    at = F.when(F.col("heads") > 0, F.col("before") - F.col("opened")).otherwise(F.col("before") + F.col("carry"))
    seq = F.upper(F.regexp_replace("line", r"\s+", ""))
    return placed.where(~F.col("head")).select("file", record, at.alias("at"), seq.alias("seq")), placed.where("head").select("file", record, F.trim(F.expr("substring(line, 2)")).alias("header"))


def read_fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of files too large for a row each, where every record fits one: file, record, header, seq."""
    lines, headers = numbered_lines(spark, path)
    whole = lines.groupBy("file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq"))), lambda x: x["seq"]), "").alias("seq"))
    out = headers.join(whole, ["file", "record"], "full")
    return out.select("file", "record", F.coalesce("header", "file").alias("header"), F.coalesce("seq", F.lit("")).alias("seq"))


def read_fasta_pieces(spark: SparkSession, path: str, bases: int = PIECE, overlap: int = LENGTH - 1) -> tuple[DataFrame, DataFrame]:
    """Pieces (file, record, at, seq) of records of any size, each reaching `overlap` bases into the next, and headers
    (file, record, header). Pieces are dealt over tasks; they go straight into the scans."""
    lines, headers = numbered_lines(spark, path)
    end = F.col("at") + F.length("seq")
    first, last = F.greatest(F.lit(0), F.floor((F.col("at") - overlap) / bases)), F.floor((end - 1) / bases)
    cut = lines.where("seq <> ''").select("*", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("k"))
    begin = F.greatest(F.col("at"), F.col("k") * bases)
    stop = F.least(end, (F.col("k") + 1) * bases + overlap)
    part = F.substring("seq", (begin - F.col("at") + 1).cast("int"), (stop - begin).cast("int"))
    parts = cut.select("file", "record", "k", F.struct(begin.alias("at"), part.alias("seq")).alias("p")).where("p.seq <> ''")
    pieces = parts.groupBy("file", "record", "k").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["seq"]), "").alias("seq"))
    return pieces.select("file", "record", (F.col("k") * bases).alias("at"), "seq"), headers
