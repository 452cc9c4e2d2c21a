"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a character class of Java and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, wherever and however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
