"""Mixing sources to target weights by the cube method.

Each source has a target number of words; a document's expected number of copies is target / size of its
source, at most `cap`. The whole part is taken for certain, the fraction is an inclusion probability. The
cube method's flight moves three fractional documents at a time along the null space of the two balancing
constraints (number of documents, number of words), until one of them is 0 or 1; expectations stay, and so
do both totals. It runs inside blocks of about BLOCK documents of a source, chosen by hash; what each block
leaves fractional (two documents at most) flies again in blocks of blocks until a source fits one block,
and only that last pair is rounded, to the least imbalance. Every random number comes from a hash of the document, so reruns agree.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source, last in
order. Rows that agree in id, source and size are
decided together. A source
without words has target 0. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm.text import WORD, table, whole
from strandlake.session import settle

#: Weights by source in turn, words of the mix against all words, most copies of a document.
WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2
BLOCK = 4096
EPS = 1e-9


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target, from (source, size) rows.

    By weight, stopped at cap * source_size, the excess reshared: the target is min(cap * size, level * weight),
    and the level follows from sorting sources by where they stop. One row a source goes through the window.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int")).cast("double")
    s = by_source.withColumn("weight", weight).withColumn("most", cap * F.col("source_size").cast("double"))
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    total = Window.partitionBy()
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", (share * F.sum("source_size").over(total) - F.coalesce(F.sum("most").over(before), F.lit(0.0))).alias("left"), (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"))
    fits = F.when(F.col("left") / F.col("open") <= F.col("most") / F.col("weight"), F.struct(*order[:1], F.col("source").isNull(), "source", F.col("left") / F.col("open")))
    s = s.withColumn("level", F.min(fits).over(total)["col4"])
    return s.select("source", "source_size", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))).alias("target"))


def flight(p: np.ndarray, x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Moves p until at most two entries are fractional; x: words; u: one random number an entry."""
    p = p.copy()
    open_: list[int] = []
    for i in range(len(p)):
        if not EPS < p[i] < 1 - EPS:
            continue
        open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = open_
        v = np.array([x[b] - x[c], x[c] - x[a], x[a] - x[b]], float)  # orthogonal to (1, 1, 1) and to x
        if not v.any():
            v = np.array([1.0, -1.0, 0.0])
        q = p[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(v > 0, (1 - q) / v, np.where(v < 0, -q / v, np.inf)).min()
            down = np.where(v > 0, q / v, np.where(v < 0, (q - 1) / v, np.inf)).min()
        q = q + up * v if u[i] * (up + down) < down else q - down * v
        q[q < EPS], q[q > 1 - EPS] = 0, 1
        p[open_] = q
        open_ = [k for k in open_ if 0 < p[k] < 1]
    return p


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Decides the last one or two fractional entries: of the ways to round them, the one whose words, then
    whose number, stay nearest to the expected. Then, while that brings the words nearer, the decided
    entry that fits the difference best changes sides, four entries at most."""
    left = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    p = np.where(p >= 1 - EPS, 1.0, np.where(p <= EPS, 0.0, p))
    q, w = p[left], x[left]
    p[left] = min(itertools.product((0.0, 1.0), repeat=len(left)), key=lambda t: (abs(((t - q) * w).sum()), abs((t - q).sum())))
    over = ((p[left] - q) * w).sum()
    for _ in range(4 if len(left) else 0):
        after = np.abs(over + np.where(p > 0.5, -x, x))
        k = int(after.argmin())
        if after[k] >= abs(over):
            break
        over += x[k] if p[k] < 0.5 else -x[k]
        p[k] = 1 - p[k]
    return p


KEY = ["doc_id", "source", "size"]


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys meet; the columns of left, then what right adds."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(right, on, how).drop(*(f"__{k}" for k in keys))


def flier(last: bool):
    def fly(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["u", "doc_id", "size"], kind="stable")
        u = frame.u.to_numpy()
        p = flight(frame.p.to_numpy(), frame.x.to_numpy(), u)
        return frame.assign(p=land(p, frame.x.to_numpy()) if last else p)[[*KEY, "p", "x", "u"]]

    return fly


def balanced_sample(units: DataFrame) -> DataFrame:
    """KEY and take (0 or 1) for units (KEY, p, x, u) with 0 < p < 1; x is what the constraint sums."""
    id_type = units.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, source string, size long, p double, x double, u double"
    is_open = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    decided: list[DataFrame] = []
    level = 0
    while True:
        blocks = units.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        last = (blocks.agg(F.max("blocks")).first()[0] or 1) <= 1

        block = F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.col("blocks"))
        placed = null_safe_join(units, blocks, ["source"]).withColumn("block", block)
        flown, _ = settle(placed.groupBy("source", "block").applyInPandas(flier(last), schema), "flight")
        decided.append(flown.where(~is_open).select(*KEY, F.round("p").cast("long").alias("take")))
        if last:
            break
        units, level = flown.where(is_open), level + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row per input row."""
    sizes, _ = settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(whole(text_col)).alias("size")), "sizes")
    goals, _ = settle(targets(sizes, weights, share, cap), "targets")
    by_source = null_safe_join(sizes, goals, ["source"])
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    by_source = by_source.withColumn("sure", F.floor(ratio + EPS)).withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("sure")))
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "size", F.lit(seed).cast("long"), F.lit("u")), 11) / F.lit(float(1 << 53))
    units = by_source.where((F.col("p") > EPS) & (F.col("size") > 0)).groupBy(*KEY, "p").agg((F.count("*") * F.col("size")).cast("double").alias("x"))
    taken = balanced_sample(units.select(*KEY, "p", "x", u.alias("u")))
    out = null_safe_join(by_source, taken, KEY, "left")
    copies = F.when(F.col("size") > 0, F.col("sure") + F.coalesce("take", F.lit(0))).otherwise(0)
    return out.select(*KEY, "source_size", "target", copies.cast("long").alias("copies"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")
