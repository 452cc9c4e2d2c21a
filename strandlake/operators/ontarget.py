"""On-target efficiency: three predicates and their consensus."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.dna import at_count, one_hot

#: Bounds of the AT share and of the folding energy; the scaffold that follows the guide, and
#: the shape of a fold in which the guide stays free.
AT_LOW, AT_HIGH = 0.20, 0.65
ENERGY_SHAPED, ENERGY_OTHER = -30.0, -18.0
SCAFFOLD = "GUUUUAGAGCUAGAAAUAGCAAGUUAAAAUAAGGCUAGUCCGUUAUCAACUUGAAAAAGUGGCACCGAGUCGGUGCUUUU"
FREE_GUIDE = r".{28}\({4}\.{4}\){4}\.{3}\){4}.{21}\({4}\.{4}\){4}\({7}\.{3}\){7}\.{3}\s\((.+)\)"


def chopchop(seq: Column) -> Column:
    """Whether base 20 is G."""
    return F.substring(seq, 20, 1) == "G"


def fold_eligible(seq: Column) -> Column:
    """Whether a site is worth folding: not T..GG, nor CC..A."""
    return ~((seq.startswith("T") & seq.endswith("GG")) | (seq.startswith("CC") & seq.endswith("A")))


def fold_verdict(shaped: Column, energy: Column) -> Column:
    """Accepts a fold of the expected shape down to -30, any other only above -18; no energy, no."""
    return F.coalesce(F.when(shaped, energy >= ENERGY_SHAPED).otherwise(energy > ENERGY_OTHER), F.lit(False))


def parse_fold(line: Column) -> Column:
    """struct(structure, energy) of a line such as "..((..)) ( -3.40)"."""
    return F.struct(F.regexp_extract(line, r"^([.()]+)\s", 1).alias("structure"), F.regexp_extract(line, r"\(\s*(-?[0-9.]+)\s*\)\s*$", 1).try_cast("double").alias("energy"))


def free_guide(line: Column) -> Column:
    """Whether a fold (a line of structure and energy) has the shape in which the guide stays free."""
    return F.coalesce(line.rlike(FREE_GUIDE), F.lit(False))


def fold_input(seq: Column, scaffold: str = SCAFFOLD) -> Column:
    """What is folded: G, bases 2 to 20, the scaffold."""
    return F.concat(F.lit("G"), F.substring(seq, 2, 19), F.lit(scaffold))


def mm10db_composition(seq: Column) -> Column:
    """No TTTT, and an AT share of the whole site within bounds."""
    share = at_count(seq) / F.length(seq)
    return (F.instr(seq, "TTTT") == 0) & share.between(AT_LOW, AT_HIGH)


def mm10db(seq: Column, folded: Column) -> Column:
    return mm10db_composition(seq) & folded


def svm_weights(support_vectors: Sequence[Sequence[float]], dual_coef: Sequence[float]) -> list[float]:
    """A linear machine's support vectors summed into one weight a feature."""
    return [sum(c * v[k] for c, v in zip(dual_coef, support_vectors, strict=True)) for k in range(len(support_vectors[0]))]


def svm_score(seq: Column, weights: Sequence[float], bias: float) -> Column:
    """Decision value on the one-hot code of the first 20 bases: one table look-up a base."""
    w = F.array(*map(F.lit, map(float, weights)))
    return F.aggregate(F.zip_with(one_hot(seq), w, lambda x, y: x * y), F.lit(float(bias)), lambda s, v: s + v)


def sgrnascorer(seq: Column, weights: Sequence[float], bias: float) -> Column:
    return svm_score(seq, weights, bias) >= 0


def consensus(chop: Column, mm10: Column, svm: Column) -> Column:
    """The flags as 0 or 1, comma-joined: CHOPCHOP, mm10db, sgRNAScorer."""
    return F.concat_ws(",", *(c.cast("int").cast("string") for c in (chop, mm10, svm)))


def votes(flags: Column) -> Column:
    return F.length(flags) - F.length(F.translate(flags, "1", ""))


def recommended(flags: Column, score: Column, least_votes: int = 2, least_score: float = 75.0) -> Column:
    return (votes(flags) >= least_votes) & (score >= least_score)


def fold_with(guides: DataFrame, fold: Callable[[list[str]], list[tuple[str, float]]], scaffold: str = SCAFFOLD) -> DataFrame:
    """structure and energy from an outside folding program, given as a function on a batch of strings."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = fold(f["__input"].tolist())
            yield f.drop(columns="__input").assign(structure=[s for s, _ in done], energy=[e for _, e in done])

    schema = guides.withColumn("structure", F.lit("")).withColumn("energy", F.lit(0.0)).schema
    eligible = guides.where(fold_eligible(F.col("sequence")))
    return eligible.withColumn("__input", fold_input(F.col("sequence"), scaffold)).mapInPandas(run, schema)
