"""Off-target scores of guides from published formulas.

Scores are complete sums, not stopped early, so they do not depend on an order. Whether a site equal to the
guide counts is a parameter, as published uses differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.dna import LOW_BITS

#: Weights of mismatches by position, PAM-distal first (Hsu et al. 2013).
MIT_WEIGHTS = (0, 0, 0.014, 0, 0, 0.395, 0.317, 0, 0.389, 0.079, 0.445, 0.508, 0.613, 0.851, 0.732, 0.828, 0.615, 0.804, 0.685, 0.583)
METHODS = ("mit", "cfd", "and", "or", "avg")


def differs(a: Column, b: Column, position: int) -> Column:
    """Whether the base at a position differs, from the signatures."""
    return F.shiftrightunsigned(a.bitwiseXOR(b), 2 * position).bitwiseAND(F.lit(3).cast("long")) != 0


def mit_hit(a: Column, b: Column, weights: Sequence[float] = MIT_WEIGHTS) -> Column:
    """Local score of a pair of signatures: weights of mismatches, their mean distance, their number."""
    product = F.lit(1.0)
    for p, w in enumerate(weights):
        if w:
            product = product * F.when(differs(a, b, p), F.lit(1.0 - w)).otherwise(F.lit(1.0))
    # the low bit of each base that differs: their number, and from the places of the lowest and the highest the first and the last
    x = a.bitwiseXOR(b)
    bits = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW_BITS).cast("long"))
    n = F.bit_count(bits)
    first = F.shiftright(F.bit_count(bits.bitwiseAND(-bits) - 1), 1)
    last = F.shiftright(F.length(F.bin(bits)) - 1, 1)
    mean = (last - first) / (n - 1)
    spread = F.when(n < 2, F.lit(1.0)).otherwise(1.0 / ((19.0 - mean) / 19.0 * 4.0 + 1.0))
    return F.when(n == 0, F.lit(1.0)).otherwise(product * spread / (n * n))


def mit_scores(pairs: DataFrame, guides: DataFrame, count_exact: bool = False) -> DataFrame:
    """guide_id, mit_score in 0..100; guides without off-targets score 100."""
    hit = mit_hit(F.col("guide_sig"), F.col("signature")) * F.col("occurrences")
    used = pairs if count_exact else pairs.where("mismatches > 0")
    sums = used.groupBy("guide_id").agg(F.sum(hit).alias("hits"))
    return guides.join(sums, "guide_id", "left").select("guide_id", (10000.0 / (100.0 + 100.0 * F.coalesce("hits", F.lit(0.0)))).alias("mit_score"))


def cfd_hit(a: Column, b: Column, penalties: dict[tuple[int, int, int], float]) -> Column:
    """Product of the penalties (position, guide base, site base) of the mismatches; bases as 0..3.

    The table has 20 x 12 entries and becomes array literals, so a pair costs 20 look-ups and no join."""
    out = F.lit(1.0)
    for p in range(20):
        x = F.shiftrightunsigned(a, 2 * p).bitwiseAND(F.lit(3).cast("long")).cast("int")
        y = F.shiftrightunsigned(b, 2 * p).bitwiseAND(F.lit(3).cast("long")).cast("int")
        row = F.array(*[F.lit(1.0 if i == j else float(penalties.get((p, i, j), 1.0))) for i in range(4) for j in range(4)])
        out = out * F.get(row, x * 4 + y)
    return out


def weighed(pairs: DataFrame, pam_factors: dict[str, float] | None) -> Column:
    """Occurrences, each with the factor of its PAM (GG or AG) by the catalogue's counters; all count 1 without factors."""
    if pam_factors is None or "gg" not in pairs.columns:
        return F.col("occurrences").cast("double")
    return F.col("gg") * F.lit(float(pam_factors["GG"])) + (F.col("occurrences") - F.col("gg")) * F.lit(float(pam_factors["AG"]))


def cfd_scores(pairs: DataFrame, guides: DataFrame, penalties: dict[tuple[int, int, int], float], count_exact: bool = True, pam_factors: dict[str, float] | None = None) -> DataFrame:
    """guide_id, cfd_score in 0..100. pam_factors: of the PAMs GG and AG, which users bring; pairs then have the column gg
    of a catalogue."""
    hit = cfd_hit(F.col("guide_sig"), F.col("signature"), penalties) * weighed(pairs, pam_factors)
    used = pairs if count_exact else pairs.where("mismatches > 0")
    sums = used.groupBy("guide_id").agg(F.sum(hit).alias("hits"))
    return guides.join(sums, "guide_id", "left").select("guide_id", (10000.0 / (100.0 + 100.0 * F.coalesce("hits", F.lit(0.0)))).alias("cfd_score"))


def passes(method: str, mit: Column, cfd: Column, threshold: float = 75.0) -> Column:
    """Our reading of the methods on complete scores: one score, both, either, or their mean at the threshold."""
    return {"mit": mit >= threshold, "cfd": cfd >= threshold, "and": (mit >= threshold) & (cfd >= threshold), "or": (mit >= threshold) | (cfd >= threshold), "avg": (mit + cfd) / 2 >= threshold}[method]


def shown(method: str, mit: Column, cfd: Column) -> list[Column]:
    """Scores as reported: -1 for one that the method does not use."""
    return [F.lit(-1.0) if method == "cfd" else mit, F.lit(-1.0) if method == "mit" else cfd]


def violations(scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a score is null, not a number, infinite, or neither -1 nor within 0..100."""
    bad = F.lit(False)
    for c in columns:
        v = F.col(c)
        bad = bad | v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))) | ~(v.between(0, 100) | (v == -1))
    return scores.where(bad)
