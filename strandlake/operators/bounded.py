"""Scores of guides that can still reach a threshold, slice by slice.

A score falls with the sum of a guide's hits, and no hit is negative: once a part of the sum is over the bound that the
threshold sets, the score is under it whatever follows. Slices of a stored index are joined in rounds, each pair counts in
the first slice in which it meets, and guides that are over the bound meet no site of later rounds. The accepted guides and their
scores are those of complete sums. More guides than simjoin.FEW_GUIDES meet the whole catalogue once, in one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.index import Index
from strandlake.operators.scoring import mit_hit
from strandlake.operators.simjoin import many, offtargets
from strandlake.session import settle


def bound(threshold: float) -> float:
    """The greatest sum of hits of a score that reaches the threshold."""
    return 100.0 / threshold - 1.0 if threshold > 0 else float("inf")


def accepted(guides: DataFrame, index: Index, threshold: float = 75.0, distance: int = 4, rounds: int = 3) -> DataFrame:
    """guide_id, guide_sig, mit_score of the guides (guide_id, guide_sig) whose score reaches the threshold; sites equal to a guide do not count."""
    n = len(index.masks)
    left, _ = settle(guides.select("guide_id", "guide_sig", F.lit(0.0).alias("hits")), "left")
    rounds = 1 if many(left, index) else rounds
    for k in range(rounds):
        slices = range(k * n // rounds, (k + 1) * n // rounds) if rounds > 1 else None
        met = offtargets(left.select("guide_id", "guide_sig"), index, distance, slices=slices).where("mismatches > 0")
        sums = met.groupBy("guide_id").agg(F.sum(mit_hit(F.col("guide_sig"), F.col("signature")) * F.col("occurrences")).alias("more"))
        total = F.col("hits") + F.coalesce("more", F.lit(0.0))
        left, _ = settle(left.join(sums, "guide_id", "left").select("guide_id", "guide_sig", total.alias("hits")).where(F.col("hits") <= bound(threshold)), "left")
    return left.select("guide_id", "guide_sig", (10000.0 / (100.0 + 100.0 * F.col("hits"))).alias("mit_score"))
