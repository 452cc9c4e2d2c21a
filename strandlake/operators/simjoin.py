"""Similarity join of guides with the catalogue: all sites within a number of mismatches.

Guides and sites meet in the buckets of a sliced index; a pair comes out in the first slice in which it
meets, which is an expression of the two signatures, so no distinct is needed afterwards. More than FEW_GUIDES guides, which need nearly all parts
of an index, meet the catalogue itself in blocks (operators/blocks.py), and no part is built for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.functions.dna import SITE, hamming
from strandlake.operators import blocks
from strandlake.operators.catalogue import PAIRS_OF_SIX, Mask, sliced
from strandlake.operators.index import Index, meetings, planned
from strandlake.session import settle

#: Guides that read parts of a stored index; more meet its whole catalogue.
FEW_GUIDES = 1 << 11


def many(guides: DataFrame, sites: DataFrame | Index) -> bool:
    return isinstance(sites, Index) and guides.count() > FEW_GUIDES


def first_slice(a: Column, b: Column, masks: Sequence[Mask]) -> Column:
    """Number of the first mask under which the signatures agree."""
    x, out = a.bitwiseXOR(b), F.lit(None).cast("int")
    for k in range(len(masks) - 1, -1, -1):
        bits = sum(3 << 2 * p for p in masks[k])
        out = F.when(x.bitwiseAND(F.lit(bits).cast("long")) == 0, F.lit(k)).otherwise(out)
    return out


def candidates(guides: DataFrame, sites: DataFrame | Index, masks: Sequence[Mask] = PAIRS_OF_SIX, distance: int = SITE, slices: Sequence[int] | None = None) -> DataFrame:
    """Every meeting of a guide (guide_id, guide_sig) and a site (signature, occurrences) in a bucket. sites: a stored
    index, of which only the parts that the guides need are read (sub-buckets further than the distance are left out), or
    a catalogue, sliced here by the masks and joined on slice and bucket."""
    if isinstance(sites, Index):
        return meetings(sites, guides, distance, slices)
    return sliced(guides, masks, "guide_sig").join(sliced(sites, masks), ["slice_id", "bucket_id"])


def candidate_counts(guides: DataFrame, index: Index) -> DataFrame:
    """slice_id, guide_sig, candidates, occurrences: how many meetings candidates() has for a guide in a slice, from the sizes of the
    buckets; no meeting is made and no part of the index built for it."""
    own = sliced(guides.select("guide_sig").distinct(), index.masks, "guide_sig")
    return own.join(planned(index), ["slice_id", "bucket_id"]).select("slice_id", "guide_sig", F.col("entries").alias("candidates"), "occurrences")


def offtargets(guides: DataFrame, sites: DataFrame | Index, distance: int = 4, masks: Sequence[Mask] = PAIRS_OF_SIX, slices: Sequence[int] | None = None) -> DataFrame:
    """guide_id, guide_sig, signature, occurrences, mismatches and the other columns of sites, each pair once. The masks
    of a stored index are its own; slices: only pairs that first meet in these slices of it."""
    if isinstance(sites, Index) and slices is None:
        guides, _ = settle(guides, "guides")
        if many(guides, sites):
            return blocks.offtargets(guides, sites.catalogue(), distance)
    masks = sites.masks if isinstance(sites, Index) else masks
    near = candidates(guides, sites, masks, distance, slices).withColumn("mismatches", hamming(F.col("guide_sig"), F.col("signature"))).where(F.col("mismatches") <= distance)
    return near.where(F.col("slice_id") == first_slice(F.col("guide_sig"), F.col("signature"), masks)).drop("slice_id", "bucket_id")


def offtargets_by_distinct(guides: DataFrame, sites: DataFrame | Index, distance: int = 4, masks: Sequence[Mask] = PAIRS_OF_SIX) -> DataFrame:
    """The same by removing repeats, for indexes whose masks are not known. Many guides meet the catalogue, in which a pair comes once."""
    if isinstance(sites, Index):
        guides, _ = settle(guides, "guides")
        if many(guides, sites):
            return blocks.offtargets(guides, sites.catalogue(), distance)
    near = candidates(guides, sites, masks, distance).withColumn("mismatches", hamming(F.col("guide_sig"), F.col("signature"))).where(F.col("mismatches") <= distance)
    return near.drop("slice_id", "bucket_id").dropDuplicates(["guide_id", "signature"])


def needed_buckets(guides: DataFrame, masks: Sequence[Mask]) -> DataFrame:
    """Distinct slice_id and bucket_id that the guides read."""
    return sliced(guides.select("guide_sig"), masks, "guide_sig").select("slice_id", "bucket_id").distinct()
