"""Catalogues counted by number, many guides against the whole catalogue, sizes of buckets without an index."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_index import as_guides, as_sites, brute, near, pairs, sequences

from strandlake.operators import blocks, bounded, counted, fold, scan, scoring, simjoin
from strandlake.operators import catalogue as cat
from strandlake.operators import index as idx


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_sites_are_counted_as_by_patterns(spark, monkeypatch, held):
    monkeypatch.setattr(counted, "HELD", held)
    g = random.Random(31)
    texts = ["".join(g.choice("ACGTacgtGGCC" + "N" * (k % 3 == 0)) for _ in range(n)) for k, n in enumerate((0, 22, 23, 24, 400, 400, 3000, 200_000))]
    texts += [texts[5], None, "é" * 30 + texts[4], "CC" + "A" * 19 + "GG" * 3]
    rows = spark.createDataFrame([(t,) for t in texts], "seq string")
    want = {tuple(r) for r in cat.catalogue(scan.offtarget_sites(rows)).select("signature", "occurrences", "gg").collect()}
    assert len(want) > 5000
    assert {tuple(r) for r in counted.counts(rows).collect()} == want
    assert counted.counts(rows.where("false")).count() == 0


def test_many_guides_meet_the_catalogue_without_an_index(spark, tmp_path, monkeypatch):
    seqs = sequences(32, 3000)
    guides = near(33, seqs[:90], 4) + ["ACGTN" + "A" * 15]
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs + seqs[:500]), cat.FIVE_BLOCKS, base=f"file://{tmp_path}", parts=4)
    for name, n in (("GUIDES", 25), ("SITES", 400), ("AT_ONCE", 16)):
        monkeypatch.setattr(blocks, name, n)
    monkeypatch.setattr(simjoin, "FEW_GUIDES", 10)
    own = as_guides(spark, guides)
    got = simjoin.offtargets(own, index)
    assert pairs(got) == brute(guides[:-1], seqs, 4)
    assert pairs(simjoin.offtargets_by_distinct(own, index)) == brute(guides[:-1], seqs, 4)
    direct = simjoin.offtargets(own, index.catalogue(), masks=cat.PAIRS_OF_SIX)
    columns = ["guide_id", "guide_sig", "signature", "occurrences", "gg", "mismatches"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, direct.select(columns).collect()))
    assert index.published() == {}
    with pytest.raises(ValueError, match="missed"):
        simjoin.offtargets(own, index, 5)


def test_many_guides_are_accepted_in_one_round(spark, tmp_path, monkeypatch):
    seqs = sequences(34, 600)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, sorted({*seqs, *near(35, seqs[:15] * 40, 2)})), cat.PAIRS_OF_SIX, base=f"file://{tmp_path}", parts=1)
    guides = as_guides(spark, seqs[:60])
    want = {r.guide_id: r.mit_score for r in bounded.accepted(guides, index).collect()}
    assert 20 < len(want) < 60
    other = idx.open_index(spark, "other", index.catalogue, cat.PAIRS_OF_SIX, base=f"file://{tmp_path}", parts=1)
    monkeypatch.setattr(simjoin, "FEW_GUIDES", 10)
    assert {r.guide_id: r.mit_score for r in bounded.accepted(guides, other).collect()} == pytest.approx(want)
    assert other.published() == {}


@pytest.mark.parametrize("masks", [cat.FIVE_BLOCKS, cat.PAIRS_OF_SIX])
def test_sizes_of_buckets_need_no_index(spark, tmp_path, masks):
    """They are those of the manifest once all parts, or these parts, are built."""
    seqs = sequences(36, 2000)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs + seqs[:300] * 2), masks, base=f"file://{tmp_path}", parts=4, hot=20)
    rows = lambda df: sorted(map(tuple, df.select("slice_id", "bucket_id", "entries", "occurrences").collect()))
    some = [0, 3, 5, 17]
    whole, part = rows(idx.planned(index)), rows(idx.planned(index, some))
    counts = sorted(map(tuple, simjoin.candidate_counts(as_guides(spark, seqs[:50]), index).collect()))
    assert index.published() == {}
    idx.ensure(index, some)
    assert rows(cat.bucket_histogram(index.manifest())) == part
    idx.ensure(index)
    assert rows(cat.bucket_histogram(index.manifest())) == whole
    met = simjoin.candidates(as_guides(spark, seqs[:50]), index).groupBy("slice_id", "guide_sig").agg(F.count("*"), F.sum("occurrences"))
    assert sorted(map(tuple, met.collect())) == counts


def test_indexes_of_a_source_share_its_catalogue(spark, tmp_path):
    built = []

    def sites():
        built.append(1)
        return as_sites(spark, sequences(37, 100))

    for masks in (cat.FIVE_BLOCKS, cat.PAIRS_OF_SIX):
        assert idx.open_index(spark, "k", sites, masks, base=f"file://{tmp_path}").catalogue().count() == 100
    assert built == [1]


def test_a_hit_is_a_short_expression(spark):
    """So that Spark compiles it: it had 20 flags written out six times over."""
    assert len(str(scoring.mit_hit(F.col("a"), F.col("b")))) < 5000


def test_few_guides_are_folded_by_many_tasks(spark):
    """A hundred sequences are few bytes and much work: partitions are not joined."""
    g = random.Random(38)
    guides = spark.createDataFrame([("G" + "".join(g.choice("ACGT") for _ in range(20)) + "GG",) for _ in range(100)], "sequence string")
    done = fold.folds(guides).withColumn("task", F.spark_partition_id())
    assert done.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
