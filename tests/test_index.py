"""The stored index: parts on demand, races, second level, pruning; numbered and merged catalogues; linear cutting."""

from __future__ import annotations

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandlake.functions import dna
from strandlake.operators import bounded, merge, scan, scoring, simjoin
from strandlake.operators import catalogue as cat
from strandlake.operators import index as idx

THREE = cat.block_masks(3, 1)


def sequences(seed, n, letters="ACGT"):
    g = random.Random(seed)
    return sorted({"".join(g.choice(letters) for _ in range(20)) for _ in range(n)})


def near(seed, seqs, most):
    g = random.Random(seed)
    out = []
    for s in seqs:
        w = list(s)
        for p in g.sample(range(20), g.randint(0, most)):
            w[p] = g.choice("ACGT")
        out.append("".join(w))
    return sorted(set(out))


def as_sites(spark, seqs):
    return cat.catalogue(spark.createDataFrame([(s,) for s in seqs], "seq20 string"))


def as_guides(spark, seqs):
    return spark.createDataFrame([(s,) for s in seqs], "s string").select(dna.pack(F.col("s")).alias("guide_sig")).distinct().withColumn("guide_id", F.col("guide_sig"))


def packed(s):
    return sum("ACGT".index(b) << 2 * k for k, b in enumerate(s))


def brute(guides, sites, distance):
    return {(packed(g), packed(s)) for g in guides for s in sites if sum(a != b for a, b in zip(g, s, strict=True)) <= distance}


def pairs(df):
    rows = [(r.guide_sig, r.signature) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def scanned(df):
    """Files that the scans of a finished query opened, and rows that they put out, by the metrics of its plan."""
    plan = df._jdf.queryExecution().executedPlan()
    total = {"numFiles": 0, "numOutputRows": 0}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            for m in total:
                total[m] += node.metrics().apply(m).value()
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return total


def test_few_guides_open_few_files(spark, tmp_path):
    """A hundred guides read under a tenth of the index, and missing parts alone are built."""
    seqs = sequences(1, 6000)
    guides = near(2, seqs[:100], 2)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs), THREE, distance=2, base=f"file://{tmp_path}", parts=1024)
    idx.ensure(index)
    files = len([f for f in Path(tmp_path).rglob("builds/*/part=*/*.parquet")])
    assert files > 2500
    g = as_guides(spark, guides)
    plan = idx.entries(index, idx.needed_parts(index, g))
    rows = plan.collect()
    seen = scanned(plan)
    assert seen["numFiles"] == len(plan.inputFiles())
    assert seen["numFiles"] < files / 10
    assert len(rows) < 3 * len(seqs) / 10
    assert pairs(simjoin.offtargets(g, index, 2)) == brute(guides, seqs, 2)


def test_missing_parts_are_built_alone(spark, tmp_path):
    seqs = sequences(3, 3000)
    first, second = near(4, seqs[:6], 2), near(5, seqs[500:560], 3)
    built = []

    def sites():
        built.append(1)
        return as_sites(spark, seqs)

    index = lambda: idx.open_index(spark, "k", sites, cat.FIVE_BLOCKS, base=f"file://{tmp_path}", parts=16)
    assert pairs(simjoin.offtargets(as_guides(spark, first), index())) == brute(first, seqs, 4)
    some = index().published()
    assert 0 < len(some) < 80
    assert set(some) == set(idx.needed_parts(index(), as_guides(spark, first)))
    assert pairs(simjoin.offtargets(as_guides(spark, second), index())) == brute(second, seqs, 4)
    more = index().published()
    assert {p: b for p, b in more.items() if p in some} == some
    assert len(set(more.values())) == 2
    idx.ensure(index())
    assert len(index().published()) == 80
    assert index().manifest().agg(F.sum("entries")).first()[0] == 5 * len(seqs)
    assert built == [1]
    stats = cat.index_stats(index().manifest()).collect()
    assert {(r.slice_id, r.entries) for r in stats} == {(k, len(seqs)) for k in range(5)}
    again = idx.entries(index(), range(80)).groupBy("slice_id", "bucket_id").agg(F.bit_xor(F.xxhash64("signature", "occurrences", "gg")).alias("d"))
    assert again.join(index().manifest().where("entries > 0"), ["slice_id", "bucket_id"]).where("d <> digest").isEmpty()


def test_two_builders(spark, tmp_path):
    """Both write the same parts; the second to publish gives up those that the first has, and its files of them."""
    seqs = sequences(6, 2000)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs), cat.FIVE_BLOCKS, base=f"file://{tmp_path}", parts=4)
    one = idx.write_build(index, list(range(12)))
    two = idx.write_build(index, list(range(8, 20)))
    assert idx.publish_build(index, *one) == []
    assert idx.publish_build(index, *two) == [8, 9, 10, 11]
    assert index.published() == {p: (one if p < 12 else two)[0] for p in range(20)}
    left = {int(p.name.partition("=")[2]) for p in Path(index.root.removeprefix("file://"), "builds", two[0]).glob("part=*")}
    assert left and left <= set(range(12, 20))
    assert idx.entries(index, range(20)).count() == 5 * len(seqs)
    three = idx.write_build(index, [0, 1])
    assert idx.publish_build(index, *three) == [0, 1]
    guides = near(7, seqs[:40], 4)
    assert pairs(simjoin.offtargets(as_guides(spark, guides), index)) == brute(guides, seqs, 4)


def test_a_number_taken_meanwhile_is_left_alone(spark, tmp_path, monkeypatch):
    """Another builder publishes between the look at the log and the move."""
    seqs = sequences(8, 500)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs), cat.FIVE_BLOCKS, base=f"file://{tmp_path}", parts=1)
    mine, other = idx.write_build(index, [0, 1, 2]), idx.write_build(index, [2, 3])
    move, calls = idx.publish, []

    def publish(spark, source, target):
        calls.append(target)
        if len(calls) == 1:
            assert idx.publish_build(index, *other) == []
        return move(spark, source, target)

    monkeypatch.setattr(idx, "publish", publish)
    assert idx.publish_build(index, *mine) == [2]
    assert index.published() == {0: mine[0], 1: mine[0], 2: other[0], 3: other[0]}


def test_an_empty_source_builds_no_index(spark, tmp_path):
    with pytest.raises(ValueError, match="no site"):
        idx.open_index(spark, "k", lambda: as_sites(spark, []), cat.FIVE_BLOCKS, base=f"file://{tmp_path}")
    with pytest.raises(ValueError, match="missed"):
        idx.open_index(spark, "k", lambda: as_sites(spark, ["A" * 20]), cat.FIVE_BLOCKS, 5, base=f"file://{tmp_path}")


@pytest.mark.parametrize("masks", [cat.FIVE_BLOCKS, cat.PAIRS_OF_SIX])
def test_hot_buckets_have_a_second_level(spark, tmp_path, masks):
    """Half of all sites share a bucket: it becomes the work of many tasks, and no pair is lost."""
    g = random.Random(9)
    hot = sorted({"ACGTACG" + "".join(g.choice("ACGT") for _ in range(13)) for _ in range(1500)})
    seqs = sorted({*hot, *sequences(10, 1500)})
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs), masks, base=f"file://{tmp_path}", parts=4, hot=200)
    guides = near(11, hot[:60] + seqs[:20], 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # a partition is a task, however small
    try:
        idx.ensure(index)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = simjoin.offtargets(as_guides(spark, guides), index)
    assert pairs(got) == brute(guides, seqs, 4)
    second = index.manifest().where("sub <> -1").groupBy("slice_id", "bucket_id").agg(F.count("*").alias("subs"), F.sum("entries").alias("entries"), F.max("entries").alias("most")).collect()
    assert second
    assert max(r.entries for r in second) >= len(hot)
    assert all(r.subs > 20 and r.most < r.entries / 5 for r in second)
    whole = index.manifest().where("sub = -1").agg(F.max("entries")).first()[0]
    assert whole <= 200
    hottest = index.manifest().where("sub <> -1").groupBy("part").agg(F.sum("entries").alias("n")).orderBy(F.desc("n")).first().part
    files = list(Path(index.root.removeprefix("file://")).rglob(f"builds/*/part={hottest}/*.parquet"))
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # written by as many tasks as there are


def test_further_bases_leave_few():
    for masks in (cat.FIVE_BLOCKS, cat.PAIRS_OF_SIX, THREE):
        for m in masks:
            assert not set(idx.further(m)) & set(m)
            assert 20 - len(m) - len(idx.further(m)) <= idx.FREE_BASES


def test_many_guides_are_shuffled_not_broadcast(spark, tmp_path, monkeypatch):
    seqs = sequences(12, 800)
    index = idx.open_index(spark, "k", lambda: as_sites(spark, seqs), cat.FIVE_BLOCKS, base=f"file://{tmp_path}", parts=1)
    guides = near(13, seqs[:50], 4)
    monkeypatch.setattr(idx, "MOST_CELLS", 10)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = simjoin.offtargets(as_guides(spark, guides), index)
        assert pairs(got) == brute(guides, seqs, 4)
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_numbered_catalogue_is_pruned(spark, tmp_path):
    seqs = sequences(14, 4000)
    sites = as_sites(spark, seqs).repartition(6)
    stored = cat.numbered(sites, f"file://{tmp_path}/n")
    assert {r.seq20: r.global_id for r in stored.ids().collect()} == {s: k for k, s in enumerate(seqs)}
    assert stored.count() == len(seqs)
    for first, end in ((0, 1), (0, len(seqs)), (1000, 1500), (1234, 3987), (len(seqs) - 1, len(seqs) + 5), (7, 7), (5000, 6000)):
        assert sorted(r.global_id for r in stored.between(first, end).ids().collect()) == list(range(first, min(end, len(seqs)))), (first, end)
    again = cat.numbered(as_sites(spark, ["A" * 20]), f"file://{tmp_path}/n")
    assert again.count() == len(seqs)
    part = stored.between(1000, 1010)
    part.ids().collect()
    text = part.rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(place" in text
    none = cat.numbered(as_sites(spark, []), f"file://{tmp_path}/e")
    assert none.ids().count() == none.count() == none.between(0, 9).ids().count() == 0


def test_merge_writes_touched_cells_only(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    old = [s for s in sequences(15, 3000) for _ in range(1 + (s[0] == "C"))]
    new = ["ACGTAC" + s[6:] for s in sequences(16, 200)] + ["ACGT" + "A" * 16] * 3 + old[:1] * 5
    merge.store(as_sites(spark, old), path)
    before = merge.cells(spark, path)
    touched = merge.merge_into(spark, path, as_sites(spark, new))
    after = merge.cells(spark, path)
    assert set(touched) == {"ACGT", old[0][:4]}
    assert {c for c in after if after[c] != before.get(c)} == set(touched)
    want = {tuple(r) for r in as_sites(spark, old + new).select("seq20", "signature", "occurrences", "gg").collect()}
    assert {tuple(r) for r in merge.load(spark, path).collect()} == want
    assert merge.merge_into(spark, path, as_sites(spark, [])) == []
    assert merge.load(spark, f"file://{tmp_path}/none").count() == 0


def test_merges_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/c"
    a, b, c = sequences(17, 200), sequences(18, 200), sequences(19, 200)
    merge.store(as_sites(spark, a), path)
    move, calls = merge.publish, []

    def publish(spark, source, target):
        calls.append(target)
        if len(calls) == 1:
            merge.merge_into(spark, path, as_sites(spark, b))
        return move(spark, source, target)

    monkeypatch.setattr(merge, "publish", publish)
    merge.merge_into(spark, path, as_sites(spark, c))
    assert {(r.seq20, r.occurrences) for r in merge.load(spark, path).collect()} == {(r.seq20, r.occurrences) for r in as_sites(spark, a + b + c).collect()}


def test_pam_counters(spark):
    rows = [("A" * 20, True)] * 3 + [("A" * 20, False)] * 2 + [("C" * 20, False)]
    counted = cat.catalogue(spark.createDataFrame(rows, "seq20 string, gg boolean"))
    assert {(r.seq20[0], r.occurrences, r.gg) for r in counted.collect()} == {("A", 5, 3), ("C", 1, 0)}
    guide = as_guides(spark, ["A" * 20])
    met = simjoin.offtargets(guide, counted)
    score = lambda **k: scoring.cfd_scores(met, guide, {}, **k).first().cfd_score
    assert score() == pytest.approx(10000 / (100 + 500))
    assert score(pam_factors={"GG": 1.0, "AG": 0.5}) == pytest.approx(10000 / (100 + 400))


def test_cutting_a_record_is_linear(spark):
    def seconds(n):
        df = spark.range(1).select(F.expr(f"repeat('ACGGTTCA', {n // 8})").alias("seq"))
        began = time.time()
        total = scan.pieces(df, []).agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases")).first()
        took = time.time() - began
        assert total.n == -(-n // scan.PIECE)
        assert total.bases == n + 22 * (total.n - 1)
        return took

    seconds(1 << 20)
    small, large = seconds(10_000_000), seconds(40_000_000)
    assert large < 5
    assert large < 10 * small + 1


def test_guides_leave_the_join_early(spark, tmp_path):
    """The accepted set and its scores are those of complete sums; later rounds meet fewer sites."""
    seqs = sequences(20, 1200)
    crowded = near(21, seqs[:15] * 40, 2)
    sites = sorted({*seqs, *crowded})
    index = idx.open_index(spark, "k", lambda: as_sites(spark, sites), cat.PAIRS_OF_SIX, base=f"file://{tmp_path}", parts=1)
    guides = as_guides(spark, seqs[:60])
    complete = scoring.mit_scores(simjoin.offtargets(guides, index), guides).collect()
    for threshold in (0, 50, 75, 100):
        got = {r.guide_id: r.mit_score for r in bounded.accepted(guides, index, threshold).collect()}
        want = {r.guide_id: r.mit_score for r in complete if r.mit_score >= threshold}
        assert got == pytest.approx(want)
    rejected = [r.guide_id for r in complete if r.mit_score < 75]
    assert 10 <= len(rejected) < 40
    first = simjoin.offtargets(guides, index, slices=range(5)).where("mismatches > 0")
    sums = first.groupBy("guide_id").agg(F.sum(scoring.mit_hit(F.col("guide_sig"), F.col("signature")) * F.col("occurrences")).alias("h"))
    gone = sums.where(F.col("h") > bounded.bound(75)).select("guide_id")
    rest = lambda g: simjoin.candidates(g, index, distance=4, slices=range(5, 15)).count()
    assert rest(guides.join(gone, "guide_id", "left_anti")) < rest(guides) * 0.8
