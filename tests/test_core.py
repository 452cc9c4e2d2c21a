"""Guide design: hand values, properties, streaming, and every query against DuckDB."""

from __future__ import annotations

import gzip
import json
import random
from pathlib import Path

import pytest
from conftest import canonical
from pyspark.sql import functions as F

from strandlake import queries
from strandlake.functions import dna
from strandlake.operators import catalogue as cat
from strandlake.operators import ontarget, scan, scoring, simjoin
from strandlake.plans import ranges
from strandlake.sources import fasta, requests
from strandlake.streaming import commits

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = "ATCGATCGATCGATCGATCGAGGATCGATCGATCGATCGATCGTGGCCAATCGATCGATCGATCGATCG"
#: A query of 245 bases that holds 100 guides (a fixed value).
HUNDRED = "CGGGGGCGGCGGGCGGTGTGGGGGGGCAGCCCAGGTCGGGGGGCGGGGGGGCCGGGGGCCAGAGCCGGGGGGGTGGGCGGAGGTGGACGCGCGGCGGGCGGGGCGGAGCGGCGGGGGGCCGAGGGGGCGAGGGCGGGCGCGGGGAGGGCCAGCGCGGCCCGGGGGGGGCGCGCGCCGGCGTGGGGGGGCCGGCGCGCGGGCGGCCGCCGAGCGGGGGTGCGCGTACGCGGAGAGCCGGGGCGGGG"


def jobs(spark, *seqs):
    return spark.createDataFrame(list(enumerate(seqs)), "job_id long, seq string")


def guides(spark, seq, **kw):
    out = scan.target_ids(scan.unique_guides(scan.guide_sites(jobs(spark, seq), **kw)))
    return [tuple(r) for r in out.orderBy("target_id").select("start", "end", "strand", "sequence").collect()]


def test_sample_guides(spark):
    assert guides(spark, SAMPLE) == [(0, 23, "+", "ATCGATCGATCGATCGATCGAGG"), (23, 46, "+", "ATCGATCGATCGATCGATCGTGG"), (46, 69, "-", "CGATCGATCGATCGATCGATTGG")]
    assert guides(spark, SAMPLE.lower()) == []
    assert len(guides(spark, SAMPLE.lower(), upper=True)) == 3


def test_hundred_guides(spark):
    assert len(HUNDRED) == 245
    assert len(guides(spark, HUNDRED)) == 100


def test_edges_of_scan(spark):
    assert guides(spark, "A" * 20 + "GG") == []
    twice = "ACGTACGTACGTACGTACGTAGG"
    assert guides(spark, twice + "TTT" + twice) == []
    both = twice + "TTT" + twice.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert all(g[3] != twice for g in guides(spark, both))
    assert guides(spark, "") == []


def brute_sites(seq):
    out = []
    for i in range(len(seq) - 22):
        w = seq[i : i + 23]
        if set(w) <= set("ACGT"):
            if w[21:] == "GG":
                out.append((i, "+", w))
            if w[:2] == "CC":
                out.append((i, "-", w.translate(str.maketrans("ACGT", "TGCA"))[::-1]))
    return sorted(out)


def test_chunks_join_up(spark):
    r = random.Random(3)
    seq = "".join(r.choice("ACGTGGCCN") for _ in range(5000))
    got = sorted((x.start, x.strand, x.sequence) for x in scan.guide_sites(jobs(spark, seq)).collect())
    assert got == brute_sites(seq)


def test_scalars(spark):
    row = spark.createDataFrame([("ACGTrymkbdhvSWN", "ACGTACGTACGTACGTACGTAGG", "TCGTACGTACGTACGTACGAAGG")], "a string, b string, c string").select(
        dna.revcomp(F.col("a")), dna.pack(F.col("b")), dna.hamming(dna.pack(F.col("b")), dna.pack(F.col("c"))), dna.bucket(dna.pack(F.col("b")), (0, 1, 5)), dna.one_hot(F.lit("ACTGN"), 5), dna.pack(F.lit("ACGN" * 5)), dna.u_to_t(F.lit("AUGU")),
    ).first()
    assert row[0] == "NWSbdhvmkryACGT"
    assert row[1] == sum("ACGT".index(b) << 2 * k for k, b in enumerate("ACGTACGTACGTACGTACGT"))
    assert row[2] == 2
    assert row[3] == 0 | 1 << 2 | 1 << 4
    assert row[4] == [0, 0, 0, 1, 0, 0, 1, 0, 0, 1, 0, 0, 1, 0, 0, 0, 1, 1, 1, 1]
    assert row[5] is None
    assert row[6] == "ATGT"


def test_sql_functions(spark):
    dna.register(spark)
    seq = "ACGTACGTACGTACGTACGT"
    got = spark.sql(f"SELECT revcomp('AAC'), dna_pack('{seq}'), dna_bucket(dna_pack('{seq}'), 4, 4), dna_hamming(dna_pack('{seq}'), dna_pack('T{seq[1:]}'))").first()
    assert got[0] == "GTT"
    assert got[2] == 0b11100100
    assert got[3] == 1


def test_mask_coverage():
    cat.check_coverage(cat.FIVE_BLOCKS, 4)
    cat.check_coverage(cat.PAIRS_OF_SIX, 4)
    with pytest.raises(ValueError):
        cat.check_coverage(cat.FIVE_BLOCKS, 5)


@pytest.mark.parametrize("distance", range(5))
def test_join_finds_what_comparing_all_finds(spark, distance):
    r = random.Random(distance)
    guide = ["".join(r.choice("ACGT") for _ in range(20)) for _ in range(30)]
    sites = set(guide[:5])
    for g in guide:
        for _ in range(30):
            s = list(g)
            for p in r.sample(range(20), r.randint(0, 6)):
                s[p] = r.choice("ACGT")
            sites.add("".join(s))
    expected = {(g, s) for g in guide for s in sites if sum(a != b for a, b in zip(g, s, strict=True)) <= distance}
    g = spark.createDataFrame([(x,) for x in guide], "seq string").select(F.col("seq").alias("guide_id"), dna.pack(F.col("seq")).alias("guide_sig"))
    s = cat.catalogue(spark.createDataFrame([(x,) for x in sites], "seq20 string")).withColumn("global_id", F.col("seq20"))
    for masks in (cat.FIVE_BLOCKS, cat.PAIRS_OF_SIX):
        rows = simjoin.offtargets(g, s, distance, masks).collect()
        assert len(rows) == len(expected)
        assert {(x.guide_id, x.global_id) for x in rows} == expected
        assert {(x.guide_id, x.global_id) for x in simjoin.offtargets_by_distinct(g, s, distance, masks).collect()} == expected


def mit(guide, site):
    wrong = [p for p in range(20) if guide[p] != site[p]]
    if not wrong:
        return 1.0
    score = 1.0
    for p in wrong:
        score *= 1 - scoring.MIT_WEIGHTS[p]
    if len(wrong) > 1:
        d = (wrong[-1] - wrong[0]) / (len(wrong) - 1)
        score /= (19 - d) / 19 * 4 + 1
    return score / len(wrong) ** 2


def test_mit_against_plain_python(spark):
    r = random.Random(9)
    pairs = []
    for _ in range(200):
        g = "".join(r.choice("ACGT") for _ in range(20))
        s = list(g)
        for p in r.sample(range(20), r.randint(0, 4)):
            s[p] = r.choice("ACGT")
        pairs.append((g, "".join(s)))
    df = spark.createDataFrame(pairs, "g string, s string")
    for row in df.select("g", "s", scoring.mit_hit(dna.pack(F.col("g")), dna.pack(F.col("s"))).alias("v")).collect():
        assert row.v == pytest.approx(mit(row.g, row.s), abs=1e-12)


def test_reverse_modes_and_overflow(spark):
    m = "CT" + "ACGTACGTACGTACGTACGT" + "C"
    rc = lambda x: x.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    df = spark.createDataFrame([(m,)], "seq string")
    assert [tuple(r) for r in scan.offtarget_sites(df, "-").collect()] == [(rc(m[:20]), False)]
    assert [tuple(r) for r in scan.offtarget_sites(df, "-", "protospacer").collect()] == [(rc(m)[:20], False)]
    pams = spark.createDataFrame([("A" * 20 + "TGG",), ("A" * 20 + "CAG",), ("CCG" + "ACGT" * 5,), ("ACGT" * 5 + "AAC",)], "seq string")
    assert sorted(r.gg for r in scan.offtarget_sites(pams).collect()) == [False, True, True]
    many = spark.createDataFrame([("A" + "C" * 19,)] * 300 + [("G" * 20,)], "seq20 string")
    assert {r.seq20: r.occurrences for r in cat.catalogue(many).collect()} == {"A" + "C" * 19: 300, "G" * 20: 1}


def test_fasta(spark, tmp_path):
    text = "acgt\n\n>one first\nacg\ntt\n\n>two\n>three\nGG\n"
    (tmp_path / "a.fa").write_text(text)
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">x\nACGT\r\nac\r\n")
    for reader in (fasta.read_fasta, fasta.read_fasta_lines):
        rows = {(r.file.rpartition("/")[2], r.header.rpartition("/")[2], r.seq) for r in reader(spark, f"file://{tmp_path}/*.fa*").collect()}
        assert rows == {("a.fa", "a.fa", "ACGT"), ("a.fa", "one first", "ACGTT"), ("a.fa", "two", ""), ("a.fa", "three", "GG"), ("b.fa.gz", "x", "ACGTAC")}


def test_fasta_pieces_of_files_in_many_splits(spark, tmp_path):
    g = random.Random(6)
    dna_of = lambda n: "".join(g.choice("ACGT") for _ in range(n))
    records = [dna_of(n) for n in (5, 0, 3000, 17, 9000, 1, 400)]
    text = "ac\n" + "".join(f">r{k}\n" + "".join(r[i : i + 61] + "\n" for i in range(0, len(r), 61)) for k, r in enumerate(records))
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "b.fa").write_text(">long\n" + records[4])
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    try:
        pieces, headers = fasta.read_fasta_pieces(spark, f"file://{tmp_path}/*.fa", bases=256, overlap=22)
        rows = {(r.file[-4:], r.record, r["at"]): r.seq for r in pieces.collect()}
        heads = {(r.file[-4:], r.record): r.header for r in headers.collect()}
        lines = {(r.file[-4:], r.record): r.seq for r in fasta.read_fasta_lines(spark, f"file://{tmp_path}/*.fa").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    want = {("a.fa", k + 1): r for k, r in enumerate(records)} | {("b.fa", 1): records[4], ("a.fa", 0): "AC"}
    assert lines == want
    assert heads == {("a.fa", k + 1): f"r{k}" for k in range(7)} | {("b.fa", 1): "long"}
    assert rows == {(*key, at): r[at : at + 278] for key, r in want.items() for at in range(0, len(r), 256)}


def test_one_long_record_is_the_work_of_many_tasks(spark):
    g = random.Random(4)
    seq = "".join(g.choice("ACGT") for _ in range(400_000))
    one = spark.createDataFrame([(1, seq)], "job_id long, seq string").coalesce(1)
    got = scan.guide_sites(one, long_records=True)
    tasks = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism
    plain = scan.guide_sites(one)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    sites = scan.offtarget_sites(one)
    assert sites.withColumn("p", F.spark_partition_id()).select("p").distinct().count() >= spark.sparkContext.defaultParallelism
    want = sum(seq[i] != "T" and seq[i + 21 : i + 23] in ("AG", "GG") for i in range(len(seq) - 22)) + sum(seq[i : i + 2] in ("CC", "CT") and seq[i + 22] != "A" for i in range(len(seq) - 22))
    assert sites.count() == want


def test_messages_sources_and_quarantine(spark, tmp_path):
    message = lambda g, **k: json.dumps({"default": json.dumps(k), "genome": json.dumps(g)})
    rows = [(1, message("g", JobID="j", TargetID=2, Sequence="A")), (2, message("g", JobID="j", TargetID=2)), (3, "no"), (4, None), (5, json.dumps({"default": "{", "genome": '"g"'}))]
    assert [tuple(r) for r in requests.guide_messages(spark.createDataFrame(rows, "k long, body string")).collect()] == [(1, "j", 2, "A", "g")]
    twice = json.dumps(json.dumps({"sequence": "AC", "genome": "a \"b\""}))
    got = requests.normalize(spark.createDataFrame([(1, twice)], "job_id long, body string")).first()
    assert (got.sequence, got.genome, got.error) == ("AC", 'a "b"', None)
    files = spark.createDataFrame([("a", ">x ACGT\n\n"), ("b", ">x\nAC\nG"), ("c", None)], "file string, value string")
    assert [(r.n_bases, r.error) for r in fasta.usable(files).orderBy("file").collect()] == [(0, "empty"), (3, None), (0, "empty")]
    with pytest.raises(ValueError):
        fasta.check_usable(files.where("file <> 'b'"))
    path, guard, aside = (f"file://{tmp_path}/{n}" for n in ("rows", "guard", "aside"))
    batch = spark.createDataFrame([(1, "x", 5.0), (2, "y", 7.0)], "job_id long, batch_id string, score double")
    commits.commit_batch(batch, path, guard, quarantine=aside)
    commits.commit_batch(spark.createDataFrame([(1, "x", 6.0), (3, "z", 8.0)], batch.schema), path, guard, quarantine=aside)
    assert {(r.job_id, r.score) for r in spark.read.parquet(path).collect()} == {(1, 5.0), (2, 7.0), (3, 8.0)}
    assert [(r.job_id, r.score, r.reason) for r in spark.read.parquet(aside).collect()] == [(1, 6.0, "other_contents")]


def test_folds(spark):
    free = "." * 28 + "((((....))))...))))" + "." * 21 + "((((....))))(((((((...)))))))..."
    assert len(ontarget.SCAFFOLD) == 80
    rows = spark.createDataFrame([(free + " (-20.00)", True), (free.replace("...))))", "......."), False), (None, False)], "line string, want boolean")
    assert all(r[0] == r[1] for r in rows.select(ontarget.free_guide(F.col("line")), "want").collect())


def test_requests(spark):
    body = lambda **k: json.dumps(k)
    rows = [(1, body(sequence="AC GT\r\n", genome="g")), (2, body(genome="g")), (3, body(sequence="A")), (4, body(sequence=" ", genome="g")), (5, body(sequence="A" * 30, genome="g")), (6, "no json"), (7, None)]
    got = {r.job_id: (r.sequence, r.error) for r in requests.normalize(spark.createDataFrame(rows, "job_id long, body string"), 20).collect()}
    assert got[1] == ("ACGT", None)
    assert [got[k][1] for k in range(2, 8)] == ["missing_sequence", "missing_genome", "empty", "too_long", "missing_sequence", "missing_sequence"]


def test_on_target_rules(spark):
    rows = [(True, -35.0, False), (True, -30.0, True), (False, -18.0, False), (False, -17.9, True), (False, None, False), (True, None, False)]
    df = spark.createDataFrame([r[:2] for r in rows], "shaped boolean, energy double")
    assert [r[0] for r in df.select(ontarget.fold_verdict(F.col("shaped"), F.col("energy"))).collect()] == [r[2] for r in rows]
    vectors, coefs = [[1.0] * 80, [0.5, 0.25] * 40], [0.5, -1.0]
    assert ontarget.svm_weights(vectors, coefs) == [0.0, 0.25] * 40
    folded = ontarget.fold_with(spark.createDataFrame([("C" * 23,), ("T" + "A" * 20 + "GG",)], "sequence string"), lambda xs: [("." * len(x), -1.0) for x in xs], "UUUU").collect()
    assert [(r.sequence, len(r.structure)) for r in folded] == [("C" * 23, 24)]
    flags = spark.createDataFrame([("1,0,1", 80.0, True), ("1,0,0", 99.0, False), ("1,1,1", 74.9, False)], "f string, s double, e boolean")
    assert all(r[0] == r[1] for r in flags.select(ontarget.recommended(F.col("f"), F.col("s")), "e").collect())


def test_merged_ranges(spark):
    rows = [("a", 0, 10), ("a", 12, 20), ("a", 30, 40), ("a", 41, 60), ("b", 5, 5)]
    got = {tuple(r) for r in ranges.merged_ranges(spark.createDataFrame(rows, "f string, start_byte long, end_byte long"), "f", gap=2, most=29).collect()}
    assert got == {("a", 0, 20, 2), ("a", 30, 40, 1), ("a", 41, 60, 1), ("b", 5, 5, 1)}
    with pytest.raises(Exception, match="overlapping"):
        ranges.merged_ranges(spark.createDataFrame([("a", 0, 10), ("a", 9, 20)], "f string, start_byte long, end_byte long"), "f").collect()


def test_score_violations(spark):
    rows = [(1, 50.0), (2, -1.0), (3, -0.5), (4, 100.5), (5, float("nan")), (6, float("inf")), (7, None)]
    assert {r[0] for r in scoring.violations(spark.createDataFrame(rows, "k long, v double"), ["v"]).collect()} == {3, 4, 5, 6, 7}


def test_commits_are_idempotent(spark, tmp_path):
    path, guard = f"file://{tmp_path}/rows", f"file://{tmp_path}/guard"
    batch = spark.createDataFrame([(1, "x", 0, 5.0), (1, "x", 1, 6.0), (2, "y", 0, 7.0)], "job_id long, batch_id string, target_id int, score double")
    for _ in range(2):
        commits.commit_batch(batch, path, guard)
        assert spark.read.parquet(path).count() == 3
        assert spark.read.parquet(guard).count() == 2
    with pytest.raises(ValueError):
        commits.commit_batch(batch.withColumn("score", F.lit(1.0)), path, guard)
    assert spark.read.parquet(path).agg(F.sum("score")).first()[0] == 18.0


def test_stream_of_jobs(spark, tmp_path):
    inbox = Path(tmp_path, "in")
    inbox.mkdir()
    (inbox / "1.json").write_text(json.dumps({"job_id": "1", "sequence": SAMPLE, "genome": "g"}) + "\n")

    def design(batch):
        sites = scan.guide_sites(batch.select("job_id", F.col("sequence").alias("seq")))
        return scan.target_ids(scan.unique_guides(sites)).withColumn("batch_id", F.lit("b"))

    for _ in range(2):
        q = commits.stream_commits(commits.stream_jobs(spark, f"file://{inbox}"), f"file://{tmp_path}/rows", f"file://{tmp_path}/guard", f"file://{tmp_path}/check", design)
        q.awaitTermination()
        assert spark.read.parquet(f"file://{tmp_path}/rows").count() == 3


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not Path(SF).exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        p = Path(SF, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    rows = got.collect()
    if name not in queries.ORACLE_SQL:
        assert rows
        return
    result = duck.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(rows, got.columns) == canonical(result.fetchall(), columns)
