"""Guide sites and off-target sites of sequences, on both strands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.functions.dna import revcomp

LENGTH = 23
#: A guide site is 21 bases and GG, or its reverse complement; an off-target site does not
#: begin with T and ends in AG or GG.
FORWARD, REVERSE = "[ACGT]{21}GG", "CC[ACGT]{21}"
OFF_FORWARD, OFF_REVERSE = "[ACG][ACGT]{19}[ACGT][AG]G", "C[CT][ACGT][ACGT]{19}[TGC]"
CHUNK = 512
#: Bases of a piece of a sequence; pieces are dealt over tasks.
PIECE = 1 << 16


def pieces(sequences: DataFrame, carried: list[str], length: int = LENGTH, bases: int = PIECE) -> DataFrame:
    """carried columns, at (0-based), seq: sequences in pieces that reach `length` - 1 bases into the next, dealt over
    all cores (or spark.sql.shuffle.partitions, if that is more), so that one chromosome is the work of many tasks.
    A record is cut in one pass; files with records that no row should hold come in pieces (read_fasta_pieces)."""
    spark = sequences.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own, next_bases = (F.regexp_extract_all("seq", F.lit(f"(?s)(.{{1,{bases}}})(?=(.{{0,{length - 1}}}))"), F.lit(g)) for g in (1, 2))
    cut = sequences.select(*carried, F.posexplode(F.arrays_zip(own.alias("own"), next_bases.alias("next"))).alias("__k", "__p"))
    return cut.select(*carried, (F.col("__k") * bases).alias("at"), F.concat("__p.own", "__p.next").alias("seq")).repartition(n)


def matches(sequences: DataFrame, pattern: str, carried: list[str], length: int = LENGTH) -> DataFrame:
    """carried columns, start (0-based) and site of every match of pattern, overlapping ones too.

    Sequences are cut into chunks that reach `length` - 1 bases into the next, so the work is linear in the
    bases. Splitting a chunk before every match gives the positions. Long records go through pieces() first.
    """
    chunks = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    cut = sequences.select(*carried, chunks.alias("__c")).select(*carried, F.posexplode(F.expr(f"transform(__c, (c, i) -> concat(c, coalesce(substring(get(__c, i + 1), 1, {length - 1}), '')))")).alias("__n", "__t"))
    hit = cut.where(F.col("__t").rlike(pattern)).select(*carried, "__n", "__t", F.split("__t", f"(?={pattern})").alias("__p"))
    starts = F.expr("transform(sequence(0, size(__p) - 1), i -> aggregate(slice(__p, 1, i), 0, (n, p) -> n + length(p)))")
    at = hit.select(*carried, "__n", "__t", F.explode(starts).alias("__s")).where((F.col("__s") < CHUNK) & ((F.col("__s") > 0) | F.col("__t").rlike("^" + pattern)))
    return at.select(*carried, (F.col("__n") * CHUNK + F.col("__s")).alias("start"), F.expr(f"substring(__t, __s + 1, {length})").alias("site"))


def guide_sites(jobs: DataFrame, strands: str = "+-", upper: bool = False, long_records: bool = False) -> DataFrame:
    """(job_id, seq) -> job_id, start, end, strand, sequence (oriented), positions on the forward string.

    Requests are short (20,000 bases at most) and stay in their tasks; long_records deals pieces of them."""
    seq = F.upper("seq") if upper else F.col("seq")
    jobs = jobs.select("job_id", seq.alias("seq"))
    if long_records:
        return sites_of_pieces(pieces(jobs, ["job_id"]), strands)
    found = []
    if "+" in strands:
        found.append(matches(jobs, FORWARD, ["job_id"]).select("job_id", "start", F.lit("+").alias("strand"), F.col("site").alias("sequence")))
    if "-" in strands:
        found.append(matches(jobs, REVERSE, ["job_id"]).select("job_id", "start", F.lit("-").alias("strand"), revcomp(F.col("site")).alias("sequence")))
    out = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return out.select("job_id", F.col("start").cast("int").alias("start"), (F.col("start") + LENGTH).cast("int").alias("end"), "strand", "sequence")


def sites_of_pieces(cut: DataFrame, strands: str = "+-") -> DataFrame:
    """The same of pieces (job_id, at, seq); job_id may be a struct. Overlaps are shorter than a site, so none comes twice."""
    found = guide_sites(cut.select(F.struct("job_id", "at").alias("job_id"), "seq"), strands)
    start = F.col("job_id.at") + F.col("start")
    return found.select("job_id.job_id", start.alias("start"), (start + LENGTH).alias("end"), "strand", "sequence")


def unique_guides(sites: DataFrame) -> DataFrame:
    """Sites whose oriented sequence occurs once in the job, on either strand, with count = 1."""
    one = sites.groupBy("job_id", "sequence").agg(F.count("*").alias("count"), F.min("start").alias("start"), F.min("end").alias("end"), F.min("strand").alias("strand"))
    return one.where("count = 1").select("job_id", "sequence", "count", "start", "end", "strand")


def target_ids(guides: DataFrame) -> DataFrame:
    """Dense target_id from 0 in each job: forward strand first, then by start."""
    order = Window.partitionBy("job_id").orderBy(F.when(F.col("strand") == "+", 0).otherwise(1), "start")
    return guides.withColumn("target_id", F.row_number().over(order) - 1)


def offtarget_sites(sequences: DataFrame, strands: str = "+-", reverse_mode: str = "literal") -> DataFrame:
    """seq20 of every off-target site and gg (whether its PAM ends in GG, not AG), repeats kept, from pieces dealt over
    tasks. No positions, so one pass of look-ahead matching; a piece overlaps the next by less than a site, so no site
    comes up twice.

    On the reverse strand, literal takes the first 20 bases of the match before complementing; protospacer
    complements the match first.
    """
    seq = F.upper("seq")
    every = lambda p: F.regexp_extract_all(seq, F.lit(f"(?=({p}))"), F.lit(1))
    found = []
    if "+" in strands:
        found.append(F.transform(every(OFF_FORWARD), lambda m: F.struct(F.substring(m, 1, 20).alias("seq20"), (F.substring(m, 22, 1) == "G").alias("gg"))))
    if "-" in strands:
        oriented = lambda m: revcomp(F.substring(m, 1, 20)) if reverse_mode == "literal" else F.substring(revcomp(m), 1, 20)
        found.append(F.transform(every(OFF_REVERSE), lambda m: F.struct(oriented(m).alias("seq20"), (F.substring(m, 2, 1) == "C").alias("gg"))))
    cut = sequences if "at" in sequences.columns else pieces(sequences, [])
    return cut.select(F.explode(F.concat(*found)).alias("s")).select("s.seq20", "s.gg")
