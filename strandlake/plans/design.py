"""Guide design from jobs and a genome: scan, consensus, off-targets, scores, results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.dna import pack
from strandlake.operators import ontarget, scan, scoring, simjoin
from strandlake.operators.index import Index
from strandlake.session import settle


def guides_with_ids(jobs: DataFrame) -> DataFrame:
    """job_id, target_id, sequence, start, end, strand and guide_sig of every unique guide."""
    return scan.target_ids(scan.unique_guides(scan.guide_sites(jobs))).withColumn("guide_sig", pack(F.col("sequence")))


def with_consensus(guides: DataFrame, folds: DataFrame, weights: Sequence[float], bias: float) -> DataFrame:
    """folds: sequence, shaped, energy; a guide without a fold is not accepted by mm10db."""
    seq = F.col("sequence")
    joined = guides.join(folds, "sequence", "left")
    verdict = ontarget.fold_eligible(seq) & ontarget.fold_verdict(F.col("shaped"), F.col("energy"))
    flags = ontarget.consensus(ontarget.chopchop(seq), ontarget.mm10db(seq, F.coalesce(verdict, F.lit(False))), ontarget.sgrnascorer(seq, weights, bias))
    return joined.withColumn("consensus", flags).drop("shaped", "energy")


def design_guides(jobs: DataFrame, sites: DataFrame | Index, folds: DataFrame, weights: Sequence[float], bias: float, distance: int = 4) -> DataFrame:
    """job_id, target_id, sequence, start, end, strand, consensus, mit_score. sites: a catalogue or a stored index.

    Guides are settled once, as the join and the result both read them, and so are scores, as results may be read again to be sorted. The join sees each distinct guide once, however many jobs ask for it.
    """
    guides, _ = settle(with_consensus(guides_with_ids(jobs), folds, weights, bias), "guides")
    distinct = guides.select("guide_sig").distinct().withColumn("guide_id", F.col("guide_sig"))
    scores, _ = settle(scoring.mit_scores(simjoin.offtargets(distinct, sites, distance), distinct), "scores")
    return guides.join(scores.withColumnRenamed("guide_id", "guide_sig"), "guide_sig").select("job_id", "target_id", "sequence", "start", "end", "strand", "consensus", "mit_score")


def results_by_job(results: DataFrame, job_id) -> DataFrame:
    """Guides of one job by target_id; of stored results, only row groups that can hold the job are read."""
    return results.where(F.col("job_id") == F.lit(job_id)).orderBy("target_id")


def store_results(results: DataFrame, path: str) -> DataFrame:
    """Results written in order of jobs, so that a look-up by job prunes, and read back."""
    results.repartitionByRange("job_id").sortWithinPartitions("job_id", "target_id").write.parquet(path)
    return results.sparkSession.read.parquet(path)


def progress(results: DataFrame) -> DataFrame:
    """Per job: targets, those with a consensus, those with a score; derived, so redelivery cannot count twice."""
    return results.groupBy("job_id").agg(F.count("*").alias("num_guides"), F.count("consensus").alias("num_scored_ontarget"), F.count("mit_score").alias("num_scored_offtarget"))
