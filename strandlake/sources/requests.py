"""Job requests: JSON bodies of a query sequence and the name of a genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SEQ_LENGTH = 20_000
#: What the request form admits, and how public assemblies are named.
SEQUENCE = "^[ATCGatcg]+$"
GENOME = "^G[A-Z]{2}_[0-9]{9}.[0-9]+"
ACCESSION = r"^(GCA|GCF)_\d{9}\.\d+$"


def decoded(body: Column) -> Column:
    """A JSON text; where it is a string, the JSON text within."""
    return F.when(F.trim(body).startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), body, F.lit("}")), "$.v")).otherwise(body)


def guide_messages(bodies: DataFrame) -> DataFrame:
    """body -> job_id, target_id, sequence, genome and the other columns, of messages {"default": JSON of a guide,
    "genome": JSON of a name}; those that are no JSON or lack JobID, TargetID or Sequence go."""
    rest = [c for c in bodies.columns if c != "body"]
    outer = bodies.select(*rest, F.from_json("body", "`default` string, genome string").alias("m"))
    guide = F.from_json("m.default", "JobID string, TargetID long, Sequence string")
    inner = outer.select(*rest, guide.alias("g"), decoded(F.col("m.genome")).alias("genome"))
    return inner.select(*rest, F.col("g.JobID").alias("job_id"), F.col("g.TargetID").alias("target_id"), F.col("g.Sequence").alias("sequence"), "genome").dropna(subset=["job_id", "target_id", "sequence", "genome"])


MARKER = r"^(.+)/mapper/([^/]+)/batches/([^/]+)/mapper-result\.json$"


def marker_parts(paths: DataFrame) -> DataFrame:
    """path (URL-encoded) -> genome, job_id, batch_id and the other columns, of marker paths only."""
    rest = [c for c in paths.columns if c != "path"]
    rows = paths.select(*rest, F.url_decode("path").alias("p")).where(F.col("p").rlike(MARKER))
    return rows.select(*rest, *(F.regexp_extract("p", MARKER, i).alias(n) for i, n in enumerate(("genome", "job_id", "batch_id"), 1)))


def normalize(bodies: DataFrame, max_length: int = MAX_SEQ_LENGTH, upper: bool = False) -> DataFrame:
    """(job_id, body) -> job_id, sequence, genome, error: null, missing_sequence, missing_genome, empty or too_long.
    A body that was encoded twice (a JSON string that holds the object) is read as well."""
    parsed = bodies.select("job_id", F.from_json(decoded(F.col("body")), "sequence string, genome string").alias("b"))
    cleaned = F.translate("b.sequence", "\r\n ", "")
    cleaned = F.upper(cleaned) if upper else cleaned
    error = F.when(F.col("b.sequence").isNull(), "missing_sequence").when(F.col("b.genome").isNull(), "missing_genome").when(F.length(cleaned) == 0, "empty").when(F.length(cleaned) > max_length, "too_long")
    return parsed.select("job_id", cleaned.alias("sequence"), F.col("b.genome").alias("genome"), error.alias("error"))


def valid(sequence: Column, genome: Column) -> Column:
    return sequence.rlike(SEQUENCE) & genome.rlike(GENOME)


def custom_datasets(paths: DataFrame) -> DataFrame:
    """Distinct top-level folders that are no public assembly."""
    top = F.substring_index("path", "/", 1)
    return paths.select(top.alias("dataset")).distinct().where(~F.col("dataset").rlike(ACCESSION) & (F.col("dataset") != "Test_Packages"))


def accession_path(accession: Column) -> Column:
    """GCA_000001405.15 -> GCA/000/001/405."""
    return F.concat_ws("/", *(F.substring(accession, start, 3) for start in (1, 5, 8, 11)))
