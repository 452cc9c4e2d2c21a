"""DNA expressions: native columns, and the same as temporary SQL functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: IUPAC complements in both cases; letters that are not listed stand for themselves.
COMPLEMENT_FROM, COMPLEMENT_TO = "acgtrymkbdhvACGTRYMKBDHV", "tgcayrkmvhdbTGCAYRKMVHDB"
BASES = "ACGT"
#: One-hot codes of the IUPAC letters, A lowest.
ONE_HOT = {"A": 1, "C": 2, "T": 4, "G": 8, "M": 3, "R": 9, "W": 5, "S": 10, "Y": 6, "K": 12, "V": 11, "H": 7, "D": 13, "B": 14, "N": 15}
SITE = 20
#: Low bit of each of 20 two-bit bases.
LOW_BITS = sum(1 << 2 * k for k in range(SITE))


def revcomp(s: Column) -> Column:
    return F.reverse(F.translate(s, COMPLEMENT_FROM, COMPLEMENT_TO))


def u_to_t(s: Column) -> Column:
    return F.translate(s, "U", "T")


def pack(s: Column) -> Column:
    """Signature of a 20-base site: base k in bits 2k and 2k + 1, A C G T as 0 1 2 3; of the first 20 letters; null if they are not ACGT.

    The letters become digits of base 4, last base first, which one conversion reads."""
    digits = F.reverse(F.translate(F.substring(s, 1, SITE), BASES, "0123"))
    return F.when(s.rlike(f"^[{BASES}]{{{SITE}}}"), F.conv(digits, 4, 10).cast("long"))


def bucket(signature: Column, mask: Sequence[int]) -> Column:
    """The bases at the mask's positions (ascending), packed; neighbouring positions move together."""
    out, j = None, 0
    runs: list[list[int]] = []
    for p in mask:
        if runs and runs[-1][-1] == p - 1:
            runs[-1].append(p)
        else:
            runs.append([p])
    for run in runs:
        part = F.shiftleft(F.shiftrightunsigned(signature, 2 * run[0]).bitwiseAND(F.lit((1 << 2 * len(run)) - 1).cast("long")), 2 * j)
        out = part if out is None else out.bitwiseOR(part)
        j += len(run)
    return out


def hamming(a: Column, b: Column) -> Column:
    """Bases in which two signatures differ."""
    x = a.bitwiseXOR(b)
    return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(LOW_BITS).cast("long")))


def one_hot(s: Column, n: int = SITE) -> Column:
    """4 n zeros and ones for the first n letters, each four as in ONE_HOT, high bit first; an unknown letter gives null fours."""
    table = F.create_map(*[F.lit(v) for kv in ONE_HOT.items() for v in kv])
    fours = F.transform(F.filter(F.split(F.substring(s, 1, n), ""), lambda c: c != ""), lambda c: F.element_at(table, c))
    return F.flatten(F.transform(fours, lambda v: F.array(*[F.shiftright(v, k).bitwiseAND(1) for k in (3, 2, 1, 0)])))


def at_count(s: Column) -> Column:
    return F.length(s) - F.length(F.regexp_replace(s, "[AT]", ""))


def register(spark: SparkSession) -> None:
    """revcomp, dna_pack, dna_bucket and dna_hamming as SQL functions that Catalyst inlines."""
    for body in (
        f"revcomp(s STRING) RETURNS STRING RETURN reverse(translate(s, '{COMPLEMENT_FROM}', '{COMPLEMENT_TO}'))",
        f"dna_pack(s STRING) RETURNS BIGINT RETURN CASE WHEN s RLIKE '^[ACGT]{{20}}' THEN CAST(conv(reverse(translate(substring(s, 1, 20), 'ACGT', '0123')), 4, 10) AS BIGINT) END",
        "dna_bucket(sig BIGINT, first INT, width INT) RETURNS BIGINT RETURN shiftrightunsigned(sig, 2 * first) & (shiftleft(1L, 2 * width) - 1)",
        f"dna_hamming(a BIGINT, b BIGINT) RETURNS INT RETURN bit_count(((a ^ b) | shiftrightunsigned(a ^ b, 1)) & {LOW_BITS}L)",
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
