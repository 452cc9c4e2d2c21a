"""Rule bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit per
rule; policies are named, versioned bit masks over it, so that a new policy or an ablation never reads
a text again.

Defined results: a null or empty text has no words, all counts 0, and fails FEW_WORDS. A repeated row is
judged like any other. An empty table gives an empty ledger. Columns of the input other than the id and
the text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.text import SPACE, let, table, whole, words

FEW_WORDS, REPEATED_WORDS, SYMBOLS, REPEATED_LINES, WORD_LENGTH = (1 << k for k in range(5))

RULES: dict[str, tuple[int, str]] = {
    "few_words": (FEW_WORDS, "n_words < 50"),
    "repeated_words": (REPEATED_WORDS, "100 * n_repeat_words > 50 * n_words"),
    "symbols": (SYMBOLS, "10 * n_symbols > n_words"),
    "repeated_lines": (REPEATED_LINES, "2 * n_dup_lines > n_lines"),
    "word_length": (WORD_LENGTH, "word_chars < 3 * n_words OR word_chars > 12 * n_words"),
}

#: Versions are never edited, only added.
POLICIES: dict[str, int] = {
    "v1": FEW_WORDS | REPEATED_WORDS,
    "v2": FEW_WORDS | REPEATED_WORDS | SYMBOLS | REPEATED_LINES | WORD_LENGTH,
}


def repeated_window_words(w: Column) -> Column:
    """Words of array w that lie in a window of three that occurs twice or more.

    Windows are hashed; documents whose hashes are all distinct end there. In the others each hash gives
    its low bits to the window's position, so that one sort of longs brings equal windows side by side,
    and neighbours count when their words are equal too.
    """
    windows = F.size(w) - 2
    bits = F.length(F.bin(windows.cast("long")))
    low = F.pow(F.lit(2.0), bits).cast("long") - 1

    def covered(s: Column, mask: Column) -> Column:
        def equal(x: Column, y: Column) -> Column:
            p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            same = x.bitwiseOR(mask) == y.bitwiseOR(mask)
            for k in range(3):
                same = same & (F.get(w, p + k) == F.get(w, q + k))
            return F.coalesce(same, F.lit(False))

        found = F.filter(s, lambda x, i: equal(x, F.get(s, i + 1)) | equal(x, F.get(s, i - 1)))
        places = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask)))
        zero = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n"))
        return F.aggregate(places, zero, step)["n"]

    def of_hashes(h: Column) -> Column:
        placed = lambda m: F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(m)).bitwiseOR(i.cast("long"))))
        exact = let(low, lambda m: let(placed(m), lambda s: covered(s, m)))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact)

    hashes = F.transform(F.sequence(F.lit(0), windows - 1), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(windows < 2, F.lit(0).cast("long")).otherwise(let(hashes, of_hashes))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, measurements, fail_bits. One scan, no shuffle."""
    return judged(docs, F.col(id_col), text_col).select(id_col, *MEASURES, "fail_bits")


def accepted(docs: DataFrame, policy: str, text_col: str = "text") -> DataFrame:
    """The rows of docs, unchanged, that the policy accepts."""
    return judged(docs, F.struct("*").alias("__row"), text_col).where(passes(policy)).select("__row.*")


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def judged(docs: DataFrame, carried: Column, text_col: str) -> DataFrame:
    text = whole(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_window_words(w).alias("n_repeat_words"),
        )

    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    out = docs.select(carried, let(words(text), measured).alias("__m"), by_line.alias("__l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"))
    out = out.select(out.columns[0], "__m.n_words", "__m.word_chars", "n_symbols", "__l.n_lines", "__l.n_dup_lines", "__m.n_repeat_words")
    bits = [F.when(F.expr(rule), F.lit(bit)).otherwise(0) for bit, rule in RULES.values()]
    return out.withColumn("fail_bits", sum(bits[1:], bits[0]))


def passes(policy: str, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(POLICIES[policy]) == 0


def ablation(rules_ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: failed (documents that fail it), only (that fail no other rule of the
    policy: what leaving the rule out would bring back), never (share of no failure: 0 or 1).

    The ledger is first counted per distinct bit pattern, at most 2 ** rules rows.
    """
    mask = POLICIES[policy]
    patterns = rules_ledger.groupBy(F.col("fail_bits").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))
    used = [(name, bit) for name, (bit, _) in RULES.items() if bit & mask]
    count = [F.struct(F.lit(name).alias("rule"), F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, F.col("n"))), F.lit(0)).alias("failed"), F.coalesce(F.sum(F.when(F.col("bits") == bit, F.col("n"))), F.lit(0)).alias("only"), (F.coalesce(F.bit_or("bits"), F.lit(0)).bitwiseAND(bit) == 0).alias("never")) for name, bit in used]
    return patterns.agg(F.array(*count).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledger(table(spark, sf_dir, "documents"))
    base = F.col("fail_bits").bitwiseAND(POLICIES["v1"]) != 0
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), passes("v2").alias("kept"), "fail_bits", "n_lines")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the newest policy rejects, and what leaving it out would bring back."""
    return ablation(ledger(table(spark, sf_dir, "documents")), "v2")


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM spot),
rep AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n > 1) GROUP BY 1),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
 (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
 [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
l AS (SELECT *, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM m),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
 + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END + CASE WHEN word_chars < 3 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END)::INTEGER AS fail_bits FROM l)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, n_lines FROM b
"""
ABLATION_SQL = (
    "WITH op AS (" + OP1_SQL + ") SELECT rule, count(*) FILTER (WHERE fail_bits & bit <> 0) AS failed, count(*) FILTER (WHERE fail_bits = bit) AS \"only\", count(*) FILTER (WHERE fail_bits & bit <> 0) = 0 AS never FROM op, (VALUES "
    + ", ".join(f"('{name}', {bit})" for name, (bit, _) in RULES.items())
    + ") AS r(rule, bit) GROUP BY rule"
)
