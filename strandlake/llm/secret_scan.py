"""Secret scans: three patterns, and a battery of randomness tests for strings that no pattern names.

Base spans, leftmost and non-overlapping for each kind: assign (a key word, = or :, a value of 12 characters
or more), access (AKIA and what follows, 18 or more), hex (16 or more). Every other string of 20 or more
letters, digits and - _ + / (= at the end only) with letters and digits is a candidate; one with signs of both
base64 and base64url is cut at those of each kind instead, and its parts are tested: the encoding is inferred (hex, base32,
base36, base64), and three tests ask whether it is random over that alphabet: chi-squared uniformity, runs
above and below the middle, lag-1 serial correlation. A string that any of them rejects at 0.001 / 3 is not
random.

A second p-value asks how likely ordinary text of that length, written as an identifier, would look so random: by its
chi-squared, which grows with the length, and by its runs of one class of characters (lower, upper, digit, sign), so
the test gains power with the length. What is ordinary stands in PRIOR, found from identifiers of 160 English words: for
each encoding, the excess of chi-squared, the rate of class changes and its spread, and the median and 99.5th percentile
of both z-scores together, which fix the p-value. The null is the same whatever the size of the input. With fit=True (the
caller's choice) it is fitted to the data: every document gives a few of its words, joined as identifiers are (camel case, with
_, lower or upper case) with a number behind, and the values of PRIOR count as PRIOR_STRINGS further strings, so no number
of strings switches from one null to the other. The p-values go through Benjamini-Hochberg at 1 % within strata of
encoding and length, from a histogram of all candidates; with fit, the number of ordinary strings is estimated from the
p-values over one half, as far as these are fitted.

Offsets are code points, ends exclusive. Everything is column expressions; the text is read once.

Defined results: null and empty texts have no spans. Repeated rows are each scanned. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm.text import let, table, whole
from strandlake.session import discard, settle

#: The base patterns. A run of hexadecimal digits is one match whatever its length, and so is
#: AKIA with what follows, so the least length can stand in the pattern; for assign it is tested afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
#: '=' ends a candidate; before other signs of a candidate it is no part of it (NAME=value).
CANDIDATE = "[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?|(?=[A-Za-z0-9+/_=-]{20})[A-Za-z0-9+/_-]+=+(?![A-Za-z0-9+/_=-])"
#: Parts of a candidate that has signs of both base64 and base64url.
PARTS = ("(?=[A-Za-z0-9_=-]{20})[A-Za-z0-9_-]+=*", "(?=[A-Za-z0-9+/=]{20})[A-Za-z0-9+/]+=*")

UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: name: (alphabet, pattern of the whole string).
ENCODINGS = {
    "hex": (DIGITS + "abcdef", r"^[0-9a-f]+$"),
    "hex_upper": (DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    "base32": (UPPER + "234567", r"^[A-Z2-7]+=*$"),
    "base36": (DIGITS + LOWER, r"^[0-9a-z]+$"),
    "base64": (UPPER + LOWER + DIGITS + "+/", r"^[A-Za-z0-9+/]+=*$"),
    "base64url": (UPPER + LOWER + DIGITS + "-_", r"^[A-Za-z0-9_-]+=*$"),
}
#: Of ordinary strings: excess of chi-squared a symbol, class changes a step, their variance a step, median and 99.5th
#: percentile of the sum of both z-scores.
PRIOR = {
    "hex": (0.9, 0.25, 0.3, 0.0, 3.8),
    "hex_upper": (0.9, 0.25, 0.3, 0.0, 3.8),
    "base32": (0.9, 0.05, 0.15, 0.0, 3.4),
    "base36": (0.9, 0.05, 0.15, 0.0, 3.4),
    "base64": (2.1, 0.29, 0.42, 0.0, 3.8),
    "base64url": (2.1, 0.29, 0.42, 0.0, 3.8),
}
PRIOR_STRINGS, LEAST_VARIANCE = 200, 0.15
REJECT, FDR = 0.001, 0.01
#: Bins of -log10 p, twenty to a decade; the last takes all smaller p.
BINS = 400


def prefix_sums(x: Column) -> Column:
    """Sums of all elements before each one, in blocks of 64, so that long arrays stay near linear."""
    block = lambda i: F.floor(i / 64).cast("int")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, v: s + v)

    def inside(starts: Column) -> Column:
        return F.transform(x, lambda _, i: F.get(starts, block(i)) + total(F.slice(x, block(i) * 64 + 1, i % 64)))

    sums = F.transform(F.sequence(F.lit(0), block(F.size(x) - 1)), lambda b: total(F.slice(x, b * 64 + 1, 64)))
    grow = lambda s, v: F.concat(s, F.array(F.element_at(s, -1) + v))
    return let(F.aggregate(sums, F.array(F.lit(0)), grow), inside)


NONE = "CAST(array() AS array<struct<start:int,end:int,value:string>>)"


def spans(text: Column, pattern: str, value_group: int = 0) -> Column:
    """start, end and value of every match, leftmost and non-overlapping."""
    gaps = F.transform(F.split(text, pattern), lambda g: F.length(g))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = matches if not value_group else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))

    def placed(m: Column) -> Column:
        steps = F.zip_with(F.transform(m, lambda v: F.length(v)), F.slice(gaps, 1, F.size(m)), lambda a, b: a + b)

        def build(before: Column) -> Column:
            at = F.zip_with(before, F.slice(gaps, 1, F.size(m)), lambda a, b: a + b)
            start_end = F.zip_with(at, m, lambda s, v: F.struct(s.alias("start"), (s + F.length(v)).alias("end")))
            return F.zip_with(start_end, values, lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))

        return let(steps, lambda s: let(prefix_sums(s), build))

    return F.when(text.rlike(pattern), let(matches, placed)).otherwise(F.expr(NONE))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, by a logistic approximation (error below 2e-4, relative
    error bounded in the near tail; far tails are conservative)."""
    z = F.least(F.greatest(z, F.lit(-9.0)), F.lit(9.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def tested(value: Column) -> Column:
    """struct(encoding, n, df, chi, turns, p_random) of one candidate; null where no encoding fits."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    chosen = F.lit(None).cast("string")
    for name, (_, pattern) in reversed(ENCODINGS.items()):
        chosen = F.when(value.rlike(pattern), F.lit(name)).otherwise(chosen)
    pick = lambda name, k: F.element_at(F.create_map(*[F.lit(v) for e, row in ENCODINGS.items() for v in (e, (row[0], float(len(row[0])))[k])]), name)

    def battery(name: Column, codes: Column) -> Column:
        n, size = F.size(codes).cast("double"), pick(name, 1)
        squares = F.aggregate(F.transform(F.array_distinct(codes), lambda v: F.size(F.filter(codes, lambda c: c == v)).cast("double")), F.lit(0.0), lambda s, c: s + c * c)
        df, middle = size - 1, (size - 1) / 2
        following = F.slice(codes, 2, F.size(codes))

        def judged(chi: Column) -> Column:
            cube = F.pow(chi / df, F.lit(1 / 3))
            p_chi = upper_tail((cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
            pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), following, lambda a, b: (a - middle) * (b - middle))
            serial = F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v) / (F.sqrt(n - 1) * (size * size - 1) / 12)
            above = F.aggregate(codes, F.lit(0.0), lambda s, c: s + F.when(c > middle, 1.0).otherwise(0.0))
            runs = 1 + F.aggregate(F.zip_with(F.slice(codes, 1, F.size(codes) - 1), following, lambda a, b: F.when((a > middle) != (b > middle), 1.0).otherwise(0.0)), F.lit(0.0), lambda s, v: s + v)
            product = 2 * above * (n - above)
            expected, spread = product / n + 1, F.sqrt(F.greatest(product * (product - n) / (n * n * (n - 1)), F.lit(1e-9)))
            p_runs = F.least(F.lit(1.0), 2 * upper_tail(F.abs(runs - expected) / spread))
            p_serial = F.least(F.lit(1.0), 2 * upper_tail(F.abs(serial)))
            return F.struct(name.alias("encoding"), n.cast("int").alias("n"), df.alias("df"), chi.alias("chi"), class_turns(body).alias("turns"), F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, p_serial)).alias("p_random"))

        return let(squares * size / n - n, judged)

    body = F.regexp_replace(value, "=+$", "")
    codes = lambda name: F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: (F.instr(pick(name, 0), c) - 1).cast("double"))
    return F.when(mixed & chosen.isNotNull(), let(chosen, lambda name: let(codes(name), lambda c: battery(name, c))))


def class_turns(s: Column) -> Column:
    """How often the class of a character (lower, upper, digit, sign) differs from that of the one before."""
    classes = F.translate(s, LOWER + UPPER + DIGITS + "+/-_", "a" * 26 + "A" * 26 + "0" * 10 + "____")
    return (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1).cast("double")


def ordinary(text: Column) -> Column:
    """A few words of the text from a place that its hash picks, joined as identifiers are; null if it has none."""
    h = F.xxhash64(text)
    place = F.pmod(h, F.greatest(F.length(text) - 100, F.lit(1)).cast("long")).cast("int") + 1
    letters = F.regexp_extract(F.substring(text, place, F.lit(200)), r"[A-Za-z]{2,12}(?:[^A-Za-z]+[A-Za-z]{2,12}){3,5}", 0)
    words = F.split(F.lower(letters), "[^a-z]+")
    kind, number = F.pmod(F.shiftright(h, 8), F.lit(4)), F.pmod(F.shiftright(h, 16), F.lit(10_000)).cast("string")
    joined = lambda f, sep="": F.array_join(F.transform(words, f), sep)
    styled = F.when(kind == 0, joined(F.initcap)).when(kind == 1, F.concat(joined(lambda w: w, "_"), F.lit("_"))).when(kind == 2, joined(lambda w: w)).otherwise(joined(F.upper))
    return F.when(letters != "", F.concat(styled, F.when(kind == 3, F.translate(number, "0189", "2345")).otherwise(number)))


def z_scores(c: Column, null: Column) -> Column:
    """How much more random than ordinary strings: by chi-squared and by class changes, added."""
    n, steps = c["n"], F.greatest(c["n"] - 1, F.lit(1))
    centre = c["df"] + n * null["excess"]
    return (centre - c["chi"]) / F.sqrt(2 * (c["df"] + 2 * n * null["excess"])) + (c["turns"] - steps * null["rate"]) / F.sqrt(steps * null["variance"])


FIELDS = ("excess", "rate", "variance", "middle", "high")


def null_map(values: dict[str, tuple[float, ...]]) -> Column:
    return F.create_map(*[F.lit(v) if isinstance(v, str) else F.struct(*(F.lit(float(x)).alias(f) for x, f in zip(v, FIELDS, strict=True))) for e in ENCODINGS for v in (e, values[e])])


def fitted_null(tokens: DataFrame) -> tuple[dict[str, tuple[float, ...]], dict[str, float]]:
    """The values of PRIOR, fitted to tested ordinary strings (column o) by two aggregations, a row for each encoding; and the weight
    that the strings have beside the prior."""
    o = tokens.where("o IS NOT NULL AND o.n >= 20").select("o.*")
    steps = F.col("n") - 1
    first = o.groupBy("encoding").agg(F.count("*").alias("n"), F.avg((F.col("chi") - F.col("df")) / F.col("n")).alias("excess"), (F.sum("turns") / F.sum(steps)).alias("rate"), F.sum(F.col("turns") * F.col("turns") / steps).alias("a"), F.sum("turns").alias("b"), F.sum(steps).alias("c"))
    values, weights = dict(PRIOR), dict.fromkeys(PRIOR, 0.0)
    mixed = lambda w, own, prior: tuple(w * x + (1 - w) * y for x, y in zip(own, prior, strict=True))
    for r in first.collect():
        w = weights[r.encoding] = r.n / (r.n + PRIOR_STRINGS)
        variance = (r.a - 2 * r.rate * r.b + r.rate**2 * r.c) / r.n  # mean of (turns - steps * rate) ** 2 / steps
        values[r.encoding] = (*mixed(w, (r.excess, r.rate, max(variance, LEAST_VARIANCE)), PRIOR[r.encoding][:3]), *PRIOR[r.encoding][3:])
    z = z_scores(F.struct("n", "df", "chi", "turns"), F.element_at(null_map(values), F.col("encoding")))
    for r in o.select("encoding", z.alias("z")).groupBy("encoding").agg(F.percentile_approx("z", F.array(F.lit(0.5), F.lit(0.995)), F.lit(10_000)).alias("q")).collect():
        values[r.encoding] = (*values[r.encoding][:3], *mixed(weights[r.encoding], (r.q[0], max(r.q[1], r.q[0] + 1.0)), PRIOR[r.encoding][3:]))
    return values, weights


def parts(s: Column) -> Column:
    """The candidate itself or, where it has signs of both base64 and base64url, its parts at each kind."""
    cut = F.array_distinct(F.concat(*(spans(s["value"], p) for p in PARTS)))
    moved = F.transform(cut, lambda c: F.struct((c["start"] + s["start"]).alias("start"), (c["end"] + s["start"]).alias("end"), c["value"].alias("value")))
    return F.when(s["value"].rlike("[+/]") & s["value"].rlike("[_-]"), moved).otherwise(F.array(s))


def stratum(c: Column) -> Column:
    return F.concat(c["encoding"], F.lit(":"), F.length(F.bin(c["n"].cast("long"))).cast("string"))


def p_bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-20 * F.log10(F.greatest(p, F.lit(1e-30)))).cast("int"))


def thresholds(found: DataFrame, weights: dict[str, float]) -> Column:
    """Map from stratum to the least bin that Benjamini-Hochberg lets through; weights: how far the p-values of an encoding are
    fitted, so that the number of ordinary strings can be told from them.

    The histogram has one row for each stratum and bin: 6 encodings, 31 lengths and 401 bins at most,
    however much text there is; the map has one entry for each stratum."""
    c = found.select(F.explode("candidates").alias("c")).select(stratum(F.col("c")).alias("stratum"), p_bin(F.col("c.p_text")).alias("bin"))
    histogram = c.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy("stratum").orderBy(F.col("bin").desc())
    whole_stratum = Window.partitionBy("stratum")
    passing = histogram.withColumn("k", F.sum("n").over(up)).withColumn("m", F.sum("n").over(whole_stratum))
    # of m strings so many are ordinary, as half of these have p over 10 ** -0.3, about 0.5
    ordinary_ones = F.least("m", 2 * (F.sum(F.when(F.col("bin") <= 5, F.col("n")).otherwise(0)).over(whole_stratum) + 1))
    weight = F.element_at(F.create_map(*[F.lit(v) for e in weights for v in (e, weights[e])]), F.substring_index("stratum", ":", 1))
    passing = passing.withColumn("m", weight * ordinary_ones + (1 - weight) * F.col("m"))
    # every p of a bin is at most 10 ** (-bin / 20)
    cut = passing.where(F.pow(F.lit(10.0), -F.col("bin") / 20) * F.col("m") <= FDR * F.col("k")).groupBy("stratum").agg(F.min("bin").alias("bin"))
    rows = cut.collect()
    return F.create_map(*[F.lit(v) for r in rows for v in (r["stratum"], r["bin"])]) if rows else F.expr("CAST(map() AS map<string,int>)")


def of_kind(kind: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit: bool = False) -> DataFrame:
    """doc_id and found: array of (start, end, kind as index into KINDS), by start, then kind. fit: the null is fitted to the data."""
    text = whole(text_col)
    base = [F.filter(spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= 12), spans(text, ACCESS), spans(text, HEX)]
    kept = [F.transform(s, of_kind(k)) for k, s in enumerate(base)]
    judged = F.transform(F.flatten(F.transform(spans(text, CANDIDATE), parts)), lambda s: let(tested(s["value"]), lambda t: F.struct(s["start"].alias("start"), s["end"].alias("end"), *(t[c].alias(c) for c in ("encoding", "n", "df", "chi", "turns", "p_random")))))
    raw, path = settle(docs.select(F.col(id_col).alias("doc_id"), F.concat(*kept).alias("base"), F.filter(judged, lambda c: c["encoding"].isNotNull()).alias("candidates"), *([let(ordinary(text), tested).alias("o")] if fit else [])), "spans")
    values, weights = fitted_null(raw) if fit else (PRIOR, dict.fromkeys(PRIOR, 0.0))
    null = null_map(values)

    def with_p(c: Column) -> Column:
        own = F.element_at(null, c["encoding"])
        # the 99.5th percentile of ordinary strings has p = 0.005
        p_text = upper_tail(2.5758 * (z_scores(c, own) - own["middle"]) / (own["high"] - own["middle"]))
        return F.struct(*(c[k].alias(k) for k in ("start", "end", "encoding", "n", "p_random")), p_text.alias("p_text"))

    src, _ = settle(raw.select("doc_id", "base", F.transform("candidates", with_p).alias("candidates")), "judged")
    discard(docs.sparkSession, path)
    cut = thresholds(src, weights)
    good = F.filter("candidates", lambda c: (c["p_random"] >= REJECT) & (p_bin(c["p_text"]) >= F.element_at(cut, stratum(c))))
    added = F.transform(good, of_kind(3))
    return src.select("doc_id", F.sort_array("base").alias("base"), F.sort_array(F.concat("base", added)).alias("found"))


def listed(found: str) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(table(spark, sf_dir, "documents"))
    count = [F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == k), False)).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return out.select("doc_id", *count, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("found").alias("spans"))
