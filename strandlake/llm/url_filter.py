"""URL rules indexed by their rarest literal token.

A rule is an action and a pattern over host + path + query: `||` starts at the host or at a label of it, `|` at the
start or end, `*` is any run of characters, `^` a separator (no letter, digit, `_`, `-`, `.` or `%`) or the end.
Listed rules (host and path prefix, `example.net/en/`) are the pattern `||example.net/en/`, case-sensitive in the
path; they decide before all others, the longest first. Of other patterns an allowing one decides before a blocking
one. Where nothing fits, the default holds.

1. A run of letters, digits and % that has another literal or an anchor on both sides is a token of every url that the
   pattern fits. Tokens of rules are counted over all urls.
2. Each rule is filed under its rarest token, rules without any under the empty one, which all urls have.
3. The tokens of each distinct url fetch the rules filed under them by an equi-join (Spark broadcasts the rules if their
   file is small, else both sides are shuffled). Only those rules run their regular expressions.
4. Verdicts are joined to the rows by url.

Defined results: a url that is null or has no `://` has an empty host and path, fits no rule and gets the default.
Repeated rows are each judged. An empty table gives an empty result; without rules the default holds for all. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.text import table
from strandlake.session import settle

#: Rules of the contract.
LISTED = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Patterns that decide where no listed rule does.
PATTERNS = (
    ("block", "||casino-"), ("block", "||cheap-pills."), ("block", "||free-bets."), ("block", "||spam-farm."),
    ("block", "-casino."), ("block", "-pills."), ("block", "/adserver/*/click^"), ("block", "^affid="), ("block", "/doorway-*.html|"),
    ("allow", "/robots.txt|"), ("allow", "||*.example.org/about^"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A token of a pattern that is a whole token of every url that it fits.
SAFE = "(?<=[^a-z0-9%*])[a-z0-9%]+(?=[^a-z0-9%*])"
SEPARATOR = r"(?:[^a-zA-Z0-9_.%-]|\z)"
RULES = "action string, pattern string, rule string"


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """host, path, and the host with all that follows it."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host, rest = F.regexp_extract(after, "^[^/?#]*", 0), F.regexp_extract(after, "^[^/?#]*((?s).*)", 1)
    return lowered(host), F.regexp_extract(rest, "^[^?#]*", 0), F.concat(lowered(host), rest)


def rule_table(spark: SparkSession, listed: Sequence[tuple[str, str]], patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """action, pattern, rule (null for patterns that are not listed)."""
    return spark.createDataFrame([(a, "||" + r, r) for a, r in listed] + [(a, p, None) for a, p in patterns], RULES)


def expression(rules: DataFrame) -> Column:
    """The regular expression of a pattern."""
    body = F.regexp_replace(F.regexp_replace("pattern", r"^\|\|?", ""), r"\|$", "")
    body = F.regexp_replace(body, r"[-.+?$(){}|\[\]\\]", r"\\$0")
    body = F.replace(F.regexp_replace(body, r"\*+", ".*"), F.lit("^"), F.lit(SEPARATOR))
    start = F.when(F.col("pattern").startswith("||"), r"^(?:[^/?#]*\.)?").when(F.col("pattern").startswith("|"), "^").otherwise("")
    return F.concat(F.when(F.col("rule").isNull(), "(?is)").otherwise("(?s)"), start, body, F.when(F.col("pattern").rlike(r"[^|]\|$"), r"\z").otherwise(""))


def tokens(subject: Column) -> Column:
    return F.array_distinct(F.split(lowered(subject), "[^a-z0-9%]+"))


def filed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """The rules with expr and token, the rarest of their tokens by counts (token, n)."""
    safe = F.regexp_extract_all(lowered(F.col("pattern")), F.lit(SAFE), F.lit(0))
    whole = rules.select(*rules.columns, expression(rules).alias("expr"), F.explode_outer(safe).alias("token"))
    key = [*rules.columns, "expr"]
    return whole.join(counts, "token", "left").groupBy(*key).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))["token"].alias("token"))


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, action, rule, pattern of every distinct url that some rule fits: the rule that decides."""
    _, _, subject = parts(F.col("url"))
    known = urls.where("instr(url, '://') > 0").groupBy("url").agg(F.lit(1).alias("__one")).select("url", subject.alias("subject"))
    known, _ = settle(known, "urls")
    held = known.select("url", "subject", F.explode(F.concat(F.array_remove(tokens(F.col("subject")), ""), F.array(F.lit("")))).alias("token"))
    sought = rules.select(F.explode(F.regexp_extract_all(lowered(F.col("pattern")), F.lit(SAFE), F.lit(0))).alias("token")).distinct()
    counts = held.groupBy("token").agg(F.count("*").alias("n")).join(sought, "token")
    index, _ = settle(filed(rules, counts), "rules")
    fits = held.join(index, "token").where(F.expr("subject RLIKE expr"))
    listed = F.col("rule").isNotNull()
    order = F.struct(listed.alias("listed"), F.when(listed, F.length("rule")).otherwise(0).alias("n"), (F.col("action") == "allow").alias("allow"), F.length("pattern").alias("m"), F.col("pattern"), F.col("action"), F.col("rule"))
    return fits.groupBy("url").agg(F.max(order).alias("w")).select("url", "w.action", "w.rule", "w.pattern")


def verdicts(rows: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id, host, path, rule, verdict, pattern (what decided, null by default) of every row."""
    src = rows.select(F.col(id_col), F.col(url_col).cast("string").alias("url"))
    host, path, _ = parts(F.coalesce("url", F.lit("")))
    return src.join(judged(src, rules), "url", "left").select(id_col, host.alias("host"), path.alias("path"), "rule", F.coalesce("action", F.lit(default)).alias("verdict"), "pattern")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "pages"), rule_table(spark, LISTED, PATTERNS))


_END = "(?:[^a-zA-Z0-9_.%-]|$)"
OP13_SQL = rf"""WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after FROM pages),
b AS (SELECT page_id, regexp_extract(after, '^[^/?#]*') AS h, after FROM a),
c AS (SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host, substr(after, length(h) + 1) AS rest FROM b),
d AS (SELECT page_id, host, regexp_extract(rest, '^[^?#]*') AS path, translate(host || rest, '{UPPER}', '{LOWER}') AS s FROM c),
e AS (SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
 WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM d),
f AS (SELECT *, CASE WHEN regexp_matches(s, '/robots\.txt$') THEN '/robots.txt|' WHEN regexp_matches(s, '^(?:[^/?#]*\.)?.*\.example\.org/about{_END}') THEN '||*.example.org/about^' END AS allowed,
 [p for p in [CASE WHEN regexp_matches(s, '^(?:[^/?#]*\.)?casino-') THEN '||casino-' END, CASE WHEN regexp_matches(s, '^(?:[^/?#]*\.)?cheap-pills\.') THEN '||cheap-pills.' END,
 CASE WHEN regexp_matches(s, '^(?:[^/?#]*\.)?free-bets\.') THEN '||free-bets.' END, CASE WHEN regexp_matches(s, '^(?:[^/?#]*\.)?spam-farm\.') THEN '||spam-farm.' END,
 CASE WHEN contains(s, '-casino.') THEN '-casino.' END, CASE WHEN contains(s, '-pills.') THEN '-pills.' END, CASE WHEN regexp_matches(s, '/adserver/.*/click{_END}') THEN '/adserver/*/click^' END,
 CASE WHEN regexp_matches(s, '{_END}affid=') THEN '^affid=' END, CASE WHEN regexp_matches(s, '/doorway-.*\.html$') THEN '/doorway-*.html|' END] if p IS NOT NULL] AS blocked FROM e)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL OR allowed IS NOT NULL OR len(blocked) = 0 THEN 'allow' ELSE 'block' END AS verdict,
 CASE WHEN rule IS NOT NULL THEN '||' || rule WHEN allowed IS NOT NULL THEN allowed ELSE list_reverse_sort([{{'n': length(p), 'p': p}} for p in blocked])[1].p END AS pattern FROM f"""
