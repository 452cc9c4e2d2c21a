"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification.

A document's set: hashes (64 bits) of its distinct 2-word shingles, words lower-cased A-Z; with fewer words
the whole sequence; none without words or text. The signature needs two permutations only: the first, sigma,
scatters the set over 2 ** 32 places; the second, pi, is taken at places shifted circularly by k, and
coordinate k is the least pi(sigma(s) + k). Four coordinates make a band, and documents that share a band
are candidates; a pair at the threshold is missed by all bands with probability 5e-8.

Steps:
1. Equal sets collapse to a class, which is the node from here on. Classes of one id are linked.
2. Star: in each band bucket the most central member (whose buckets are largest) leads, and the others are
   linked to it after exact verification on full sets. Components of these links are found.
3. The rest: in buckets that still hold several components, members outside the leader's component meet the
   others in blocks. Pairs whose long signature rules out the threshold (4.5 standard deviations below) stop
   there; the others are verified on full sets and components are found again. Of the links between one
   document and one component a single one comes out. All members outside the leader's component meet all
   others, whatever the size of the bucket; this is quadratic in them. No pair is dropped by a cap. With `large` given, a
   bucket of more members is dealt anew by SUB_BANDS bands of SUB_ROWS further coordinates before that, so that unlike
   members of a hot bucket do not all meet; a pair at the threshold is missed by all of these with probability 1e-5.

Defined results: documents without words are their own component. A null id is not linked: component_id is null,
kept is true. Rows that share an id are one document: all their texts are in one component. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.components import components
from strandlake.llm.shingles import batches, shingles, words
from strandlake.llm.text import table
from strandlake.session import discard, settle, spread

WIDTH, PERCENT = 2, 80
BANDS, ROWS = 32, 4
#: Coordinates of the long signature, one byte of each is kept; least estimate that goes on to verification.
LONG, LEAST = 512, 0.72
BLOCK = 512
#: Bands for a bucket that is dealt anew (of bytes of the long signature beyond the first bands).
SUB_BANDS, SUB_ROWS = 16, 3


def circulant(s: np.ndarray, n: int) -> np.ndarray:
    """n coordinates of the signature of a set of 64-bit hashes."""
    sigma = (s >> np.uint64(32)).astype(np.uint32)
    shift = np.arange(n, dtype=np.uint32)[:, None]
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(sigma), 512):
        x = sigma[None, at : at + 512] + shift
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, fp (128 bits of the set), bands (BANDS longs), sig (LONG bytes)."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(BANDS, dtype=np.uint64)
        for batch in arrow:
            for at, flat, offsets in batches(batch, 1):
                w, first = words(flat, offsets)
                rows = []
                for a, b in zip(first[:-1], first[1:], strict=True):
                    s = np.unique(shingles(w[a:b], WIDTH))
                    if not len(s):
                        rows.append((0, None, None, None))
                        continue
                    c = circulant(s, LONG)
                    bands = [xxhash.xxh3_64_intdigest(c[k * ROWS : (k + 1) * ROWS].tobytes(), int(k)) for k in salt]
                    rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()), np.array(bands, "u8").view("i8").tolist(), c.astype(np.uint8).tobytes()))
                n, fp, bands, sig = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(rows)), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "fp", "bands", "sig"])

    return spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(run, "doc_id long, n_shingles long, fp binary, bands array<long>, sig binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """id, fp (128 bits of the set) and the set, from id and text."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            for at, flat, offsets in batches(batch, 1):
                w, first = words(flat, offsets)
                sets = [np.unique(shingles(w[a:b], WIDTH)).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                fps = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), fps, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], names=["id", "fp", "s"])

    return docs.mapInArrow(run, "id long, fp binary, s array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    one = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return pairs.join(one, "a").join(two, "b").where(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def likely(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose long signatures do not rule out the threshold."""

    def run(arrow: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in arrow:
            if len(f):
                x, y = (np.frombuffer(b"".join(f[c]), np.uint8).reshape(-1, LONG) for c in ("sa", "sb"))
                f = f[((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= LEAST]
            yield f[["a", "b"]]

    one = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    two = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(one, "a").join(two, "b").mapInPandas(run, "a long, b long")


def blocked(members: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of every bucket that holds several components: members outside the leader's component,
    and all members, each cut into blocks (i and j) and repeated for every block of the other side."""
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_all"), F.ceil(F.count_if(F.expr("component <> main")) / BLOCK).cast("int").alias("n_out"), (F.min("component") < F.max("component")).alias("several")).where("n_out > 0 AND several").drop("several")
    m = members.join(counts, "key")
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    outside = m.where("component <> main").withColumn("i", block("n_out")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)))
    others = m.withColumn("j", block("n_all")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_out") - 1)))
    columns = ["key", "i", "j", *columns]
    return outside.select(*columns), others.select(*columns).toDF(*columns)


def likely_partners(x: pd.DataFrame, y: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of x the rows of y in other components that its signature does not rule out. A pair
    counts in the first band that it shares, so it comes up once."""
    if not len(x) or not len(y):
        return
    band = int(x.band.iloc[0])
    bx, by = np.stack(x.bands.to_list()), np.stack(y.bands.to_list())
    sx, sy = (np.frombuffer(b"".join(f.sig), np.uint8).reshape(-1, LONG) for f in (x, y))
    cx, cy = x.component.to_numpy(), y.component.to_numpy()
    for k in range(len(x)):
        at = np.flatnonzero((cy != cx[k]) & ~(by[:, :band] == bx[k, :band]).any(axis=1))
        if len(at):
            at = at[((sy[at] == sx[k]).mean(axis=1) - 1 / 256) / (1 - 1 / 256) >= LEAST]
            if len(at):
                yield k, at


def mark(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
    """key and id of the rows that have a likely partner."""
    found: set[int] = set()
    for k, at in likely_partners(x, y):
        found.add(x.id.iloc[k])
        found.update(y.id.iloc[at])
    key = int(x.key.iloc[0]) if len(x) else 0
    return pd.DataFrame({"key": np.full(len(found), key, np.int64), "id": np.array(sorted(found), np.int64)})


def link(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
    """Pairs (a, b) that reach the threshold on full sets, one for each row of x and component of y."""
    found = []
    for k, at in likely_partners(x, y):
        mine, linked = x.s.iloc[k], set()
        for v in at:
            other = y.component.iloc[v]
            if other not in linked:
                both = len(np.intersect1d(mine, y.s.iloc[v], assume_unique=True))
                if 100 * both >= PERCENT * (len(mine) + len(y.s.iloc[v]) - both):
                    linked.add(other)
                    found.append((min(x.id.iloc[k], y.id.iloc[v]), max(x.id.iloc[k], y.id.iloc[v])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def dealt_anew(members: DataFrame, most: int) -> DataFrame:
    """members with the buckets of more than most members cut by further coordinates."""
    counts = members.groupBy("key").agg(F.count("*").alias("__n"))
    counted = members.join(counts, "key")
    part = F.sequence(F.lit(0), F.lit(SUB_BANDS - 1))
    large = counted.where(F.col("__n") > most).withColumn("__q", F.explode(part))
    at = LONG - SUB_BANDS * SUB_ROWS + 1 + F.col("__q") * SUB_ROWS
    large = large.withColumn("key", F.xxhash64("key", "__q", F.substring("sig", at, F.lit(SUB_ROWS))))
    return counted.where(F.col("__n") <= most).drop("__n").unionByName(large.drop("__n", "__q"))


def across(members: DataFrame, sets: DataFrame, large: int | None = None) -> DataFrame:
    """Links between components that share a bucket. Signatures go first and mark the rows of a bucket that
    have a likely partner; full sets follow for those alone."""
    members, path = settle(members if large is None else dealt_anew(members, large), "rest")
    columns = ["id", "component", "band", "bands", "sig"]
    out, every = blocked(members, columns)
    marked, _ = settle(out.groupBy("key", "i", "j").cogroup(every.groupBy("key", "i", "j")).applyInPandas(mark, "key long, id long").distinct(), "marked")
    left = members.join(marked, ["key", "id"], "left_semi").join(sets, "id")
    out, every = blocked(left, [*columns, "s"])
    return out.groupBy("key", "i", "j").cogroup(every.groupBy("key", "i", "j")).applyInPandas(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row. large: None for all buckets whole, or members of a
    bucket beyond which it is dealt anew (a pair is lost with probability 1e-5)."""
    spark, paths = docs.sparkSession, []

    def written(df: DataFrame, name: str) -> DataFrame:
        df, path = settle(df, name)
        paths.append(path)
        return df

    every, _ = settle(sketches(docs, id_col, text_col), "sketches")
    classes = every.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    reps = written(classes.withColumn("id", F.monotonically_increasing_id()), "reps")  # written once, so ids stay
    ids = reps.select("fp", "id", "first_id")

    keyed = reps.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = written(keyed.join(buckets, ["band", "key"]), "buckets")
    central = keyed.groupBy("id").agg(F.sum("n").alias("weight"))
    leads = keyed.join(central, "id").groupBy("band", "key").agg(F.max(F.struct("weight", (-F.col("id")).alias("id")))["id"].alias("id"))
    leads = written(leads.select("band", "key", (-F.col("id")).alias("lead")), "leads")
    led = written(keyed.join(leads, ["band", "key"]), "led")

    wanted = ids.join(central.select("id"), "id", "left_semi")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = shingle_sets(texts.join(wanted.select(F.col("first_id").alias("id")), "id", "left_semi").select("id", "text"))
    sets = written(sets.dropDuplicates(["fp"]).drop("id").join(wanted.select("fp", "id"), "fp").select("id", "s"), "sets")
    star = led.where("id <> lead").select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()
    links = verified(likely(star, reps.select("id", "sig")), sets)
    shared = every.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("fp"), F.max("fp").alias("last")).where("fp < last")
    if not shared.isEmpty():  # ids with several texts: their classes belong together
        own = every.join(shared.select("doc_id", F.col("fp").alias("one")), "doc_id").where("fp <> one").select("one", "fp").distinct()
        links = links.unionByName(own.join(ids.select(F.col("fp").alias("one"), F.col("id").alias("a")), "one").join(ids.select("fp", F.col("id").alias("b")), "fp").select("a", "b"))
    links = written(links, "links")
    found = components(links)

    member = led.where("n > 2").join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    lead_of = found.select(F.col("node").alias("lead"), F.col("component").alias("main"))
    member = member.join(lead_of, "lead", "left").withColumn("main", F.coalesce("main", "lead"))
    mixed = member.where("component <> main").select("band", "key").distinct()
    rest = member.join(mixed, ["band", "key"], "left_semi").join(reps, "id").select("key", "band", "id", "component", "main", "bands", "sig")
    more = written(across(rest, sets, large), "more")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    labelled = ids.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class, _ = settle(labelled.join(least, "component").select("fp", "component_id"), "by_class")
    for path in paths:
        discard(spark, path)
    out = every.select("doc_id", "n_shingles", "fp").join(by_class, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Exact for any table whose ids are not null and differ: prefixes of the sets, rarest shingles first, find the candidates.
OP3_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
    FROM split
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS MATERIALIZED (
    SELECT id, n, unnest(s) AS x FROM classes
), ranked AS (
    SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY df, x) AS k
    FROM shingles JOIN (SELECT x, count(*) AS df FROM shingles GROUP BY x) USING (x)
), prefixes AS MATERIALIZED (
    SELECT id, n, x FROM ranked WHERE k <= n - (80 * n + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT p.id AS a, q.id AS b FROM prefixes p JOIN prefixes q ON p.x = q.x AND p.id < q.id AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
), met AS (
    SELECT a, b, p.n AS na, q.n AS nb, len(list_intersect(p.s, q.s)) AS shared
    FROM candidates JOIN classes p ON p.id = a JOIN classes q ON q.id = b
), links AS MATERIALIZED (
    SELECT a, b FROM met WHERE 100 * shared >= 80 * (na + nb - shared)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(id, other) AS (
    SELECT id, id FROM classes
    UNION
    SELECT r.id, w.b FROM reach r JOIN ways w ON w.a = r.other
), components AS (
    SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(m.component_id, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN components m ON m.id = c.id
"""
