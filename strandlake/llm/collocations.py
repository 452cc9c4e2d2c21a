"""Phrases whose words occur together more often than apart, by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), parted into pieces at punctuation and line breaks, and into words at blanks. Everything is
counted for each language on its own (null: `und`).

1. A worker writes the words of a run of texts behind one another with one blank after each. Prefix polynomials over
   these bytes (numpy, modulo 2 ** 64) give the fingerprint of every n-gram by one subtraction and one product; the
   language is mixed in. Runs are counted by sorting; workers and Spark add the counts up before the shuffle, with a
   pointer (of the tasks that have an occurrence, the next one from a place that the fingerprint sets, so that texts are sent by all tasks alike) and the least and greatest of a second fingerprint of 31 bits.
2. Words are counted first, then n-grams whose shorter parts are all frequent: a bit map of the frequent
   fingerprints, of at most 16 MB, is broadcast for each length. It never hides a frequent n-gram; where it is too
   small for its keys it only lets more of the others through.
3. In a last reading, the task that a pointer names sends the text of the frequent n-gram, once, with the document and the
   number of the word. Where second fingerprints or texts differ, different n-grams share a fingerprint: these are read
   again and counted by their texts, so counts are exact unless 95 bits agree.
4. Cuts of a phrase into two are looked up in the table of frequent phrases, scored in exact decimals, and phrases
   inside a longer one of the same count are dropped. The first rows of a language come from the first rows of 64
   parts of it.

Defined results: null and empty texts have no words. Repeated rows count again. A language without candidates has no rows; an empty table gives
none. Other columns are ignored, whatever their names. A long text is read in blocks of words, each with the four words after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm import bitmap
from strandlake.llm.shingles import _BYTE, _LOWER, U, _power, batches, mix64
from strandlake.llm.text import table
from strandlake.session import discard, settle, spread

LONGEST, LEAST, MOST_ROWS = 5, 100, 2000
#: Bytes of a run of texts or block of a long one; fingerprints that a worker adds up before it sends them, and rows of a batch.
RUN, HELD, SENT = 1 << 19, 1 << 20, 1 << 16
#: Phrases that a worker holds before it sends them with their counts (about 100 bytes each).
MOST_PHRASES = 1 << 20
#: Tasks at which the search for the one that sends a text begins; more even the work out and make the shuffle larger.
STARTS = 4
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAP = _BREAK.copy()
_GAP[[9, 32]] = True
OTHER = np.random.default_rng(20250311).integers(1, 2**64, 256, dtype=U)


def word_runs(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Of a run of texts, or block by block of a long one: bytes of the words with a blank after each, where words begin and end in them, the piece and
    the text of each word, and how many words are the block's own; LONGEST - 1 words of the next block follow."""
    flat = _LOWER[flat]
    gap = _GAP[flat]
    first = np.zeros(len(flat) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(~gap & (first[:-1] | np.concatenate([[True], gap[:-1]])[: len(flat)]))
    ends = np.flatnonzero(~gap & (first[1:] | np.concatenate([gap[1:], [True]])[-len(flat) :] if len(flat) else ~gap)) + 1
    if not len(starts):
        return
    breaks = np.flatnonzero(_BREAK[flat] | first[:-1])
    piece = np.searchsorted(breaks, starts, "right")
    text = np.searchsorted(offsets, starts, "right") - 1
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + RUN)))
        more = min(to + LONGEST - 1, len(starts))
        s, e = starts[at:more], ends[at:more]
        size = e - s + 1
        begin = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(s - begin[:-1], size) + np.arange(begin[-1])
        last = begin[1:] - 1
        take[last] -= 1
        packed = flat[take]
        packed[last] = 32
        yield packed, begin[:-1], last, piece[at:more], text[at:more], min(to, len(starts)) - at
        at = to


class Prints:
    """Fingerprints of the n-grams of a block."""

    def __init__(self, run: tuple, salts: np.ndarray, bits: int = 64):
        self.shift = U(64 - bits)
        self.packed, self.begin, self.end, self.piece, self.text, self.own = run
        power, self.inverse = _power(len(self.packed) + 1)
        self.sums = np.zeros(len(self.packed) + 1, U)
        np.cumsum(_BYTE[self.packed] * power[: len(self.packed)], out=self.sums[1:])
        self.others = np.zeros(len(self.packed) + 1, U)
        np.cumsum(OTHER[self.packed] * power[: len(self.packed)], out=self.others[1:])
        self.salt = salts[self.text]

    def of(self, first: np.ndarray, n: int) -> np.ndarray:
        """Of the n-grams that begin at these words."""
        b, e = self.begin[first], self.end[first + n - 1]
        return mix64((self.sums[e] - self.sums[b]) * self.inverse[b] ^ self.salt[first]) >> self.shift

    def check(self, first: np.ndarray, n: int) -> np.ndarray:
        """A second fingerprint of them, by other values of the bytes: 31 bits."""
        b, e = self.begin[first], self.end[first + n - 1]
        return (mix64((self.others[e] - self.others[b]) * self.inverse[b] ^ self.salt[first]) >> U(33)).astype(np.int32)

    def whole(self, n: int) -> np.ndarray:
        """Words of the block at which n words of one piece begin."""
        stop = min(self.own, len(self.piece) - n + 1)
        return np.flatnonzero(self.piece[: max(0, stop)] == self.piece[n - 1 : n - 1 + max(0, stop)])

    def frequent(self, n: int, known: np.ndarray, part: int) -> np.ndarray:
        """Those whose `part`-grams may all be frequent."""
        first = self.whole(n)
        for k in range(n - part + 1):
            first = first[bitmap.holds(known, self.of(first + k, part))]
        return first


def salts(langs: list[str | None]) -> np.ndarray:
    seen = {x: int.from_bytes(hashlib.blake2b((x or "und").encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([seen[x] for x in langs], U)


def runs(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[int, Prints]]:
    """First row and fingerprints of every run of a batch (text, lang, …)."""
    salt = salts(batch.column(1).to_pylist())
    for at, flat, offsets in batches(batch, 0, RUN, 1 << 14):
        for run in word_runs(flat, offsets):
            yield at, Prints(run, salt[at:], bits)


class Tally:
    """Counts by key, with the least and the greatest second fingerprint of each, added up until many different keys are held."""

    SCHEMA = "key long, n long, low int, high int, part int"

    def __init__(self, part: int):
        self.part, self.waiting, self.held = part, [], 0

    def add(self, keys: np.ndarray, check: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.waiting.append(grouped(keys, np.ones(len(keys), np.int64), check, check))
        self.held += len(self.waiting[-1][0])
        if self.held > HELD:
            self.merge()
            if self.held > HELD // 4 * 3:
                yield from self.rows()

    def merge(self) -> None:
        self.waiting = [grouped(*(np.concatenate(x) for x in zip(*self.waiting, strict=True)))]
        self.held = len(self.waiting[0][0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        keys, n, low, high = self.waiting[0]
        self.waiting, self.held = [], 0
        for at in range(0, len(keys), SENT):
            k, c, lo, hi = (x[at : at + SENT] for x in (keys, n, low, high))
            columns = [pa.array(k.view(np.int64)), pa.array(c), pa.array(lo.astype("i4")), pa.array(hi.astype("i4")), pa.array(np.full(len(k), self.part, "i4"))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "low", "high", "part"])


def grouped(keys: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begin], np.add.reduceat(n[order], begin), np.minimum.reduceat(low[order], begin), np.maximum.reduceat(high[order], begin)


def frequent_prints(docs: DataFrame, lengths: list[int], known: Broadcast | None, least: int, bits: int = 64) -> DataFrame:
    """key, n, low, high, part of the fingerprints of these lengths that occur least times or more, among n-grams whose parts (one word shorter
    than the least length) are known. low and high differ if texts share a fingerprint; part points to a task that has read an occurrence, the next one from one of STARTS places."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(TaskContext.get().partitionId())
        for batch in stream:
            for _, p in runs(batch, bits):
                for n in lengths:
                    first = p.whole(n) if known is None else p.frequent(n, known.value, lengths[0] - 1)
                    if len(first):
                        yield from tally.add(p.of(first, n), p.check(first, n))
        if tally.held:
            yield from tally.rows()

    # a task's number of its turn of all tasks, counted from one of STARTS places by the key: few bits, as they are shuffled
    tasks = F.lit(max(1, docs.rdd.getNumPartitions()))
    turn, begin = F.floor(F.col("part") / tasks).cast("int") * tasks, F.floor(F.pmod(F.xxhash64("key"), F.lit(STARTS)) * tasks / STARTS).cast("int")
    place = F.min(turn + F.pmod(F.col("part") - begin, tasks)).alias("place")
    sums = docs.mapInArrow(run, Tally.SCHEMA).groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), place)
    part = F.floor(F.col("place") / tasks).cast("int") * tasks + F.pmod(F.col("place") + begin, tasks)
    return sums.where(F.col("n") >= least).withColumn("part", part.cast("int")).drop("place")


def without(keys: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Which keys are not among those told (sorted)."""
    if not len(told):
        return np.ones(len(keys), bool)
    return told[np.minimum(np.searchsorted(told, keys), len(told) - 1)] != keys


def pointed(keys: np.ndarray, part: int) -> np.ndarray:
    """What stands in the map of pointers for a fingerprint and a task."""
    return mix64(keys ^ mix64(np.full(1, part + 1, U)))


def pointers(frequent: DataFrame) -> DataFrame:
    """key of the map of pointers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            part = f["part"].to_numpy().astype(U)
            yield pd.DataFrame({"key": mix64(f["key"].to_numpy().view(U) ^ mix64(part + U(1))).view(np.int64)})

    return frequent.select("key", "part").mapInPandas(run, "key long")


def texts(docs: DataFrame, known: Broadcast, pointing: Broadcast, bits: int = 64) -> DataFrame:
    """key, lang, phrase, words, doc_id, word: the text of an n-gram where its pointer says, once a task. The rows of no words have, as key, how many
    words of a language a task has read."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), {}
        told = [np.empty(0, U)] * (LONGEST + 1)  # of each length, sorted
        for batch in stream:
            for p, langs, ids, word in placed(batch, total, bits):
                rows: list[tuple] = []
                for n in range(1, LONGEST + 1):
                    first = p.whole(n) if n == 1 else p.frequent(n, known.value, n - 1)
                    keys, at = np.unique(p.of(first, n), return_index=True)
                    here = bitmap.holds(pointing.value, pointed(keys, part))
                    here[here] = without(keys[here], told[n])
                    if not here.any():
                        continue
                    told[n] = np.sort(np.concatenate([told[n], keys[here]]), kind="stable")
                    raw = p.packed.tobytes()
                    for key, k in zip(keys[here].view(np.int64).tolist(), first[at[here]].tolist(), strict=True):
                        rows.append((key, langs[p.text[k]], raw[p.begin[k] : p.end[k + n - 1]].decode(), n, ids[p.text[k]], int(word[k])))
                if rows:
                    yield as_batch(rows)
        if total:
            yield as_batch([(n, lang, "", 0, None, None) for lang, n in total.items()])

    return docs.mapInArrow(run, TEXTS)


TEXTS = "key long, lang string, phrase string, words int, doc_id long, word long"


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split(" ")[0] for c in TEXTS.split(", ")])


def placed(batch: pa.RecordBatch, total: dict[str, int], bits: int) -> Iterator[tuple]:
    """Of every block: fingerprints, languages and ids from its first text on, the number of each word within its text. total
    counts the words of each language."""
    langs, ids = [x or "und" for x in batch.column(1).to_pylist()], batch.column(2).to_pylist()
    row, words = -1, 0  # of a long text in blocks: words before this one
    for at, p in runs(batch, bits):
        words = words if row == at + p.text[0] else 0
        last = p.text[p.own - 1]
        row = at + int(last)
        word = np.arange(len(p.text)) - np.searchsorted(p.text, p.text) + words * (p.text == p.text[0])
        per = np.bincount(p.text[: p.own])
        for k in np.flatnonzero(per).tolist():
            total[langs[at + k]] = total.get(langs[at + k], 0) + int(per[k])
        yield p, langs[at:], ids[at:], word
        words = (words if p.text[0] == last else 0) + int(per[-1])


def ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers begin, begin + 1, … of each range in a row, and where each range starts among them."""
    start = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(begin - start[:-1], size) + np.arange(start[-1]), start[:-1]


def same_bytes(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the bytes of x from a and of y from b on are the same, for size bytes each."""
    out = np.ones(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        own, start = ranges(a[part], size[part])
        out[part] = np.add.reduceat(x[own] != y[ranges(b[part], size[part])[0]], start) == 0
    return out


class Phrases:
    """Phrases of a worker with their counts: the text of each stands in a store, and every further occurrence of its
    fingerprint is compared to it."""

    NUMBERS = ("size", "words", "n", "doc", "word")

    def __init__(self):
        self.keys, self.at = np.empty(0, U), np.empty(0, np.int64)  # sorted fingerprints, and their places in what follows
        self.store, self.begin, self.salt, self.key = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, U), np.empty(0, U)
        self.size, self.words, self.n, self.doc, self.word = (np.empty(0, np.int64) for _ in self.NUMBERS)

    def add(self, p: Prints, first: np.ndarray, keys: np.ndarray, words: int, doc: np.ndarray, word: np.ndarray) -> None:
        """Occurrences at the words `first` of a block: their fingerprints, length, documents and numbers within them."""
        while len(first):
            kinds, pointer, where = np.unique(keys, return_index=True, return_inverse=True)
            begin, size, salt = p.begin[first], p.end[first + words - 1] - p.begin[first], p.salt[first]
            alike = (size == size[pointer][where]) & (salt == salt[pointer][where])
            alike[alike] = same_bytes(p.packed, begin[alike], p.packed, begin[pointer][where][alike], size[alike])
            self.count(p.packed, kinds, begin[pointer], size[pointer], salt[pointer], words, np.bincount(where[alike], minlength=len(kinds)), doc[pointer], word[pointer])
            first, keys, doc, word = first[~alike], keys[~alike], doc[~alike], word[~alike]  # other texts with the same fingerprints

    def count(self, packed: np.ndarray, kinds: np.ndarray, begin: np.ndarray, size: np.ndarray, salt: np.ndarray, words: int, n: np.ndarray, doc: np.ndarray, word: np.ndarray) -> None:
        new = np.ones(len(kinds), bool)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, kinds), len(self.keys) - 1)
            new = self.keys[place] != kinds
            row = self.at[place]
            same = ~new & (self.size[row] == size) & (self.salt[row] == salt)
            same[same] = same_bytes(self.store, self.begin[row[same]], packed, begin[same], size[same])
            self.n[row[same]] += n[same]
        else:
            same = np.zeros(len(kinds), bool)
        if same.all():
            return
        rest = ~same
        take, start = ranges(begin[rest], size[rest])
        number = len(self.n) + np.arange(rest.sum())
        self.begin, self.salt, self.key = (np.concatenate(x) for x in ((self.begin, len(self.store) + start), (self.salt, salt[rest]), (self.key, kinds[rest])))
        self.store = np.concatenate([self.store, packed[take]])
        for name, values in zip(self.NUMBERS, (size, np.full(len(kinds), words), n, doc, word), strict=True):
            setattr(self, name, np.concatenate([getattr(self, name), values[rest]]))
        every = np.concatenate([self.keys, kinds[new]])  # a text whose fingerprint is taken stays beside the index
        order = np.argsort(every)
        self.keys, self.at = every[order], np.concatenate([self.at, number[new[rest]]])[order]


NO_ID = -(1 << 63)


def exact_counts(docs: DataFrame, known: Broadcast, shared: Broadcast, least: int, bits: int = 64) -> DataFrame:
    """lang, phrase, words, n, doc_id, word, keys of the phrases with a shared fingerprint, counted by their texts."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = Phrases(), {}

        def rows() -> pa.RecordBatch:
            raw = held.store.tobytes()
            found = [raw[b : b + s].decode() for b, s in zip(held.begin.tolist(), held.size.tolist(), strict=True)]
            columns = [pa.array(held.key.view(np.int64)), pa.array([names[x] for x in held.salt.tolist()], pa.string()), pa.array(found, pa.string()), pa.array(held.words.astype("i4")), pa.array(held.doc, mask=held.doc == NO_ID), pa.array(held.word), pa.array(held.n)]
            return pa.RecordBatch.from_arrays(columns, names=["key", "lang", "phrase", "words", "doc_id", "word", "n"])

        for batch in stream:
            langs = [x or "und" for x in batch.column(1).to_pylist()]
            names.update(zip(salts(langs).tolist(), langs, strict=True))
            for p, _, ids, word in placed(batch, {}, bits):
                ids = np.array([NO_ID if x is None else x for x in ids[: p.text[-1] + 1]], np.int64)
                for n in range(1, LONGEST + 1):
                    first = p.whole(n) if n == 1 else p.frequent(n, known.value, n - 1)
                    keys = p.of(first, n)
                    kept = bitmap.holds(shared.value, keys)
                    first, keys = first[kept], keys[kept]
                    held.add(p, first, keys, n, ids[p.text[first]], word[first])
                if len(held.n) > MOST_PHRASES:
                    yield rows()
                    held = Phrases()
        yield rows()

    sums = docs.mapInArrow(run, TEXTS + ", n long").groupBy("key", "lang", "phrase", "words").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "word")).alias("at"))
    return sums.where(F.col("n") >= least).select("key", "lang", "phrase", "words", "n", "at.doc_id", "at.word")


def phrase_counts(docs: DataFrame, frequent: DataFrame, least: int, bits: int = 64) -> DataFrame:
    """lang, phrase, words, n, doc_id, word of every phrase of up to LONGEST words that occurs least times or more: exact counts, and one
    occurrence (a document and the number of the word within it). The row of no words has the number of all words of a language."""
    known = bitmap.broadcast_bits(frequent, frequent.count())
    pointing = bitmap.broadcast_bits(pointers(frequent), frequent.count())
    told, _ = settle(texts(docs, known, pointing, bits), "texts")
    pointing.unpersist()
    total = told.where("words = 0").groupBy("lang").agg(F.sum("key").alias("n"))
    total = total.select("lang", F.lit("").alias("phrase"), F.lit(0).alias("words"), "n", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("word"))
    one = told.where("words > 0").groupBy("key").agg(F.min(F.struct("lang", "phrase", "words", "doc_id", "word")).alias("t"), F.max(F.struct("lang", "phrase")).alias("last"))
    met = frequent.join(one, "key").withColumn("shared", (F.col("low") != F.col("high")) | (F.col("t.lang") != F.col("last.lang")) | (F.col("t.phrase") != F.col("last.phrase")))
    met, _ = settle(met, "met")
    out = total.unionByName(met.where("NOT shared").select("t.lang", "t.phrase", "t.words", "n", "t.doc_id", "t.word"))
    shared = met.where("shared").select("key")
    if n := shared.count():
        again = bitmap.broadcast_bits(shared, n)
        found, _ = settle(exact_counts(docs, known, again, least, bits), "exact")
        again.unpersist()
        out = out.unionByName(found.join(shared, "key", "left_semi").drop("key"))
    known.unpersist()
    return out


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score (of the lowest-scoring cut), doc_id, word of the phrases of two words and more."""
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    total = phrases.where("words = 0").select("lang", F.col("n").alias("total"))
    held = phrases.where("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    w = F.split("phrase", " ")
    cut = phrases.where("words > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    join = lambda first, n: F.array_join(F.slice(w, first, n), " ")
    cut = cut.withColumn("left", join(F.lit(1), F.col("k"))).withColumn("right", join(F.col("k") + 1, F.col("words") - F.col("k")))
    cut = cut.join(held.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(held.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cut = cut.withColumnRenamed("n", "a").join(total, "lang").withColumnRenamed("total", "n")
    cut = cut.withColumn("thousand", (F.col("a") * 1000).cast("decimal(18,0)"))
    score = F.expr("CAST(thousand * CAST(n AS DECIMAL(18,0)) AS DECIMAL(38,0)) div CAST(CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)) AS DECIMAL(38,0))")
    least = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "words", "doc_id", "word")).alias("c"))
    return least.select("lang", "phrase", "c.words", "c.a", "c.l", "c.r", "c.n", "c.score", "c.doc_id", "c.word")


def outermost(scores: DataFrame) -> DataFrame:
    """Without phrases that lie inside a longer one of at least the same count."""
    w = F.split("phrase", " ")
    inner = F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    inside = scores.where("words > 2").withColumn("w", w).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return scores.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a").drop("longer")


def first_rows(scores: DataFrame, most: int) -> DataFrame:
    """rank, and the columns of scores, of each language's first rows, by way of the first rows of 64 parts of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = scores.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= most).drop("__part", "rank")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_ROWS, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, and one occurrence (doc_id, word), of the first phrases of each language. docs: text, lang, doc_id.
    bits: of the fingerprints (fewer make more work and the same result)."""
    spark = docs.sparkSession
    src = spread(docs.select(F.col("text"), F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id")))
    paths, frequent, known = [], None, None
    for lengths in ([1], [2], [3], [4, 5]):
        found, path = settle(frequent_prints(src, lengths, known, least, bits), "prints")
        paths.append(path)
        if known:
            known.unpersist()
        known = bitmap.broadcast_bits(found, found.count())
        frequent = found if frequent is None else frequent.unionByName(found)
    known.unpersist()
    phrases, _ = settle(phrase_counts(src, frequent, least, bits), "phrases")
    for path in paths:
        discard(spark, path)
    scores, _ = settle(scored(phrases), "scores")
    return first_rows(outermost(scores), most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id", "word")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the occurrence, of which any would do."""
    return collocations(table(spark, sf_dir, "documents")).drop("doc_id", "word")


_NGRAMS = " UNION ALL ".join(f"SELECT lang, array_to_string(w[i:i + {n - 1}], ' ') AS phrase, {n} AS words FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM piece WHERE len(w) >= {n})" for n in range(1, LONGEST + 1))
OP12_SQL = f"""WITH part AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
piece AS (SELECT lang, [x for x in regexp_split_to_array(p, '[\\x20\\x09]+') if x <> ''] AS w FROM part),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY 1),
f AS (SELECT lang, phrase, words, count(*) AS f FROM ({_NGRAMS}) GROUP BY ALL HAVING count(*) >= {LEAST}),
cut AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM f WHERE words > 1),
cs AS (SELECT c.lang, c.phrase, c.words, c.k, c.f AS a, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score FROM cut c JOIN total USING (lang)
 JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM cs QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT s.lang, s.phrase FROM best s JOIN (SELECT lang, a, words, string_split(phrase, ' ') AS w FROM best) b ON b.lang = s.lang AND b.words > s.words AND b.a >= s.a AND contains(' ' || array_to_string(b.w, ' ') || ' ', ' ' || s.phrase || ' ')),
rest AS (SELECT * FROM best ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM rest) WHERE rank <= {MOST_ROWS}"""
