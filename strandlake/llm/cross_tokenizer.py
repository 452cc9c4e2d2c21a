"""Alignment of two tokenizers' tokens by byte ranges, over texts of any length.

Byte offsets at which tokens of both end cut a text into groups. A stretch of text between two cuts can be encoded by itself: a single
blank between two characters that are no white space begins a new token in both tokenizers (cuttable() looks at their
rules; where they differ, a whole text is one stretch). Stretches with their leading blank are what workers encode, align and
remember: closed groups.

1. Texts of more than CHUNK characters are cut into chunks, rows of their own that are dealt over tasks. A chunk is a fragment: an open prefix
   up to its first cut, closed groups, an open suffix after its last cut. compose() of two fragments closes the
   suffix of the first with the prefix of the second; it is associative, so fragments meet FAN at a time in rounds of a tree, and only their
   open ends travel. What closes there is a part of the text like the closed parts of chunks and like whole short texts.
2. First reading: pairs of overlapping tokens of each distinct stretch times its occurrences, added up in workers and by Spark.
3. The most frequent pairs (HOT at most, found by a histogram of counts) are broadcast with their counts. In the second reading parts
   sum them up; the others leave as pairs and are joined. Sums and strings of a text's parts are put together in
   order; short texts are whole at once.

Defined results: null and empty texts have no tokens, nor have texts whose token bytes are not those of blank + text
(U+2581 in the second tokenizer): zeros and an empty digest, and their pairs count nowhere. Repeated rows and null ids are documents of their
own. An empty table gives an empty result. Other columns are ignored, whatever their names. The strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.text import table, whole
from strandlake.session import settle, spread

CHUNK, FAN, HOT = 1 << 16, 16, 1 << 20
#: Bytes of texts that a worker aligns together; stretches and their characters that it remembers.
RUN, KEPT, KEPT_CHARS = 1 << 22, 500_000, 1 << 25
#: Stretches that are encoded together.
TOGETHER = 200
CUT = re.compile(r"(?<=\S) (?=\S)")
LATIN = re.compile("[\x00-\u024f]*").fullmatch
#: Fixed value: how byte-level vocabularies of this family part words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "cold", "bad")
BLANK = "▁"


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def cuttable(a: object, b: object) -> bool:
    """Whether both tokenizers begin a new token at every CUT and nothing before it changes what follows."""
    spec = json.loads(a.to_str())
    pre = spec["pre_tokenizer"] or {}
    first = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    across = re.compile(f"[^{BLANK}]{BLANK}").search
    second = b.normalize("a  b ﬁ") == f"{BLANK}a{BLANK}{BLANK}b{BLANK}ﬁ" and not any(across(b.id_to_piece(k)) for k in range(b.get_piece_size()))
    return bool(first and second)


def ranked(a: object, token_bytes: list[bytes], special: set[int]) -> dict[bytes, int] | None:
    """Ids by token bytes, where they are also the order of the merges: then the pair with the least id merges first, as it does by the
    list of merges, and a library that knows ids alone gives the same. None where they are not."""
    spec = json.loads(a.to_str())
    model, of = spec["model"], byte_level()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get(x + y, -1) for x, y in merges]
    alone = all(model["vocab"].get(c, 1 << 30) < min(made, default=0) for c in of)
    if not alone or made != sorted(set(made)) or len(made) + 256 + len(special) != len(token_bytes) or model.get("ignore_merges") or model.get("dropout"):
        return None
    return {t: k for k, t in enumerate(token_bytes) if k not in special}


class Aligner:
    """Tokens, groups and links of stretches of text."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        cut = cuttable(self.a, self.b)
        self.split = CUT.split if cut else lambda text: [text]
        of = byte_level()
        special = {t["id"] for t in json.loads(self.a.to_str())["added_tokens"]}
        names = [self.a.id_to_token(k) for k in range(self.a.get_vocab_size())]
        self.a_bytes = [t.encode() if k in special else bytes(of[c] for c in t) for k, t in enumerate(names)]
        pieces = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace(BLANK, " ").encode() for k in pieces]
        ranks = ranked(self.a, self.a_bytes, special) if cut else None
        self.fast = Encoding("pairs", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.a_len, self.b_len = (np.array([*map(len, x)]) for x in (self.a_bytes, self.b_bytes))
        n = len(self.a_bytes)
        ids = [str(k).encode() for k in range(max(n, len(self.b_bytes)))]
        self.ends = [x + s for s, size in ((b",", n), (b"|", n), (b",", len(self.b_bytes)), (b";", len(self.b_bytes))) for x in ids[:size]]

    def sorted(self, units: list[str]) -> tuple[list[str], list[str], list[str]]:
        """Stretches of Latin letters and signs, others, and those that are empty or have white space at an end."""
        firm = [u for u in units if u and u == u.strip()]
        edge = [u for u in units if not u or u != u.strip()]
        latin = [u for u in firm if u.isascii() or LATIN(u)] if self.fast else []
        return latin, [u for u in firm if not (u.isascii() or LATIN(u))] if self.fast else firm, edge

    def tokens(self, latin: list[str], firm: list[str], edge: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both tokenizers for the stretches in a row. Those without white space at their ends are encoded together
        with a blank between, as each begins new tokens; Latin ones by the faster library."""
        joined = lambda units: [" ".join(units[k : k + TOGETHER]) for k in range(0, len(units), TOGETHER)]
        fast, texts = joined(latin), [*joined(firm), *edge]
        a = [self.fast.encode_ordinary(" " + t) for t in fast] + [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = self.b.encode(fast + texts, num_threads=1)
        return tuple(np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in ids)]) for ids in (a, b))

    def whole(self, a: np.ndarray, b: np.ndarray, raw: bytes) -> bool:
        return all(b"".join(map(of.__getitem__, ids.tolist())) == raw for of, ids in ((self.a_bytes, a), (self.b_bytes, b)))

    def learn(self, units: list[str], with_groups: bool = True) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Of stretches (without the leading blank), which come back in another order: counts by FIELDS (links in no table yet), pairs of
        all links in a row, how many are each one's, and its groups, each followed by ;."""
        kinds = self.sorted(units)
        units = [*chain.from_iterable(kinds)]
        raw = [b" " + u.encode() for u in units]
        a, b = self.tokens(*kinds)
        good = np.ones(len(units), bool)
        if not self.whole(a, b, b"".join(raw)):  # some are not what their tokens spell: told apart one by one
            good = np.array([self.whole(*self.tokens(*self.sorted([u])), x) for u, x in zip(units, raw, strict=True)], bool)
            a, b = self.tokens(*self.sorted([u for u, g in zip(units, good.tolist(), strict=True) if g]))
        stops = np.cumsum(np.where(good, [*map(len, raw)], 0))
        end_a, end_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=-1) > 0]
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        pairs = a[at_a] << 32 | b[at_b]
        cuts = ends[(end_a[at_a] == ends) & (end_b[at_b] == ends)]
        counts = np.zeros((len(units), len(FIELDS)), np.int64)
        for k, sorted_ends in enumerate((end_a, end_b, cuts, ends)):
            counts[:, k] = np.diff(np.searchsorted(sorted_ends, stops, "right"), prepend=0)
        counts[:, 7] = ~good
        if not with_groups:
            return units, counts, pairs, counts[:, 3], []
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n = len(self.a_bytes)
        codes = np.concatenate([a + n * (cuts[group_a] == end_a), b + 2 * n + len(self.b_bytes) * (cuts[group_b] == end_b)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        strings = [*map(self.ends.__getitem__, codes[order].tolist())]
        text, size = b"".join(strings), np.array([*map(len, strings)], np.int64)
        to = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts[:, 0] + counts[:, 1])].tolist()
        return units, counts, pairs, counts[:, 3], [text[s:e] for s, e in zip([0, *to], to)]


class Known:
    """Stretches that a worker has aligned, numbered: their counts, pairs and groups."""

    def __init__(self, aligner: Aligner, hot: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        self.aligner, self.hot = aligner, hot
        self.clear()

    def clear(self) -> None:
        self.index, self.chars, self.counts = {}, 0, np.zeros((0, len(FIELDS)), np.int64)
        self.pairs, self.n_pairs, self.groups, self.cold = [], [], [], {}

    def full(self) -> bool:
        return len(self.index) > KEPT or self.chars > KEPT_CHARS

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the stretches of all texts in a row, and where each text's begin."""
        lists = [*map(self.aligner.split, texts)]
        index = self.index
        new = [u for u in set().union(*lists) if u not in index]
        if new:
            new, counts, pairs, n_pairs, groups = self.aligner.learn(new, self.hot is not None)
            first = len(index)
            index.update(zip(new, range(first, first + len(new)), strict=True))
            self.chars += sum(map(len, new))
            if self.hot is None:
                self.pairs.append(pairs)
                self.n_pairs.append(n_pairs)
            else:
                self.groups += groups
                self.weigh(counts, pairs, n_pairs, first)
            self.counts = np.concatenate([self.counts, counts])
        flat = np.fromiter(map(index.__getitem__, chain.from_iterable(lists)), np.int64)
        return flat, np.cumsum([0, *map(len, lists)])[:-1]

    def weigh(self, counts: np.ndarray, pairs: np.ndarray, n_pairs: np.ndarray, first: int) -> None:
        """Adds count_sum and n_best over the pairs of the table, and keeps the others."""
        keys, n, best = self.hot
        unit = np.repeat(np.arange(len(n_pairs)), n_pairs)
        at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
        found = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
        np.add.at(counts[:, 5], unit[found], n[at[found]])
        np.add.at(counts[:, 4], unit[found], best[at[found]])
        np.add.at(counts[:, 6], unit[~found], 1)
        rest = pairs[~found]
        of = unit[~found]
        for u in np.unique(of).tolist():
            self.cold[first + u] = rest[np.searchsorted(of, u) : np.searchsorted(of, u, "right")]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows with about RUN characters of text (last column), or a single longer text."""
    size = np.cumsum([len(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + RUN, "right")))
        yield batch.slice(at, to - at)
        at = to


# --- fragments of long texts ------------------------------------------------------------------------

Fragment = tuple[int, str, str]  # the first chunk with a cut (-1: none), the open prefix (the whole, if none), the open suffix


def fragment(number: int, text: str) -> tuple[Fragment, str | None]:
    """The fragment of a chunk, and its closed part (None: a single cut or none)."""
    cuts = [m.start() for m in CUT.finditer(text)]
    if not cuts:
        return (-1, text, ""), None
    first, last = cuts[0], cuts[-1]
    return (number, text[:first], text[last + 1 :]), text[first + 1 : last] if first < last else None


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, tuple[int, str] | None]:
    """The fragment of two neighbours, and what closes between them: (the chunk before whose closed part it stands, text)."""
    if y[0] < 0:
        return ((x[0], x[1] + y[1], "") if x[0] < 0 else (x[0], x[1], x[2] + y[1])), None
    if x[0] < 0:
        return (y[0], x[1] + y[1], y[2]), None
    return (x[0], x[1], y[2]), (y[0], x[2] + y[1])


def long_parts(chunks: DataFrame) -> DataFrame:
    """row, pos, text: the parts of long texts, from their chunks (row, chunk, text), to be encoded each by itself."""
    kinds = "row long, chunk long, pos long, cut long, prefix string, suffix string"  # pos: null for a fragment; else a part, prefix its text

    def begin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for row, chunk, text in zip(f["row"], f["chunk"], f["text"], strict=True):
                (cut, prefix, suffix), closed = fragment(chunk, text)
                rows.append((row, chunk, None, cut, prefix, suffix))
                if closed is not None:
                    rows.append((row, chunk, 2 * chunk, None, closed, None))
            yield frame(rows)

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for row, chunk, listed in zip(f["row"], f["chunk"], f["l"], strict=True):
                whole = None
                for x in listed:
                    one = (x["cut"], x["prefix"], x["suffix"])
                    whole, closed = (one, None) if whole is None else compose(whole, one)
                    if closed:
                        rows.append((row, chunk, 2 * closed[0] - 1, None, closed[1], None))
                rows.append((row, chunk, None, *whole))
            yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["row", "chunk", "pos", "cut", "prefix", "suffix"]).astype({"row": "int64", "chunk": "int64", "pos": "Int64", "cut": "Int64"})

    made, _ = settle(chunks.mapInPandas(begin, kinds), "fragments")
    parts = made.where("pos IS NOT NULL")
    level = made.where("pos IS NULL")
    while (level.agg(F.max("chunk")).first()[0] or 0) > 0:
        near = level.groupBy("row", F.floor(F.col("chunk") / FAN).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("chunk", "cut", "prefix", "suffix"))).alias("l"))
        made, _ = settle(near.mapInPandas(meet, kinds), "fragments")
        parts, level = parts.unionByName(made.where("pos IS NOT NULL")), made.where("pos IS NULL")
    ends = level.select("row", F.explode(F.when(F.col("cut") < 0, F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.col("prefix").alias("text")))).otherwise(F.array(F.struct((2 * F.col("cut") - 1).alias("pos"), F.col("prefix").alias("text")), F.struct(F.lit(2**62).alias("pos"), F.col("suffix").alias("text"))))).alias("e"))
    return parts.select("row", "pos", F.col("prefix").alias("text")).unionByName(ends.select("row", "e.pos", "e.text"))


# --- readings ---------------------------------------------------------------------------------------


def broken(parts: DataFrame, files: tuple[str, str]) -> DataFrame:
    """row of long texts with a part whose token bytes are not its own."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(aligner(*files))
        for batch in stream:
            for part in slices(batch):
                numbers, begin = known.numbers(part.column(1).to_pylist())
                bad = np.add.reduceat(known.counts[numbers, 7], begin) > 0
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(bad))], names=["row"])
                if known.full():
                    known.clear()

    return parts.select("row", "text").mapInArrow(run, "row long").distinct()


def pair_counts(texts: DataFrame, files: tuple[str, str]) -> DataFrame:
    """pair (first id in the high 32 bits), n: how many links hold it. Texts that fail the byte check count nothing."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = Known(aligner(*files)), np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            n_pairs = np.concatenate([np.zeros(0, np.int64), *known.n_pairs])
            pairs, where = np.unique(np.concatenate([np.zeros(0, np.int64), *known.pairs]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, where, np.repeat(seen, n_pairs))
            return pa.RecordBatch.from_arrays([pa.array(pairs[n > 0]), pa.array(n[n > 0])], names=["pair", "n"])

        for batch in stream:
            for part in slices(batch):
                numbers, begin = known.numbers(part.column(0).to_pylist())
                good = np.add.reduceat(known.counts[numbers, 7], begin) == 0
                good = np.repeat(good, np.diff(np.append(begin, len(numbers))))
                now = np.bincount(numbers[good], minlength=len(known.index))
                now[: len(seen)] += seen
                seen = now
                if known.full():
                    yield rows()
                    known.clear()
                    seen = np.zeros(0, np.int64)
        yield rows()

    return texts.select("text").where("text <> ''").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def split_pairs(counts: DataFrame, most: int) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs with n and best (1: no pair of its second id has more), less those that stand in the arrays of the `most` or fewer most frequent.

    A histogram of counts in eighths of powers of two finds the least count of these; there is a row for each id of the second vocabulary in the join."""
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    top = counts.groupBy(second).agg(F.max("n").alias("top"))
    bin_of = F.floor(8 * F.log2("n"))
    pairs, _ = settle(counts.select("*", second).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"), bin_of.alias("bin")), "pairs")
    least, total = 1 << 30, 0
    for b, n in sorted(pairs.groupBy("bin").count().collect(), reverse=True):
        total += n
        if total > most:
            break
        least = b
    hot = pairs.where(F.col("bin") >= least).toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    return pairs.where(F.col("bin") < least), tuple(hot.column(c).to_numpy()[order] for c in ("pair", "n", "best"))


ALIGNED = "row long, pos long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, digest string, groups binary, cold array<long>"


def aligned(texts: DataFrame, files: tuple[str, str], hot: object, digests: bool) -> DataFrame:
    """ALIGNED of every row (row, pos, text): counts, with n_best and count_sum over the broadcast pairs, the other pairs (cold, one entry a link), and the digest of
    the groups or the groups themselves."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(aligner(*files), hot.value)
        for batch in stream:
            for part in slices(batch):
                texts = [t or "" for t in part.column(2).to_pylist()]
                numbers, begin = known.numbers(texts)
                to = np.append(begin, len(numbers))[1:]
                sums = np.add.reduceat(known.counts[numbers], begin)
                sums[(sums[:, 7] > 0) | np.array([not t for t in texts])] = 0
                strings, colds, groups = [], [], known.groups.__getitem__
                for s, e, cold, any_tokens in zip(begin.tolist(), to.tolist(), sums[:, 6].tolist(), (sums[:, 0] > 0).tolist(), strict=True):
                    own = numbers[s:e].tolist()
                    strings.append(b"".join(map(groups, own)) if any_tokens else b"")
                    colds.append(np.concatenate([known.cold[u] for u in own if u in known.cold]) if cold else None)
                digest = [hashlib.sha256(x[:-1]).hexdigest() if x else "" for x in strings] if digests else None
                n = part.num_rows
                columns = [part.column(0), part.column(1), *(pa.array(sums[:, k]) for k in range(6)), pa.array(digest or [None] * n, pa.string()), pa.array([None] * n if digests else strings, pa.binary()), pa.array(colds, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "pos", *FIELDS[:6], "digest", "groups", "cold"])
                if known.full():
                    known.clear()

    return texts.select("row", "pos", "text").mapInArrow(run, ALIGNED)


def streamed_digest(parts: DataFrame) -> DataFrame:
    """row, digest of the groups of all parts in order. Rows are dealt and sorted by text; a task holds one part at a time."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, digest, begun = None, None, False
        for batch in stream:
            done: list[tuple[int, str]] = []
            for r, g in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if r != row:
                    if row is not None:
                        done.append((row, digest.hexdigest() if begun else ""))
                    row, digest, begun = r, hashlib.sha256(), False
                if g:
                    digest.update(b";" + g[:-1] if begun else g[:-1])
                    begun = True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["row", "digest"])
        if row is not None:
            yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([digest.hexdigest() if begun else ""])], names=["row", "digest"])

    return parts.select("row", "pos", "groups").repartition("row").sortWithinPartitions("row", "pos").mapInArrow(run, "row long, digest string")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark, files = docs.sparkSession, (a_path, b_path)
    src = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))).withColumn("row", F.monotonically_increasing_id())
    is_long = F.length("text") > chunk
    short = src.where(~is_long)
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    chunks, _ = settle(src.where(is_long).select((-1 - F.col("row")).alias("row"), "doc_id", F.posexplode(cut).alias("chunk", "text")).withColumn("chunk", F.col("chunk").cast("long")).repartition(F.col("row"), F.col("chunk")), "chunks")
    parts, _ = settle(long_parts(chunks.select("row", "chunk", "text")).repartition(F.col("row"), F.col("pos")), "parts")
    bad, _ = settle(broken(parts, files), "broken")
    parts = parts.join(bad, "row", "left_anti")

    counts = pair_counts(short.select("text").unionByName(parts.select("text")), files)
    cold, table_of_hot = split_pairs(counts, hot)
    sent = spark.sparkContext.broadcast(table_of_hot)
    own = ["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    done, _ = settle(aligned(short.select("row", F.col("doc_id").alias("pos"), "text"), files, sent, True), "aligned")  # whole texts need no pos
    pieces, _ = settle(aligned(parts, files, sent, False), "pieces")
    sent.unpersist()
    others = done.select("row", "cold").unionByName(pieces.select("row", "cold")).select("row", F.explode("cold").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("k"))
    more = others.join(cold, "pair").groupBy("row").agg(F.sum(F.col("k") * F.col("best")).alias("more_best"), F.sum(F.col("k") * F.col("n")).alias("more_sum"))
    more, _ = settle(more, "cold")
    sums = pieces.groupBy("row").agg(*(F.sum(c).alias(c) for c in own[1:])).join(streamed_digest(pieces), "row")
    long_ones = chunks.where("chunk = 0").select("row", "doc_id").join(sums, "row", "left").select("doc_id", *own, "digest")
    every = done.select(F.col("pos").alias("doc_id"), *own, "digest").unionByName(long_ones).join(more, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    total = {"n_best": zero("n_best") + zero("more_best"), "count_sum": zero("count_sum") + zero("more_sum")}
    return every.select("doc_id", *(total.get(c, zero(c)).alias(c) for c in own[1:]), F.coalesce("digest", F.lit("")).alias("groups_sha256"))


def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
