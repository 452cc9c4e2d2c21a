"""Near-duplicate passages: compact windows of several min-hashes, joined on their intervals, then verified.

A text is its sequence of 5-word shingles. For a hash, the Cartesian tree over the hashes of the sequence groups
all subsequences that share their least element: each element that is least in some window of RUN shingles owns
one compact window, which reaches to the next lesser element on either side. Where the windows of HASHES hashes
overlap in RUN shingles or more, their intersection is one window with one key: all subsequences in it that hold
the minima have the same HASHES minima. Two texts with RUN shingles (21 words) in a row in common share a key for
certain; others by chance, a window of similarity s with probability s ** HASHES. Stretches of PASSAGE words or
more, similar by 0.8 and without a 4-word sequence that repeats inside them, have 21 shingles in a row in common:
a place where they part costs four shingles or more on each side, so c common shingles allow c / 32 such places
(one up to 63).

Steps:
1. Equal word sequences are one text. Keys that two texts hold, or one text at places apart, are found by the least and
   the greatest holder of each (combined before they travel; no list of holders).
2. The texts are read again; a bit map lets through the windows whose keys are repeated. It takes KEY_BITS bits a
   key; with more than MOST_KEYS keys there is none, and all windows go on (more rows, the same result).
3. Star: each holder of a key meets the first holder, the leader. The intervals are joined: the windows of both are
   laid over each other at their minima, and their intersections, over all keys that the two texts share, bound the
   stretches of shingles that travel to the verification. There is one row for a pair of texts.
4. The rest: places where the leader of their key has no passage near them. Each meets all holders of its key, in blocks; the
   shingles around the places are laid over each other, and the first holder that agrees is verified. Then classes are
   found, and places with further holders that agree meet again those that have no class in common with them, until
   every holder that agrees is in a class of the place or has been verified with it. No partner is left out. Holders of
   poor texts (a few shingles again and again) may agree by place and share too few distinct shingles for any passage
   there: they are verified at once if they meet at several places, as longer stretches may do, and need not be else.
5. Passages that overlap in a text are one region; linked regions are one class.

Result: a row for each passage found, from either side, with its class; a row for each further copy of a whole text.
Copies and near copies stay linear: each place is linked to its leader or to one partner of a class; all texts that
agree with it over a key are verified with it or in one class with it.

Defined results: null and empty texts, texts under 50 words and rows with a null id have no passages. Rows that
share an id and a text count once; with other texts they are texts of their own. A passage that repeats inside one
text is reported with match_id = doc_id where the two places do not overlap. An empty table gives an empty result.
Other columns are ignored, whatever their names. Verification compares 32 bits of each shingle's hash. Texts are
told apart by 64 bits.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake import session
from strandlake.llm.components import contracted_components
from strandlake.llm.shingles import U, batches, mix64, shingles, words
from strandlake.llm.text import table
from strandlake.session import discard, spread

WIDTH, PASSAGE, SIMILARITY = 5, 50, 0.8
SPAN = PASSAGE - WIDTH + 1  # shingles of the shortest passage
#: Shingles of the shortest window, and min-hashes that it must share.
RUN, HASHES = 17, 3
#: Bits of the map for each repeated key (a wrong key in a thousand gets through), and most keys that have a map.
KEY_BITS, MOST_KEYS = 20, 1 << 23
PROBES = 7
#: Parts that keys are dealt to (a power of two), and windows of a task that are combined before they travel.
PARTS, MOST_HELD = 1 << 12, 1 << 20
#: Holders of a key in a block.
BLOCK = 2048
#: No classes, no texts.
NONE = "CAST(array() AS array<long>)"
_PLACE = U((1 << 28) - 1)
_ODD = np.random.default_rng(20240613).integers(1, 2**63, HASHES, dtype=U) | U(1)


def settle(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As session.settle(); what was shuffled for the table is removed once it is written, not when the driver's memory is cleared."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return session.settle(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def ranked(x: np.ndarray, q: int) -> np.ndarray:
    """Hash q of every shingle with its place in the low bits: no two are equal."""
    return ((x * _ODD[q]) & ~_PLACE) | np.arange(len(x), dtype=U)


def least_places(packed: np.ndarray, span: int) -> np.ndarray:
    """For every window of `span` places, the place of its least hash."""
    size = 1
    while size < span:
        step = min(size, span - size)
        packed = np.minimum(packed[: len(packed) - step], packed[step:])
        size += step
    return (packed & _PLACE).astype(np.int64)


def nearest_less(v: np.ndarray) -> np.ndarray:
    """Index of the nearest lesser value to the left, -1 where there is none: the left side of a Cartesian tree.

    All values jump over greater ones at once. What lies between a value and its index so far is greater, so
    the index of that index is the next to try."""
    left = np.arange(-1, len(v) - 1)
    open_ = np.arange(1, len(v))
    while len(open_):
        at = left[open_]
        open_ = open_[(at >= 0) & (v[at] > v[open_])]
        left[open_] = left[left[open_]]
    return left


def tree_windows(packed: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the compact window of each of places (ascending, each least in some window).

    The nearest lesser element of one that is least in some window of RUN is such an element itself, so the
    tree need not hold the others."""
    v = packed[places]
    left, right = nearest_less(v), len(v) - 1 - nearest_less(v[::-1])[::-1]
    bounded = np.concatenate([places, [-1]])  # index -1 and len(v) have no lesser element
    first = np.where(left >= 0, bounded[left] + 1, 0)
    last = np.where(right < len(v), bounded[np.minimum(right, len(v))] - 1, len(packed) - 1)
    return first, last


class Batch:
    """Compact windows of all texts of PASSAGE words or more of a batch: text, key, place of the first hash's minimum
    and interval, in shingles from the start of the text; in order of text and place."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.w, self.first = words(flat, offsets)
        n = np.diff(self.first)
        self.long = np.flatnonzero(n >= PASSAGE)
        self.text = self.key = self.c = np.empty(0, np.int64)
        self._minima: list[tuple[np.ndarray, np.ndarray]] = []
        if not len(self.long):
            self.x = np.empty(0, U)
            return
        self.x = shingles(self.w, WIDTH)
        owner = np.repeat(np.arange(len(n)), n)[: len(self.x)]
        starts = np.flatnonzero(((np.arange(len(self.x)) + RUN + WIDTH - 1 <= self.first[1:][owner]) & (n >= PASSAGE)[owner])[: len(self.x) - RUN + 1])
        text = owner[starts]
        turn = text[1:] != text[:-1]
        packed = [ranked(self.x, q) for q in range(HASHES)]
        least = [least_places(p, RUN)[starts] for p in packed]
        for at in least:
            turn |= at[1:] != at[:-1]
        new = np.flatnonzero(np.concatenate([[True], turn]))
        self.text = text[new]
        key = U(HASHES)
        for at in least:
            key = mix64(self.x[at[new]] * U(0x9FB21C651E98DF25) + mix64(key + np.zeros(len(new), U)))
        self.key, self.c = key, least[0][new] - self.first[self.text]
        self._minima = [(p, at[new]) for p, at in zip(packed, least, strict=True)]

    @functools.cached_property
    def intervals(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last shingle of every window: the compact windows of its minima, laid over each other."""
        begin, end = self.first[self.text], self.first[self.text + 1] - WIDTH
        lo, hi = begin, end
        for p, at in self._minima:
            new = np.concatenate([[True], at[1:] != at[:-1]])  # minima of windows in order stand in order
            left, right = tree_windows(p, at[new])
            spot = np.cumsum(new) - 1
            lo, hi = np.maximum(lo, left[spot]), np.minimum(hi, right[spot])
        return lo - begin, hi - begin

    @property
    def l(self) -> np.ndarray:  # noqa: E743
        return self.intervals[0]

    @property
    def r(self) -> np.ndarray:
        return self.intervals[1]

    def ids(self) -> np.ndarray:
        """64 bits that tell the word sequences of the long texts apart."""
        return np.array([xxhash.xxh3_64_intdigest(self.w[self.first[k] : self.first[k + 1]].tobytes()) for k in self.long], U).view(np.int64)

    def apart(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows whose key the same text holds at an earlier place, a passage or more before, and the first such."""
        both = self.key.view(U) + self.text.astype(U) * U(0x9E3779B97F4A7C15)
        ordered = np.sort(both)
        some = np.flatnonzero(np.isin(both, ordered[1:][ordered[1:] == ordered[:-1]]))
        if not len(some):
            return some, some
        order = some[np.lexsort((self.c[some], self.key[some], self.text[some]))]
        t, k = self.text[order], self.key[order]
        same = (t[1:] == t[:-1]) & (k[1:] == k[:-1])
        group = np.concatenate([[0], np.cumsum(~same)])
        head = order[np.searchsorted(group, group)]
        far = self.c[order] - self.c[head] >= SPAN
        return order[far], head[far]


def combined(keys: np.ndarray, holders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, and the least and the greatest holder of each."""
    order = np.argsort(keys)
    keys, holders = keys[order], holders[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[begins], np.minimum.reduceat(holders, begins), np.maximum.reduceat(holders, begins)


def repeated_keys(docs: DataFrame) -> DataFrame:
    """Keys with two holders (32 bits of the text); a key that one text holds at places apart has two.

    Keys travel in runs of one of PARTS parts by their first bits, each with its least and greatest holder of a task's
    MOST_HELD windows, so that a frequent key does not travel with every text."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            keys, lo, hi = combined(*map(np.concatenate, zip(*held, strict=True)))
            n = 1 + (hi > lo)
            keys, holders = np.repeat(keys, n), np.repeat(lo, n)
            holders[np.cumsum(n) - 1] = hi
            part = (keys >> U(64 - PARTS.bit_length() + 1)).astype(np.int32)
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.concatenate([begins, [len(part)]])
            runs = [pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer((ends * v.itemsize).astype(np.int32).tobytes()), pa.py_buffer(v.tobytes())]) for v in (keys, holders)]
            return pa.RecordBatch.from_arrays([pa.array(part[begins]), *runs], names=["part", "keys", "holders"])

        for batch in arrow:
            for _, flat, offsets in batches(batch, 1):
                b = Batch(flat, offsets)
                if len(b.key):
                    holder = np.zeros(len(b.first), np.int64)
                    holder[b.long] = b.ids()
                    h = (holder[b.text] >> 32).astype(np.int32)
                    again, _ = b.apart()
                    held.append((np.concatenate([b.key, b.key[again]]), np.concatenate([h, h[again] ^ 1])))
                    if sum(len(keys) for keys, _ in held) >= MOST_HELD:
                        yield sent()
                        held.clear()
        if held:
            yield sent()

    def met(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        last = None

        def several() -> pa.RecordBatch:
            keys, lo, hi = combined(np.frombuffer(b"".join(k for k, _ in held), U), np.frombuffer(b"".join(h for _, h in held), np.int32))
            return pa.RecordBatch.from_arrays([pa.array(keys[lo < hi].view(np.int64))], names=["key"])

        for batch in arrow:
            for part, *row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if held and part != last:
                    yield several()
                    held.clear()
                last = part
                held.append(tuple(row))
        if held:
            yield several()

    runs = docs.select("doc_id", "text").mapInArrow(run, "part int, keys binary, holders binary")
    return runs.repartition("part").sortWithinPartitions("part").mapInArrow(met, "key long")


def spots(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of the bit map that has all bits of a key, and these."""
    place, bits = mix64(keys) & U(words - 1), np.zeros(len(keys), U)
    pick = mix64(keys + U(1))
    for k in range(PROBES):
        bits |= U(1) << ((pick >> U(6 * k)) & U(63))
    return place, bits


def bit_map(keys: DataFrame, n: int) -> np.ndarray | None:
    """Bit map of n keys, None where they are too many: KEY_BITS * MOST_KEYS bits reach the driver at most."""
    if n > MOST_KEYS:
        return None
    size = (1 << max(20, (n * KEY_BITS - 1).bit_length())) // 64

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            word, bits = spots(f["key"].to_numpy().view(U), size)
            yield pd.DataFrame({"word": word.astype(np.int64), "bit": bits.view(np.int64)})

    rows = keys.select("key").mapInPandas(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size, U)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return out


def known(keys: np.ndarray, held: np.ndarray | None) -> np.ndarray:
    """Indexes of the keys that the bit map lets through."""
    if held is None:
        return np.arange(len(keys))
    word, bits = spots(keys, len(held))
    return np.flatnonzero(held[word] & bits == bits)


TEXTS = "doc_id long, t long, n_words int, keys array<long>, c array<int>, l array<int>, r array<int>, off int, x array<int>, own array<struct<i:int,j:int,i2:int,j2:int,similarity:double>>"


def repeated_texts(docs: DataFrame, held: np.ndarray | None) -> DataFrame:
    """A row for every text of PASSAGE words or more: id, text id, words; where it has windows with repeated keys, these,
    its shingles around them (32 bits of each, from shingle `off` on) and its passages that repeat inside it."""
    shared = docs.sparkSession.sparkContext.broadcast(held)
    found = pa.struct([("i", pa.int32()), ("j", pa.int32()), ("i2", pa.int32()), ("j2", pa.int32()), ("similarity", pa.float64())])
    ints = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("n_words", pa.int32()), ("keys", pa.list_(pa.int64())), ("c", ints), ("l", ints), ("r", ints), ("off", pa.int32()), ("x", ints), ("own", pa.list_(found))])

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            ids = batch.column(0)
            for at, flat, offsets in batches(batch, 1):
                b = Batch(flat, offsets)
                if not len(b.long):
                    continue
                hit = known(b.key, shared.value)
                cuts = np.searchsorted(b.text[hit], np.concatenate([b.long, [len(b.first)]]))
                again, head = b.apart()
                texts, begins = np.unique(b.text[again], return_index=True)
                own = {k: repeats(b.x[b.first[k] : b.first[k + 1] - WIDTH + 1], b.c[one], b.c[two]) for k, one, two in zip(texts.tolist(), np.split(head, begins[1:]), np.split(again, begins[1:]), strict=True)} if len(again) else {}
                rows = []
                for n, (k, t) in enumerate(zip(b.long.tolist(), b.ids().tolist(), strict=True)):
                    begin, end = int(b.first[k]), int(b.first[k + 1])
                    row = {"doc_id": ids[at + k].as_py(), "t": t, "n_words": end - begin, "own": [dict(zip(("i", "j", "i2", "j2", "similarity"), m, strict=True)) for m in own.get(k, [])]}
                    mine = hit[cuts[n] : cuts[n + 1]]
                    if len(mine):
                        _, once = np.unique(b.key[mine], return_index=True)
                        mine = mine[once]
                        off = max(0, int(b.c[mine].min()) - 2 * SPAN)
                        x = b.x[begin + off : min(begin + int(b.c[mine].max()) + 2 * SPAN, end - WIDTH) + 1]
                        row |= {"keys": b.key[mine].view(np.int64), "off": off, "x": (x >> U(32)).astype(np.uint32).view(np.int32)}
                        row |= {name: v[mine].astype(np.int32) for name, v in (("c", b.c), ("l", b.l), ("r", b.r))}
                    if row["doc_id"] is not None:
                        rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, TEXTS)


#: Of SPAN shingles a stretch must share so many for a similarity of SIMILARITY.
NEED = int(np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * SPAN - 1e-9))
#: A longer stretch may reach it where its densest SPAN shingles share fewer (eight lost in the middle of 75).
LOOSE = NEED - 5


def stretches(hit: np.ndarray, match: Callable[[int, int], tuple | None]) -> Iterator[tuple]:
    """What match(first, last) gives for stretches of SPAN places or more that it accepts.

    A run of windows with LOOSE hits or more is tried whole, from its first to its last hit. Failing that,
    its windows by their hits, each grown while the hits suffice: every one that has NEED, then those that
    have fewer until one fails."""
    if len(hit) < SPAN:
        return
    sums = np.concatenate([[0], np.cumsum(hit)])
    at = np.flatnonzero(sums[SPAN:] - sums[:-SPAN] >= LOOSE)
    if not len(at):
        return

    def grown(first: int, last: int, lo: int, hi: int, right: bool) -> tuple[int, int]:
        for way in (right, not right):
            ends = np.arange(last, hi) if way else np.arange(lo, first + 1)
            n = ends - first + 1 if way else last - ends + 1
            c = sums[ends + 1] - sums[first] if way else sums[last + 1] - sums[ends]
            good = ends[hit[ends] & (c >= SIMILARITY * (2 * n - c) - 1e-9)]
            if len(good):
                first, last = (first, int(good[-1])) if way else (int(good[0]), last)
        return first, last

    cuts = np.flatnonzero(np.diff(at) > 1)
    for a, b in zip(at[np.concatenate([[0], cuts + 1])].tolist(), at[np.concatenate([cuts, [len(at) - 1]])].tolist(), strict=True):
        inside = np.flatnonzero(hit[a : b + SPAN]) + a
        first, last = int(inside[0]), int(inside[-1])
        whole = match(first, last) if last - first + 1 >= SPAN else None
        if whole:
            yield whole
            continue
        counts = sums[a + SPAN : b + SPAN + 1] - sums[a : b + 1]
        got: list[tuple[int, int]] = []
        for k in np.argsort(-counts, kind="stable").tolist():
            first, last = a + k, a + k + SPAN - 1
            if any(f <= last and first <= t for f, t in got):
                continue
            bare = match(first, last) if counts[k] >= NEED else None
            if bare or counts[k] < NEED:
                lo, hi = max([a, *(t + 1 for _, t in got if t < first)]), min([b + SPAN, *(f for f, _ in got if f > last)])
                tries = (match(*grown(first, last, lo, hi, right)) for right in (True, False))
                bare = next((m for m in tries if m), bare)
            if bare:
                got.append(bare[:2])
                yield bare
            elif counts[k] < NEED:
                break


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    s, t = set(x.tolist()), set(y.tolist())
    both = len(s & t)
    return both / (len(s) + len(t) - both)


def variety(x: np.ndarray) -> int:
    """The least number of distinct values in SPAN places in a row (SPAN or more places)."""
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    here, before = order[1:][same], order[:-1][same]
    near = here - before < SPAN
    n = len(x) - SPAN + 1
    again = np.bincount(np.maximum(here[near] - SPAN + 1, 0), minlength=n + 1) - np.bincount(np.minimum(before[near] + 1, n), minlength=n + 1)
    return SPAN - int(np.cumsum(again)[:n].max())


def row_variety(m: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """variety() of every row, where places that are not inside differ from all; more than any set has for rows with fewer than
    SPAN places inside."""
    n, width = m.shape
    flat = np.where(inside, m.astype(U) | (np.arange(n, dtype=U)[:, None] << U(32)), (U(1) << U(63)) | np.arange(n * width, dtype=U).reshape(n, width)).ravel()
    order = np.argsort(flat, kind="stable")
    same = flat[order[1:]] == flat[order[:-1]]
    here, before = order[1:][same], order[:-1][same]
    near = here - before < SPAN
    row, here, before, windows = here[near] // width, here[near] % width, before[near] % width, width - SPAN + 1
    cell = row * (windows + 1)
    again = np.bincount(cell + np.maximum(here - SPAN + 1, 0), minlength=n * (windows + 1)) - np.bincount(cell + np.minimum(before + 1, windows), minlength=n * (windows + 1))
    least = SPAN - np.cumsum(again.reshape(n, -1), axis=1)[:, :windows].max(axis=1)
    return np.where(inside.sum(axis=1) < SPAN, 4 * SPAN, least)


def passages(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Stretches of x and y (first and last shingle of each) whose sets are similar, and how similar.

    First along the shifts by which many shingles of x recur in y, then, where a dense stretch of x is
    left, against the stretch of y that its shingles span."""
    if len(x) < SPAN or len(y) < SPAN:
        return []
    order = np.argsort(y, kind="stable")
    ordered = y[order]
    spot = np.minimum(np.searchsorted(ordered, x), len(y) - 1)
    hit = ordered[spot] == x
    if np.count_nonzero(hit) < LOOSE:
        return []
    both = len(np.unique(x[hit]))
    if both < SIMILARITY * SPAN and both < SIMILARITY * max(variety(x), variety(y)) - 1e-9:
        return []  # either stretch of a passage has so many distinct shingles at least, and must share 0.8 of them
    out: list[tuple[int, int, int, int, float]] = []
    taken = np.zeros(len(x), bool)
    at = np.flatnonzero(hit)
    shifts, counts = np.unique(order[spot[at]] - at, return_counts=True)
    for d in shifts[counts >= WIDTH][np.argsort(-counts[counts >= WIDTH], kind="stable")].tolist():
        lo, hi = max(0, -d), min(len(x), len(y) - d)

        def along(first: int, last: int) -> tuple | None:
            first, last = first + lo, last + lo  # noqa: B023
            same = similarity(x[first : last + 1], y[first + d : last + d + 1])  # noqa: B023
            return (first, last, first + d, last + d, same) if same >= SIMILARITY else None  # noqa: B023

        if hi - lo >= SPAN:
            for found in stretches((x[lo:hi] == y[lo + d : hi + d]) & ~taken[lo:hi], along):
                out.append(found)
                taken[found[0] : found[1] + 1] = True

    def spanned(first: int, last: int) -> tuple | None:
        inside = at[(at >= first) & (at <= last)]
        places = order[spot[inside]]
        middle = np.sort(places - inside)[[(len(inside) - 1) // 2, len(inside) // 2]].mean() if len(inside) else 0  # by how much most of the stretch is shifted
        near = places[np.abs(places - inside - middle) <= (last - first + 1) // 4 + WIDTH]
        if not len(near):
            return None
        lo, hi = int(near.min()), int(near.max())
        short = max(0, SPAN - (hi - lo + 1))  # a stretch of y cut back below the least length
        begin, end = max(0, lo - short), min(len(y), hi + short + 1)
        n, own, other = hi - lo + 1 + short, set(x[first : last + 1].tolist()), y[begin:end].tolist()
        if end - begin < n or len(own.intersection(other)) < SIMILARITY * len(own) - 1e-9:
            return None
        counts: dict[int, int] = {}
        best, k, both = 0.0, 0, 0
        for at_, v in enumerate(other):  # a window of n slides over y, its distinct shingles are counted
            counts[v] = counts.get(v, 0) + 1
            both += counts[v] == 1 and v in own
            if at_ >= n:
                gone = other[at_ - n]
                counts[gone] -= 1
                if not counts[gone]:
                    del counts[gone]
                    both -= gone in own
            if at_ >= n - 1 and (same := both / (len(own) + len(counts) - both)) > best:
                best, k = same, at_ - n + 1
        return (first, last, begin + k, begin + k + n - 1, best) if best >= SIMILARITY else None

    out.extend(stretches(hit & ~taken, spanned))
    return out


def repeats(x: np.ndarray, heads: np.ndarray, places: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Passages of one text that repeat in it, from windows (heads) whose keys come again at places. A stretch that
    repeats an earlier one is reported once."""
    x, out = (x >> U(32)).astype(np.uint32), []
    covered = np.zeros(len(x), bool)
    for shift in np.unique(places - heads).tolist():
        at = (places - heads == shift) & ~covered[places]
        one, two = heads[at], places[at]
        if not len(one):
            continue
        a, b = max(0, int(one.min()) - 2 * SPAN), min(len(x) - shift, int(one.max()) + 2 * SPAN + 1)

        def along(first: int, last: int) -> tuple | None:
            first, last = first + a, min(last, first + shift - WIDTH) + a  # noqa: B023 (both sides must not overlap)
            same = similarity(x[first : last + 1], x[first + shift : last + shift + 1]) if last - first + 1 >= SPAN else 0  # noqa: B023
            return (first - a, last - a, same) if same >= SIMILARITY else None  # noqa: B023

        for first, last, similar in stretches((x[a:b] == x[a + shift : b + shift]) & ~covered[a + shift : b + shift], along):
            first, last = first + a, last + a
            out.append((first, last, first + shift, last + shift, similar))
            covered[first + shift : last + shift + 1 + SPAN // 2] = True
    return out


def lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The lists of a column, as views."""
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return (flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True))


PAIR = "a long, b long, open array<int>, found array<struct<i:int,j:int,i2:int,j2:int,similarity:double>>"


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """For every pair of texts (a, b) with its stretches (la, ra, lb, rb) and the places ws of b: passages found, and
    places with none of them near (open)."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.struct([("i", pa.int32()), ("j", pa.int32()), ("i2", pa.int32()), ("j2", pa.int32()), ("similarity", pa.float64())])
        ints = pa.list_(pa.int32())
        for batch in arrow:
            opens, founds = [], []
            names = batch.schema.names
            xs, ys, ws = (lists(batch.column(names.index(k))) for k in ("xa", "xb", "ws"))
            ia, ib = (batch.column(names.index(k)).to_numpy() for k in ("oa", "ob"))
            for oa, ob, x, y, w in zip(ia.tolist(), ib.tolist(), xs, ys, ws, strict=True):
                got = passages(x, y)
                founds.append([{"i": oa + i, "j": oa + j, "i2": ob + i2, "j2": ob + j2, "similarity": s} for i, j, i2, j2, s in got])
                left = w
                for _, _, i2, j2, _ in got:
                    left = left[(left < ob + i2 - SPAN) | (left > ob + j2 + SPAN)]
                opens.append(left)
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(k)) for k in ("a", "b")), pa.array(opens, ints), pa.array(founds, pa.list_(found))], names=["a", "b", "open", "found"])

    def side(k: str) -> tuple[DataFrame, Column, Column]:
        from_ = F.greatest(F.col(f"l{k}") - SPAN - F.col(f"off_{k}"), F.lit(0))
        return texts.select(F.col("t").alias(k), F.col("off").alias(f"off_{k}"), F.col("x").alias(f"x_{k}")), from_, F.col(f"r{k}") + SPAN + 1 - F.col(f"off_{k}") - from_

    for k in ("a", "b"):
        text, from_, n = side(k)
        pairs = pairs.join(text, k).withColumn(f"x{k}", F.slice(f"x_{k}", from_ + 1, F.greatest(n, F.lit(0)))).withColumn(f"o{k}", F.col(f"off_{k}") + from_).drop(f"x_{k}", f"off_{k}")
    return pairs.select("a", "b", "ws", "xa", "xb", "oa", "ob").mapInArrow(run, PAIR)


def star(windows: DataFrame) -> DataFrame:
    """a (leader), b, stretches la, ra, lb, rb and places ws of b, for every text and leader that share a key: the
    intervals of both, laid over each other at their minima, intersect in the stretches."""
    leads = windows.groupBy("key").agg(F.min(F.struct("t", "c", "l", "r")).alias("lead"), F.max("t").alias("hi")).where("lead.t < hi").drop("hi")
    met = windows.join(leads, "key").where("t <> lead.t")
    left, right = F.least(F.col("c") - F.col("l"), F.col("lead.c") - F.col("lead.l")), F.least(F.col("r") - F.col("c"), F.col("lead.r") - F.col("lead.c"))
    met = met.select(F.col("lead.t").alias("a"), F.col("t").alias("b"), (F.col("lead.c") - left).alias("la"), (F.col("lead.c") + right).alias("ra"), (F.col("c") - left).alias("lb"), (F.col("c") + right).alias("rb"), "c")
    return met.groupBy("a", "b").agg(F.min("la").alias("la"), F.max("ra").alias("ra"), F.min("lb").alias("lb"), F.max("rb").alias("rb"), F.collect_set("c").alias("ws"))


def still_open(state: DataFrame) -> DataFrame:
    """t, c: places of texts where the leader of their own key has no passage near them, whatever other texts have there."""
    return state.select(F.col("b").alias("t"), F.explode("open").alias("c")).distinct()


#: Lengths of the stretches around a place that are compared, and shingles that must agree in each.
LENGTHS = {n: int(np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * n - 1e-9)) for n in range(SPAN, 2 * SPAN + 1, SPAN // 4)}


def agreeing(rows: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Rows of every (shingles around a place) with a stretch of LENGTHS that agrees enough with the same of rows, or with its only
    one. Shifts by one word after an edit count."""
    eq = every == rows
    eq[:, 1:] |= every[:, 1:] == rows[..., :-1]
    eq[:, :-1] |= every[:, :-1] == rows[..., 1:]
    near = np.flatnonzero(eq.sum(axis=1, dtype=np.int16) >= NEED)
    if not len(near):
        return near
    sums = np.zeros((len(near), every.shape[1] + 1), np.int16)
    np.cumsum(eq[near], axis=1, out=sums[:, 1:])
    return near[np.max([(sums[:, n:] - sums[:, :-n]).max(axis=1) - need for n, need in LENGTHS.items()], axis=0) >= 0]


def poor(m: np.ndarray, inside: np.ndarray, least: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether rows one and two of m, which agree, share too few distinct shingles for any passage inside both, as passages()
    has it. least: variety of the rows, 0 where it is not known yet."""
    rows = np.unique(np.concatenate([one, two]))
    rows = rows[least[rows] == 0]
    if len(rows):
        least[rows] = row_variety(m[rows], inside[rows])
    most = np.maximum(least[one], least[two])
    out = most > SPAN
    # a stretch of LENGTHS agrees but for an eighth or less, which is a fifth of its distinct shingles in uniform texts alone
    some = np.flatnonzero(most <= SPAN * 3 // 5)
    for at in range(0, len(some), 4096):  # distinct shingles of either, sorted together: what comes twice is in both
        k = some[at : at + 4096]
        sides = []
        for side, r in enumerate((one[k], two[k])):
            values = np.where(inside[r], m[r].astype(U), U((1 << 40) + (side << 20)) + np.arange(m.shape[1], dtype=U))
            values.sort(axis=1)
            values[:, 1:][values[:, 1:] == values[:, :-1]] = U(1 << 50)
            sides.append(values)
        both = np.concatenate(sides, axis=1)
        both.sort(axis=1)
        out[k] = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < U(1 << 32))).sum(axis=1) < SIMILARITY * most[k] - 1e-9
    return out


def live(holders: DataFrame) -> DataFrame:
    """holders of the keys that have a place with todo and two texts, with the blocks of all (n_all) and of those with todo (n_out)."""
    counts = holders.groupBy("key").agg(F.count("*").alias("n"), F.count_if("todo").alias("out")).where("n > 1 AND out > 0")
    blocks = [F.ceil(F.col(n) / BLOCK).cast("int").alias(name) for n, name in (("n", "n_all"), ("out", "n_out"))]
    return holders.join(counts.select("key", *blocks), "key")


def open_holders(windows: DataFrame, shingled: DataFrame, state: DataFrame) -> tuple[DataFrame, str]:
    """key, t, c, todo, pad, x, n_all, n_out: all holders of the keys that have a place which is still open (todo), with the shingles
    around."""
    places, _ = settle(still_open(state).withColumn("todo", F.lit(True)), "open")
    holders = windows.select("key", "t", "c")
    keys = holders.join(places, ["t", "c"], "left_semi").select("key").distinct()
    rows = holders.join(keys, "key", "left_semi").dropDuplicates(["key", "t"]).join(places, ["t", "c"], "left").withColumn("todo", F.coalesce("todo", F.lit(False)))
    rows, _ = settle(rows, "holders")
    begin = F.greatest(F.col("c") - SPAN - F.col("off"), F.lit(0))
    around = live(rows).join(shingled, "t").withColumn("pad", begin + F.col("off") - F.col("c") + SPAN).withColumn("x", F.slice("x", begin + 1, 2 * SPAN + 1 - F.col("pad")))
    return settle(around.select("key", "t", "c", "todo", "pad", "x", "n_all", "n_out"), "around")


def further(around: DataFrame, left: DataFrame, regions: DataFrame, tried: DataFrame) -> DataFrame:
    """As open_holders(), with classes and tried, for the places left whose key has a holder that shares none of their classes."""
    holders = around.select("key", "t", "c").join(left.select("key").distinct(), "key", "left_semi")
    holders = holders.join(left.withColumn("todo", F.lit(True)), ["key", "t", "c"], "left").withColumn("todo", F.coalesce("todo", F.lit(False)))
    holders, _ = settle(holders, "left")
    holders = holders.join(places_classes(holders, regions), ["t", "c"], "left").withColumn("classes", F.expr(f"coalesce(classes, {NONE})"))
    n = holders.groupBy("key").agg(F.count("*").alias("n"))
    common = holders.select("key", F.explode("classes").alias("class")).groupBy("key", "class").agg(F.count("*").alias("with")).join(n, "key").where("with = n")
    holders = holders.join(common.groupBy("key").agg(F.collect_set("class").alias("common")), "key", "left")
    holders = holders.withColumn("todo", F.expr("todo AND NOT coalesce(arrays_overlap(classes, common), false)")).drop("common")
    holders, _ = settle(live(holders), "holders")
    told = tried.join(holders.select("t", "c").distinct(), ["t", "c"], "left_semi").groupBy("t", "c").agg(F.collect_set("a").alias("tried"))
    holders = holders.join(told, ["t", "c"], "left").withColumn("tried", F.expr(f"coalesce(tried, {NONE})"))
    return holders.join(around.select("key", "t", "pad", "x"), ["key", "t"])


HOLDER = ["t", "c", "pad", "x", "classes", "tried"]
#: From so many holders on, a place is laid over all others of its block at once; those of smaller blocks are paired up.
MANY = 64
MET = "key long, b long, cb int, n long, a long, ca int, poor boolean"


def partners(met: DataFrame, most: int) -> DataFrame:
    """key, b, cb, n, a, ca, poor: of every place with todo the first `most` holders of its key that agree with it, in the order of
    texts (a, ca), among those that share none of its classes and have not been tried with it; n on the first row, how many
    there are. Apart from these, at first (`most` 1), those that agree and are poor: at these places alone they cannot
    have a passage. Holders meet in blocks."""
    block = lambda n: F.pmod(F.xxhash64("t"), F.col(n)).cast("int")
    out = met.where("todo").withColumn("i", block("n_out")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1))).withColumn("side", F.lit(0))
    every = met.withColumn("j", block("n_all")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_out") - 1))).withColumn("side", F.lit(1))
    group = ["key", "i", "j"]
    both = out.select(*group, "side", *HOLDER).unionByName(every.select(*group, "side", *HOLDER)).repartition(*group).sortWithinPartitions(*group, "side", "t")

    def of_blocks(rows: pa.Table) -> pa.RecordBatch:
        """Rows of whole blocks, one after another."""
        cells = rows.combine_chunks().to_batches()[0]
        key, i, j, side, t, c, pad = (cells.column(k).to_numpy() for k in range(7))
        begins = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        ends = np.concatenate([begins[1:], [len(key)]])
        middles = begins + np.add.reduceat(side == 0, begins)
        offsets = cells.column(7).offsets.to_numpy()
        lengths = np.diff(offsets)
        m, inside = np.repeat(side.astype(np.uint32)[:, None], 2 * SPAN + 1, axis=1), np.zeros((len(key), 2 * SPAN + 1), bool)  # what lies outside a text agrees with nothing
        places = np.repeat(np.arange(len(key)), lengths), np.arange(lengths.sum()) - np.repeat(offsets[:-1] - offsets[0] - pad, lengths)
        m[places], inside[places] = cells.column(7).values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint32), True
        classes, tried = list(lists(cells.column(8))), list(lists(cells.column(9)))
        fresh = not sum(map(len, classes)) and not sum(map(len, tried))

        def new(k: int, every: np.ndarray) -> np.ndarray:
            """Those of every that share no class with k and have not been tried with it."""
            out = t[every] != t[k]
            if len(classes[k]):
                owner = np.repeat(np.arange(len(every)), [len(classes[v]) for v in every.tolist()])
                out[owner[np.isin(np.concatenate([classes[v] for v in every.tolist()]), classes[k])]] = False
            if len(tried[k]):
                out[np.isin(t[every], tried[k])] = False
            return every[out]

        least, parts = np.zeros(len(key), np.int64), []

        def keep(one: np.ndarray, two: np.ndarray) -> None:
            """Counts pairs that agree (all of their first sides), and keeps what goes on."""
            order = np.lexsort((two, one))  # the rows of a block stand in the order of texts
            one, two = one[order], two[order]
            bad = poor(m, inside, least, one, two)
            good, weak = np.flatnonzero(~bad), np.flatnonzero(bad) if most == 1 else np.empty(0, np.int64)
            head = np.flatnonzero(np.concatenate([[True], one[good][1:] != one[good][:-1]])[: len(good)])
            size = np.diff(np.concatenate([head, [len(good)]]))
            n = np.zeros(len(good), np.int64)
            n[head] = size
            first = np.arange(len(good)) - np.repeat(head, size) < most
            taken = np.concatenate([good[first], weak])
            parts.append((one[taken], two[taken], np.concatenate([n[first], np.zeros(len(weak), np.int64)]), bad[taken]))

        ones, twos, n_held = [], [], 0
        large = ends - middles >= MANY
        for b, e, f in zip(begins[large].tolist(), middles[large].tolist(), ends[large].tolist(), strict=True):
            for k in range(b, e):
                some = new(k, np.arange(e, f))
                found = some[agreeing(m[k], m[some])] if 2 * len(some) < f - e else (near := e + agreeing(m[k], m[e:f]))[np.isin(near, some, assume_unique=True)]
                ones.append(np.full(len(found), k))
                twos.append(found)
                n_held += len(found)
                if n_held > 1 << 17:
                    keep(np.concatenate(ones), np.concatenate(twos))
                    ones, twos, n_held = [], [], 0
        small = np.flatnonzero(~large & (middles > begins) & (middles < ends))
        size = (ends - middles)[small]
        k = np.concatenate([np.arange(b, e) for b, e in zip(begins[small].tolist(), middles[small].tolist(), strict=True)] or [np.empty(0, np.int64)])
        width, first = np.repeat(size, (middles - begins)[small]), np.repeat(middles[small], (middles - begins)[small])
        one = np.repeat(k, width)
        two = np.arange(len(one)) - np.repeat(np.cumsum(width) - width - first, width)
        for at in range(0, len(one), 1 << 13):
            p, q = one[at : at + (1 << 13)], two[at : at + (1 << 13)]
            found = agreeing(m[p], m[q])
            p, q = p[found], q[found]
            if fresh:
                other = t[p] != t[q]
                p, q = p[other], q[other]
            elif len(p):
                cuts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
                kept = [new(int(p[cut]), part) for cut, part in zip(cuts, np.split(q, cuts[1:]), strict=True)]
                p, q = np.repeat(p[cuts], list(map(len, kept))), np.concatenate(kept)
            ones.append(p)
            twos.append(q)
        if ones:
            keep(np.concatenate(ones), np.concatenate(twos))
        one, two, n, weak = map(np.concatenate, zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 3 + (np.empty(0, bool),)
        return pa.RecordBatch.from_arrays([*map(pa.array, (key[one], t[one], c[one], n, t[two], c[two], weak))], names=["key", "b", "cb", "n", "a", "ca", "poor"])

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in arrow:
            if not len(batch):
                continue
            key, i, j = (batch.column(k).to_numpy() for k in range(3))
            last = int(np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))[-1]) + 1 if (key[0], i[0], j[0]) != (key[-1], i[-1], j[-1]) else 0
            if held and (last or [held[-1].column(k)[-1].as_py() for k in range(3)] != [key[0], i[0], j[0]]):
                yield of_blocks(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = []
            elif last:
                yield of_blocks(pa.Table.from_batches([batch.slice(0, last)]))
            held.append(batch.slice(last))
        if held:
            yield of_blocks(pa.Table.from_batches(held))

    return both.mapInArrow(run, MET)


def chosen(met: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs with columns as of star(): the first `most` partners of the places of half a passage, and poor ones that meet at
    several places; and key, t, c of the places that have further ones."""
    half = F.expr(f"cb div {SPAN // 2}").alias("half")
    each = met.where("NOT poor").select("key", "b", half, "cb", "a", "ca")
    if most == 1:
        first = each.groupBy("b", "half").agg(F.min("a").alias("a"))
    else:
        first = each.groupBy("b", "half").agg(F.slice(F.array_sort(F.collect_set("a")), 1, most).alias("a")).withColumn("a", F.explode("a"))
    taken, _ = settle(each.join(first, ["b", "half", "a"]), "taken")
    both = taken.select("a", "b", "ca", "cb", F.lit(False).alias("poor")).unionByName(met.where("poor").select("a", "b", "ca", "cb", "poor"))
    pairs = both.groupBy("a", "b").agg(F.min("ca").alias("la"), F.max("ca").alias("ra"), F.min("cb").alias("lb"), F.max("cb").alias("rb"), F.collect_set("cb").alias("ws"), F.min("poor").alias("poor"))
    n = met.where("NOT poor").groupBy("key", "b", "cb").agg(F.sum("n").alias("n"))
    done = taken.groupBy("key", "b", "cb").agg(F.count("*").alias("done"))
    left = n.join(done, ["key", "b", "cb"], "left").where("done IS NULL OR n > done").select("key", F.col("b").alias("t"), F.col("cb").alias("c"))
    return pairs.where("NOT poor OR la < ra OR lb < rb").drop("poor"), left


def places_classes(holders: DataFrame, regions: DataFrame) -> DataFrame:
    """t, c, classes: classes of the regions that a place lies in or near, as `open` has it."""
    at = holders.select("t", "c").distinct().join(regions, "t").where(f"c >= i - {SPAN} AND c <= j + {SPAN}")
    return at.groupBy("t", "c").agg(F.collect_set("class").alias("classes"))


def of_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", F.explode("found").alias("f")).select("a", "f.i", "f.j", "b", "f.i2", "f.j2", "f.similarity")


PLACES = ["a", "i", "j", "b", "i2", "j2"]


def pair_passages(texts: DataFrame, shingled: DataFrame) -> DataFrame:
    """a, i, j, b, i2, j2 (first and last shingle in either text), similarity and class of the passages that texts share."""
    windows = texts.where("keys IS NOT NULL").select("t", F.explode(F.arrays_zip("keys", "c", "l", "r")).alias("k")).select("t", F.col("k.keys").alias("key"), "k.c", "k.l", "k.r")
    pairs, _ = settle(star(windows), "pairs")
    state, _ = settle(verified(pairs, shingled), "verified")
    own = texts.select("t", F.explode("own").alias("f")).select(F.col("t").alias("a"), "f.i", "f.j", F.col("t").alias("b"), "f.i2", "f.j2", "f.similarity")
    found = of_pairs(state).unionByName(own)
    around, _ = open_holders(windows, shingled, state)
    holders, tried, most = around.withColumn("classes", F.expr(NONE)).withColumn("tried", F.expr(NONE)), None, 1
    while True:
        met, _ = settle(partners(holders, most), "met")
        pairs, left = chosen(met, most)
        pairs, _ = settle(pairs, "rest")
        needed = pairs.select(F.col("a").alias("t")).unionByName(pairs.select(F.col("b").alias("t"))).distinct()
        more, _ = settle(verified(pairs, shingled.join(needed, "t", "left_semi")), "verified")
        left, _ = settle(left, "left")
        if tried is None:
            found, _ = settle(found.unionByName(of_pairs(more)).dropDuplicates(PLACES), "found")
            linked, regions = with_classes(found)
        else:
            news, _ = settle(of_pairs(more).dropDuplicates(PLACES).join(found, PLACES, "left_anti"), "news")
            if not news.isEmpty():
                found = found.unionByName(news)
                linked, regions = with_classes(found)
        if left.isEmpty():
            return linked
        new = pairs.select(F.explode("ws").alias("c"), F.col("b").alias("t"), "a")
        tried = new if tried is None else tried.unionByName(new)
        holders = further(around, left, regions, tried)
        most *= 16


def with_classes(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found with class: passages of a text that overlap are one region, and linked regions one class; and the regions (t, i, j,
    class)."""
    sides = found.select(F.col("a").alias("t"), "i", "j").unionByName(found.select(F.col("b").alias("t"), F.col("i2").alias("i"), F.col("j2").alias("j")))
    sides = sides.groupBy("t", "i").agg(F.max("j").alias("j"))  # as many rows for a text as it has places, at most
    before = Window.partitionBy("t").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    begins = sides.withColumn("begins", F.coalesce(F.col("i") > F.max("j").over(before), F.lit(True)))
    start = F.max(F.when(F.col("begins"), F.col("i"))).over(Window.partitionBy("t").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    regions, _ = settle(begins.select("t", "i", "j", F.xxhash64("t", start).alias("region")), "regions")
    one, two = regions.drop("j").toDF("a", "i", "one"), regions.drop("j").toDF("b", "i2", "two")
    linked, _ = settle(found.join(one, ["a", "i"]).join(two, ["b", "i2"]), "linked")
    classes = contracted_components(linked.select(F.col("one").alias("a"), F.col("two").alias("b")))
    named = lambda df, region: df.join(classes.toDF(region, "class"), region, "left").withColumn("class", F.coalesce("class", region))
    whole = named(regions.groupBy("t", "region").agg(F.min("i").alias("i"), F.max("j").alias("j")), "region")
    return named(linked, "one").drop("one", "two"), whole.drop("region")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start_word, end_word (exclusive), match_id, match_start, match_end, similarity, class_id (the smallest id
    that holds a passage of the class)."""
    src = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    repeated, path = settle(repeated_keys(src), "keys")
    whole, whole_path = settle(repeated_texts(src, bit_map(repeated, repeated.count())), "whole")
    shingled, _ = settle(whole.where("x IS NOT NULL").select("t", "off", "x").dropDuplicates(["t"]), "shingled")
    texts, _ = settle(whole.drop("off", "x"), "texts")
    for old in (path, whole_path):
        discard(docs.sparkSession, old)
    found = pair_passages(texts, shingled)

    ids = texts.select("doc_id", "t", "n_words").distinct()
    reps, _ = settle(ids.groupBy("t").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("n_words").alias("n_words")), "reps")
    named = found.join(reps.select(F.col("t").alias("a"), F.col("rep").alias("one")), "a").join(reps.select(F.col("t").alias("b"), F.col("rep").alias("two")), "b")
    named, _ = settle(named, "named")
    least = named.groupBy("class").agg(F.least(F.min("one"), F.min("two")).alias("class_id"))
    named = named.join(least, "class")

    def rows(doc: str, i: str, j: str, match: str, i2: str, j2: str) -> DataFrame:
        end = lambda k: (F.col(k) + WIDTH).cast("long")
        return named.select(F.col(doc).alias("doc_id"), F.col(i).cast("long").alias("start_word"), end(j).alias("end_word"), F.col(match).alias("match_id"), F.col(i2).cast("long").alias("match_start"), end(j2).alias("match_end"), "similarity", "class_id")

    copies = ids.join(reps.where("rep < last").drop("n_words"), "t")
    n, zero = F.col("n_words").cast("long"), F.lit(0).cast("long")
    match = F.when(F.col("doc_id") == F.col("rep"), F.col("last")).otherwise(F.col("rep"))
    whole = copies.select("doc_id", zero.alias("start_word"), n.alias("end_word"), match.alias("match_id"), zero.alias("match_start"), n.alias("match_end"), F.lit(1.0).alias("similarity"), F.col("rep").alias("class_id"))
    return rows("one", "i", "j", "two", "i2", "j2").unionByName(rows("two", "i2", "j2", "one", "i", "j")).unionByName(whole)


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
