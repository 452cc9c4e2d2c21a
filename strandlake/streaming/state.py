"""Stateful operators on streams: dedupe over all batches, and a barrier over parts as they arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandlake.plans.ranges import digest

FIRST, CONFLICT = "first", "conflict"
READY, WAITING, MISFIT = "ready", "waiting", "misfit"


def distinct_messages(stream: DataFrame, keys: list[str], body: list[str], expire_ms: int | None = None) -> DataFrame:
    """keys, body, digest, kind: each body that a key was sent with once, over all micro-batches and restarts. The first is of kind
    first, any other a conflict, which the reader treats as an error; deliveries of a known body give nothing.

    State holds the digests of a key's bodies; it is dropped when expire_ms pass without a delivery (None: kept; timers run in
    queries that go on, not in those that end with their input). Among bodies
    that a key first brings in one batch the least digest is the first. Repeats go before the shuffle, task by task, so a
    key that is sent over and over does not weigh on one task."""
    marked = stream.select(*keys, *body, digest(*body).alias("digest"))

    def once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.drop_duplicates([*keys, "digest"])

    def known(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, others = state.get if state.exists else (None, [])
        seen, new = {first, *others}, []
        for f in frames:
            f = f.drop_duplicates("digest")
            f = f[~f["digest"].isin(seen)]
            seen.update(f["digest"])
            new.append(f)
        if sum(map(len, new)):
            out = pd.concat(new).sort_values("digest")
            begins = first is None
            first = out["digest"].iloc[0] if begins else first
            yield out.assign(kind=[FIRST if begins and k == 0 else CONFLICT for k in range(len(out))])
            state.update((first, sorted(seen - {first, None})))
        else:
            state.update((first, list(others)))
        if expire_ms is not None:
            state.setTimeoutDuration(expire_ms)

    out = marked.withColumn("kind", F.lit("")).schema
    timeout = GroupStateTimeout.NoTimeout if expire_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return marked.mapInPandas(once, marked.schema).groupBy(*keys).applyInPandasWithState(known, out, "first string, others array<string>", "append", timeout)


#: Groups of batches that share a row of state, so that a micro-batch costs a call a group and not a call a batch.
SHARDS = 1 << 10
NEVER = (1 << 63) - 1
WAITS, TOLD, DONE = range(3)


class Batches:
    """Batches of a shard in columns: ids, expected numbers, stages, when their timers fire, and a row of all flags of the parts of those that are not done."""

    SCHEMA = "ids binary, expected binary, stage binary, until binary, bits binary"

    def __init__(self, stored: tuple | None):
        read = lambda k, of: np.frombuffer(stored[k] if stored else b"", of).copy()
        self.ids, self.expected, self.stage, self.until = read(0, np.int64), read(1, np.int32), read(2, np.uint8), read(3, np.int64)
        if len(self.until) < len(self.ids):  # without timers
            self.until = np.full(len(self.ids), NEVER, np.int64)
        self.flags = np.unpackbits(read(4, np.uint8), count=int(self.sizes().sum())).astype(bool)

    def sizes(self) -> np.ndarray:
        """Flags of each batch."""
        return np.where(self.stage == DONE, 0, np.maximum(self.expected, 0)).astype(np.int64)

    def begins(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes())])

    def stored(self, timers: bool) -> tuple:
        return self.ids.tobytes(), self.expected.tobytes(), self.stage.tobytes(), self.until.tobytes() if timers else b"", np.packbits(self.flags).tobytes()

    def places(self, ids: np.ndarray, expected: np.ndarray) -> np.ndarray:
        """Where these batches stand; those that are not known are added with the least number that they are expected to have."""
        new = ~np.isin(ids, self.ids)
        if new.any():
            order = np.lexsort((expected[new], ids[new]))
            kinds, first = np.unique(ids[new][order], return_index=True)
            n = expected[new][order][first]
            self.ids, self.expected = np.concatenate([self.ids, kinds]), np.concatenate([self.expected, n.astype(np.int32)])
            self.stage = np.concatenate([self.stage, np.full(len(kinds), WAITS, np.uint8)])
            self.until = np.concatenate([self.until, np.full(len(kinds), NEVER, np.int64)])
            self.flags = np.concatenate([self.flags, np.zeros(int(np.maximum(n, 0).sum()), bool)])
        order = np.argsort(self.ids)
        return order[np.searchsorted(self.ids, ids, sorter=order)]

    def mark(self, ids: np.ndarray, part: np.ndarray, expected: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the batches that these markers touch and of those that are done by them, and which markers fit no batch."""
        at = self.places(ids, expected)
        fits = (expected == self.expected[at]) & (part >= 0) & (part < self.expected[at])
        begin, own = self.begins(), fits & (self.stage[at] != DONE)
        self.flags[begin[at[own]] + part[own]] = True
        touched = np.unique(at)
        seen = np.concatenate([[0], np.cumsum(self.flags)])
        ready = touched[(self.stage[touched] != DONE) & (seen[begin[touched + 1]] - seen[begin[touched]] == self.expected[touched])]
        kept = np.ones(len(self.ids), bool)
        kept[ready] = False
        self.flags = self.flags[np.repeat(kept, self.sizes())]
        self.stage[ready] = DONE
        return touched, ready, ~fits

    def missing(self, place: int) -> list[int]:
        begin = self.begins()
        return np.flatnonzero(~self.flags[begin[place] : begin[place + 1]]).tolist()

    def forget(self, gone: np.ndarray) -> None:
        """Drops batches that are done, which have no flags."""
        self.ids, self.expected, self.stage, self.until = (x[~gone] for x in (self.ids, self.expected, self.stage, self.until))


def barrier(markers: DataFrame, wait_ms: int | None = None, keep_ms: int = 86_400_000) -> DataFrame:
    """(batch_id, part, expected) -> batch_id, status, expected, missing: `ready` once when parts 0 to expected - 1 are all there,
    in any order, with repeats; `waiting` once, with the missing parts, when none has come for wait_ms; `misfit` for a
    marker whose part or expected number does not fit its batch, each kind of it once a micro-batch.

    A batch's state is a bit map of its parts, among those of its shard (SHARDS, by a hash of the id), which are filled together by numpy. A ready
    batch is remembered for keep_ms after its last marker, so that late repeats open no
    new one; a waiting one stays until its parts come. Timers fire with the next micro-batch."""
    schema = "batch_id long, status string, expected int, missing array<int>"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, rows = Batches(state.get if state.exists else None), []
        now = 0 if wait_ms is None else state.getCurrentProcessingTimeMs()
        new = [f[["batch_id", "part", "expected"]].drop_duplicates() for f in frames]
        if sum(map(len, new)):
            ids, part, expected = (pd.concat(new).drop_duplicates()[c].to_numpy() for c in ("batch_id", "part", "expected"))
            touched, ready, odd = held.mark(ids, part, expected)
            rows += [(b, MISFIT, n, [p]) for b, p, n in zip(ids[odd].tolist(), part[odd].tolist(), expected[odd].tolist(), strict=True)]
            rows += [(b, READY, n, []) for b, n in zip(held.ids[ready].tolist(), held.expected[ready].tolist(), strict=True)]
            if wait_ms is not None:
                stage = held.stage[touched]
                held.until[touched] = np.where(stage == DONE, now + keep_ms, np.where(stage == WAITS, now + wait_ms, NEVER))
        if wait_ms is not None:
            late = held.until <= now
            for k in np.flatnonzero(late & (held.stage == WAITS)).tolist():
                rows.append((int(held.ids[k]), WAITING, int(held.expected[k]), held.missing(k)))
                held.stage[k], held.until[k] = TOLD, NEVER
            held.forget(late & (held.stage == DONE))
        if len(held.ids):
            state.update(held.stored(wait_ms is not None))
            if wait_ms is not None and (next_at := int(held.until.min())) < NEVER:
                state.setTimeoutDuration(max(1, next_at - now))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=names)

    known = markers.select(F.col("batch_id").cast("long").alias("batch_id"), F.col("part").cast("int").alias("part"), F.col("expected").cast("int").alias("expected")).where("part IS NOT NULL AND expected IS NOT NULL")
    shards = known.withColumn("shard", F.pmod(F.xxhash64("batch_id"), F.lit(SHARDS))).groupBy("shard")
    return shards.applyInPandasWithState(step, schema, Batches.SCHEMA, "append", GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout)
