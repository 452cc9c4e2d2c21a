"""The catalogue's sites by number: signatures of all windows of a run of sequences at once, counted before they leave the task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.functions.dna import BASES, SITE
from strandlake.operators.scan import LENGTH, pieces

#: Letters that are read at once; different signatures that a task holds before it sends them.
RUN, HELD = 1 << 20, 1 << 20
SCHEMA = "signature long, occurrences long, gg long"
_CODE = np.full(256, 4, np.uint8)
for _k, _b in enumerate(BASES):
    _CODE[[ord(_b), ord(_b.lower())]] = _k
_A, _C, _G, _T = range(4)
_ALL = np.uint64((1 << 2 * SITE) - 1)


def packed(code: np.ndarray, last_first: bool) -> np.ndarray:
    """Signature of the SITE letters from each place on (codes 0 to 3), by doubling: 1, 2, 4, 8, 16, 20; last_first: of them in reverse order."""

    def longer(x: np.ndarray, n: int, y: np.ndarray, m: int) -> np.ndarray:
        x, y = x[: len(x) - m], y[n : n + len(x) - m]
        return x << np.uint64(2 * m) | y if last_first else x | y << np.uint64(2 * n)

    one = code.astype(np.uint64)
    two = longer(one, 1, one, 1)
    four = longer(two, 2, two, 2)
    eight = longer(four, 4, four, 4)
    return longer(longer(eight, 8, eight, 8), 16, four, 4)


def sites(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the off-target sites on both strands (scan.OFF_FORWARD, and scan.OFF_REVERSE read literally) of letters, repeats kept, and whether
    their PAM ends in GG."""
    code = _CODE[letters]
    if len(code) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, bool)
    bad = np.concatenate([[0], np.cumsum(code == 4, dtype=np.int32)])
    n = len(code) - LENGTH + 1
    sound = bad[LENGTH:] == bad[:n]
    code = code & np.uint8(3)
    at = lambda k: code[k : k + n]
    forward = np.flatnonzero(sound & (at(0) != _T) & ((at(21) == _A) | (at(21) == _G)) & (at(22) == _G))
    reverse = np.flatnonzero(sound & (at(0) == _C) & ((at(1) == _C) | (at(1) == _T)) & (at(22) != _A))
    signatures = np.concatenate([packed(code, False)[forward], packed(code, True)[reverse] ^ _ALL])
    return signatures.view(np.int64), np.concatenate([code[forward + 21] == _G, code[reverse + 1] == _C])


def summed(signatures: np.ndarray, n: np.ndarray, gg: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(signatures)
    signatures = signatures[order]
    begin = np.flatnonzero(np.concatenate([[True], signatures[1:] != signatures[:-1]]))
    return signatures[begin], np.add.reduceat(n[order], begin), np.add.reduceat(gg[order], begin)


def as_batches(counts: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts[0]), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in counts], names=["signature", "occurrences", "gg"])


def run_of(texts: list[str | None]) -> np.ndarray:
    """Letters of the texts with one between them that is no base."""
    return np.frombuffer("\n".join(x for x in texts if x).encode(), np.uint8)


def counts(sequences: DataFrame) -> DataFrame:
    """signature, occurrences, gg of the off-target sites of sequences (seq), as catalogue(offtarget_sites()) without the letters. Long records are
    dealt over tasks in pieces."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        held = 0

        def added(texts: list[str | None]) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, held
            found, gg = sites(run_of(texts))
            if len(found):
                waiting.append((found, np.ones(len(found), np.int64), gg.astype(np.int64)))
                held += len(found)
            if held > HELD:
                yield from as_batches(summed(*map(np.concatenate, zip(*waiting, strict=True))))
                waiting, held = [], 0

        for batch in stream:
            texts, size = [], 0
            for text in batch.column(0).to_pylist():
                texts.append(text)
                size += len(text or "")
                if size > RUN:
                    yield from added(texts)
                    texts, size = [], 0
            yield from added(texts)
        if waiting:
            yield from as_batches(summed(*map(np.concatenate, zip(*waiting, strict=True))))

    cut = sequences if "at" in sequences.columns else pieces(sequences, [])
    found = cut.select("seq").mapInArrow(run, SCHEMA)
    return found.groupBy("signature").agg(F.sum("occurrences").alias("occurrences"), F.sum("gg").alias("gg"))
