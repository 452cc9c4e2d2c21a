"""Byte-level BPE by a hierarchical-bitmap rank queue, and its inverse.

encode() takes the pieces that the pattern finds, each on its own. A piece that is itself a token is one
id. Any other starts as single bytes in a linked list; the merge rank of each adjacent pair goes to the
bucket of that rank, which holds list positions. Two levels of 256-way bitmaps tell by find-first-set
which rank is next; entries whose pair has changed meanwhile are skipped. Each merge makes at most two new
entries, so a piece of n bytes takes about n log n steps however long it is.

Defined results: null and empty texts give no ids and decode to no bytes. Repeated rows are each encoded.
An empty table gives an empty result. Other columns are ignored, whatever their names. Special tokens are
never recognised: their strings are ordinary text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.memo import Memo
from strandlake.llm.text import table
from strandlake.session import spread

#: Words a worker remembers, twice over; documents in one output batch.
MEMO_WORDS, BATCH = 800_000, 256


#: A bitmap word covers so many ranks, as a power of two; a second level covers the words.
SHIFT = 8
BIT = [1 << k for k in range(1 << SHIFT)]


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pieces = regex.compile(pattern).findall
        self.leaf = [0] * (len(self.tokens) >> SHIFT) + [0]
        self.byte = [ranks[bytes([k])] for k in range(256)]
        self.two = [ranks.get(bytes([k >> 8, k & 255]), -1) for k in range(1 << 16)]
        self.memo = Memo(lambda word: array("i", self.piece(word.encode())).tobytes(), MEMO_WORDS)

    def piece(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n, get, leaf, two, low = len(piece), ranks.get, self.leaf, self.two, (1 << SHIFT) - 1
        ids = [self.byte[b] for b in piece]  # of the token that begins at i
        end = list(range(1, n + 1))  # the token at i is piece[i : end[i]]; the next one begins at end[i]
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the token at i with the next one
        buckets: dict[int, list[int]] = {}  # by rank, heaps of positions
        top = live = 0  # which words of leaf have bits (none between calls); pairs that can merge
        for i, (a, b) in enumerate(zip(piece, piece[1:])):
            if (r := two[a << 8 | b]) >= 0:
                pair[i] = r
                live += 1
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    leaf[r >> SHIFT] |= BIT[r & low]
                    top |= BIT[r >> SHIFT]
        while live:
            k = (top & -top).bit_length() - 1
            bits = leaf[k]
            rank = k << SHIFT | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                leaf[k] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if pair[i] != rank:
                continue  # stale
            j = end[i]
            ids[i], end[i], pair[i] = rank, (stop := end[j]), -1
            live -= 1
            if pair[j] >= 0:
                pair[j] = -1
                live -= 1
            if stop < n:
                before[stop] = i
                if (r := get(piece[i : end[stop]])) is not None:
                    pair[i] = r
                    live += 1
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        leaf[r >> SHIFT] |= BIT[r & low]
                        top |= BIT[r >> SHIFT]
            if (k := before[i]) >= 0:
                if pair[k] >= 0:
                    pair[k] = -1
                    live -= 1
                if (r := get(piece[k:stop])) is not None:
                    pair[k] = r
                    live += 1
                    if r in buckets:
                        heappush(buckets[r], k)
                    else:
                        buckets[r] = [k]
                        leaf[r >> SHIFT] |= BIT[r & low]
                        top |= BIT[r >> SHIFT]
        while top:  # only stale entries are left
            leaf[(top & -top).bit_length() - 1] = 0
            top &= top - 1
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = end[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.memo.join(self.pieces(t)), "<i4") for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def transcode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """id, ids (array of int) and, if asked for, decoded (the bytes that the ids stand for). No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                ids = own.encode([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *map(len, ids)], dtype="i4")
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "i4"), *ids])))
                columns = [part.column(0), lists]
                if decode:
                    columns.append(pa.array([own.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][: len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded binary" * decode)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id and decoded, from id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            texts = [b"".join(map(own.tokens.__getitem__, x or [])) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=[id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    out = transcode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
