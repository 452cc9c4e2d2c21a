"""Token-id files with byte-plane shuffling.

A shard holds whole documents in ascending id order:

    b"SLTOK001" | planes of chunk 0 | planes of chunk 1 | ... | footer | u64 footer length | b"SLTOKEND"

A chunk is a fixed-size block of ids (the last may be shorter), unsigned 32 bits, transposed into four byte
planes, each compressed with zstandard. The footer is zstandard-compressed JSON of the chunk index (offset,
ids, bytes of each plane) and of the documents (id, ids of each). Shards are closed after the document that
fills them, so memory stays within one document and one block. Files are written under a temporary name and
renamed: a task that is run again writes the same bytes to the same place.

Defined results: null and empty texts hold the end id alone. Rows with one id are kept apart, in the order
of their texts; a null id sorts first and is read back as null. An empty table gives no shard. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandlake.llm.memo import Memo
from strandlake.llm.text import table, whole
from strandlake.session import scratch_path, settle

HEAD, TAIL = b"SLTOK001", b"SLTOKEND"
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
BAR = "|"
ACCENT = re.compile("[\u0300-\u036f]")
STOP = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,])(?=[\x20\x09-\x0D]|\Z)")
BLOCK_IDS, SHARD_IDS, MEMO_WORDS, BATCH = 1 << 16, 1 << 22, 800_000, 512


class ShardWriter:
    def __init__(self, folder: str, name: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.final, self.temporary = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary)
        self.out.write(HEAD)
        self.at, self.chunks, self.docs, self.n_ids = len(HEAD), [], [], 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.pack = zstandard.ZstdCompressor(level=1).compress

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append([doc_id, len(ids)])
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            every = np.concatenate(self.waiting)
            full = len(every) // BLOCK_IDS * BLOCK_IDS
            for k in range(0, full, BLOCK_IDS):
                self._chunk(every[k : k + BLOCK_IDS])
            self.waiting, self.n_waiting = [every[full:].copy()], len(every) - full

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack(p.tobytes()) for p in np.ascontiguousarray(ids, "<u4").view("u1").reshape(-1, 4).T]
        self.chunks.append([self.at, len(ids), [len(p) for p in planes]])
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_waiting:
            self._chunk(np.concatenate(self.waiting))
        footer = self.pack(json.dumps({"chunks": self.chunks, "docs": self.docs}).encode())
        self.out.write(footer + struct.pack("<Q", len(footer)) + TAIL)
        self.out.close()
        self.fs.move(self.temporary, self.final)


def read_shard(folder: str, name: str) -> Iterator[tuple[int, np.ndarray]]:
    """(doc_id, ids) in file order; holds one document and one chunk."""
    fs, root = pafs.FileSystem.from_uri(folder)
    unpack = zstandard.ZstdDecompressor().decompress
    with fs.open_input_file(f"{root}/{name}") as f:
        size, end = f.size(), len(TAIL) + 8
        f.seek(size - end)
        n, tail = struct.unpack("<Q8s", f.read(end))
        if tail != TAIL:
            raise ValueError(f"{name}: not a whole shard")
        f.seek(size - end - n)
        footer = json.loads(unpack(f.read(n)))

        def blocks() -> Iterator[np.ndarray]:
            for at, n_ids, lengths in footer["chunks"]:
                f.seek(at)
                planes = [np.frombuffer(unpack(f.read(x)), "u1") for x in lengths]
                yield np.stack(planes, axis=1).reshape(-1).view("<u4")[:n_ids]

        rest, more = np.empty(0, "<u4"), blocks()
        for doc_id, n_ids in footer["docs"]:
            parts, have = [rest], len(rest)
            while have < n_ids:
                parts.append(next(more))
                have += len(parts[-1])
            every = np.concatenate(parts) if len(parts) > 1 else rest
            yield doc_id, every[:n_ids]
            rest = every[n_ids:]


#: Fixed value: how the tokenizers that plainer() suits part words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def plainer(text: str) -> str:
    """The text with fewer different words and the same ids. The tokenizer lower-cases after composing
    accents: where none follows a letter, A-Z may be lower-cased first. It also parts a full stop or comma
    from a plain or Latin-1 letter or digit before it: where white space follows, a space may do so first."""
    if text.isascii():
        text = text.lower()
    elif not ACCENT.search(text):
        text = text.encode().lower().decode()
    return STOP.sub(r" \1", text)


def by_words(tokenizer: object) -> bool:
    """Whether the tokenizer composes, lower-cases and parts at white space as plainer() and the memory of words need."""
    spec = json.loads(tokenizer.to_str())
    steps = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    return steps == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed" and split.get("invert") is True and split.get("pattern") == {"Regex": WORD_PATTERN}


class WordEncoder:
    """Ids of whole texts, by the library as it is where by_words() does not hold. Else the tokenizer drops white space and never joins across it, so a text's ids are
    those of its white-space-separated words in turn, and frequent words need not be encoded again. New
    words go to the tokenizer together, between bars that give one id each; words with a bar go alone."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words(self.tokenizer)
        self.memo = Memo(lambda word: self._ids([word])[0].tobytes(), MEMO_WORDS)
        bar = self._ids([BAR])[0]
        self.bar = int(bar[0]) if len(bar) == 1 else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if BAR not in w] if self.bar is not None else []
        runs = [plain[k : k + 500] for k in range(0, len(plain), 500)]
        for run, ids in zip(runs, self._ids([f" {BAR} ".join(run) for run in runs]), strict=True):
            ends = np.append(np.flatnonzero(ids == self.bar), len(ids))
            raw, at = ids.tobytes(), 0
            for word, end in zip(run, (ends * 4).tolist(), strict=True):
                self.memo[word] = raw[at:end]
                at = end + 4
        alone = [w for w in new if w not in self.memo]
        self.memo.update(zip(alone, (x.tobytes() for x in self._ids(alone)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_words:
            return self._ids(texts)
        lists = [WORDS(plainer(t)) for t in texts]
        memo = self.memo
        self._learn([w for w in set().union(*lists) if w not in memo and len(w) <= memo.longest and w not in memo.old])
        return [np.frombuffer(memo.join(words), "<u4") for words in lists]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards; the manifest: part, shard, n_docs, n_ids, start (ids in all shards before it).

    Documents are range-partitioned by id, which reads only the id to find the bounds; each task encodes
    and writes its range, so neither texts nor ids are gathered anywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, count, shard = encoder(tokenizer_path).encode, TaskContext.get().partitionId(), 0, None
        fields = ("part", "shard", "name", "n_docs", "n_ids")
        done: list[tuple] = []

        def close() -> None:
            nonlocal shard, count
            shard.close()
            done.append((part, count, f"part-{part:06d}-{count:06d}.bin", len(shard.docs), shard.n_ids))
            shard, count = None, count + 1

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                piece = batch.slice(at, BATCH)
                for doc_id, ids in zip(piece.column(0).to_pylist(), encode(piece.column(1).to_pylist()), strict=True):
                    shard = shard or ShardWriter(folder, f"part-{part:06d}-{count:06d}.bin")
                    shard.add(doc_id, np.append(ids, np.uint32(end_id)))
                    if shard.n_ids >= SHARD_IDS:
                        close()
        if shard:
            close()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(fields, x, strict=True)) for x in done], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    n = max(docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)
    ordered = src.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    shards, _ = settle(ordered.mapInArrow(run, "part int, shard int, name string, n_docs long, n_ids long"), "manifest")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    return shards.withColumn("inside", inside).join(before, "part").select("part", "shard", "name", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("start"))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files. One shard at a time in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple[int, int, int, int]] = []
                for doc_id, ids in read_shard(folder, name):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(manifest.sparkSession.sparkContext.defaultParallelism, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("name", "start").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(manifest, folder)
