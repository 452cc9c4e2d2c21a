"""A bit map of 64-bit keys with a fixed greatest size, built by Spark and broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.shingles import U, mix64

#: Bits a key, and bits at most (16 MB). A map that is too small for its keys lets more through, and loses none.
KEY_BITS, MOST_BITS = 16, 1 << 27


def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix64(keys + U(k)) & U(bits - 1) for k in (1, 2, 3)]


def broadcast_bits(keys: DataFrame, n: int, most: int = MOST_BITS) -> Broadcast:
    """Bit map of the n longs of column key. Its words are united by Spark; MOST_BITS reach the driver at most."""
    bits = min(most, 1 << max(16, (n * KEY_BITS - 1).bit_length()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            p = np.concatenate(places(f["key"].to_numpy().view(U), bits))
            yield pd.DataFrame({"word": (p >> U(6)).astype(np.int64), "bit": (U(1) << (p & U(63))).view(np.int64)})

    rows = keys.select("key").mapInPandas(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, U)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(U)
    return keys.sparkSession.sparkContext.broadcast(out)


def holds(bit_map: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the map may hold each key; true for all that it was built of."""
    out = np.ones(len(keys), bool)
    for p in places(keys, len(bit_map) * 64):
        out &= (bit_map[p >> U(6)] >> (p & U(63))) & U(1) != 0
    return out
