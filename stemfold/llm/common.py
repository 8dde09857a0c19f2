"""Shared helpers: samples, slices and hashing of words in bulk; lineage cuts are the library's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemfold.sources.scratch import cut as cut


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_sample(df: DataFrame, most: int, *columns: str) -> DataFrame:
    """About ``most`` rows of ``df`` (all, if there are no more), by a hash of ``columns``, so the same rows whatever the partitioning.

    Rows are counted and then filtered, so no task or driver ever holds more
    than the sample, and repeated rows come or go together.
    """
    share = min(1.0, most / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 31)) < int(share * (1 << 31)))


def binary(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def slices(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``most`` bytes, so that numpy buffers stay small; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


# --- hashing -------------------------------------------------------------
# Odd multipliers of a 64-bit finalizer and of the position powers.
MIX1 = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
POSITION = np.uint64(0x9E3779B97F4A7C15)

_random = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUE = _random.integers(1, 2**64 - 1, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.multiply.accumulate(np.full(4096, POSITION))


def powers(n: int) -> np.ndarray:
    global _powers
    if n > len(_powers):
        _powers = np.multiply.accumulate(np.full(n, POSITION))
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), element by element."""
    h = h ^ (h >> np.uint64(33))
    h = h * MIX1
    h = h ^ (h >> np.uint64(33))
    h = h * MIX2
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts, in order, and the number of words of each text.

    Words are maximal runs without ASCII white space. All texts are hashed in
    one pass: value(byte) * power(position in the word), summed over the word.
    """
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    solid = ~SPACE[buf]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lens = ends - starts
    at = np.flatnonzero(solid)
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    position = np.arange(len(at)) - np.repeat(first, lens)
    values = BYTE_VALUE[buf[at]] * powers(int(lens.max()))[position]
    return mix(np.add.reduceat(values, first)), counts


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words of one text; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    n_own = min(n, len(words))
    out = np.zeros(len(words) - n_own + 1, np.uint64)
    for k in range(n_own):
        out = mix(out ^ words[k : len(words) - n_own + 1 + k]) + np.uint64(n_own)
    return out
