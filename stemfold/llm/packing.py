"""Packing of token sequences along a Hilbert curve through the documents' vectors."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import cut, n_parts

#: Fixed value: how byte-level BPE cuts a text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A text with so long a stretch without white space goes to the slower, linear encoder.
LONG_RUN = 20_000
DIMS, DEPTH, BUCKETS = 3, 10, 256
PROJECTION = np.random.Generator(np.random.PCG64(7)).normal(size=(BUCKETS, DIMS)).astype(np.float32)


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file.

    ``tokenizers`` reads the file and defines the ids. Where the file is plain
    byte-level BPE, whose ranks are its ids, the same vocabulary is given to a
    faster encoder; texts that hold a special token's string, and texts with
    very long runs, stay with ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = None
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer"):
            import tiktoken

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in self.special}
            self.fast = tiktoken.Encoding("from file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special) or (len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def hilbert(points: np.ndarray, depth: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (n x dims, ``depth`` bits each), all points at once."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(depth - 1, 0, -1)):
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(depth - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(depth - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """The Hilbert key of each document: token counts hashed to a vector of unit length, projected, squeezed to a grid."""
    v = np.stack([np.bincount((ids.astype(np.int64) * 2654435761 >> 8) % BUCKETS, minlength=BUCKETS) for ids in documents]).astype(np.float32)
    v = np.sqrt(v)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    side = 1 << DEPTH
    grid = np.clip(side / (1 + np.exp(-1.7 * (v @ PROJECTION))), 0, side - 1)
    return hilbert(grid.astype(np.int64), DEPTH)


def tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """(id, key, n, ids): each text's ids with ``end_id`` after them, as bytes, and its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        end = np.array([end_id], np.uint32)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                ids = [np.concatenate((encode(t or ""), end)) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(curve_keys(ids)), pa.array([len(x) for x in ids], pa.int64()), pa.array([_narrow(x) for x in ids], pa.binary())], names=["id", "key", "n", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, key bigint, n bigint, ids binary")


def _narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id where they fit (first byte 2), else four."""
    return b"\2" + ids.astype("<u2").tobytes() if int(ids.max()) < 65536 else b"\4" + ids.astype("<u4").tobytes()


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if blob[0] == 2 else "<u4", offset=1).astype("<u4")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1, range_ids: int = 4_000_000, most_ranges: int = 10_000) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    All documents stand in order of (Hilbert key, hash of id, id) as one
    stream of ids, each ended by ``end_id``; the stream is cut at every
    multiple of ``length``. Only the last sequence can be short.

    The order is a range partitioning: splitters come from about 16 sampled
    rows a range weighed by their ids. A range has about ``range_ids`` ids, or
    more where that would make over ``most_ranges``: ranges are sorted by
    Spark, which spills, and read as a stream, so what bounds them is time and
    not memory, while the driver and each task hold a few numbers for each of at
    most ``most_ranges``. A key that many documents share is split by id too,
    and rows that repeat an id by a few bits of their place in the written table. One
    small aggregate gives the ids in each range; from these sums each range
    knows where in the stream it starts, and ids are shuffled once.

    A null or empty text is ``end_id`` alone; a null id has the hash of null; repeated
    rows are packed each. Extra columns are not read.
    """
    spark = docs.sparkSession
    place = F.monotonically_increasing_id()
    rows = cut(tokenized(docs, id_col, text_col, tokenizer_path, end_id).withColumns({"tie": F.xxhash64("id").bitwiseAND(~0xFFFF).bitwiseOR(place.bitwiseAND(0xFFFF)), "draw": F.xxhash64("id", place)}), "tokens")
    count, total = rows.agg(F.count("*"), F.sum("n")).first()
    parts = min(max(n_parts(spark), -(-(total or 0) // range_ids)), most_ranges)
    # each row is drawn for itself, so repeated ones do not come or go together
    some = rows.where(F.pmod("draw", F.lit(1 << 31)) < int(min(1.0, 16 * max(parts, 1000) / max(1, count)) * (1 << 31)))
    drawn = some.select("key", "tie", "n").toPandas().sort_values(["key", "tie"])
    # splitters stand at equal shares of ids, not of documents
    at = np.searchsorted(drawn["n"].cumsum().to_numpy(), np.arange(1, parts) * (drawn["n"].sum() / parts)) if len(drawn) else np.zeros(0, np.int64)
    splitters = sorted({(int(drawn["key"].iat[k]), int(drawn["tie"].iat[k])) for k in at})
    keys, ties = (np.array([s[k] for s in splitters], np.int64) for k in (0, 1))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, tie = b.column(0).to_numpy(), b.column(1).to_numpy()
            bucket = np.searchsorted(keys, key, "left")
            for k in np.flatnonzero(bucket < np.searchsorted(keys, key, "right")):  # keys that are splitters: by their tie
                lo, hi = bucket[k], np.searchsorted(keys, key[k], "right")
                bucket[k] = lo + np.searchsorted(ties[lo:hi], tie[k], "right")
            yield pa.record_batch([*b.columns, pa.array(bucket.astype(np.int32))], names=[*b.schema.names, "bucket"])

    sums = rows.select("key", "tie", "n").mapInArrow(ranged, "key bigint, tie bigint, n bigint, bucket int").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = {r["bucket"]: r["n"] for r in sums.collect()}  # most_ranges rows at most
    starts, at = {}, 0
    for b in range(len(splitters) + 1):
        starts[b] = at
        at += totals.get(b, 0)
    kind = dict(docs.dtypes)[id_col]
    dealt = rows.select("key", "tie", "id", "n", "ids").mapInArrow(ranged, f"key bigint, tie bigint, id {kind}, n bigint, ids binary, bucket int").repartitionById(len(splitters) + 1, F.col("bucket")).sortWithinPartitions("bucket", "key", "tie", "id", "n", "ids")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[int, int] = {}
        for b in batches:
            out: list[tuple] = []
            owner = []
            for k, (bucket, blob) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                ids = _wide(blob)
                at, n, done = place.get(bucket, starts[bucket]), len(ids), 0
                while done < n:
                    offset = (at + done) % length
                    take = min(n - done, length - offset)
                    owner.append(k)
                    out.append((done, take, zlib.crc32(ids[done : done + take].tobytes()), n, (at + done) // length, offset))
                    done += take
                place[bucket] = at + n
            columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(6)]
            yield pa.record_batch([b.column(0).take(pa.array(owner, pa.int64())), *columns], names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return dealt.select("id", "bucket", "ids").mapInArrow(pieces, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
