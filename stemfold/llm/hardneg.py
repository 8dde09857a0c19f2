"""Hard negatives by vertical scans: dimensions in each anchor's own order, bounds of what is left shrink the candidates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemfold.llm.common import cut
from stemfold.sources.scratch import fresh

#: Dimensions that are added between two looks at the bounds.
STEP = 8
#: Above this a double no longer holds every integer.
EXACT = 2.0**53


def quantized(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, vector): rows that take part, with the long components floor(scale * x)."""
    most = F.sqrt(F.lit(2.0**62) / F.greatest(F.size(vector_col), F.lit(1)))
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fits = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) < most), F.lit(False)))
    some = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).where(fits)
    return some.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vector"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The components as rows of longs; shorter vectors end in zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), int(sizes.max(initial=0))), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def vertical(rows: DataFrame, block_rows: int) -> DataFrame:
    """(ids, labels, dims): blocks of up to ``block_rows`` rows in order of label and id, each dimension a packed column of its own."""

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        ids, labels, m = t.column(0).to_numpy(), t.column(1).to_numpy(), _matrix(t.column(2))
        order = np.lexsort((ids, labels))
        most = int(np.abs(m).max(initial=0))
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        columns = np.ascontiguousarray(m[order].T.astype(kind))
        return pa.record_batch([pa.array([ids[order].astype("<i8").tobytes()]), pa.array([labels[order].astype("<i8").tobytes()]), pa.array([[c.tobytes() for c in columns]], pa.list_(pa.binary()))], names=["ids", "labels", "dims"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, block_rows - n)
                held.append(part)
                n += part.num_rows
                b = b.slice(part.num_rows)
                if n == block_rows:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.mapInArrow(run, "ids binary, labels binary, dims array<binary>")


@dataclass
class Anchors:
    """A block of anchors: ids, labels and components, the order of their dimensions, and the positives once they are known."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    positives: list[list[tuple[int, int]]]  # (id, score) by rank

    def order(self) -> np.ndarray:
        return np.argsort(-np.abs(self.q), axis=1, kind="stable")


class Block:
    """One stored block, and what its least and largest components let an anchor still expect."""

    def __init__(self, ids: bytes, labels: bytes, dims: list[bytes], anchors: Anchors, order: np.ndarray) -> None:
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        n = len(self.ids)
        wide = np.zeros((anchors.q.shape[1], n), np.int64)  # dimensions of one side only add nothing
        for d, packed in enumerate(dims[: len(wide)]):
            wide[d] = np.frombuffer(packed, {2: "<i2", 4: "<i4", 8: "<i8"}[len(packed) // n])
        least, most = (wide.min(axis=1), wide.max(axis=1)) if n else (wide[:, :0].sum(axis=1),) * 2
        a, b = anchors.q * least, anchors.q * most
        gains = [np.take_along_axis(f(a, b), order, axis=1) for f in (np.maximum, np.minimum)]
        # above[a, k], below[a, k]: what the dimensions from the k-th on can add at most and at least
        self.above, self.below = (np.pad(np.cumsum(g[:, ::-1], axis=1)[:, ::-1], ((0, 0), (0, 1))) for g in gains)
        biggest = float(np.abs(anchors.q).max(initial=0)) * float(np.abs(wide).max(initial=0)) * max(1, len(wide))
        self.columns = wide.astype(np.float64) if biggest < EXACT else wide
        self.q = anchors.q.astype(self.columns.dtype)

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def between(self, a: int, dims: np.ndarray, rows: np.ndarray, low: float, high: float, best: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of those among ``rows`` that score within [low, high] with anchor ``a``.

        Dimensions are read in the anchor's order. A row stays as long as its
        partial score and the bounds of what is left allow it; with ``best``,
        ``low`` also rises to the best-th largest score that is already sure.
        """
        q, above, below = self.q[a], self.above[a], self.below[a]
        scores = np.zeros(len(rows), self.columns.dtype)
        for at in range(0, len(dims), STEP):
            some = dims[at : at + STEP]
            scores += q[some] @ self.columns[some[:, None], rows]
            done = at + len(some)
            if best and len(rows) > best:
                low = max(low, np.partition(scores, -best)[-best] + below[done])
            stay = (scores >= low - above[done]) & (scores <= high - below[done])
            left = np.count_nonzero(stay)
            if left < 0.7 * len(rows) or done == len(dims):
                rows, scores = rows[stay], scores[stay]
            if not left:
                break
        return rows, scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _blocks(batches: Iterator[pa.RecordBatch], anchors: Anchors, order: np.ndarray) -> Iterator[Block]:
    for b in batches:
        for k in range(b.num_rows):
            yield Block(*(c[k].as_py() for c in b.columns), anchors, order)


def nearest_alike(blocks: DataFrame, sent: Broadcast, k: int) -> DataFrame:
    """(anchor, id, score): for each task and anchor its ``k`` best other rows of the anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = sent.value
        order = anchors.order()
        found = [(np.zeros(0), np.zeros(0, np.int64)) for _ in anchors.ids]
        for block in _blocks(batches, anchors, order):
            for a, (own, label) in enumerate(zip(anchors.ids, anchors.labels, strict=True)):
                lo, hi = block.of_label(label)
                alike = block.ids[lo:hi]
                left, right = np.searchsorted(alike, own, "left"), np.searchsorted(alike, own, "right")
                rows = np.concatenate((np.arange(lo, lo + left), np.arange(lo + right, hi)))
                if len(rows):
                    had, ids = found[a]
                    rows, scores = block.between(a, order[a], rows, had[-1] if len(had) == k else -np.inf, np.inf, k)
                    found[a] = _best(np.concatenate((had.astype(scores.dtype), scores)), np.concatenate((ids, block.ids[rows])), k)
        yield _rows([(a, i, s) for a, (scores, ids) in enumerate(found) for i, s in zip(ids, scores, strict=True)], ["anchor", "id", "score"])

    return blocks.mapInArrow(run, "anchor bigint, id bigint, score bigint")


def in_windows(blocks: DataFrame, sent: Broadcast, k: int, low: int, high: int) -> DataFrame:
    """(anchor, place, id, score): for each task, anchor and positive the ``k`` best rows of other labels within the window of its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Anchors = sent.value
        order = anchors.order()
        # (place, least score, greatest score): low and high are percentages
        windows = [[(p, -(-low * s // 100), high * s // 100) for p, (_, s) in enumerate(ps)] for ps in anchors.positives]
        windows = [[w for w in ws if w[1] <= w[2]] for ws in windows]
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for block in _blocks(batches, anchors, order):
            others: dict[int, np.ndarray] = {}
            for a, (own, label) in enumerate(zip(anchors.ids, anchors.labels, strict=True)):
                if not windows[a]:
                    continue
                if label not in others:
                    lo, hi = block.of_label(label)
                    others[label] = np.concatenate((np.arange(lo), np.arange(hi, len(block.ids))))
                floors = {p: max(least, found[a, p][0][-1]) if (a, p) in found and len(found[a, p][0]) == k else least for p, least, _ in windows[a]}
                rows, scores = block.between(a, order[a], others[label], min(floors.values()), max(w[2] for w in windows[a]))
                other = block.ids[rows] != own
                scores, ids = _best(scores[other], block.ids[rows[other]], len(rows))
                for p, _, most in windows[a]:
                    first = np.searchsorted(-scores, -most, "left")
                    top = slice(first, min(first + k, int(np.searchsorted(-scores, -floors[p], "right"))))
                    if top.start < top.stop:
                        had = found.get((a, p), (scores[:0], ids[:0]))
                        found[a, p] = _best(np.concatenate((had[0], scores[top])), np.concatenate((had[1], ids[top])), k)
        yield _rows([(a, p, i, s) for (a, p), (scores, ids) in found.items() for i, s in zip(ids, scores, strict=True)], ["anchor", "place", "id", "score"])

    return blocks.mapInArrow(run, "anchor bigint, place bigint, id bigint, score bigint")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([int(r[c]) for r in rows], pa.int64()) for c in range(len(names))], names=names)


def _first(df: DataFrame, k: int, *group: str) -> DataFrame:
    """The first ``k`` rows of each group by score, ties by id. Spark applies the limit before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "id"))
    return df.withColumn("rank", place).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_rows: int = 8_192, anchor_block: int = 8_192
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` says which rows are anchors. An anchor's positives are its first
    ``positives`` other rows of the same label by score, the integer inner
    product of floor(scale * x), ties by id. For each positive come the first ``negatives`` rows of
    other labels whose score is from ``low`` to ``high`` per cent of the positive's.

    Vectors are written once as blocks of packed dimensions. Anchors are a
    query set and are taken ``anchor_block`` at a time: these are broadcast (that
    many vectors at most, about), and two scans of the blocks follow, one for
    positives, one for the windows that their scores open. In a scan each
    anchor reads the dimensions by descending magnitude, and the least and
    largest components of those left bound what a row can still gain; rows that
    cannot enter go. A task keeps the best rows found so far, so later
    blocks start with a high bound, and gives few rows for each anchor whatever it reads:
    neither vectors nor pairs are shuffled. Work grows with
    anchors times rows, as every anchor asks all of them.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part,
    nor does one whose components are so large (over sqrt(2**62 / dimensions) after scaling) that a score
    might not fit a long. Of vectors of different lengths the common dimensions
    count; an empty one scores 0. A row with the anchor's id is not a
    candidate of that anchor; other repeated rows count each; anchors alike in id, label
    and vector are one. Scores of 0 and below open a window only at 0.
    Extra columns are not read.
    """
    spark = df.sparkSession
    rows = quantized(df, id_col, vector_col, label_col, scale)
    # one count decides into how many blocks the rows go; small files share a task
    parts = max(1, -(-df.count() // block_rows))
    blocks = cut(vertical(rows.coalesce(parts), block_rows), "vertical")
    asked = quantized(df.where(anchor), id_col, vector_col, label_col, scale).distinct()
    some = cut(asked.withColumn("hash", F.xxhash64("id", "label", "vector")), "anchors")
    rounds = max(1, -(-some.count() // anchor_block))
    target = fresh(spark, "negatives")
    for k in range(rounds):
        t = some.where(F.pmod("hash", F.lit(rounds)) == k).orderBy("id", "label", "vector").toArrow()
        anchors = Anchors(t.column(0).to_numpy(), t.column(1).to_numpy(), _matrix(t.column(2)), [[] for _ in range(t.num_rows)])
        sent = spark.sparkContext.broadcast(anchors)
        best = _first(nearest_alike(blocks, sent, positives), positives, "anchor").orderBy("anchor", "rank").toArrow()  # positives x anchor_block rows at most
        for a, i, s in zip(*(best.column(c).to_pylist() for c in ("anchor", "id", "score")), strict=True):
            anchors.positives[a].append((i, s))
        sent = spark.sparkContext.broadcast(anchors)
        named = [(a, p, int(anchors.ids[a]), i, s) for a, ps in enumerate(anchors.positives) for p, (i, s) in enumerate(ps)]
        names = spark.createDataFrame(pa.table({c: pa.array([r[j] for r in named], pa.int64()) for j, c in enumerate(("anchor", "place", "anchor_id", "positive_id", "positive_score"))}))
        first = _first(in_windows(blocks, sent, negatives, low, high), negatives, "anchor", "place")
        out = first.join(F.broadcast(names), ["anchor", "place"])  # positives x anchor_block rows at most
        out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(target)
    kinds = ("anchor_id", T.LongType()), ("positive_id", T.LongType()), ("rank", T.IntegerType()), ("negative_id", T.LongType()), ("positive_score", T.LongType()), ("negative_score", T.LongType())
    return spark.read.schema(T.StructType([T.StructField(c, t) for c, t in kinds])).parquet(target)
