"""Quality scores by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import SPACE, binary, cut, hash_sample, slices, word_hashes

FEATURES = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "space", "bang", "symbol", "stop", "other_punct", "non_ascii",
    "word_len", "max_word", "distinct_words", "repeated_lines", "line_len", "upper_words", "symbol_words", "entropy", "distinct_bytes", "top_word", "end_punct", "digit_words",
)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256)
    t[np.frombuffer(chars, np.uint8)] = 1
    return t


CLASSES = np.stack([_table(c) for c in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\v\f", b"!?", b"#$%&*|~^<>@\\{}[]_=+", b".,;:", b"\"'()-/`", bytes(range(128, 256)))], axis=1)
KIND = CLASSES[:, 0] + 2 * CLASSES[:, 2]  # 1 upper case, 2 digit
STOP_END, SYMBOL_END = _table(b".!?") > 0, _table(b"#$%&*|!") > 0


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the values of each text, given how many values each has."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def statistics(texts: list[bytes]) -> np.ndarray:
    """The features of some texts, from their bytes alone, one row each; zeros for an empty text."""
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    owner = np.repeat(np.arange(n), sizes + 1)
    hist = np.bincount(owner * 256 + buf, minlength=n * 256).reshape(n, 256).astype(np.float64)
    hist[:, 32] -= 1  # the separator
    size = np.maximum(sizes, 1)
    p = hist / size[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    hashes, counts = word_hashes(texts)
    edge = np.flatnonzero(np.diff(~SPACE[buf], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    words = np.maximum(counts, 1)
    first, second, last = KIND[buf[starts]], KIND[buf[np.minimum(starts + 1, len(buf) - 1)]], buf[ends - 1]
    per_word = lambda flags: _per_text(flags.astype(np.int64), counts) / words
    doc = np.repeat(np.arange(n, dtype=np.uint64), counts)
    key = np.sort((doc << np.uint64(40)) | (hashes >> np.uint64(24)))
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    run = np.diff(np.append(new, len(key)))
    holder = (key[new] >> np.uint64(40)).astype(np.int64)
    top, longest = np.zeros(n), np.zeros(n)
    np.maximum.at(top, holder, run)
    np.maximum.at(longest, doc.astype(np.int64), ends - starts)
    lines = [t.split(b"\n") for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, n)
    distinct_lines = np.fromiter((len(set(x)) for x in lines), np.int64, n)
    out = np.column_stack([
        np.log1p(sizes), np.log1p(counts), np.log1p(n_lines), p @ CLASSES,
        _per_text(ends - starts, counts) / words, longest, np.bincount(holder, minlength=n) / words, 1 - distinct_lines / n_lines, np.log1p(sizes / n_lines),
        per_word((first == 1) & (second == 1)), per_word(SYMBOL_END[last]), entropy, (hist > 0).sum(axis=1), top / words,
        per_word(STOP_END[last]), per_word(first == 2),
    ]).astype(np.float32)
    out[sizes == 0] = 0
    return out


def all_statistics(column: pa.Array) -> np.ndarray:
    texts = [t or b"" for t in binary(column)]
    return np.concatenate([np.zeros((0, len(FEATURES)), np.float32), *(statistics(texts[a:b]) for a, b in slices(texts))])


@dataclass
class Trees:
    """Complete binary trees of one depth. Node k has the children 2k+1 and 2k+2; the last level holds leaf values."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a value above it goes right
    leaf: np.ndarray  # trees x leaves
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of x; all rows walk down a tree together."""
        raw = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            raw += leaf[node - inner]
        return 1 / (1 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Logistic boosting: each level of each tree takes its splits from one histogram over (node, feature, bin).

    Without rows the scores are 0.5; with one label only they are near it.
    """
    n, d = x.shape
    inner = 2**depth - 1
    if not n:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)), 0.0)
    mean = np.clip(y.mean(), 0.5 / (n + 1), 1 - 0.5 / (n + 1))
    base = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    raw = np.full(n, base)
    features, thresholds, leaves = [], [], []
    column = np.arange(d)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32), np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = (((node - first)[:, None] * d + column) * bins + binned).ravel()
            sums = [np.bincount(slot, np.repeat(v, d), width * d * bins).reshape(width, d, bins).cumsum(axis=2) for v in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain[:, :, :-1].reshape(width, -1).argmax(axis=1)
            for k, b in enumerate(best):
                j, at = divmod(int(b), bins - 1)
                if gain[k, j, at] > 1e-9 and at < len(cuts[j]):
                    feature[first + k], threshold[first + k] = j, cuts[j][at]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = rate * np.bincount(node - inner, g, inner + 1) / (np.bincount(node - inner, h, inner + 1) + l2)
        raw += leaf[node - inner]
        features.append(feature), thresholds.append(threshold), leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), base)


def _matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float32).reshape(len(blobs), len(FEATURES))


def document_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the float32 features of each row's whole text as bytes. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [row.tobytes() for row in all_statistics(b.column(1))]
            yield pa.record_batch([b.column(0), pa.array(x, pa.binary())], names=[id_col, "x"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, x binary")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int = 20_000, fold: int = 5) -> Trees:
    """Fit on the documents of about ``max_rows`` labelled ids (a sample by hash of the id), so the driver holds a bounded matrix.

    The sampled ids are few and are broadcast; statistics are made of their
    documents only, and no text is shuffled. Rows with ``crc32(id as text) mod
    fold = 0`` are held out. Rows without a label or id are left out; an id
    labelled more than once takes the mean, 0.5 and more counting as 1, and an
    id with several documents is one row. The label is only ever the target.
    """
    of = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    of = of.where("l_id IS NOT NULL").where(F.crc32(F.col("l_id").cast("string")) % fold != 0)
    some = hash_sample(cut(of, "labels"), max_rows, "l_id")
    texts = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text")).join(F.broadcast(some.select("l_id")), F.col("d_id") == F.col("l_id"), "left_semi")
    stats = document_statistics(texts, "d_id", "text").groupBy("d_id").agg(F.min("x").alias("x"))
    rows = stats.join(F.broadcast(some), F.col("d_id") == F.col("l_id")).select("l_id", "x", "y").toPandas().sort_values("l_id")
    return fit_trees(_matrix([bytes(v) for v in rows["x"]]), rows["y"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, fold: int = 5, max_rows: int = 20_000) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, score, predicted.

    Texts are read once for the scores and shuffled never. Null and empty
    texts have zero statistics and a score like any other. A row with a null
    id is scored and is not held out; repeated rows have equal scores. Extra
    columns are not read.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col, max_rows, fold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(model.scores(all_statistics(b.column(1))))], names=[id_col, "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % fold == 0, F.lit(False))
    return scored.select(id_col, held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``threshold``; scored and filtered in one pass without a shuffle of texts.

    A null or empty text is scored like any other; rows with a null id and
    repeated rows stay or go by their text alone; an empty table stays empty,
    and without labels every score is 0.5, so all rows stay. Other columns
    pass through whatever their names.
    """
    model = fit_quality(docs, labels, id_col, text_col, label_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.scores(all_statistics(b.column(at))) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: object, fold: int = 5) -> bool:
    return zlib.crc32(str(doc_id).encode()) % fold == 0
