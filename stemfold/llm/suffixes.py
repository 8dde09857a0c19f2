"""Repeated substrings by a sampled suffix order: anchors, sampled splitters, local sorts, boundary comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stemfold.llm.common import BYTE_VALUE, binary, cut, mix, n_parts, slices

#: A suffix starts at an anchor; this many bytes from there are its leading token.
LEAD = 24
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Contexts of one leading token above this number are settled window by window across tasks.
MANY = 4096
PLACE = np.uint64((1 << 24) - 1)
#: One suffix stands for about so many bytes of text.
BYTES_A_SUFFIX = 37
#: Bytes of a text whose requests stand in one list.
REQUESTED = 64 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _tables or len(_tables[0]) < n:
        _tables[:] = [_powers(BASE, n), _powers(INVERSE, n)]
    return _tables[0], _tables[1]


def _prefix(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte values times powers, and the inverse powers; see _span."""
    power, inverse = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[buf] * power[: len(buf)], out=total[1:])
    return total, inverse


def _span(total: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, end) that does not depend on where they stand."""
    return mix((total[end] - total[start]) * inverse[start])


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of the texts: (text, anchor, first window, windows, leading token, context).

    Each window of ``length`` bytes has one anchor, the place in it whose
    LEAD bytes have the least hash, the first on ties. Equal windows have
    equal anchors in equal places, so windows need comparing only under one
    leading token. Consecutive windows with one anchor make one suffix; its
    context is a hash of all bytes of these windows and the anchor's place.
    Places count within a text.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    ends = np.cumsum(sizes)
    total, inverse = _prefix(buf)
    at = np.arange(len(buf) - LEAD + 1)
    lead = _span(total, inverse, at, at + LEAD)
    low = (lead & ~PLACE) | at.astype(np.uint64)
    reach, wide = 1, length - LEAD + 1
    while 2 * reach <= wide:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < wide:
        low = np.minimum(low[: len(low) - (wide - reach)], low[wide - reach :])
    anchor = (low[:n] & PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    valid = ends[text[:n]] - np.arange(n) >= length
    new = valid & np.concatenate(([True], (anchor[1:] != anchor[:-1]) | ~valid[:-1] | (text[1:n] != text[: n - 1])))
    first = np.flatnonzero(new)
    stop = np.flatnonzero(valid & np.concatenate((new[1:] | ~valid[1:], [True])))
    windows = stop - first + 1
    owner = text[first]
    begin = (ends - sizes)[owner]
    a = anchor[first]
    context = mix(_span(total, inverse, first, first + windows - 1 + length) ^ ((a - first) * 4096 + windows).astype(np.uint64))
    return owner, a - begin, first - begin, windows, lead[a], context


# One suffix in a packed row: the columns of a structured array.
ORDER = ["lead", "context", "doc", "anchor"]
SUFFIX = np.dtype([("lead", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("anchor", "<i4"), ("first", "<i4"), ("windows", "<i2")])
KEY = np.dtype([(name, SUFFIX[name]) for name in ORDER])


#: A longer text is taken in pieces of this many windows; places in a piece have 24 bits.
PIECE = 8 << 20
#: Bytes of text worked on at once.
SLICE = 3 << 19


def _suffixes(ids: np.ndarray, texts: list[bytes], length: int) -> np.ndarray:
    if len(texts) == 1 and len(texts[0]) > PIECE:
        parts = []
        for at in range(0, len(texts[0]), PIECE):
            part = _rows(ids, *anchors([texts[0][at : at + PIECE + length - 1]], length))
            part["anchor"] += at
            part["first"] += at
            parts.append(part)
        return np.concatenate(parts)
    return _rows(ids, *anchors(texts, length))


def _rows(ids: np.ndarray, owner: np.ndarray, anchor: np.ndarray, first: np.ndarray, windows: np.ndarray, lead: np.ndarray, context: np.ndarray) -> np.ndarray:
    out = np.zeros(len(owner), SUFFIX)
    out["doc"], out["anchor"], out["first"], out["windows"], out["lead"], out["context"] = ids[owner], anchor, first, windows, lead, context
    return out


class Splitters:
    """Range bounds for suffixes in the order (lead, context, doc, anchor), from a sample.

    A range starts with a leading token, so that all suffixes of a token stand
    in one range, unless the token takes several ranges: then the bounds
    within it are full keys.
    """

    def __init__(self, sample: np.ndarray, parts: int) -> None:
        s = np.sort(sample, order=ORDER)
        bounds = s[[len(s) * k // parts for k in range(1, parts)]] if len(s) else s
        first = np.concatenate((np.ones(min(1, len(bounds)), bool), bounds["lead"][1:] != bounds["lead"][:-1]))
        for name in ("context", "doc", "anchor"):
            bounds[name] = np.where(first, -(1 << 63) if name == "doc" else 0, bounds[name])
        self.bounds = np.unique(bounds)
        lead, n = np.unique(self.bounds["lead"], return_counts=True)
        self.hot = lead[n > 1]

    def __len__(self) -> int:
        return len(self.bounds) + 1

    def of(self, s: np.ndarray) -> np.ndarray:
        lo = np.searchsorted(self.bounds["lead"], s["lead"], "left")
        hi = np.searchsorted(self.bounds["lead"], s["lead"], "right")
        many = np.flatnonzero(hi - lo > 1)
        hi[many] = np.searchsorted(self.bounds[ORDER].astype(KEY), s[many][ORDER].astype(KEY), "right")
        return hi


def _arrays(b: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    keep = [(i, t) for i, t in zip(b.column(0).to_pylist(), binary(b.column(1)), strict=True) if i is not None and t]
    return np.array([i for i, _ in keep], np.int64), [t for _, t in keep]


FOUND = "kind int, part int, lead bigint, context bigint, doc bigint, anchor bigint, first bigint, windows bigint"
#: Kinds of what a range's sort yields.
REPEATED, ASK, ASK_HOT, HEAD, TAIL = 0, 1, 2, 3, 4


def _sorted_range(hot: np.ndarray):
    """Sort one range and compare neighbours: repeated suffixes, and those whose contexts must be looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {}
        for b in batches:
            for part, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                blobs.setdefault(part, []).append(x)
        for part in sorted(blobs):
            s = np.frombuffer(b"".join(blobs.pop(part)), SUFFIX)
            s = s[np.lexsort((s["anchor"], s["doc"], s["context"], s["lead"]))]
            token = np.concatenate(([True], s["lead"][1:] != s["lead"][:-1]))
            group = token | np.concatenate(([True], s["context"][1:] != s["context"][:-1]))
            head = np.flatnonzero(group)
            of = np.cumsum(group) - 1
            top = head[of]
            repeated = (s["doc"] > s["doc"][top]) | ((s["doc"] == s["doc"][top]) & (s["anchor"] > s["anchor"][top]))
            token_of = np.cumsum(token) - 1
            contexts = np.bincount(token_of[head])
            ask = group & (contexts[token_of] > 1)
            is_hot = np.isin(s["lead"], hot)
            kind = np.where(ask | (group & is_hot), np.where(is_hot | (contexts[token_of] > MANY), ASK_HOT, ASK), -1)
            picks = [(REPEATED, np.flatnonzero(repeated)), (ASK, np.flatnonzero(kind == ASK)), (ASK_HOT, np.flatnonzero(kind == ASK_HOT))]
            if is_hot[0]:  # the group may have begun in an earlier range: its least suffix is in HEAD, not asked for here
                picks[2] = (ASK_HOT, picks[2][1][picks[2][1] != 0])
                picks.append((HEAD, np.array([0])))
            if is_hot[-1]:
                picks.append((TAIL, np.array([len(s) - 1])))
            for k, at in picks:
                for lo in range(0, len(at), 100_000):
                    r = s[at[lo : lo + 100_000]]
                    yield pa.record_batch([pa.array(np.full(len(r), k, np.int32)), pa.array(np.full(len(r), part, np.int32)), pa.array(np.ascontiguousarray(r["lead"]).view(np.int64)), pa.array(np.ascontiguousarray(r["context"]).view(np.int64)), pa.array(np.ascontiguousarray(r["doc"])), pa.array(r["anchor"].astype(np.int64)), pa.array(r["first"].astype(np.int64)), pa.array(r["windows"].astype(np.int64))], names=["kind", "part", "lead", "context", "doc", "anchor", "first", "windows"])

    return run


def _windows(lead: np.ndarray, doc: np.ndarray, anchor: np.ndarray, first: np.ndarray, windows: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, doc, start) of every window of the contexts. The hash takes in leading token, anchor's place and all bytes."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    total, inverse = _prefix(np.frombuffer(b"".join(contexts), np.uint8))
    n = np.maximum(np.minimum(windows, sizes - length + 1), 0)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + k
    rep = lambda x: np.repeat(x, n)
    start = rep(first) + k
    h = mix(_span(total, inverse, at, at + length) ^ rep(lead.astype(np.int64).view(np.uint64)) ^ (rep(anchor) - start).astype(np.uint64))
    return h, rep(doc), start


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, windows): the maximal runs of consecutive starts."""
    order = np.lexsort((start, doc))
    d, s = doc[order], start[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(d)), bool), (d[1:] != d[:-1]) | (s[1:] - s[:-1] > 1))))
    stop = np.append(new[1:], len(d)) - 1 if len(d) else new
    return d[new], s[new], s[stop] - s[new] + 1 if len(d) else s[new]


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, length: int, sample_docs: int = 4096, sample_suffixes: int = 400_000, range_bytes: int = 64 << 20, most_ranges: int = 10_000) -> DataFrame:
    """(doc, first, windows): runs of starts of ``length``-byte windows that also start earlier. Ids are longs.

    Splitters come from about ``sample_suffixes`` suffixes of about
    ``sample_docs`` documents, whatever their length, so the driver holds no
    more than these. There is a range for each ``range_bytes`` of text, as
    many as shuffle partitions at least and ``most_ranges`` at most.
    """
    spark = docs.sparkSession
    pick = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    size, bytes_ = pick.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    drawn = pick.where(F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(1 << 31)) < int(min(1.0, sample_docs / max(1, size)) * (1 << 31)))
    step = max(1, (drawn.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (BYTES_A_SUFFIX * sample_suffixes))
    n_ranges = min(max(n_parts(spark), -(-(bytes_ or 0) // range_bytes)), most_ranges)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = _arrays(b)
            for i, j in slices(texts):
                s = _suffixes(ids[i:j], texts[i:j], length)
                s = s[::step]
                yield pa.record_batch([pa.array([s.tobytes()], pa.binary())], names=["s"])

    some = drawn.mapInArrow(sampled, "s binary").collect()
    splitters = Splitters(np.frombuffer(b"".join(r[0] for r in some), SUFFIX), n_ranges)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = _arrays(b)
            for i, j in slices(texts, SLICE):
                s = _suffixes(ids[i:j], texts[i:j], length)
                part = splitters.of(s)
                order = np.argsort(part, kind="stable")
                part, s = part[order], s[order]
                new = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), part[1:] != part[:-1])))
                rows = [s[lo:hi].tobytes() for lo, hi in zip(new, np.append(new[1:], len(s)), strict=True)]
                yield pa.record_batch([pa.array(part[new].astype(np.int32)), pa.array(rows, pa.binary())], names=["part", "s"])

    ranges = pick.mapInArrow(dealt, "part int, s binary").repartitionById(len(splitters), F.col("part"))
    found = cut(ranges.mapInArrow(_sorted_range(splitters.hot), FOUND), "suffixes")
    # Compare across the bounds of hot tokens: two rows a range at most.
    edges: dict[int, dict[int, tuple]] = {}
    for r in found.where(F.col("kind").isin(HEAD, TAIL)).collect():
        edges.setdefault(r["part"], {})[r["kind"]] = r
    last, again, asked = None, [], []
    key = lambda r: (r["lead"], r["context"])
    for part in sorted(edges):
        head, tail = edges[part].get(HEAD), edges[part].get(TAIL)
        if head is not None:
            (again if last is not None and key(last) == key(head) else asked).append(head)
        last = tail
    schema = found.schema
    moved = spark.createDataFrame([(REPEATED, *tuple(r)[1:]) for r in again] + [(ASK_HOT, *tuple(r)[1:]) for r in asked], schema)
    everything = found.where(~F.col("kind").isin(HEAD, TAIL)).unionByName(moved)
    whole = everything.where(F.col("kind") == REPEATED).select("doc", "first", "windows")
    # of a very long text each piece asks for itself, so no list holds all that a document asks for
    requests = everything.where(F.col("kind") != REPEATED).groupBy("doc", F.floor(F.col("first") / REQUESTED).alias("piece")).agg(F.collect_list(F.struct((F.col("kind") == ASK_HOT).alias("hot"), "lead", "anchor", "first", "windows")).alias("asked"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text, asked in zip(b.column(0).to_pylist(), binary(b.column(1)), b.column(2).to_pylist(), strict=True):
                cols = [[x[k] for x in asked] for k in ("hot", "lead", "anchor", "first", "windows")]
                bits = [text[x["first"] : x["first"] + x["windows"] - 1 + length] for x in asked]
                yield pa.record_batch([pa.array(cols[0], pa.bool_()), *(pa.array(c, pa.int64()) for c in (cols[1], [doc] * len(asked), *cols[2:])), pa.array(bits, pa.binary())], names=["hot", "lead", "doc", "anchor", "first", "windows", "bytes"])

    near = cut(pick.join(requests, F.col("id") == F.col("doc")).select("id", "text", "asked").mapInArrow(contexts, "hot boolean, lead bigint, doc bigint, anchor bigint, first bigint, windows bigint, bytes binary"), "contexts")

    def columns(b: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
        return [b.column(k).to_numpy() for k in range(5)]

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All contexts of a leading token are in this task, together."""
        kept: list[pa.RecordBatch] = []
        for b in [*batches, None]:
            if b is not None:
                kept.append(b)
                if sum(x.num_rows for x in kept) < 20_000:
                    continue
            t = pa.Table.from_batches(kept).combine_chunks() if kept else None
            if t is None or not t.num_rows:
                return
            lead = t.column(0).to_numpy()
            done = t.num_rows if b is None else int(np.flatnonzero(lead != lead[-1])[-1:].sum() + 1) if (lead != lead[-1]).any() else 0
            if done:
                part = t.slice(0, done)
                h, doc, start = _windows(*columns(part), part.column(5).to_pylist(), length)
                order = np.lexsort((start, doc, h))
                h, doc, start = h[order], doc[order], start[order]
                head = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
                top = np.repeat(head, np.diff(np.append(head, len(h))))
                late = (doc > doc[top]) | ((doc == doc[top]) & (start > start[top]))
                d, s, n = _runs(doc[late], start[late])
                yield pa.record_batch([pa.array(d), pa.array(s), pa.array(n)], names=["doc", "first", "windows"])
            kept = t.slice(done).to_batches()

    plain = near.where("NOT hot").select("lead", "doc", "anchor", "first", "windows", "bytes").repartition("lead").sortWithinPartitions("lead").mapInArrow(settled, "doc bigint, first bigint, windows bigint")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                h, doc, start = _windows(*columns(b), b.column(5).to_pylist(), length)
                n = np.maximum(np.minimum(b.column(4).to_numpy(), np.array([len(x) for x in b.column(5).to_pylist()]) - length + 1), 0)
                yield pa.record_batch([pa.array(np.repeat(b.column(0).to_numpy(), n)), pa.array(h.view(np.int64)), pa.array(doc), pa.array(start)], names=["lead", "h", "doc", "start"])

    hot = cut(near.where("hot").select("lead", "doc", "anchor", "first", "windows", "bytes").mapInArrow(exploded, "lead bigint, h bigint, doc bigint, start bigint"), "windows")
    least = hot.groupBy("lead", "h").agg(F.min(F.struct("doc", "start")).alias("least"), F.count("*").alias("n")).where("n > 1").select("lead", "h", "least")
    late = hot.join(least, ["lead", "h"]).where(F.struct("doc", "start") > F.col("least")).select("doc", F.col("start").alias("first"), F.lit(1).cast("bigint").alias("windows"))
    return whole.unionByName(plain).unionByName(late)


def merged_windows(runs: DataFrame, length: int) -> DataFrame:
    """(doc, first, windows): runs of a document whose bytes overlap or touch become one, so there are as many rows as removed stretches."""
    end = F.col("first") + F.col("windows") - 1 + length
    order = Window.partitionBy("doc").orderBy("first", F.desc("windows"))
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("end", end).withColumn("new", F.when(F.col("first") <= reached, 0).otherwise(1))
    isles = marked.withColumn("isle", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = isles.groupBy("doc", "isle").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    return whole.select("doc", "first", (F.col("end") - F.col("first") + 1 - length).alias("windows"))


def _merged(found: list, n: int, length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the windows cover."""
    out: list[list[int]] = []
    for start, end in sorted((x["first"], min(n, x["first"] + x["windows"] - 1 + length)) for x in found):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, with_bytes: bool = True) -> DataFrame:
    """One row for each row: id, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_bytes`` kept, the bytes that stay.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a document of smaller id, or earlier in its own. Strings are
    taken from the texts as they came and do not cross documents.

    1. Suffixes are sampled at anchors, one for about 39 bytes, and dealt to
       ranges of (leading token, context, id, place) by sampled splitters.
    2. Each range sorts its suffixes. Those after the first of an equal
       context are repeats in all their windows. A token that spans ranges is
       compared across their bounds.
    3. Where a token has several contexts, their bytes are fetched, one of
       each context, and windows compared; tokens that are everywhere are
       settled by an aggregate over windows.

    Texts are compared by 64-bit hashes of leading bytes and whole windows. A
    null text is empty. A row with a null id is left whole and removes
    nothing. Rows that repeat an id are the same document. Ids are integral.
    Extra columns are not read.
    """
    runs = repeated_windows(docs, id_col, text_col, length)
    of = merged_windows(runs, length).groupBy("doc").agg(F.collect_list(F.struct("first", "windows")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in binary(b.column(1))]
            rows, kept = [], []
            for t, found in zip(texts, b.column(2).to_pylist(), strict=True):
                spans = _merged(found or [], len(t), length)
                at, parts = 0, []
                for start, end in spans:
                    parts.append(t[at:start])
                    at = end
                kept.append(b"".join([*parts, t[at:]]))
                rows.append((len(t), len(t) - len(kept[-1]), len(spans)))
            yield pa.record_batch([b.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), *([pa.array(kept, pa.binary())] if with_bytes else [])], names=names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_bytes]
    kind = dict(docs.dtypes)[id_col]
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = named.where("id IS NOT NULL").join(of, F.col("id") == F.col("doc"), "left").select("id", "text", "found")
    # rows without an id are not shuffled to one task
    joined = joined.unionByName(named.where("id IS NULL").withColumn("found", F.lit(None).cast(dict(joined.dtypes)["found"])))
    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{', kept binary' * with_bytes}")
