"""Merkle manifest of a table: trees for each source under one root, and all membership proofs by one fetch for each part of leaves."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemfold.llm.common import cut

#: Trees are built in chunks of ARITY ** CHUNK_LEVELS nodes.
CHUNK_LEVELS = 7
#: Requests up to this many are broadcast.
BROADCAST_REQUESTS = 200_000


def digest(parts: list[bytes]) -> bytes:
    """SHA-256 of the digests' lower-case hex texts, one after another."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def encoded(column: Column, kind: str) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = column if kind == "string" else column.cast("string")
    return F.when(column.isNull(), F.lit(b"-")).otherwise(F.concat(F.octet_length(value).cast("string").cast("binary"), F.lit(b":"), value.cast("binary")))


def leaf_table(docs: DataFrame, columns: list[str], id_col: str, source_col: str, tampered: dict[str, Column], chosen: Column) -> DataFrame:
    """(source, id, leaf, tampered): tampered is the leaf of the changed row, null where the row is not chosen or does not change."""
    kinds = dict(docs.dtypes)

    def leaf(changed: dict[str, Column]) -> Column:
        return F.unhex(F.sha2(reduce(lambda a, b: F.concat(a, b), [encoded(changed.get(c, F.col(c)), kinds[c]) for c in columns]), 256))

    differs = reduce(lambda a, b: a | b, [~v.eqNullSafe(F.col(c)) for c, v in tampered.items()], F.lit(False))
    return docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("id"), leaf({}).alias("leaf"), F.when(F.coalesce(chosen, F.lit(False)) & differs, leaf(tampered)).alias("tampered"))


def place_leaves(leaves: DataFrame, part_leaves: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves with their places, segments and sources.

    Placed leaves are (part, tree, pos, source, id, leaf, tampered): trees are
    numbered in the order of sources, null first and then by bytes; pos counts
    the leaves of a tree in order of id. Segments (part, tree, first, n, leaves) are
    what a part holds of a tree; ``leaves`` is the size of the whole tree.

    Parts are ranges of (source, id, leaf, place in the written table), so a
    source or an id that holds most rows is spread over parts. Sums by part
    give the places; no window holds more than a part or one row for each part.
    """
    rows = cut(leaves.withColumn("draw", F.monotonically_increasing_id()), "leaves")
    parts = max(1, -(-rows.count() // part_leaves))
    # binary sorts by bytes, and null comes first
    ranged = rows.withColumn("key", F.col("source").cast("binary")).repartitionByRange(parts, "key", "id", "leaf", "draw")
    ordered = cut(ranged.withColumn("part", F.spark_partition_id()).drop("draw", "key"), "ordered")
    here = ordered.groupBy("part", "source").agg(F.count("*").alias("n"))
    start = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    segments = cut(here.withColumns({"first": start.cast("long"), "leaves": F.sum("n").over(Window.partitionBy("source"))}), "segments")
    # number the sources: by the part where each begins, then within it
    began = segments.where("first = 0")
    own = began.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").cast("binary"))) - 1)
    before = began.groupBy("part").agg(F.count("*").alias("new")).withColumn("before", F.coalesce(F.sum("new").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    trees = cut(own.join(before, "part").select("source", (F.col("before") + F.col("k")).cast("long").alias("tree"), "leaves"), "trees")
    named = cut(segments.drop("leaves").withColumnRenamed("source", "s").join(trees, F.col("s").eqNullSafe(F.col("source"))).select("part", "tree", "source", "first", "n", "leaves"), "segments")
    # the first leaf of a segment in its part takes the segment's place
    within = F.row_number().over(Window.partitionBy("part", "source").orderBy("id", "leaf")) - 1
    numbered = ordered.withColumn("within", within).withColumnsRenamed({"part": "p", "source": "s"})
    placed = numbered.join(named, (F.col("p") == F.col("part")) & F.col("s").eqNullSafe(F.col("source"))).select("part", "tree", (F.col("first") + F.col("within")).alias("pos"), "source", "id", "leaf", "tampered", "leaves")
    return cut(placed, "placed"), named, trees


def interior(nodes: DataFrame, arity: int, levels: int = CHUNK_LEVELS) -> DataFrame:
    """(tree, level, pos, digest, leaves): all nodes above the leaves of trees given as (tree, pos, digest, leaves).

    Chunks of ``arity ** levels`` consecutive nodes are gathered and folded
    in a task that reads them in order; their tops are the nodes of the next
    round, which is that much smaller. Three rounds serve ten thousand million leaves.
    """
    out: list[DataFrame] = []
    base, now = 0, nodes.select("tree", F.lit(0).alias("level"), "pos", "digest", "leaves").where("leaves > 1")
    while True:
        now = cut(_chunks(now, arity, levels, base), "nodes")
        out.append(now)
        base += levels
        # trees that still have several nodes at this level
        now = now.where((F.col("level") == base) & (F.col("leaves") > arity**base))
        if now.isEmpty():
            return reduce(DataFrame.unionByName, out)


def _chunks(nodes: DataFrame, arity: int, levels: int, base: int) -> DataFrame:
    span = arity**levels

    def fold(tree: int, chunk: int, leaves: int, level: list[bytes]) -> Iterator[tuple]:
        width = -(-leaves // arity**base)  # nodes of the whole tree at the base level
        at = chunk * span
        for up in range(1, levels + 1):
            if width == 1:
                return
            level = [digest(level[k : k + arity]) for k in range(0, len(level), arity)]
            at, width = at // arity, -(-width // arity)
            yield from ((tree, base + up, at + k, d, leaves) for k, d in enumerate(level))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for b in batches:
            for tree, chunk, leaves, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != (tree, chunk, leaves):
                    if key:
                        out += fold(*key, held)
                    key, held = (tree, chunk, leaves), []
                    if len(out) > 20_000:
                        yield _node_batch(out)
                        out = []
                held.append(d)
        if key:
            out += fold(*key, held)
        yield _node_batch(out)

    dealt = nodes.withColumn("chunk", F.floor(F.col("pos") / span)).repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "pos")
    return dealt.select("tree", "chunk", "leaves", "digest").mapInArrow(run, "tree bigint, level int, pos bigint, digest binary, leaves bigint")


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("tree", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()), ("digest", pa.binary()), ("leaves", pa.int64()))
    return pa.record_batch([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[c for c, _ in kinds])


def missing(first: int, last: int, leaves: int, arity: int) -> list[tuple[int, int]]:
    """(level, pos) of the least set of nodes that the proofs of leaves first to last of a tree need from elsewhere.

    At each level the leaves' ancestors are consecutive, so what is missing are the
    rest of the first and of the last run; parents of both are then known.
    """
    out, level = [], 0
    while leaves > 1:
        out += [(level, p) for p in [*range(first - first % arity, first), *range(last + 1, min(last - last % arity + arity, leaves))]]
        first, last, leaves, level = first // arity, last // arity, -(-leaves // arity), level + 1
    return out


def requests(segments: DataFrame, n_trees: int, arity: int) -> DataFrame:
    """(part, tree, level, pos): what each part fetches, from its segments' trees and from the tree above them (tree -1)."""
    top = segments.groupBy("part").agg(F.min("tree").alias("first"), F.max("tree").alias("last")).select("part", F.lit(-1).cast("long").alias("tree"), "first", "last", F.lit(n_trees).cast("long").alias("leaves"))
    spans = segments.select("part", "tree", "first", (F.col("first") + F.col("n") - 1).alias("last"), "leaves").unionByName(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(part, tree, level, pos) for part, tree, first, last, leaves in zip(*(c.to_pylist() for c in b.columns), strict=True) for level, pos in missing(first, last, leaves, arity)]
            yield pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int32(), pa.int64()))], names=["part", "tree", "level", "pos"])

    return spans.mapInArrow(run, "part int, tree bigint, level int, pos bigint")


class Known:
    """The nodes of one tree that a part knows: its own leaves, what it fetched, and what follows from both."""

    def __init__(self, first: int, own: list[bytes], fetched: dict[tuple[int, int], bytes], leaves: int, arity: int) -> None:
        self.arity, self.runs = arity, []  # by level: place of the first run, and its runs of digests
        self.parents: list[list[bytes]] = []
        at, level, width, nodes = first, 0, leaves, own
        while width > 1:
            low, high = at - at % arity, min(at + len(nodes) - 1 - (at + len(nodes) - 1) % arity + arity, width)
            nodes = [fetched[level, p] for p in range(low, at)] + nodes + [fetched[level, p] for p in range(at + len(nodes), high)]
            runs = [nodes[k : k + arity] for k in range(0, len(nodes), arity)]
            self.runs.append((low // arity, runs))
            nodes = [digest(r) for r in runs]
            self.parents.append(nodes)
            at, level, width = low // arity, level + 1, -(-width // arity)
        self.top = nodes[0]

    def siblings(self, pos: int) -> list[str]:
        """Hex digests beside the path from a leaf to the top, level by level."""
        out = []
        for first, runs in self.runs:
            own = pos % self.arity
            pos //= self.arity
            out += [d.hex() for k, d in enumerate(runs[pos - first]) if k != own]
        return out

    def fold(self, pos: int, leaf: bytes) -> bytes:
        """The top that follows from a leaf and its siblings. A run that holds what was built from is not hashed again."""
        for (first, runs), parents in zip(self.runs, self.parents, strict=True):
            own = pos % self.arity
            pos //= self.arity
            run = runs[pos - first]
            leaf = parents[pos - first] if run[own] == leaf else digest([*run[:own], leaf, *run[own + 1 :]])
        return leaf


def _proofs(n_trees: int, arity: int, id_col: str) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    names = [id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(_key: tuple, rows: pa.Table, fetched: pa.Table) -> pa.Table:
        rows = rows.sort_by([("tree", "ascending"), ("pos", "ascending")])
        known: dict[int, dict[tuple[int, int], bytes]] = {}
        for tree, level, pos, d in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "pos", "digest")), strict=True):
            known.setdefault(tree, {})[level, pos] = d
        tree, pos, leaves = (rows.column(c).to_numpy() for c in ("tree", "pos", "leaves"))
        leaf, tampered = rows.column("leaf").to_pylist(), rows.column("tampered").to_pylist()
        starts = np.flatnonzero(np.diff(tree, prepend=-2))
        trees = [Known(int(pos[a]), leaf[a:b], known.get(int(tree[a]), {}), int(leaves[a]), arity) for a, b in zip(starts, [*starts[1:], len(tree)], strict=True)]
        above = Known(int(tree[0]), [t.top for t in trees], known.get(-1, {}), n_trees, arity)
        out: list[list] = [[] for _ in names]
        for t, a, b in zip(trees, starts, [*starts[1:], len(tree)], strict=True):
            own_tree, subroot, root = int(tree[a]), t.top.hex(), above.top.hex()
            upper = "".join(above.siblings(own_tree))
            for k in range(a, b):
                proof = hashlib.sha256(("".join(t.siblings(int(pos[k]))) + upper).encode()).hexdigest()
                folded = above.fold(own_tree, t.fold(int(pos[k]), leaf[k] if tampered[k] is None else tampered[k])).hex()
                for column, x in zip(out[1:], (leaf[k].hex(), subroot, root, proof, folded, folded == root), strict=True):
                    column.append(x)
        return pa.table([rows.column("id"), *map(pa.array, out[1:])], names=names)

    return run


def merkle_manifest(
    docs: DataFrame, columns: list[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", source_col: str = "source", tampered: dict[str, Column] | None = None, chosen: Column | None = None, arity: int = 3, part_leaves: int = 20_000
) -> DataFrame:
    """One row for each row of ``docs``: its id, leaf, subroot, root, proof_sha256, folded_root and verified, as lower-case hex texts.

    A leaf is the SHA-256 of the encoded ``columns``. The leaves of a source
    in order of id make a tree whose runs of ``arity`` nodes become one, the last run
    being shorter where need be; the subroots in order of sources make the tree that
    ends in root. ``tampered`` gives changed columns for the rows that ``chosen`` says;
    folded_root is recomputed from the changed leaf, if there is one, and the row's siblings.

    Leaves are hashed where the rows are read, and texts are never moved.
    A part of about ``part_leaves`` consecutive leaves works out from its
    bounds alone which nodes its proofs lack (a few for each level), all parts'
    requests are joined to the nodes once, and each part derives the interior nodes that
    its proofs share and expands the proofs. A source that holds most rows
    takes many parts; many small sources share one.

    A null column is encoded as such; the null source is a tree of its own and comes first, a null id
    comes first in its tree and is never chosen unless ``chosen`` says so.
    Rows that repeat an id stand in order of their leaves, and rows alike in all columns have places of their own.
    An empty table gives an empty one. Extra columns are not read.
    """
    columns = list(columns)
    kind = dict(docs.dtypes)[id_col]
    placed, segments, trees = place_leaves(leaf_table(docs, columns, id_col, source_col, tampered or {}, F.lit(False) if chosen is None else chosen), part_leaves)
    n_trees = trees.count()
    nodes = interior(placed.select("tree", "pos", F.col("leaf").alias("digest"), "leaves"), arity)
    # subroots: the one node of the top level; trees of a single leaf have that leaf
    tops = nodes.where("pos = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest")).unionByName(placed.where("leaves = 1").select("tree", F.col("leaf").alias("digest")))
    above = tops.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(n_trees).cast("long").alias("leaves"))
    above = cut(above, "subroots")
    store = reduce(DataFrame.unionByName, [
        nodes.select("tree", "level", "pos", "digest"), interior(above, arity).select("tree", "level", "pos", "digest"),
        *(x.select("tree", F.lit(0).alias("level"), "pos", "digest") for x in (placed.select("tree", "pos", F.col("leaf").alias("digest")), above)),
    ])
    wanted = cut(requests(segments, n_trees, arity), "requests")
    few = wanted.count() <= BROADCAST_REQUESTS
    fetched = store.join(F.broadcast(wanted) if few else wanted, ["tree", "level", "pos"]).select("part", "tree", "level", "pos", "digest")
    rows = placed.select("part", "tree", "pos", "id", "leaf", "tampered", "leaves")
    schema = f"`{id_col}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_proofs(n_trees, arity, id_col), schema)
