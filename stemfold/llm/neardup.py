"""Near-duplicate documents: b-bit MinHash candidates, exact confirmation, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import binary, cut, mix, shingle_hashes, slices, word_hashes
from stemfold.llm.graph import components

_random = np.random.Generator(np.random.PCG64(99))
FLIPS = _random.integers(0, 2**32, 1024, dtype=np.uint32)
FACTORS = _random.integers(0, 2**31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
#: Fixed value: bits kept of each minimum; two signatures then agree by chance in one position of 16.
BITS = 4
EQUAL_NIBBLES = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z, white space is ASCII."""
    hashes, counts = word_hashes([t.lower() for t in texts])
    at = 0
    for n in counts:
        yield np.unique(shingle_hashes(hashes[at : at + n], words))
        at += n


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The minima of n hash functions over the shingles, in blocks so that a long text needs no large matrix."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 2**32 - 1, np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(out, ((x[k : k + 2048] ^ FLIPS[:n, None]) * FACTORS[:n, None]).min(axis=1), out=out)
    return out


def pack(low: np.ndarray) -> bytes:
    """The low BITS bits of the minima, two to a byte."""
    nibble = (low & np.uint32(15)).astype(np.uint8)
    return (nibble[::2] | (nibble[1::2] << 4)).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of packed signatures (rows of bytes), corrected for chance agreement of low bits."""
    agree = EQUAL_NIBBLES[a ^ b].sum(axis=-1, dtype=np.int64) / (2 * a.shape[-1])
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def lowest_estimate(percent: int, n: int) -> float:
    """Pairs estimated below this are not looked at again: six standard errors under the wanted similarity."""
    s, chance = percent / 100, 2.0**-BITS
    agree = chance + (1 - chance) * s
    return s - 6 * float(np.sqrt(agree * (1 - agree) / n)) / (1 - chance)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, h1, h2, bands, sig) of each row: (h1, h2) names its shingle set, ``bands`` holds one key for each band."""
    n = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in binary(b.column(1))]
            size, h1, h2, keys, sig = [], [], [], [], []
            for i, j in slices(texts):
                for s in shingle_sets(texts[i:j], words):
                    size.append(len(s))
                    h1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                    h2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                    if len(s):
                        low = minima(s, n)
                        key = np.arange(bands, dtype=np.uint64)
                        for part in low.reshape(bands, rows).T:
                            key = mix(key ^ part.astype(np.uint64)) + np.uint64(1)
                        keys.append(key.view(np.int64)), sig.append(pack(low))
                    else:
                        keys.append(np.zeros(0, np.int64)), sig.append(b"")
            yield pa.record_batch([b.column(0), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())], names=["id", "n_shingles", "h1", "h2", "bands", "sig"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>, sig binary")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, shingles): the full set of each row of (id, text), as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t or b"" for t in binary(b.column(1))]
            sets = [s.tobytes() for i, j in slices(raw) for s in shingle_sets(raw[i:j], words)]
            yield pa.record_batch([b.column(0), pa.array(sets, pa.binary())], names=["id", "shingles"])

    return texts.mapInArrow(run, f"id {dict(texts.dtypes)['id']}, shingles binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True)) if 100 * min(len(u), len(v)) >= percent * max(len(u), len(v)) else 0
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    left = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    full = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    return full.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _similar(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, est) of the pairs whose signatures promise enough."""
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
            est = estimate(x, y)
            mask = pa.array(est >= least)
            yield pa.record_batch([b.column(0).filter(mask), b.column(1).filter(mask), pa.array(est).filter(mask)], names=["a", "b", "est"])

    sig = classes.select("id", "sig")
    both = pairs.select("a", "b").join(sig.withColumnsRenamed({"id": "a", "sig": "x"}), "a").join(sig.withColumnsRenamed({"id": "b", "sig": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, f"a {kind}, b {kind}, est double")


def _block_links(percent: int, least: float):
    """For one block of a bucket: links between its members and the bucket's queries (members outside the largest component).

    Both come with component, signature, band keys and full set. A pair that
    shares several buckets belongs to that of its first common band.
    Signatures are compared as matrices; a query with any promising partner is
    counted against the whole block by one pass over the block's postings. One
    link of a query to each component is enough.
    """

    def run(table: pa.Table) -> pa.Table:
        query = np.array(table["query"].to_pylist(), bool)
        ids, comps = table["id"].to_pylist(), np.array(table["component"].to_pylist())
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(len(ids), -1)
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        bands, key = np.array(table["bands"].to_pylist(), np.int64), table["key"][0].as_py()
        ours, asked = np.flatnonzero(~query), np.flatnonzero(query)
        a, b = [], []
        if len(ours) and len(asked):
            sizes = np.array([len(sets[i]) for i in ours])
            flat = np.concatenate([sets[i] for i in ours])
            order = np.argsort(flat, kind="stable")
            owner, flat = np.repeat(np.arange(len(ours)), sizes)[order], flat[order]
            for q in asked:
                able = comps[ours] != comps[q]
                able[able] = bands[q, (bands[ours[able]] == bands[q]).argmax(axis=1)] == key
                able[able] = estimate(sig[ours[able]], sig[q]) >= least
                if not able.any():
                    continue
                lo, hi = np.searchsorted(flat, sets[q], "left"), np.searchsorted(flat, sets[q], "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(ours))
                hit = np.flatnonzero(able & (100 * both >= percent * (sizes + len(sets[q]) - both)))
                for k in hit[np.unique(comps[ours[hit]], return_index=True)[1]]:
                    a.append(ids[q]), b.append(ids[ours[k]])
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    return run


#: Shingles of a block of members, on average, at most.
BLOCK_SHINGLES = 2_000_000


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, bands: int = 40, rows: int = 5, pivot_rounds: int = 2, block: int = 1024) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, kept.

    Two documents are linked if their shingle sets have a Jaccard similarity
    of at least ``percent``/100; component_id is the smallest id reachable.
    40 bands of 5 miss a pair at exactly 0.8 with probability 1e-7 and closer
    ones more rarely. Longer bands, with more of them, keep chance meetings of
    unlike documents few as the corpus grows.

    1. Signatures of all rows; rows with equal sets fall into one class.
    2. Classes that share a band key form a bucket. No bucket is expanded into
       pairs: in each round every member is compared with one pivot of its
       bucket, chosen anew, unless both are in one component already.
       Signatures discard hopeless pairs; the rest are confirmed on full sets.
    3. What stays apart in a bucket after the rounds is settled exactly: by
       pairs where those are few, else in blocks of ``block`` members, or fewer
       if their sets are large, against blocks of as many of those outside the
       largest component.

    A document without words, or null, has no shingles and is linked with
    nothing; one with fewer words than a shingle has its whole sequence as
    one. A null id comes back with a null component and is kept. An id that
    occurs with several texts is one node; repeated rows come back repeated.
    Extra columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    least = lowest_estimate(percent, bands * rows)
    sig = cut(signatures(docs, id_col, text_col, words, bands, rows), "signatures")
    live = sig.where("n_shingles > 0 AND id IS NOT NULL")
    classes = cut(live.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")
    keyed = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    bucket = cut(keyed.join(shared, "key").select("key", "id", "n").distinct(), "buckets")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(bucket.select("id").distinct(), "id", "left_semi")
    sets = cut(_sets(texts, words), "sets")
    none = docs.sparkSession.createDataFrame([], f"a {kind}, b {kind}")
    edges, tested, labels = none, none, None

    def open_buckets() -> DataFrame:
        """(key, id, component, n) of the buckets whose members are in more than one component."""
        of = bucket.join(labels.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"), "n") if labels is not None else bucket.select("key", "id", F.col("id").alias("component"), "n")
        mixed = of.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("key")
        return cut(of.join(mixed, "key", "left_semi"), "open")

    def settle(pairs: DataFrame) -> None:
        nonlocal edges, tested, labels
        pairs = cut(pairs, "pairs")
        new = cut(_linked(pairs, sets, percent), "links")
        tested, edges = tested.unionByName(pairs.select("a", "b")), edges.unionByName(new)
        if not new.isEmpty():
            labels = components(edges)

    def candidates(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
        return _similar(ordered, classes, least)

    # sets of too different sizes cannot be similar enough
    apart = (F.col("component") != F.col("cb")) & (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb"))
    for turn in range(pivot_rounds):
        now = open_buckets()
        if now.isEmpty():
            break
        # one order of all ids for each round: buckets with the same members then have the same pivot, and pairs repeat instead of adding up
        order = F.xxhash64("id", F.lit(turn))
        pivots = now.groupBy("key").agg(F.min_by(F.struct("id", "component", "n"), order).alias("p")).select("key", F.col("p.id").alias("b"), F.col("p.component").alias("cb"), F.col("p.n").alias("nb"))
        pairs = candidates(now.join(pivots, "key").where(apart).select(F.col("id").alias("a"), "b"))
        if turn == 0:  # one partner each: most of a large group is joined by these
            far = F.struct("est", "other")
            each = pairs.select("a", F.col("b").alias("other"), "est").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("other"), "est"))
            best = each.groupBy("a").agg(F.max(far).alias("best")).select("a", F.col("best.other").alias("b"))
            pairs = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        settle(pairs.select("a", "b"))
    now = open_buckets()
    if not now.isEmpty():
        per = now.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
        largest = F.struct("c", "component")
        top = per.groupBy("key").agg(F.max_by("component", largest).alias("top"), F.sum("c").alias("all"), F.max("c").alias("most"), F.sum("s").alias("all_n"), F.max_by("s", largest).alias("most_n"))
        sides = cut(now.join(top, "key").withColumns({"query": F.col("component") != F.col("top"), "few": (F.col("all") - F.col("most")) * F.col("all") <= 256}), "sides")
        few = sides.where("few")
        other = few.select("key", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"))
        settle(candidates(few.where("query").join(other, "key").where(apart).select(F.col("id").alias("a"), "b")).select("a", "b"))
        blocks = lambda members, shingles: F.greatest(F.ceil(members / block), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")
        many = sides.where("NOT few").withColumns({"blocks": blocks(F.col("all"), F.col("all_n")), "askings": blocks(F.col("all") - F.col("most"), F.col("all_n") - F.col("most_n"))})
        if not many.isEmpty():
            members = many.select("key", "id", "component", F.lit(False).alias("query"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("askings") - 1)).alias("asking"))
            asked = many.where("query").select("key", "id", "component", F.lit(True).alias("query"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.pmod(F.xxhash64("id"), "askings").cast("int").alias("asking"))
            full = members.unionByName(asked).join(sets, "id").join(classes.select("id", "sig", "bands"), "id")
            new = cut(full.groupBy("key", "part", "asking").applyInArrow(_block_links(percent, least), f"a {kind}, b {kind}").distinct(), "links")
            edges = edges.unionByName(new)
            if not new.isEmpty():
                labels = components(edges)
    class_of = classes.select("h1", "h2", F.col("id").alias("rep"))
    whole = sig.select("id", "n_shingles", "h1", "h2").join(class_of, ["h1", "h2"], "left")
    if labels is not None:
        whole = whole.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        whole = whole.withColumn("component", F.lit(None).cast(kind))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id"))
    return whole.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), own).alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """The rows of ``docs``, all columns, that are the first of their group.

    The smallest id of a group stays; rows that repeat a kept id all stay, and
    so do rows with a null id and rows without words, which are in no group. An
    empty table stays empty. Other columns pass through whatever their names.
    """
    found = near_duplicates(docs, id_col, text_col, **how)
    gone = found.where("NOT kept").select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(docs.columns)
