"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes of words."""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stemfold.llm.common import POSITION, mix, powers, slices, word_hashes

PUNCTUATION = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
#: Bits of the table that a document's seeds are tried against before they are searched for.
TRY_BITS = 22
#: Above so many shared seeds of one pair the tiles are searched row by row, in memory that grows with the text only.
MOST_HITS = 2_000_000


def normal(text: str | None) -> bytes:
    """Lower case, ASCII punctuation as space, UTF-8."""
    return (text or "").lower().encode("utf-8", "replace").translate(PUNCTUATION)


#: Karp-Rabin on words: a word's place weighs by powers of an odd number, and its inverse moves a window back to the start.
_BASE = int(POSITION)
_back = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(4095, pow(_BASE, -1, 1 << 64), np.uint64))))


def _inverse_powers(n: int) -> np.ndarray:
    global _back
    if n > len(_back):
        _back = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64))))
    return _back[:n]


def seed_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words by a running sum: the run at each place is the sum up to its end less that before it, whatever k is."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers(len(words))[: len(words)], dtype=np.uint64)))
    return mix((total[k:] - total[:-k]) * _inverse_powers(n))


def _free(marked: np.ndarray, k: int) -> np.ndarray:
    """Whether the run of k words from each place has no marked word."""
    total = np.concatenate(([0], np.cumsum(marked)))
    return total[k:] == total[:-k]


def _longest_runs(hits: tuple[np.ndarray, np.ndarray], k: int) -> tuple[int, list[tuple[int, int]]]:
    """The longest maximal matches that the shared seeds (place in a, place in b) make up."""
    order = np.lexsort((hits[1], hits[1] - hits[0]))
    a, b = hits[0][order], hits[1][order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(b) != 1) | (np.diff(a) != 1))))
    size = np.diff(np.append(new, len(a))) + k - 1
    top = int(size.max())
    return top, sorted(zip(b[new[size == top]].tolist(), a[new[size == top]].tolist(), strict=True))


def _longest_by_rows(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """The same without a list of shared seeds: one row of run lengths for each word of a."""
    top, found, run = 0, [], np.zeros(len(b) + 1, np.int64)
    for i in range(len(a)):
        run[1:] = np.where((b == a[i]) & free_b & free_a[i], run[:-1] + 1, 0)
        run[0] = 0
        most = int(run.max())
        if most > top:
            top, found = most, []
        if most == top and top:
            found += [(int(j) - top, i + 1 - top) for j in np.flatnonzero(run == top)]
    return top, sorted(found)


def tiles(item: np.ndarray, text: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length) of tiles of at least k words.

    Again and again the longest matches between words that are not yet in a
    tile become tiles, those earlier in the text first, until none of k words
    is left. Order plays no part, so moved passages are found.
    """
    marked_i, marked_t, out = np.zeros(len(item), bool), np.zeros(len(text), bool), []
    seeds_i, seeds_t = seed_hashes(item, k), seed_hashes(text, k)
    while len(seeds_i) and len(seeds_t):
        own, other = np.flatnonzero(_free(marked_i, k)), np.flatnonzero(_free(marked_t, k))
        order = own[np.argsort(seeds_i[own], kind="stable")]
        lo, hi = (np.searchsorted(seeds_i[order], seeds_t[other], side) for side in ("left", "right"))
        n = hi - lo
        if not n.sum():
            break
        if n.sum() > MOST_HITS:
            top, runs = _longest_by_rows(item, text, ~marked_i, ~marked_t)
        else:
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            a, b = order[at], np.repeat(other, n)
            same = np.ones(len(a), bool)
            for j in range(k):  # hashes agree; the words decide
                same &= item[a + j] == text[b + j]
            if not same.any():
                break
            top, runs = _longest_runs((a[same], b[same]), k)
        for t, i in runs:
            if not marked_i[i : i + top].any() and not marked_t[t : t + top].any():
                marked_i[i : i + top] = marked_t[t : t + top] = True
                out.append((i, t, top))
    return out


@dataclass
class Block:
    """Some benchmark items: their words, and their seeds in order of hash with item and place."""

    ids: list
    tokens: list[list[bytes]]
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    #: Items of fewer words than a seed, by their number of words: the hash of all of them, and their ids.
    short: dict[int, tuple[np.ndarray, list[tuple[object, list[bytes]]]]]

    @classmethod
    def of(cls, rows: list[tuple], k: int) -> Block:
        ids, tokens, words, whole = [], [], [], {}
        for i, text in rows:
            own = normal(text)
            w, _ = word_hashes([own])
            if len(w) >= k:
                ids.append(i), tokens.append(own.split()), words.append(w)
            elif len(w):
                whole.setdefault(len(w), []).append((seed_hashes(w, len(w))[0], (i, own.split())))
        short = {m: (np.array([h for h, _ in found], np.uint64), [x for _, x in found]) for m, found in whole.items()}
        seeds = [seed_hashes(w, k) for w in words]
        flat = np.concatenate([np.zeros(0, np.uint64), *seeds])
        item = np.repeat(np.arange(len(ids)), [len(s) for s in seeds]).astype(np.int64)
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(s)) for s in seeds)])
        order = np.argsort(flat, kind="stable")
        table = np.zeros(1 << TRY_BITS, bool)
        table[flat >> np.uint64(64 - TRY_BITS)] = True
        return cls(ids, tokens, words, flat[order], item[order], place[order], table, short)

    def search(self, raw: bytes, text: np.ndarray, k: int, threshold: float) -> Iterator[tuple[object, float, int, int]]:
        """(item id, coverage, tiles, words covered) of the items covered enough by one text: its bytes and the hashes of its words.

        What the hashes find is compared word by word before it counts.
        """
        tokens: list[bytes] = []
        for m, (hashes, items) in self.short.items():
            own = seed_hashes(text, m)
            for i in np.flatnonzero(np.isin(hashes, own)):
                tokens = tokens or raw.split()
                if any(tokens[at : at + m] == items[i][1] for at in np.flatnonzero(own == hashes[i])):
                    yield items[i][0], 1.0, 1, m
        seeds = seed_hashes(text, k)
        tried = np.unique(seeds[self.table[seeds >> np.uint64(64 - TRY_BITS)]])
        lo, hi = (np.searchsorted(self.seeds, tried, side) for side in ("left", "right"))
        n = hi - lo
        if not n.sum():
            return
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        item, place = self.item[at], self.place[at]
        for i in np.unique(item):
            own = self.words[i]
            reach = np.zeros(len(own) + 1, np.int64)
            np.add.at(reach, place[item == i], 1)
            np.add.at(reach, place[item == i] + k, -1)
            if (reach.cumsum()[:-1] > 0).sum() < threshold * len(own):  # no tiling can cover more than the shared seeds
                continue
            found = tiles(own, text, k)
            tokens = tokens or raw.split()
            found = [(a, b, length) for a, b, length in found if self.tokens[i][a : a + length] == tokens[b : b + length]]
            covered = sum(length for _, _, length in found)
            if covered >= threshold * len(own):
                yield self.ids[i], covered / len(own), len(found), covered


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, k: int, block_chars: int) -> Iterator[Block]:
    size = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    n = max(1, math.ceil(size / block_chars))
    for b in range(n):
        part = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct().where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
        yield Block.of([(bytes(r[0]) if isinstance(r[0], bytearray) else r[0], r[1]) for r in part.collect()], k)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5, threshold: float = 0.5, block_chars: int = 8_000_000) -> DataFrame:
    """(id, item_id, coverage, n_tiles, n_words): the pairs in which tiles cover at least ``threshold`` of a benchmark item's words.

    The benchmark is a query set: it is taken in blocks of about
    ``block_chars`` characters, each tried against all documents in one pass
    that shuffles nothing. A document's runs of ``min_match`` words are looked
    up among the block's seeds; items whose shared seeds could cover enough
    are tiled. Words are lower-cased, without ASCII punctuation.

    Null texts count as empty. An item of fewer than ``min_match`` words has
    one seed of all its words and is found whole; one without words is not.
    Of matches of equal length the one earlier in the text comes first. A row
    with a null id is searched like any other, and each repeated row gives its
    own pairs. Items that agree in id and text are one; an item id with several
    texts gives a pair for each text that is found. Ids of both sides may be
    of any type; a column of the output that would have two names alike is
    called benchmark_item_id. Extra columns are not read.
    """
    out = None
    item_name = "item_id" if id_col != "item_id" else "benchmark_item_id"
    item_type = to_arrow_type(benchmark.schema[item_col].dataType)
    kinds = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    for block in _blocks(benchmark, item_col, item_text_col, min_match, block_chars):
        held = docs.sparkSession.sparkContext.broadcast(block)  # block_chars bounds it

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [normal(t) for t in b.column(1).to_pylist()]
                rows = []
                for i, j in slices(texts):
                    words, counts = word_hashes(texts[i:j])
                    ends = np.cumsum(counts)
                    for d, (end, n) in enumerate(zip(ends, counts, strict=True), i):
                        rows += [(d, *found) for found in held.value.search(texts[d], words[end - n : end], min_match, threshold)]
                where = pa.array([r[0] for r in rows], pa.int64())
                columns = [pa.array([r[k] for r in rows], t) for k, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                yield pa.record_batch([b.column(0).take(where), pa.array([r[1] for r in rows], item_type), *columns], names=[id_col, item_name, "coverage", "n_tiles", "n_words"])

        one = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kinds[0]}, {item_name} {kinds[1]}, coverage double, n_tiles bigint, n_words bigint")
        out = one if out is None else out.unionByName(one)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", min_match: int = 5, threshold: float = 0.5, block_chars: int = 8_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, of which no benchmark item is covered enough; each block filters what the one before kept.

    Null and empty texts, and all texts where the benchmark is empty, stay;
    null ids and repeated rows are rows like any others. Items are taken as
    in ``contaminated``.
    """
    at = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col, min_match, block_chars):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts = [normal(t) for t in b.column(at).to_pylist()]
                clean = []
                for i, j in slices(texts):
                    words, counts = word_hashes(texts[i:j])
                    clean += [next(held.value.search(texts[d], words[end - n : end], min_match, threshold), None) is None for d, (end, n) in enumerate(zip(np.cumsum(counts), counts, strict=True), i)]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
