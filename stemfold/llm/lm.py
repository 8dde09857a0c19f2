"""Cross-entropy difference of documents under a target and a background n-gram model with one vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import cut, n_parts, slices

#: The vocabulary has a symbol for every character of the corpus, one for any other and one for the edge of a text, and this many at least.
VOCABULARY = 96
#: A trigram is one number of three symbols of so many bits: code points, and the edge of a text after the last of them.
BITS, EDGE = 21, 0x110000
#: Bytes of text in a block, and the most cells of a dense table of trigrams.
BLOCK, DENSE = 8 << 20, 1 << 22
#: Blocks whose trigrams meet one copy of the model.
SALT = 4096


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams of the texts in order, the place in them of every token, and the tokens of each text: its characters and one edge."""
    points = [_points(t) for t in texts]
    lens = np.fromiter(map(len, points), np.int64, len(points))
    flat = np.concatenate([np.zeros(0, np.uint32), *points])
    seen = np.zeros(EDGE, bool)
    seen[flat] = True
    alphabet = np.append(np.flatnonzero(seen), EDGE)
    symbol = np.zeros(EDGE, np.int64)
    symbol[alphabet[:-1]] = np.arange(len(alphabet) - 1)
    size = len(alphabet)
    # two edges before each text, one after
    total = np.full(len(flat) + 3 * len(texts), size - 1, np.int64)
    starts = np.cumsum(lens + 3) - (lens + 3)
    total[np.arange(len(flat)) + np.repeat(3 * np.arange(len(texts)) + 2, lens)] = symbol[flat]
    own = np.ones(max(len(total) - 2, 0), bool)
    own[(starts[1:, None] + np.array([-2, -1])).ravel()] = False  # those that straddle two texts
    near = ((total[:-2] * size + total[1:-1]) * size + total[2:])[own]
    if size**3 <= DENSE:
        kinds = np.flatnonzero(np.bincount(near, minlength=size**3))
        place = np.zeros(size**3, np.int32)
        place[kinds] = np.arange(len(kinds), dtype=np.int32)
        where = place[near]
    else:
        kinds, where = np.unique(near, return_inverse=True)
    a, b, c = alphabet[kinds // size // size], alphabet[kinds // size % size], alphabet[kinds % size]
    return a << 2 * BITS | b << BITS | c, where, lens + 1


def blocks(flagged: DataFrame) -> DataFrame:
    """(block, id, text, in_target): documents dealt to blocks of about BLOCK bytes; a longer text stands alone."""
    kind = dict(flagged.dtypes)["id"]
    most = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, j in slices([x or b"" for x in b.column(1).cast(pa.binary()).to_pylist()], most):
                part = b.slice(i, j - i)
                yield pa.record_batch([pa.array(np.full(j - i, at, np.int64)), *part.columns], names=["block", "id", "text", "in_target"])
                at += 1

    return flagged.select("id", "text", "in_target").mapInArrow(run, f"block bigint, id {kind}, text string, in_target boolean")


def block_counts(dealt: DataFrame) -> DataFrame:
    """(block, code, background, target): each block's trigrams, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, flags = b.column(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            texts = [t or "" for t in b.column(1).to_pylist()]
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)] if texts else [0]
            for start, end in zip(edges, edges[1:], strict=False):
                parts = []
                for i, j in slices(texts[start:end]):
                    codes, where, n = trigrams(texts[start + i : start + j])
                    chosen = np.repeat(flags[start + i : start + j], n)
                    parts.append((codes, np.bincount(where, minlength=len(codes)), np.bincount(where[chosen], minlength=len(codes))))
                every, at = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
                counts = np.zeros((2, len(every)), np.int64)
                for k in (0, 1):
                    np.add.at(counts[k], at, np.concatenate([x[k + 1] for x in parts]))
                yield pa.record_batch([pa.array(np.full(len(every), block[start])), pa.array(every), *map(pa.array, counts)], names=["block", "code", "background", "target"])

    return dealt.select("block", "text", "in_target").mapInArrow(run, "block bigint, code bigint, background bigint, target bigint")


def losses(counts: DataFrame) -> DataFrame:
    """(code, target_loss, background_loss) of (code, target, background).

    Nats lost on each trigram's last symbol given the two before, by
    Witten-Bell interpolation down to uniform. Lower orders are sums of the
    trigrams; all of it is joins, and only one row of totals is broadcast.
    """
    models = ("target", "background")
    row = lambda n: [F.sum(F.col(f"{m}_{n}")).alias(f"{m}_sum_{n}") for m in models] + [F.greatest(F.count_if(F.col(f"{m}_{n}") > 0), F.lit(1)).alias(f"{m}_kinds_{n}") for m in models]
    three = counts.select("code", F.shiftright("code", BITS).alias("ab"), F.col("code").bitwiseAND((1 << 2 * BITS) - 1).alias("bc"), *(F.col(m).alias(f"{m}_3") for m in models))
    two = three.groupBy("bc").agg(*(F.sum(f"{m}_3").alias(f"{m}_2") for m in models)).withColumns({"b": F.shiftright("bc", BITS), "c": F.col("bc").bitwiseAND((1 << BITS) - 1)})
    single = two.groupBy("c").agg(*(F.sum(f"{m}_2").alias(f"{m}_1") for m in models))
    # the edge is one of the kinds; one symbol is left for characters that the corpus does not have
    total = single.agg(*row(1), F.greatest(F.count("*") + 1, F.lit(VOCABULARY)).alias("symbols"))

    def mixed(m: str, n: int, below: Column) -> Column:
        return (F.col(f"{m}_{n}") + F.col(f"{m}_kinds_{n}") * below) / (F.col(f"{m}_sum_{n}") + F.col(f"{m}_kinds_{n}"))

    p1 = single.crossJoin(F.broadcast(total)).select("c", *(mixed(m, 1, 1 / F.col("symbols")).alias(f"{m}_p1") for m in models))
    p2 = two.join(p1, "c").join(two.groupBy("b").agg(*row(2)), "b").select("bc", *(mixed(m, 2, F.col(f"{m}_p1")).alias(f"{m}_p2") for m in models))
    p3 = three.join(p2, "bc").join(three.groupBy("ab").agg(*row(3)), "ab")
    return p3.select("code", *((-F.log(mixed(m, 3, F.col(f"{m}_p2")))).alias(f"{m}_loss") for m in models))


def _met(asked: DataFrame, model: DataFrame, copies: int) -> DataFrame:
    """(block, code, target_loss, background_loss): the losses of each block's trigrams.

    A frequent trigram has a row for each block; from ``SALT`` blocks on these
    are dealt to ``copies`` of the model, with the same result.
    """
    if copies > 1:
        asked = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(copies)))
        model = model.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    return asked.join(model, ["code", "salt"] if copies > 1 else ["code"]).select("block", "code", "target_loss", "background_loss")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens, target_loss, background_loss, score.

    Losses are nats a token (each character and the end of the text); score is
    the mean over tokens of target loss less background loss, so the lower,
    the more like the target. Background: all documents. Target: those whose
    id is in ``target_ids``. Both count every whole text over one vocabulary of
    all characters of the corpus.

    Documents are dealt to blocks. A block's trigrams are counted once, summed
    over blocks to the models, and joined to their losses, so the most frequent
    trigram has a row for each block and not for each token; then blocks meet
    their own losses. No model is held by a driver or by one task. Ids are
    joined by a merge at every size: their number grows with the corpus.

    A null or empty text has one token, its end. A row with a null id counts
    as background and is scored. Repeated rows count repeatedly. Without
    target documents the target model is uniform. Extra columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("t_id")).where("t_id IS NOT NULL").distinct()
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = named.where("id IS NOT NULL").join(ids.hint("merge"), F.col("id") == F.col("t_id"), "left").select("id", "text", F.col("t_id").isNotNull().alias("in_target"))
    flagged = joined.unionByName(named.where("id IS NULL").withColumn("in_target", F.lit(False)))  # rows without an id are not shuffled to one task
    dealt = cut(blocks(flagged), "blocks")
    asked = cut(block_counts(dealt), "trigrams")
    model = cut(losses(cut(asked.groupBy("code").agg(F.sum("background").alias("background"), F.sum("target").alias("target")), "counts")), "losses")
    n_blocks = dealt.select("block").distinct().count()
    known = _met(asked.select("block", "code"), model, -(-n_blocks // SALT))

    def run(own: pa.Table, loss: pa.Table) -> pa.Table:
        order = np.argsort(loss["code"].to_numpy())
        code = loss["code"].to_numpy()[order]
        both = [loss[f"{m}_loss"].to_numpy()[order] for m in ("target", "background")]
        texts, parts = [t or "" for t in own["text"].to_pylist()], []
        for i, j in slices(texts):
            codes, where, n = trigrams(texts[i:j])
            at, first = np.searchsorted(code, codes), np.cumsum(n) - n
            parts.append([n, *(np.add.reduceat(x[at][where], first) / n for x in both)])
        n, target, background = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), *np.zeros((2, 0)))
        return pa.table([own["id"], pa.array(n), pa.array(target), pa.array(background), pa.array(target - background)], names=[id_col, "n_tokens", "target_loss", "background_loss", "score"])

    schema = f"`{id_col}` {kind}, n_tokens bigint, target_loss double, background_loss double, score double"
    # as many partitions as blocks, so that a task's share does not grow with the corpus
    n = max(n_parts(docs.sparkSession), n_blocks)
    return dealt.select("block", "id", "text").repartition(n, "block").groupBy("block").cogroup(known.repartition(n, "block").groupBy("block")).applyInArrow(run, schema)
