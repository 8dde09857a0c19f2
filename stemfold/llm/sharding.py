"""Assign rows to shards by jump consistent hashing, in SQL expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import cut

#: Fixed value: the multiplier of the method's linear congruential generator.
LCG = 2862933555777941757
LOW = 0xFFFFFFFF


def _times_plus_one(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * LCG + 1 modulo 2**64, on 32-bit halves in longs; no step leaves 63 bits, so ANSI mode raises nothing."""
    c = [(LCG >> s) & 0xFFFF for s in (0, 16, 32, 48)]
    p0, p1 = lo * c[0], lo * c[1]
    low = p0 + F.shiftleft(p1.bitwiseAND(0xFFFF), 16) + 1
    cross = lo * c[2] + F.shiftleft((lo * c[3]).bitwiseAND(0xFFFF), 16) + hi * c[0] + F.shiftleft((hi * c[1]).bitwiseAND(0xFFFF), 16)
    high = F.shiftright(low, 32) + F.shiftright(p1, 16) + cross
    return high.bitwiseAND(LOW), low.bitwiseAND(LOW)


def jump_path(key: Column, shards: int) -> Column:
    """A struct with ``shard`` (the bucket among ``shards``) and ``jump``, where the key would move next as shards are appended.

    ``key`` is a long. The recurrence ends when the next jump is at least
    ``shards``; jumps grow, so ``shards`` steps always suffice.
    """
    none = F.lit(0).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(LOW).alias("lo"), (none - 1).alias("shard"), none.alias("jump"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _times_plus_one(s["hi"], s["lo"])
        # key >> 33 of the new key is the high half without its lowest bit
        draw = F.shiftright(hi, 1) + 1
        jump = F.floor((s["jump"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double"))).cast("long")
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["jump"].alias("shard"), jump.alias("jump"))
        return F.when(s["jump"] < shards, moved).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


#: Copies of a row that are put out from one list.
STRETCH = 10_000


def assign_shards(df: DataFrame, key_col: str, text_col: str, shards: int, blocks: int = 256) -> DataFrame:
    """One row for each row of ``df``: its shard among ``shards``, its slot in it, and its shard if one more is appended.

    The key alone decides the shard (law ``key``). Integral keys are used as
    they are; other types by xxhash64. A null key counts as key 0; a null text
    has no bytes and the CRC of the empty text. Repeated rows each get a slot.
    Extra columns of ``df`` are not read.

    Slots count from 0 without gaps. The recurrence runs once a row; what it
    gives is written without the texts. To number a shard in parallel, it is
    cut into ``blocks`` by a hash of key, CRC and size, so a key that many
    rows share is spread. Rows alike in all of these are counted before they are
    numbered, and then take as many slots in a row; so no task sorts a whole
    shard or a third of the table, and slots do not depend on partitioning.
    """
    kind = dict(df.dtypes)[key_col]
    raw = F.col(key_col)
    key = F.coalesce(raw.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.when(raw.isNull(), 0).otherwise(F.xxhash64(raw)), F.lit(0).cast("long"))
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    path = df.select(raw.alias("key"), jump_path(key, shards).alias("path"), (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = path.select("key", "size", "text_crc32", F.col("path.shard").cast("int").alias("shard"), F.when(F.col("path.jump") == shards, shards).otherwise(F.col("path.shard")).cast("int").alias("grown_shard"))
    alike = cut(rows.groupBy("shard", "grown_shard", "key", "text_crc32", "size").agg(F.count("*").alias("n")).withColumn("block", F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(blocks)).cast("int")), "shards")
    counts = alike.groupBy("shard", "block").agg(F.sum("n").alias("n"))
    offsets = counts.selectExpr("shard AS o_shard", "block AS o_block", "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS offset")
    numbered = alike.selectExpr("*", "coalesce(sum(n) OVER (PARTITION BY shard, block ORDER BY key, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS place")
    # shards x blocks rows: bounded by the two parameters
    joined = numbered.join(F.broadcast(offsets), (F.col("shard") == F.col("o_shard")) & (F.col("block") == F.col("o_block")))
    # copies come back in stretches, so that no list of them grows with the table
    stretches = joined.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(STRETCH).cast("long"))))
    each = stretches.withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + STRETCH, F.col("n")) - 1)))
    return each.select(F.col("key").alias(key_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("place") + F.col("copy")).cast("long").alias("slot"), "grown_shard")
