"""Data-quality expectations as tables of violations (rule, key, detail)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _rows(df: DataFrame, rule: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def required(df: DataFrame, col: str, key: str, rule: str = "required") -> DataFrame:
    """Rows without a value (null or empty)."""
    return _rows(df.where(F.col(col).isNull() | (F.col(col).cast("string") == "")), rule, F.col(key), F.lit(col))


def determines(df: DataFrame, key: str, attributes: list[str], rule: str = "determines") -> DataFrame:
    """Keys that come with more than one combination of attributes."""
    many = df.select(key, *attributes).distinct().groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return _rows(many, rule, F.col(key), F.col("n"))


def known(df: DataFrame, dim: DataFrame, col: str, key: str, rule: str = "known") -> DataFrame:
    """Rows whose value the dimension does not list."""
    return _rows(df.join(dim.select(col), col, "left_anti"), rule, F.col(key), F.col(col))


def sizes(df: DataFrame, by: str, expected: dict[str, int], rule: str = "size") -> DataFrame:
    """Groups that do not have the expected number of rows; missing ones count 0."""
    want = df.sparkSession.createDataFrame(sorted(expected.items()), f"{by} string, want bigint")
    got = df.groupBy(by).agg(F.count("*").alias("n"))
    off = F.broadcast(want).join(got, by, "left").where(F.coalesce("n", F.lit(0)) != F.col("want"))
    return _rows(off, rule, F.col(by), F.coalesce("n", F.lit(0)))


def inside(df: DataFrame, key: str, start: Column, length: Column, most: Column | int, rule: str = "inside") -> DataFrame:
    """Placements that begin before 0, are empty or end after the clip."""
    end = start + length
    return _rows(df.where((start < 0) | (length <= 0) | (end > most)), rule, F.col(key), end)


def finite(df: DataFrame, col: str, key: str, rule: str = "finite") -> DataFrame:
    bad = F.col(col).isNull() | F.isnan(col) | (F.abs(F.col(col)) == float("inf"))
    return _rows(df.where(bad), rule, F.col(key), F.col(col))


def fixed_length(df: DataFrame, col: str, want: float, key: str, rule: str = "length") -> DataFrame:
    return _rows(df.where(F.col(col).isNull() | (F.col(col) != want)), rule, F.col(key), F.col(col))


def disjoint(df: DataFrame, group: str, rule: str = "disjoint") -> DataFrame:
    """Groups that stand in more than one split."""
    return determines(df, group, ["split"], rule)


def violations(*found: DataFrame) -> DataFrame:
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


# --- many rules of a table in one pass -----------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A rule that a row breaks by itself: where ``fails`` holds, ``key`` and ``detail`` describe it. A null ``fails`` is no failure."""

    name: str
    fails: Column
    key: Column
    detail: Column


@dataclass(frozen=True)
class OneRule:
    """A key comes with one value only. A null key is no key; a null value counts as one."""

    name: str
    key: Column
    value: Column


@dataclass(frozen=True)
class SizeRule:
    """Groups of ``by`` have the expected numbers of rows; others are not looked at, missing ones count 0."""

    name: str
    by: Column
    expected: dict[str, int] = field(default_factory=dict)


def missing_value(col: str, key: str, name: str = "required") -> RowRule:
    return RowRule(name, F.col(col).isNull() | (F.col(col).cast("string") == ""), F.col(key), F.lit(col))


def not_inside(key: str, start: Column, length: Column, most: Column | int, name: str = "inside") -> RowRule:
    return RowRule(name, (start < 0) | (length <= 0) | (start + length > most), F.col(key), start + length)


def not_finite(col: str, key: str, name: str = "finite") -> RowRule:
    return RowRule(name, F.col(col).isNull() | F.isnan(col) | (F.abs(F.col(col)) == float("inf")), F.col(key), F.col(col))


def other_length(col: str, want: float, key: str, name: str = "length") -> RowRule:
    return RowRule(name, F.col(col).isNull() | (F.col(col) != want), F.col(key), F.col(col))


def check(df: DataFrame, *rules: RowRule | OneRule | SizeRule) -> DataFrame:
    """(rule, key, detail): the violations of all ``rules`` from one scan of ``df``.

    A row becomes a record for each row rule that it breaks and one for each
    key that it gives to the others. One aggregate counts equal records, in part before the shuffle, so
    a key that most rows have is a few; a second one counts the values of a key.
    What breaks a row rule comes back as often as it occurs.
    """
    text = lambda c: c.cast("string")
    record = lambda kind, name, key, value: F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("rule"), text(key).alias("key"), text(value).alias("value"), F.lit(1).cast("bigint").alias("n"))
    made, expected = [], []
    for r in rules:
        if isinstance(r, RowRule):
            made.append(F.when(r.fails, record("row", r.name, r.key, r.detail)))
        elif isinstance(r, OneRule):
            made.append(F.when(r.key.isNotNull(), record("one", r.name, r.key, r.value)))
        else:
            made.append(F.when(text(r.by).isin(*r.expected), record("size", r.name, r.by, F.lit(None))))
            expected += [("size", r.name, k, None, 0, n) for k, n in sorted(r.expected.items())]
    records = df.select(F.explode(F.array_compact(F.array(*made))).alias("r")).select("r.*", F.lit(None).cast("bigint").alias("want"))
    if expected:
        records = records.unionByName(df.sparkSession.createDataFrame(expected, records.schema))
    counted = records.groupBy("kind", "rule", "key", "value").agg(F.sum("n").alias("n"), F.max("want").alias("want"))
    judged = counted.groupBy("kind", "rule", "key", F.when(F.col("kind") == "row", F.col("value")).alias("detail"), (F.col("kind") == "row").alias("own")).agg(F.sum("n").alias("n"), F.count("*").alias("values"), F.max("want").alias("want"))
    broken = judged.where((F.col("kind") == "row") | ((F.col("kind") == "one") & (F.col("values") > 1)) | ((F.col("kind") == "size") & (F.col("n") != F.col("want"))))
    detail = F.when(F.col("kind") == "row", F.col("detail")).when(F.col("kind") == "one", text(F.col("values"))).otherwise(text(F.col("n")))
    times = F.when(F.col("kind") == "row", F.col("n")).otherwise(1)
    return broken.select("rule", "key", detail.alias("detail"), F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("_t")).drop("_t")


def failures(*rules: RowRule) -> list[Column]:
    """One count of failures for each row rule, named like it: for ``agg`` or for ``observe``, in a batch or a stream."""
    return [F.sum(F.when(r.fails, 1).otherwise(0)).cast("bigint").alias(r.name) for r in rules]


def observed(df: DataFrame, *rules: RowRule) -> tuple[DataFrame, Observation]:
    """``df`` and the counts of its failures, which are there after its first action: no pass of their own."""
    seen = Observation()
    return df.observe(seen, *failures(*rules)), seen
