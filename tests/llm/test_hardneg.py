"""Operator 12 against a plain search of all pairs."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stemfold.llm.hardneg import Anchors, Block, hard_negatives
from stemfold.llm.queries import ORACLE_SQL, op12_bond_negatives
from tests.conftest import TINY

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, anchor, scale=256, positives=5, negatives=3, low=50, high=95):
    ok = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a, q, lab in {(i, tuple(v), lab) for i, v, lab in ok if anchor(i)}:
        scored = sorted((-dot(q, v), i, other) for i, v, other in ok if i != a)
        ps = [(-s, i) for s, i, other in scored if other == lab][:positives]
        for ps_score, p in ps:
            fit = [(-s, i) for s, i, other in scored if other != lab and low * ps_score <= -100 * s <= high * ps_score][:negatives]
            out |= {(a, p, k + 1, i, ps_score, s) for k, (s, i) in enumerate(fit)}
    return out


def got(df, **options):
    out = hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
    return {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect()}


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{TINY}/embeddings.parquet'")
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = con.execute(ORACLE_SQL["op12_bond_negatives"]).fetchdf()[names]
    have = op12_bond_negatives(spark, TINY).toPandas()[names]
    assert len(have) and set(map(tuple, have.values.tolist())) == set(map(tuple, want.values.tolist())) and len(have) == len(want)


@pytest.mark.parametrize("kind", ["random", "ties", "hot"])
def test_against_all_pairs(spark, kind):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(240, 12)) if kind != "ties" else rng.integers(-1, 2, (240, 12)) / 4
    if kind == "hot":
        v[60:160] = v[60]
    rows = [(k, [float(np.float32(x)) for x in v[k]], 1 if kind == "hot" and k < 200 else k % 3) for k in range(240)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, block_rows=17, anchor_block=9) == plain(rows, lambda i: i % 10 == 0)
    assert got(df) == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (1, None, 1), (2, [1.0, None], 1), (3, [1.0, float("nan")], 1), (4, [float("inf"), 1.0], 1), (5, [1.0], None), (None, [1.0, 1.0], 1), (6, [1.0, 0.5], 1), (7, [0.9], 1), (8, [], 1),
        (9, [0.6, 0.4, 5.0], 2), (11, [0.6, 0.4], 2), (11, [0.6, 0.4], 2), (12, [0.0, 0.0], 3), (10, [0.5, 0.5], 2), (10, [0.5, 0.5], 2), (13, [-1.0, -1.0], 2), (20, [], 5), (30, [1e12, 1.0], 7), (31, [-3e11, 2.0], 7), (32, [5e11, 1.0], 8),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    some = [r for r in rows if r[0] not in (30, 31, 32)]
    assert got(df.where("vec_id NOT IN (30, 31, 32) OR vec_id IS NULL")) == plain(some, lambda i: i % 10 == 0)
    assert got(df.where("vec_id < 30")) <= got(df.where("vec_id IS NULL OR vec_id < 30"))
    # components that a long could not hold as a score take no part
    assert got(df) == plain(some, lambda i: i % 10 == 0)
    assert got(df.limit(0)) == set()
    assert hard_negatives(df.where("vec_id = 1"), F.lit(True)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(k, [float(1000 * k + 1), float(-(k % 5) * 90_001), 3e5], k % 2) for k in range(60)]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), scale=1 << 10) == plain(rows, lambda i: i % 10 == 0, 1 << 10)


def test_bounds_hold_and_shrink():
    rng = np.random.default_rng(5)
    m = (rng.normal(size=(500, 32)) * np.geomspace(300, 3, 32)).astype(np.int64)
    anchors = Anchors(np.arange(4), np.zeros(4, np.int64), m[:4], [])
    order = anchors.order()
    block = Block(np.arange(500, dtype="<i8").tobytes(), np.zeros(500, "<i8").tobytes(), [c.astype("<i2").tobytes() for c in m.T], anchors, order)
    exact = m[:4] @ m.T
    for a in range(4):
        part = m[a, order[a, :8]] @ m[:, order[a, :8]].T
        assert (part + block.above[a, 8] >= exact[a]).all() and (part + block.below[a, 8] <= exact[a]).all()
        low, high = np.sort(exact[a])[[440, 470]]
        rows, scores = block.between(a, order[a], np.arange(500), low, high)
        assert sorted(rows) == np.flatnonzero((exact[a] >= low) & (exact[a] <= high)).tolist() and (scores == exact[a, rows]).all()
        rows, _ = block.between(a, order[a], np.arange(500), -np.inf, np.inf, 5)
        assert set(np.argsort(-exact[a], kind="stable")[:5]) <= set(rows) and len(rows) < 250
