"""Operators 7 and 9 where texts and tables are cut into several blocks or pieces."""

import random

import pytest
from pyspark.sql import functions as F

from stemfold.llm import lm, suffixes


def rows_of(rng, n):
    letters = "abcdefgh "
    return [(k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 400)))) for k in range(n)]


def test_losses_do_not_depend_on_blocks(spark, monkeypatch):
    """Many blocks, one text longer than a block, several copies of the model: the same figures as in one block."""
    rng = random.Random(8)
    rows = [*rows_of(rng, 60), (60, "long text " * 900), (61, None), (62, ""), (None, "no id at all"), (5, "repeated id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    target = spark.createDataFrame([(k,) for k in range(0, 61, 3)], "doc_id bigint")
    read = lambda: sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.target_loss, 9), round(r.background_loss, 9)) for r in lm.cross_entropy_difference(df, target).collect()))
    want = read()
    monkeypatch.setattr(lm, "BLOCK", 1500)
    dealt = lm.blocks(df.select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("in_target")))
    assert dealt.select("block").distinct().count() > 8
    assert read() == want
    monkeypatch.setattr(lm, "SALT", 3)
    assert read() == want


def brute(rows, length):
    """n_bytes, n_removed and n_spans of each id: a scan of all windows in order."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            if w in seen:
                gone[k : k + length] = [True] * length
            seen.add(w)
        out[i] = (len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)))
    return out


@pytest.mark.parametrize("piece", [64 << 20, 700])
def test_repeats_of_a_long_text_are_those_of_all_windows(spark, monkeypatch, piece):
    """A text of many requests, also taken piece by piece, with copies of its parts in it and elsewhere."""
    monkeypatch.setattr(suffixes, "REQUESTED", piece)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    long = text(4000)
    long += long[300:900] + text(50) + long[100:260] + text(50) + long[2000:2099]
    rows = [(1, long), (2, text(30) + long[500:1500] + text(20) + long[5000:5100] + text(9)), (3, long[10_000:10_400] + long[10_200:10_700]), (4, text(60)), (5, "")]
    docs = spark.createDataFrame([*rows, (None, long), (None, long)], "doc_id bigint, text string")
    got = suffixes.drop_repeats(docs, with_bytes=False).collect()
    want = brute([(i, t.encode()) for i, t in rows], 100)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got if r.doc_id is not None} == want
    assert want[1][2] >= 2 and want[2][2] >= 2
    # rows without an id are left whole
    assert [r.n_removed for r in got if r.doc_id is None] == [0, 0]


def test_windows_merge_into_stretches(spark):
    runs = spark.createDataFrame([(1, 0, 1), (1, 5, 3), (1, 17, 1), (1, 18, 1), (1, 40, 2), (1, 40, 1), (2, 3, 1), (2, 3, 1)], "doc long, first long, windows long")
    got = sorted(map(tuple, suffixes.merged_windows(runs, 10).collect()))
    assert got == [(1, 0, 19), (1, 40, 2), (2, 3, 1)]
