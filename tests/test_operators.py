"""Cases computed by hand, and properties."""

import math

import pytest
from pyspark.sql import functions as F

from stemfold.functions import draws as D
from stemfold.functions import scalars as S
from stemfold.operators import curate as C
from stemfold.operators import expect as Q
from stemfold.operators import levels as L
from stemfold.operators import scans as N
from stemfold.operators import segments as W
from stemfold.operators import splits as P
from stemfold.operators import stats as A
from stemfold.operators import timeline as T


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_run_length_ends_after_the_last_frame(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 5, None), ("b", 6, None)], "k string, pos int, c string")
    got = sorted(values(W.run_length(df, "k", "pos", "c", 0.5), "k", "start_time", "end_time"))
    assert got == [("a", 0.0, 1.0), ("a", 1.0, 1.5), ("b", 0.0, 1.0)]


def test_rechunk_at_the_bounds(spark):
    df = spark.createDataFrame([(1, 12.0), (2, 12.5), (3, 3.0), (4, 2.9), (5, 25.0)], "k int, duration double")
    got = sorted(values(W.rechunk(df, 3, 12, ["k"]), "k", "part", "start_time", "end_time"))
    assert [g[0] for g in got] == [1, 2, 2, 3, 5, 5, 5]
    assert got[1] == (2, 0, 0.0, 6.25) and got[6][3] == 25.0


def test_nonsilent_merges_short_silence_and_clamps(spark):
    levels = [-10, -90, -10, -90, -90, -90, -10]
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(levels)], "k int, pos int, v double")
    got = sorted(values(W.nonsilent(df, "k", "pos", "v", 0.5), "start_time", "end_time"))
    assert got == [(0.0, pytest.approx(1.6)), (pytest.approx(2.9), 3.5)]


def test_label_precedence(spark):
    m = {"a": "foreground", "b": "background", "c": "unusable"}
    df = spark.createDataFrame([("a,b",), ("a,c",), ("b",), ("z",), ("a, a",)], "x string")
    cls = S.label_classes(F.col("x"), m)
    assert [r[0] for r in df.select(S.one_class(cls, 2)).collect()] == ["foreground", "unusable", "background", None, "foreground"]
    assert [r[0] for r in df.select(S.one_class(cls, 3)).collect()] == ["unusable", "unusable", "background", None, "foreground"]


def test_usage_class_of_unclear_flags(spark):
    df = spark.createDataFrame([(True, True), (False, True), (True, None), (None, True)], "c boolean, d boolean")
    assert [r[0] for r in df.select(S.usage_class(F.col("c"), F.col("d"))).collect()] == ["com", "nc", "nd", "nc"]


def test_levels_of_silence(spark):
    df = spark.createDataFrame([([0.0] * 64,), ([1.0] * 64,)], "x array<double>")
    got = [r[0] for r in df.select(S.gated_level(F.col("x"), 40)).collect()]
    assert got[0] == -math.inf and got[1] == pytest.approx(-0.691)
    out = L.normalize(df, "x", -23.0, 40).collect()
    assert out[0]["gain"] == 0.0 and out[1]["gain"] == pytest.approx(-22.309)


def test_duck_acts_above_the_threshold_only(spark):
    df = spark.createDataFrame([([0.1],), ([2.0],)], "x array<double>")
    out = L.duck(df, "x", 0.0).collect()
    assert out[0]["x"] == [0.1] and out[1]["x"][0] == pytest.approx(1.0, abs=1e-6)


def test_mix_is_the_sum_of_stems(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0]), (2, [5.0])], "k int, x array<double>")
    assert sorted((r[0], list(r[1])) for r in L.mix(df, ["k"], "x").collect()) == [(1, [4.0, 2.0]), (2, [5.0])]


def test_truncated_length_where_high_is_not_above_low(spark):
    df = spark.range(1).select(D.trunc_length(F.lit(0.3), F.lit(1.0), F.lit(1.0), F.lit(5.0), F.lit(4.0)).alias("x"))
    assert df.first()[0] == 4.0


def test_offset_is_zero_when_nothing_is_left(spark):
    assert spark.range(1).select(D.segment_offset(F.lit(0.9), F.lit(10), F.lit(10))).first()[0] == 0


def test_counts_are_at_least_one_and_have_the_mean(spark):
    df = spark.range(20_000).select(F.lit(2.0).alias("mu"), D.u(1, "t", F.col("id")).alias("p"))
    got = D.truncated_poisson(df, "mu", "p", 1, None, "n").agg(F.min("n"), F.avg("n")).first()
    assert got[0] == 1 and got[1] == pytest.approx(2 / (1 - math.exp(-2)), abs=5 * 1.5 / math.sqrt(20_000))


def test_quantile_inverts_the_distribution(spark):
    df = spark.range(1, 100).select((F.col("id") / 100).alias("p"))
    assert df.select(F.max(F.abs(D.normal_cdf(D.normal_quantile(F.col("p"))) - F.col("p")))).first()[0] < 2e-7


def test_probabilities_sum_to_one_and_follow_users(spark):
    clips = spark.createDataFrame([("eng",)] * 3 + [("fra",)] * 2 + [("xxx",)], "langcode string")
    fam = spark.createDataFrame([("g", ["eng"], 3_000_000), ("r", ["fra"], 10)], "language_family string, members array<string>, users bigint")
    got = dict(C.sampling_probability(clips, fam).groupBy("language_family").agg(F.sum("sample_prob")).collect())
    assert sum(got.values()) == pytest.approx(1) and got["g"] == pytest.approx(0.6) and got["xxx"] == pytest.approx(0.2)


def test_weighted_draw_gives_one_item_a_draw(spark):
    w = spark.createDataFrame([(i, float(i % 5)) for i in range(200)], "item long, w double")
    d = spark.range(5000).select("id", D.u(1, "x", F.col("id")).alias("p"))
    got = D.weighted_draw(d, w, "item", "w", "p")
    assert got.count() == 5000 and got.where("item % 5 = 0").count() == 0


def test_groups_stand_in_one_split(spark):
    df = spark.createDataFrame([(i % 50, i % 2 == 0 and "a" or "b") for i in range(400)], "g int, s string")
    one, two = (P.group_split(d, "g", ["s"], 3).orderBy("g").collect() for d in (df.repartition(2), df.repartition(7)))
    assert one == two and len({r["g"] for r in one}) == 50 == len(one)
    assert {r["split"] for r in one} == {"train", "val", "test"}


@pytest.mark.parametrize("overlap", [0.0, 0.5, 1.0])
def test_placements_are_inside_and_ordered(spark, overlap):
    cfg = T.Placement(overlap=overlap)
    ev = spark.range(300).select((F.col("id") % 20).alias("k"), F.col("id").alias("event"), (F.col("id") % 17 + 1).cast("double").alias("len"), F.lit("f").alias("file"))
    got = T.place(T.candidates(ev, "k", 5, 1), "k", cfg).toPandas()
    assert len(got) and (got.start_sample >= 0).all() and (got.start_sample + got.length_sample <= 60 * 48_000).all() and (got.length_sample > 0).all()
    assert (got.groupby("k").event.nunique() == got.groupby("k").size()).all()
    if overlap == 0:
        for _, g in got.sort_values("start_sample").groupby("k"):
            assert (g.start_sample.values[1:] + 1 >= (g.start_sample + g.length_sample).values[:-1]).all()
    again = T.place(T.candidates(ev.repartition(5), "k", 5, 1), "k", cfg).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, again.values))


def test_exhaust_uses_each_file_once_a_loop(spark):
    counts = spark.range(40).select(F.col("id").alias("idx"), F.lit(5).alias("n"))
    got = T.exhaust(spark.range(100), "id", counts, 1, 2).toPandas()
    assert len(got) == 200 and (got.groupby(["loop", "id"]).size() == 1).all() and (got.groupby("idx").size() == 5).all()


def test_balanced_split_keeps_speakers_whole(spark):
    df = spark.createDataFrame([("c", f"s{i}", "female" if i % 2 else "male", 1.0 + i % 7) for i in range(60)], "corpus string, speaker string, gender string, duration double")
    got = P.balanced_split(df, {"train": 0.7, "val": 0.1, "test": 0.2}, 0.15, 6).toPandas()
    assert len(got) == 60 and got.speaker.is_unique and got.accepted.all()
    size = df.toPandas().merge(got, on="speaker").groupby("split").duration.sum()
    assert size["train"] / size.sum() == pytest.approx(0.7, abs=0.05)


def test_missing_manifest_is_left_out(spark, tmp_path):
    from stemfold.sources.manifests import read_manifest

    assert read_manifest(spark, f"file://{tmp_path}/none.csv", "a int", missing_ok=True) is None
    (tmp_path / "x.tsv").write_text("# one\n# two\nid\tname\n1\tb\n\n2\tc\n")
    assert values(read_manifest(spark, f"file://{tmp_path}/x.tsv", "id int, name string", "tab", 3), "id", "name") == [(1, "b"), (2, "c")]


def test_inventory_reads_no_contents(spark, tmp_path):
    from stemfold.sources.manifests import inventory

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.wav").write_bytes(b"12345")
    (tmp_path / "y.txt").write_bytes(b"1")
    got = inventory(spark, f"file://{tmp_path}", "*.wav", {"variant": "v"}).collect()
    assert [(r["length"], r["variant"]) for r in got] == [(5, "v")] and got[0]["path"].endswith("a/x.wav")


def test_speaker_and_gender_of_odd_names(spark):
    df = spark.createDataFrame([("a/b/x_y_z.wav",), ("solo.wav",), ("p_q.flac",)], "p string")
    st = S.speaker_track(F.col("p"))
    assert values(df.select(st["speaker"].alias("s"), st["track"].alias("t")), "s", "t") == [("y", "z"), (None, None), ("p", "q")]
    g = spark.createDataFrame([("M",), ("female_unsure",), (None,), ("NaN",), ("x",)], "g string")
    assert [r[0] for r in g.select(S.gender(F.col("g"))).collect()] == ["male", "female", "unknown", "unknown", None]


def test_violations_of_each_rule(spark):
    from stemfold.operators import expect as Q

    df = spark.createDataFrame([(1, "a", "train", 1.0), (2, None, "test", float("nan")), (3, "a", "test", 3.0)], "id int, g string, split string, x double")
    found = Q.violations(Q.required(df, "g", "id"), Q.disjoint(df, "g"), Q.finite(df, "x", "id"), Q.fixed_length(df, "x", 1.0, "id"), Q.inside(df, "id", F.lit(0), F.col("id"), 2), Q.sizes(df, "split", {"train": 1, "val": 2}))
    got = sorted((r["rule"], r["key"]) for r in found.collect())
    assert got == [("disjoint", "a"), ("finite", "2"), ("inside", "3"), ("length", "2"), ("length", "3"), ("required", "2"), ("size", "val")]


def test_names_that_are_no_open_licence_grant_nothing(spark):
    names = ["All rights reserved", "CC BY-NC 4.0", "Creative Commons NC", "Licence Art Libre", "com", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "n string").withColumn("f", S.license_flags(F.col("n")))
    got = values(df.select("f.commercial", S.usage_class(F.col("f.commercial"), F.col("f.derivative")).alias("use"), S.license_name(F.col("n")).alias("name")), "commercial", "use", "name")
    assert got == [(None, "nd", None), (False, "nc", "CC-BY-NC"), (None, "nd", "Unclear CC License"), (True, "com", "Art Libre"), (None, "nd", None), (None, "nd", None), (None, "nd", None)]


def test_clips_without_a_code_keep_a_probability(spark):
    df = spark.createDataFrame([("eng",), (None,), ("xyz",), ("eng",), (None,)], "langcode string")
    families = spark.createDataFrame([("germanic", ["eng", "eng"], 4_000_000)], "language_family string, members array<string>, users bigint")
    got = sorted((r["langcode"] or "", r["n_files"], round(r["sample_prob"], 9)) for r in C.sampling_probability(df, families).collect())
    assert got == [("", 2, round(1 / 12, 9)), ("", 2, round(1 / 12, 9)), ("eng", 2, round(1 / 3, 9)), ("eng", 2, round(1 / 3, 9)), ("xyz", 1, round(1 / 6, 9))]


def test_outputs_without_the_mixture(spark, tmp_path):
    from stemfold.sources import manifests as M

    df = spark.createDataFrame([(1, "mixture"), (1, "speech"), (1, "speech"), (1, "music_sfx"), (2, None)], "idx int, submix string").selectExpr("*", "'default' AS subset", "'train' AS split")
    assert sorted(values(M.outputs(df, ["idx"], True), "submix")) == [("mixture",), ("music_sfx",), ("speech",)]
    assert sorted(values(M.outputs(df, ["idx"], False), "submix")) == [("music_sfx",), ("speech",)]
    M.write_annotations(df, str(tmp_path / "a"), ["music_sfx"])
    assert values(spark.read.parquet(str(tmp_path / "a")), "submix") == [("speech",)] * 2


def test_sources_without_a_subset_are_listed(spark):
    df = spark.createDataFrame([("full/48k", None), ("a", None), (None, None), ("a", "nc")], "source string, subset string")
    assert sorted(values(C.without_subset(df), "source"), key=str) == [("a",), (None,)]
    assert sorted(values(C.select_subset(df, "nc"), "source")) == [("a",), ("full/48k",)]


def test_quantiles_are_exact_in_blocks(spark):
    import numpy as np

    from stemfold.operators import stats as A

    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=501).tolist(), "b": [1.0, 2.0], None: [5.0] * 40 + [7.0], "c": [4.0], "d": rng.integers(0, 5, 300).astype(float).tolist()}
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("a", None), ("a", float("nan")), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: [r[f"q{j}"] for j in range(len(shares))] for r in A.quantiles(df, F.col("v"), ["k"], shares, blocks=8).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k] == pytest.approx(np.quantile(vs, shares).tolist())
    assert {r["k"] for r in A.describe(df, F.col("v"), "k").collect()} == {*data, "e"}


def test_mix_and_overlap_in_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(L, "BLOCK", 5)
    rng = np.random.default_rng(1)
    stems = [(k % 3, rng.normal(size=int(rng.integers(0, 23))).tolist(), int(rng.integers(-6, 30))) for k in range(20)]
    df = spark.createDataFrame(stems, "m int, x array<double>, start int")
    got = {r["m"]: r["signal"] for r in L.mix(df, ["m"], "x").collect()}
    added = {(r["m"], r["pos"]): r["x"] for r in L.overlap_add(df, ["m"], "start", "x", 33).collect()}
    assert len(added) == 3 * 33
    for m in range(3):
        own = [(np.array(x), s) for k, x, s in stems if k == m]
        want = np.zeros(max(len(x) for x, _ in own))
        line = np.zeros(100)
        for x, s in own:
            want[: len(x)] += x
            line[s + 20 : s + 20 + len(x)] += x
        assert got[m] == pytest.approx(want.tolist())
        assert [added[m, p] for p in range(33)] == pytest.approx(line[20:53].tolist())


def test_ladder_steps_are_those_of_single_thresholds(spark):
    import random

    rng = random.Random(4)
    df = spark.createDataFrame([(k, i, rng.choice([-60.0, -30.0, -12.0, -5.0])) for k in range(6) for i in range(60)], "k int, pos int, v double")
    drops = [30.0, 20.0, 5.0]
    single = {j: sorted(values(W.nonsilent(df, "k", "pos", "v", 0.5, d), "k", "start_time", "end_time")) for j, d in enumerate(drops)}
    got = values(W.ladder_split(df, "k", "pos", "v", 0.5, 4.0, drops), "k", "step", "start_time", "end_time")
    for k in range(6):
        fit = [j for j in single if any(r[0] == k for r in single[j]) and all(b - a <= 4.0 for kk, a, b in single[j] if kk == k)]
        want = fit[0] if fit else max(j for j in single if any(r[0] == k for r in single[j]))
        assert sorted((a, b) for kk, _, a, b in got if kk == k) == [(a, b) for kk, a, b in single[want] if kk == k]


def test_balanced_split_picks_as_the_plain_search_does(spark):
    rows = [("c", f"s{k}", "female" if k % 3 else "male", float((k * 37) % 11 + 1)) for k in range(60)]
    share = {"train": 0.7, "val": 0.1, "test": 0.2}
    got = {r["speaker"]: (r["split"], r["seed"]) for r in P.balanced_split(spark.createDataFrame(rows, "corpus string, speaker string, gender string, duration double"), share, 1.0, 1).collect()}
    draws = {r["s"]: r["d"] for r in spark.createDataFrame([(s,) for _, s, _, _ in rows], "s string").select("s", D.u(0, "balance", F.lit(0), F.col("s")).alias("d")).collect()}
    order = sorted(((draws[s], s, d) for _, s, _, d in rows))
    left, need = {k: d for k, (_, _, d) in enumerate(order)}, {s: p * sum(r[3] for r in rows) for s, p in share.items()}
    while left:
        name = max(need, key=lambda s: (need[s], s))
        pick = min(left, key=lambda k: (abs(left[k] - need[name]), k))
        need[name] -= left.pop(pick)
        assert got[order[pick][1]] == (name, 0)


def test_precomputed_draws_and_shuffles_by_their_names(spark):
    made = T.precompute(spark, {"train": 5, "val": 2}, 3, -17.0, 2.0, -27.0, 1.0, 12.0)
    rows = made.select("split", "idx")
    again = T.precomputed_draws(rows, 3, -17.0, 2.0, -27.0, 1.0, 12.0)
    cols = ["split", "idx", "speech_lufs", "master_lufs", "speech_segments"]
    assert sorted(values(made, *cols)) == sorted(values(again, *cols)) and made.count() == 7
    keys = spark.range(50).withColumnRenamed("id", "key")
    draw = D.u(6, "shuffle", F.col("key"))
    plain = [r[0] for r in values(C.seeded_shuffle(keys, draw, "key"), "key")]
    counts = spark.createDataFrame([(0, 50)], "idx bigint, n bigint")
    slots = sorted(values(T.exhaust(keys, "key", counts, 6, tag="shuffle", keyed_by_loop=False), "slot", "key"))
    assert [k for _, k in slots] == plain


def test_headers_are_dropped_from_each_file_and_not_from_its_later_splits(spark, tmp_path):
    from stemfold.sources import manifests as M

    for f in range(3):
        (tmp_path / f"{f}.txt").write_text("# a\n# b\nid\tname\n" + "".join(f"{f * 1000 + k}\tn{k}\n" for k in range(400)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900b")
    try:
        got = M.read_manifest(spark, str(tmp_path), "id int, name string", "tab", 3)
        assert sorted(r["id"] for r in got.collect()) == [f * 1000 + k for f in range(3) for k in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from stemfold.sources import scratch

    kept, scratch._own_dir[:] = scratch._own_dir[:], []
    try:
        conf = {"spark.master": "spark://host:7077"}
        with pytest.raises(RuntimeError):
            scratch.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d))))
        assert scratch.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: "/shared/" if k == "spark.checkpoint.dir" else d))) == "/shared"
    finally:
        scratch._own_dir[:] = kept


def test_what_was_cut_can_be_cleared(spark):
    import os

    from stemfold.sources import scratch

    df = scratch.cut(spark.range(5), "small")
    folder = scratch.fresh(spark, "x").removeprefix("file://").rpartition("/")[0]
    assert df.count() == 5 and os.path.isdir(folder)
    scratch.clear(spark)
    assert not os.path.isdir(folder)


def _plain_level(powers):
    """The level of the mean squares of hops, by hand."""
    if len(powers) < 4:
        blocks = [sum(powers) / len(powers)]
    else:
        blocks = [sum(powers[k : k + 4]) / 4 for k in range(len(powers) - 3)]
    db = lambda p: 10 * math.log10(p) - 0.691 if p > 0 else -math.inf
    first = [p for p in blocks if db(p) > -70]
    second = [p for p in first if db(p) > db(sum(first) / len(first)) - 10]
    return db(sum(second) / len(second)) if second else -math.inf


def test_levels_in_long_form_are_those_of_arrays(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    clips = {k: rng.normal(size=n) * np.where(np.arange(n) // 30 % 3, 1.0, 1e-5) for k, n in enumerate((1, 2, 5, 31, 32, 33, 64, 399, 1000))} | {90: np.zeros(100)}
    arrays = spark.createDataFrame([(k, x.tolist()) for k, x in clips.items()], "k int, x array<double>")
    want = {r.k: r.v for r in arrays.select("k", S.gated_level(F.col("x"), 40).alias("v")).collect()}
    long = arrays.select("k", F.posexplode("x").alias("pos", "x")).repartition(7)
    got = {r.k: r.level for r in L.gated_levels(long, ["k"], "pos", "x", 40).collect()}
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        L.gated_levels(long, ["k"], "pos", "x", 44)
    # mastering: the same gain for all stems, as the form with arrays gives it
    stems = spark.createDataFrame([("m", s, rng.normal(size=200).tolist()) for s in "abc"], "m string, s string, x array<double>")
    whole = {r.s: r.x for r in L.master(stems, ["m"], "x", -20.0, 40).collect()}
    parts = L.master_long(stems.select("m", "s", F.posexplode("x").alias("pos", "x")), ["m"], "pos", "x", -20.0, 40).orderBy("pos").toPandas()
    for s, x in whole.items():
        assert parts[parts.s == s].x.tolist() == pytest.approx(x)
    after = L.gated_levels(L.normalize_long(long.where("k <> 90"), ["k"], "pos", "x", -20.0, 40).drop("measured", "gain"), ["k"], "pos", "x", 40).toPandas()
    assert after.level.tolist() == pytest.approx([-20.0 if want[k] > -math.inf else -math.inf for k in after.k], abs=1e-6)


def test_one_long_signal_is_spread_over_tasks(spark):
    n = 400_000
    long = spark.range(n).select(F.lit("one").alias("k"), F.col("id").alias("pos"), F.sin(F.col("id") / 7).alias("x"))
    got = L.gated_levels(long, ["k"], "pos", "x", 1000).first().level
    assert got == pytest.approx(10 * math.log10(0.5) - 0.691, abs=1e-3)


def test_stretches_are_differences_of_two_entries(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    powers = rng.random(50)
    powers[10:22] = 0.0
    hops = spark.createDataFrame([("f", k, float(p)) for k, p in enumerate(powers)], "file string, pos int, power double")
    table = T.energy_table(hops, "file", "pos", "power")
    cases = [(a, n) for a in (0, 3, 100, 105, 110, 119, 130, 215, 480, 499) for n in (1, 9, 10, 35, 40, 55, 90, 300) if a + n <= 500]
    asked = spark.createDataFrame(cases, "a long, n long").crossJoin(table)
    got = {(r.a, r.n): r.v for r in asked.select("a", "n", T.stretch_level(F.struct("energy", "loud", "loud_energy"), F.col("a"), F.col("n"), 10).alias("v")).collect()}
    for a, n in cases:
        lo, hi = -(-a // 10), (a + n) // 10
        own = powers[a // 10 : -(-(a + n) // 10)] if hi - lo < 4 else powers[lo:hi]
        want = _plain_level(own) if hi - lo >= 4 else (10 * math.log10(sum(own) / len(own)) - 0.691 if sum(own) else -math.inf)
        # finite exactly when both gates let something pass, and never above
        assert (got[a, n] > -math.inf) == (want > -math.inf), (a, n)
        assert got[a, n] <= want + 1e-9


def test_silent_events_are_skipped_and_leave_the_clock(spark):
    cfg = T.Placement(overlap=0.0, rate=1000, min_prop=0.1, length_loc=0.3)
    files = {"loud": [1.0] * 200, "silent": [0.0] * 200, "half": [0.0] * 100 + [1.0] * 100}
    hops = spark.createDataFrame([(f, k, p) for f, ps in files.items() for k, p in enumerate(ps)], "file string, pos int, power double")
    energy = T.energy_table(hops, "file", "pos", "power")
    ev = spark.createDataFrame([(k, e, 8.0 if f != "half" else 20.0, f) for k in range(30) for e, f in enumerate(["loud", "silent", "gone", "half", "loud"])], "k long, event long, len double, file string")
    tried = T.candidates(ev, "k", 10, 1)
    got = T.place(tried, "k", cfg, energy).toPandas()
    assert len(got) and set(got.event) <= {0, 3, 4}
    # what is left is placed as if the skipped events had not been there
    without = T.place(tried.where("event NOT IN (1, 2)"), "k", cfg, energy).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, without.values))
    half = got[got.event == 3]
    assert (half.segment_start_sample + half.length_sample > 10_000).all() and (half.trial > 0).any()
    assert len(T.place(tried, "k", cfg).where("event IN (1, 2)").take(1))


def _ingested(spark, batches, tmp_path, remember="1 hour", rows_before=None):
    from stemfold.plans.curation import FLAGS, URLS
    from stemfold.sources.manifests import store_new
    from stemfold.streaming.ingest import ingest

    urls = spark.createDataFrame(URLS, "url string, license string, license_family string")
    flags = spark.createDataFrame(FLAGS, "license_family string, attribution boolean, commercial boolean, derivative boolean, share_alike boolean")
    schema = "cleaned_path string, license_url string, note string"
    source, target, checkpoint = (str(tmp_path / k) for k in ("in", "out", "checkpoint"))
    if rows_before:
        store_new(C.resolve_license(spark.createDataFrame(rows_before, schema), urls, flags), target, "cleaned_path")
    state = []
    for rows in batches:
        spark.createDataFrame([(p, URLS[0][0], n) for p, n in rows], schema).coalesce(1).write.mode("append").option("header", "true").csv(source)
        q = ingest(spark, source, schema, urls, flags, target, checkpoint, remember)
        q.awaitTermination()
        state.append(max((o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]), default=0))
    got = spark.read.parquet(target).select("cleaned_path", "note").collect()
    return sorted(map(tuple, got), key=str), state


def test_ingest_stores_each_path_once(spark, tmp_path):
    from stemfold.plans.curation import URLS

    before = [("/a/0", URLS[0][0], "old")]
    batches = [[("/a/0", "new"), ("/a/1", "z"), ("/a/1", "b"), ("/a/1", None), (None, "x")], [("/a/1", "again"), ("/b/2", "c")], [("/b/2", "c"), ("/a/0", "new")], [("/c/3", "d")] * 3]
    got, state = _ingested(spark, batches, tmp_path, rows_before=before)
    # a null sorts before any text; what is stored stays
    assert got == [("/a/0", "old"), ("/a/1", None), ("/b/2", "c"), ("/c/3", "d")]
    assert state == [4, 6, 6, 7]


def test_ingest_forgets_what_the_table_remembers(spark, tmp_path):
    batches = [[(f"/{k}/{i}", "n") for i in range(50)] for k in range(3)]
    source = [batches[0], batches[1], batches[0] + batches[2]]
    got, state = _ingested(spark, source, tmp_path, remember="0 seconds")
    assert len(got) == 150 and len({p for p, _ in got}) == 150
    assert max(state) <= 100  # never the 150 paths that were seen


def test_new_rows_read_only_the_buckets_they_touch(spark, tmp_path):
    from stemfold.sources.manifests import folder_bucket, store_new

    target = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"/f{k % 40}/{k}", k) for k in range(400)], "cleaned_path string, n long")
    store_new(rows, target, "cleaned_path", 64)
    assert spark.read.parquet(target).where(F.col("bucket") != folder_bucket("cleaned_path", 64)).count() == 0
    store_new(spark.createDataFrame([("/f1/1", 7), ("/f1/new", 5), ("/f1/new", 4)], "cleaned_path string, n long"), target, "cleaned_path", 64)
    got = spark.read.parquet(target)
    assert got.count() == 401 and got.where("cleaned_path = '/f1/new'").first().n == 4
    plain = str(tmp_path / "plain")
    rows.write.parquet(plain)
    store_new(rows.limit(9).unionByName(spark.createDataFrame([("/x", 1)], "cleaned_path string, n long")), plain, "cleaned_path")
    assert spark.read.parquet(plain).count() == 401


@pytest.mark.parametrize("mu", [0.1, 12.0, 200.0, 5000.0])
def test_counts_have_the_mean_and_variance_of_their_law(spark, mu):
    n = 200_000
    d = spark.range(n).select(F.lit(mu).alias("mu"), ((F.col("id") + 0.5) / n).alias("p"))
    got = D.truncated_poisson(d, "mu", "p", 0, None, "k").agg(F.avg("k"), F.var_samp("k"), F.count("k")).first()
    assert got[2] == n and got[0] == pytest.approx(mu, rel=0.01) and got[1] == pytest.approx(mu, rel=0.01)


def test_counts_in_tails_and_without_a_mean(spark):
    rows = [(5.0, 0.0), (5.0, 0.999), (0.0, 0.5), (None, 0.5), (3000.0, 0.5), (5.0, None)]
    d = spark.createDataFrame(rows, "mu double, p double")
    far = [r.k for r in D.truncated_poisson(d, "mu", "p", 100, 2000, "k").orderBy("mu", "p").collect()]
    assert far == [None, 100, None, 100, 102, 1999]
    assert sorted(r.k for r in D.truncated_poisson(d.where("mu = 5 AND p IS NOT NULL"), "mu", "p", 7, 7, "k").collect()) == [7, 7]


def test_quantiles_of_a_frequent_value_rank_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    x = np.where(rng.random(40_000) < 0.9, 3.0, rng.normal(size=40_000))
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(6)
    got = A.quantiles(df.withColumn("g", F.lit(1)), F.col("v"), ["g"], [0.01, 0.05, 0.25, 0.5, 0.95], blocks=16).first()
    assert [got[f"q{k}"] for k in range(5)] == pytest.approx(np.quantile(x, [0.01, 0.05, 0.25, 0.5, 0.95]).tolist())
    # the value of 36,000 rows is one of the rows that are ranked
    pairs = A.value_pairs(df.select(F.lit(1).alias("g"), F.lit(0).alias("block"), "v"), ["g"])
    assert pairs.count() == len(np.unique(x)) and pairs.where("v = 3").first().c == (x == 3).sum()


def test_licences_of_a_url_listed_twice_are_defined(spark):
    urls = spark.createDataFrame([("http://a", "Z", "z"), ("https://a", "B", "b"), ("http://a", "C", "c")], "url string, license string, license_family string")
    flags = spark.createDataFrame([("b", True, True, True, False), ("b", True, False, True, False)], "license_family string, attribution boolean, commercial boolean, derivative boolean, share_alike boolean")
    for k in (1, 5):
        got = C.resolve_license(spark.createDataFrame([("https://a",)], "license_url string"), urls.repartition(k), flags).first()
        assert (got.license, got.commercial) == ("B", False)


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_scans_are_the_plain_operators(spark, blocks):
    import numpy as np

    rng = np.random.default_rng(6)
    rows = [(k, i, c, float(v)) for k, n in (("long", 400), ("one", 1), ("flat", 60), (None, 30)) for i, (c, v) in enumerate(zip(np.repeat(rng.integers(0, 3, n), rng.integers(1, 9, n))[:n].tolist(), np.repeat(rng.normal(50, 30, n), rng.integers(1, 9, n))[:n], strict=True))]
    rows = [(k, i * 3 - 7, None if c == 2 else 0 if k == "flat" else c, v) for k, i, c, v in rows]
    df = spark.createDataFrame(rows, "k string, pos int, c int, v double").repartition(5)
    same = lambda a, b: sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.select(a.columns).collect()), key=str)
    assert same(W.run_length(df, "k", "pos", "c", 0.5).select("k", "class", "start_time", "end_time"), N.run_length_scan(df, "k", "pos", "c", 0.5, blocks))
    known = df.where("k IS NOT NULL")
    assert same(W.nonsilent(known, "k", "pos", "v", 0.5), N.nonsilent_scan(known, "k", "pos", "v", 0.5, blocks=blocks))
    assert same(W.ladder_split(known, "k", "pos", "v", 0.5, 8.0, [60.0, 20.0, 5.0]), N.ladder_split_scan(known, "k", "pos", "v", 0.5, 8.0, [60.0, 20.0, 5.0], blocks=blocks))
    assert N.run_length_scan(df.limit(0), "k", "pos", "c").count() == 0


def test_a_run_may_reach_over_many_blocks_of_one_key(spark):
    n = 300_000
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("pos"), F.when(F.col("id") < 250_000, "a").when(F.col("id") < 250_001, "b").otherwise("a").alias("c"))
    held = N.in_blocks(df, ["k"], "pos", 16)
    sizes = [r["count"] for r in held.groupBy("_block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * n / 16  # no task holds the key
    got = sorted(map(tuple, N.run_length_scan(df, "k", "pos", "c", 1.0, 16).select("class", "start_time", "end_time").collect()), key=lambda r: r[1])
    assert got == [("a", 0.0, 250_000.0), ("b", 250_000.0, 250_001.0), ("a", 250_001.0, 300_000.0)]


def _plain_assignment(durations, need):
    left, need, out = list(range(len(durations))), dict(need), [""] * len(durations)
    while left:
        name = max(need, key=lambda s: (need[s], s))
        k = min(left, key=lambda k: (abs(durations[k] - need[name]), k))
        left.remove(k)
        out[k] = name
        need[name] -= durations[k]
    return out


def test_nearest_durations_as_by_plain_search():
    import random
    import time

    rng = random.Random(3)
    for n in (0, 1, 2, 7, 60, 300):
        for spread in (3, 40, 10**6):
            d = [float(rng.randint(1, spread)) for _ in range(n)]
            need = {"train": 0.7 * sum(d), "val": 0.1 * sum(d), "test": 0.2 * sum(d)}
            assert P.assign_nearest(d, need) == _plain_assignment(d, need)
    d = [rng.random() for _ in range(400_000)]
    began = time.time()
    P.assign_nearest(d, {"train": 0.7 * sum(d), "val": 0.1 * sum(d), "test": 0.2 * sum(d)})
    assert time.time() - began < 30


def test_shares_of_bins_are_whole_and_in_proportion():
    p = {"train": 0.7, "val": 0.1, "test": 0.2}
    got = P.shares_of_bins([1, 3, 10, 997, 4], [900.0, 50.0, 9.0, 1.5, 0.1], p)
    assert [sum(x) for x in got] == [1, 3, 10, 997, 4] and all(min(x) >= 0 for x in got)
    got = P.shares_of_bins([1000, 5000], [10.0, 2.0], p)
    assert [sum(x[k] for x in got) for k in range(3)] == [4200, 600, 1200]


def test_a_corpus_of_any_size_is_balanced_by_bins(spark):
    i = F.col("id")
    one = spark.range(200_000).select(F.lit("big").alias("corpus"), F.concat(F.lit("s"), i).alias("speaker"), F.when(F.hash(i) % 3 == 0, "female").otherwise("male").alias("gender"), (F.lit(5.0) + F.when(i % 2 == 0, F.lit(0.0)).otherwise(F.pmod(F.hash(i, F.lit(1)), F.lit(9000)) / 10.0)).alias("duration"))
    few = spark.createDataFrame([("few", "a", "female", 3.0), ("few", "b", None, 0.0), ("few", "c", "male", 2.0)], "corpus string, speaker string, gender string, duration double")
    got = P.balanced_split_binned(one.unionByName(few), {"train": 0.7, "val": 0.1, "test": 0.2}, 0.05, 2).join(one.select("speaker", "gender", "duration"), "speaker", "left").toPandas()
    big = got[got.corpus == "big"]
    assert len(big) == 200_000 and big.speaker.is_unique and big.accepted.all() and big.split.notna().all()
    d = big.groupby("split").duration.sum() / big.duration.sum()
    assert [d["train"], d["val"], d["test"]] == pytest.approx([0.7, 0.1, 0.2], abs=0.002)
    ratio = big[big.gender == "female"].groupby("split").duration.sum() / big.groupby("split").duration.sum()
    assert ratio.max() - ratio.min() < 0.02
    assert sorted(got[got.corpus == "few"].speaker) == ["a", "b", "c"]


def test_rules_of_a_table_are_checked_in_one_pass(spark, tmp_path):
    rows = [(k, None if k == 3 else "x", float(k), f"g{k % 3}", "a" if k < 50 else "b", "F" if k % 10 else "O") for k in range(100)] * 2 + [(None, "", math.nan, None, "c", "Z")]
    df = spark.createDataFrame(rows, "id long, name string, v double, g string, s string, st string")
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    row = [Q.missing_value("name", "id"), Q.not_finite("v", "id"), Q.not_inside("id", F.col("v"), F.lit(1), 95), Q.other_length("v", 7.0, "id")]
    found = Q.check(df, *row, Q.OneRule("disjoint", F.col("g"), F.col("s")), Q.SizeRule("size", F.col("st"), {"F": 180, "O": 21, "X": 5}))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    plain = Q.violations(
        Q.required(df, "name", "id"), Q.finite(df, "v", "id"), Q.inside(df, "id", F.col("v"), F.lit(1), 95), Q.fixed_length(df, "v", 7.0, "id"), Q.disjoint(df.where("g IS NOT NULL").selectExpr("g", "s AS split"), "g"), Q.sizes(df, "st", {"F": 180, "O": 21, "X": 5}),
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    seen, counts = Q.observed(df, *row)
    assert seen.count() == 201
    assert counts.get == {r.rule: r.n for r in plain.where("rule NOT IN ('disjoint', 'size')").groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert Q.check(df.limit(0), *row).count() == 0 and Q.check(df.limit(0), Q.SizeRule("size", F.col("st"), {"F": 1})).collect()[0].detail == "0"


def test_rules_are_counted_in_the_stream(spark, tmp_path):
    from stemfold.plans.curation import FLAGS, URLS
    from stemfold.streaming.ingest import ingest

    urls = spark.createDataFrame(URLS, "url string, license string, license_family string")
    flags = spark.createDataFrame(FLAGS, "license_family string, attribution boolean, commercial boolean, derivative boolean, share_alike boolean")
    schema = "cleaned_path string, license_url string, split string"
    source, target, checkpoint = (str(tmp_path / k) for k in ("in", "out", "checkpoint"))
    rows = [(f"/a/{k}", URLS[0][0] if k % 4 else None, "train") for k in range(20)] * 2
    spark.createDataFrame(rows, schema).coalesce(1).write.option("header", "true").csv(source)
    rule = Q.missing_value("license_url", "cleaned_path", "license")
    q = ingest(spark, source, schema, urls, flags, target, checkpoint, rules=(rule,))
    q.awaitTermination()
    # every row that is read is checked, repeats too
    assert sum(p["observedMetrics"]["violations"]["license"] or 0 for p in q.recentProgress if "violations" in p["observedMetrics"]) == 10
    assert spark.read.parquet(target).count() == 20


def test_manifest_files_are_bounded_on_skewed_splits(spark, tmp_path):
    from stemfold.sources.manifests import write_manifest

    df = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("x"), F.lit("com").alias("subset"), F.when(F.col("id") % 100 > 5, "train").when(F.col("id") % 2 == 0, "val").otherwise("test").alias("split")).repartition(24)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1m")
    try:
        write_manifest(df, str(tmp_path / "m"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sizes = {}
    for f in (tmp_path / "m").rglob("*.parquet"):
        sizes.setdefault(f.parent.name, []).append(f.stat().st_size)
    # a small split has no more files than the tasks that the large one beside it is split over
    assert max(len(sizes["split=val"]), len(sizes["split=test"])) <= len(sizes["split=train"])
    # the large split is several files, none far above the others
    assert 2 <= len(sizes["split=train"]) < 24 and max(sizes["split=train"]) < 4 << 20
    assert spark.read.parquet(str(tmp_path / "m")).count() == 200_000


def test_bucketed_lookups_shuffle_nothing(spark):
    from stemfold.plans.curation import bucketed_lookup
    from tests.conftest import TINY

    plan = bucketed_lookup(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_short_signals_are_not_padded_to_long_blocks(spark):
    df = spark.createDataFrame([("k", [1.0] * 64), ("k", [2.0] * 50)], "k string, x array<double>")
    assert L.block_size(df, "x") == 64 and L.block_size(df.limit(0), "x") == 64
    assert L.block_size(spark.createDataFrame([([1.0] * 100_000,)], "x array<double>"), "x") == L.BLOCK
    assert L.mix(df, ["k"], "x").first().signal == [3.0] * 50 + [1.0] * 14


def test_stems_share_the_placement_of_their_clip(spark):
    cfg = T.Placement(rate=1000)
    placed = spark.createDataFrame([(k, e, 0, 1000 * e, 500, 7 * e) for k in range(40) for e in range(5)], "k long, event long, trial int, start_sample long, length_sample long, segment_start_sample long")
    files = spark.createDataFrame([(f"t{t}", s, f"c{c}", f"t{t}{s}{c}{f}") for t in range(6) for s in ("vox", "mus") for c in range(3) for f in range(1 + c)], "track string, stem string, component string, file string")
    targets = spark.createDataFrame([(k, -20.0 - k) for k in range(40)], "k long, target double")
    got = T.stem_events(placed, files.unionByName(files), targets, "k", cfg, 3, 2.0, 0.5).toPandas()
    again = T.stem_events(placed.repartition(3), files.repartition(2), targets, "k", cfg, 3, 2.0, 0.5).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, again.values))
    one = got.groupby(["k", "event"])
    # a clip has one track, one placement and one level; both stems sound, each with a level around it
    assert len(one) == 200 and (one[["track", "start_sample", "length_sample", "segment_start_sample", "clip_lufs"]].nunique() == 1).all().all()
    assert (one.stem.nunique() == 2).all() and not got.duplicated(["k", "event", "stem", "component"]).any()
    assert got.track.nunique() == 6 and set(got.groupby(["k", "event", "stem"]).size()) == {1, 2, 3}
    assert all(f.startswith(t + s) for f, t, s in zip(got.file, got.track, got.stem, strict=True))
    spread = got.lufs - got.clip_lufs
    assert abs(spread.mean()) < 0.1 and spread.std() == pytest.approx(0.5, rel=0.1)
    assert (one.first().clip_lufs - one.first().submix_lufs_target).std() == pytest.approx(2.0, rel=0.25)


def test_frames_just_so_far_below_the_mean_are_heard(spark):
    # a mean of 50.00 and levels of 34.00: in floating point the sum may end on either side, as its order has it
    rows = []
    for k in range(200):
        some = [34.0] + [round(0.01 * ((k * 37 + j * 101) % 9000), 2) for j in range(65)]
        rest = round(50.0 * 67 - sum(some), 2)
        rows += [(k, j, v) for j, v in enumerate([*some[:30], rest, *some[30:]])]
    df = spark.createDataFrame(rows, "k long, pos long, v double")
    want = sorted((k, j) for k, j, v in rows if round(v * 100) >= 3400)
    for order in (F.col("pos"), -F.col("pos"), F.hash("pos"), F.hash("v")):
        means = df.groupBy("k").agg(*(c.alias(n) for n, c in W.mean_level("v").items()))
        flagged = df.orderBy("k", order).join(means, "k").where(W.near_mean(F.col("v"), F.lit(16.0)))
        assert sorted(values(flagged, "k", "pos")) == want
    # the operators begin with the first such frame
    for got in (W.nonsilent(df, "k", "pos", "v", 0.5, least_silence=0.5), N.nonsilent_scan(df, "k", "pos", "v", 0.5, least_silence=0.5)):
        assert {r[0] for r in values(got.where("start_time = 0"), "k")} == set(range(200))
    odd = spark.createDataFrame([(1, 0, None), (1, 1, float("-inf")), (1, 2, 3.0), (2, 0, None), (3, 0, float("inf")), (3, 1, 1.0), (4, 0, float("nan"))], "k long, pos long, v double")
    means = odd.groupBy("k").agg(*(c.alias(n) for n, c in W.mean_level("v").items()))
    got = {(r[0], r[1]): r[2] for r in values(odd.join(means, "k").select("k", "pos", W.near_mean(F.col("v"), F.lit(16.0)).alias("near")), "k", "pos", "near")}
    assert got == {(1, 0): None, (1, 1): True, (1, 2): True, (2, 0): None, (3, 0): True, (3, 1): False, (4, 0): True}


def test_events_are_placed_without_moving_energies(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    cfg = T.Placement(overlap=0.25, rate=1000, min_prop=0.1, length_loc=0.3)
    powers = {f: np.where((np.arange(n) // 9 + f) % 3 == 0, 0.0, rng.random(n)) for f, n in ((0, 300), (1, 40), (2, 1), (3, 3), (4, 2000))}
    hops = spark.createDataFrame([(f, k, float(p)) for f, ps in powers.items() for k, p in enumerate(ps)], "file long, pos int, power double")
    energy = T.energy_table(hops, "file", "pos", "power")
    # what a fold asks of a stretch is whether its level is finite, beyond the end of a file too
    at = spark.createDataFrame([(int(a), int(n)) for a in rng.integers(0, 31_000, 60) for n in (1, 99, 100, 101, 350, 399, 401, 455, 700, 3000, 60_000)], "a long, n long").unionByName(spark.createDataFrame([(a, n) for a in (0, 100, 4900) for n in (1, 100, 400, 500)], "a long, n long"))
    both = at.crossJoin(energy.join(T.audible(energy, cfg), "file")).select((T.stretch_level(F.struct("energy", "loud", "loud_energy"), F.col("a"), F.col("n"), cfg.hop) > float("-inf")).alias("finite"), T.sounds(F.col("heard"), F.col("a"), F.col("n"), cfg.hop).alias("sounds"))
    counts = {(r["finite"], r["sounds"]): r["count"] for r in both.groupBy("finite", "sounds").count().collect()}
    assert set(counts) == {(True, True), (False, False)} and min(counts.values()) > 100
    ev = spark.range(400).select((F.col("id") % 50).alias("k"), F.floor(F.col("id") / 50).alias("event"), (F.col("id") % 17 + 1).cast("double").alias("len"), (F.col("id") % 6).alias("file"))
    want = T.place(T.candidates(ev, "k", 4, 1), "k", cfg, energy).join(ev.select("k", "event", "file"), ["k", "event"])
    got = T.place_events(ev, "k", cfg, 4, 1, energy, ("file",))
    assert sorted(values(got, *want.columns)) == sorted(values(want, *want.columns)) and got.count() > 100
    # one shuffle, of the events alone
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1 and plan.count("aggregate(") == 1


def test_annotations_shuffle_no_stretches(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    cfg = T.Placement(overlap=0.25, rate=1000, hop_seconds=0.05, min_prop=0.1)
    powers = {f: np.where((np.arange(n) // 30 + f) % 4 == 0, 0.0, 10 ** rng.uniform(-8, 0, n)) for f, n in ((0, 700), (1, 520), (2, 90), (3, 2))}
    hops = spark.createDataFrame([(f, k, float(p)) for f, ps in powers.items() for k, p in enumerate(ps)], "file long, pos int, power double")
    rows = [(k, e, 0, int(rng.integers(0, 50_000)), int(rng.integers(1, 12_000)), int(rng.integers(0, 30_000)), int(rng.integers(0, 5))) for k in range(12) for e in range(4)]
    placed = spark.createDataFrame(rows, "k long, event long, trial int, start_sample long, length_sample long, segment_start_sample long, file long")
    targets = placed.select("k").distinct().withColumn("target", -20.0 - F.col("k"))
    got = T.annotate(placed.drop("file"), placed, hops, targets, "k", cfg)
    again = T.annotate(placed.repartition("k"), None, hops, targets, "k", cfg)
    assert sorted(values(got, *got.columns)) == sorted(values(again, *got.columns))
    # by the long form: a row for each hop of an event
    parts = []
    for k, e, _, start, n, own, f in rows:
        for pos in range(own // 50, (own + n - 1) // 50 + 1):
            if pos < len(powers.get(f, ())):
                parts.append((k, e, start // 50 + pos - own // 50, float(powers[f][pos])))
    long = spark.createDataFrame(parts, "k long, event long, at long, p double")
    own = {(r.k, r.event): r.level for r in L.gated_hops(long, ["k", "event"], "at", "p").collect()}
    mixed = {r.k: r.level for r in L.gated_hops(long.groupBy("k", "at").agg(F.sum("p").alias("p")), ["k"], "at", "p").collect()}
    assert got.count() == len(rows) and len(own) > 20
    for r in got.collect():
        level, silent = mixed.get(r.k, -math.inf), -math.inf
        gain = 0.0 if level == silent else r.submix_lufs_target - level
        assert r.submix_lufs == pytest.approx(level + gain) and r.lufs == pytest.approx(own.get((r.k, r.event), silent) + gain)
    # placed rows are shuffled once by key, their stretches never
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "stretches" not in plan


def test_stems_are_chosen_within_the_row_of_a_track(spark):
    import hashlib

    draw = lambda tag, *key: int(hashlib.md5("|".join(["3", tag, *(str(k) for k in key if k is not None)]).encode()).hexdigest()[:13], 16) / 16**13
    cfg = T.Placement(rate=1000)
    placed = spark.createDataFrame([(k, e, 0, 1000 * e, 500, 7 * e) for k in range(30) for e in range(4)], "k long, event long, trial int, start_sample long, length_sample long, segment_start_sample long")
    rows = [(f"t{t}", s, c, f"t{t}{s}{c}{f}") for t in range(5) for s in (None, "mus", "vox") for c in ("a", "b", "c", "d")[: 1 + t] for f in range(1 + t % 3)]
    files = spark.createDataFrame(rows, "track string, stem string, component string, file string")
    got = T.stem_events(placed, files.unionByName(files), placed.select("k").distinct().withColumn("target", F.lit(-20.0)), "k", cfg, 3, 2.0, 0.5)
    tracks = sorted({r[0] for r in rows}, key=lambda t: (draw("tracks", t), t))
    want = set()
    for k in range(30):
        for e in range(4):
            t = tracks[int(draw("track", k, e) * len(tracks))]
            for s in (None, "mus", "vox"):
                parts = sorted({r[2] for r in rows if r[:2] == (t, s)}, key=lambda c: (draw("component", k, e, s, c), c))
                for c in parts[: 1 + int(draw("active", k, e, s) * len(parts))]:
                    want.add((k, e, t, s, c, min((draw("file", k, e, s, c, r[3]), r[3]) for r in rows if r[:3] == (t, s, c))[1]))
    found = values(got, "k", "event", "track", "stem", "component", "file")
    assert set(found) == want and len(found) == len(want) and any(r[3] is None for r in want)
    # no row of an event and a file is ever dealt or sorted by event and stem
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if ("Exchange hashpartitioning" in x or "Window [" in x) and "event#" in x and "stem#" in x]
