"""Operator 13 against trees built and proofs checked one by one."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from stemfold.llm import merkle
from stemfold.llm.merkle import merkle_manifest, missing
from stemfold.llm.queries import ORACLE_SQL, op13_octopus_manifest
from tests.conftest import TINY

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return hashlib.sha256(b"".join(b"-" if row[c] is None else str(len(str(row[c]).encode())).encode() + b":" + str(row[c]).encode() for c in COLUMNS)).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def climb(tree, pos, own):
    """Siblings on the way up and what the top becomes."""
    beside = []
    for level in tree[:-1]:
        at = pos - pos % 3
        run = level[at : at + 3]
        beside += [x for k, x in enumerate(run) if at + k != pos]
        run[pos - at] = own
        own, pos = h(run), pos // 3
    return beside, own


def plain(rows):
    rows = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]
    sources = {}
    for r in rows:
        r["leaf"] = leaf(r)
        sources.setdefault(r["source"], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        trees.append(levels([r["leaf"] for r in sources[s]]))
    above = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for pos, r in enumerate(sources[s]):
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            changed = leaf({**r, "text": r["text"].replace("\n", "")}) if even and r["text"] is not None else r["leaf"]
            low, top = climb(trees[k], pos, changed)
            high, root = climb(above, k, top)
            out.append((r["doc_id"], r["leaf"], trees[k][-1][0], above[-1][0], h(low + high), root, root == above[-1][0]))
    return sorted(out, key=str)


def got(df, **options):
    out = merkle_manifest(df, tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, chosen=F.crc32(F.col("doc_id").cast("string")) % 2 == 0, **options)
    return sorted(map(tuple, out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TINY}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op13_octopus_manifest"]).fetchdf()
    have = op13_octopus_manifest(spark, TINY).toPandas()[list(want.columns)]
    assert sorted(map(tuple, have.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert 0 < have.verified.sum() < len(have)


def rows_of(kind):
    text = lambda k: (None, "", "a\nb", "plain", "ü\n\n漢")[k % 5]
    if kind == "many sources":
        return [(k, text(k), "en", f"s{k % 37}" if k % 3 else None, k) for k in range(150)]
    if kind == "one source":
        return [(-k, text(k), None, "only", None) for k in range(83)]
    if kind == "alone":
        return [(k, text(k), "de", f"é{k}", 1) for k in range(30)]
    # a hot source, a repeated id, rows alike in all, null ids
    return [(k, text(k), "en", "hot", k) for k in range(60)] + [(7, text(k), "en", "hot", 1) for k in range(40)] + [(9, "x\n", "fr", "", 2)] * 30 + [(None, text(k), None, None, 3) for k in range(4)]


@pytest.mark.parametrize("kind", ["many sources", "one source", "alone", "hot"])
def test_against_plain_trees(spark, kind, monkeypatch):
    rows = rows_of(kind)
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(4)
    monkeypatch.setattr(merkle.interior, "__defaults__", (2,))
    assert got(df, part_leaves=11) == plain(rows)
    monkeypatch.setattr(merkle, "BROADCAST_REQUESTS", 0)
    assert got(df, part_leaves=25) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_small_trees(spark, n):
    rows = [(k, "a\n", "en", "s", k) for k in range(n)]
    assert got(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)) == plain(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_missing_is_the_least_union():
    """What single proofs ask for, less what the part's own leaves give."""
    for leaves in (1, 2, 3, 10, 28, 82):
        for first in range(0, leaves, 5):
            for last in range(first, leaves, 7):
                asked, given, width, level, low, high = set(), set(), leaves, 0, first, last
                while width > 1:
                    for p in range(low, high + 1):
                        asked |= {(level, x) for x in range(p - p % 3, min(p - p % 3 + 3, width))}
                    given |= {(level, p) for p in range(low, high + 1)}
                    low, high, width, level = low // 3, high // 3, -(-width // 3), level + 1
                assert set(missing(first, last, leaves, 3)) == asked - given
