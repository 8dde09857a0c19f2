"""Operator 11 against the library that the vocabulary file belongs to."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stemfold.llm import tokencount
from stemfold.llm.queries import op11_two_tier_counts, table
from stemfold.llm.tokencount import WordCounter, frequent_lengths, stretches, token_counts
from tests.conftest import TINY

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "\n\n", "Don't STOP, we'll've 'twas", "<|startoftext|>", "a<|endoftext|>b <|EndOfText|> <|endoftext", "<|startoftext|><|startoftext|>x",
    "ΟΔΥΣΣΕΥΣ Σ ςΣ", "J̌ İstanbul ǰ", "é é ́e ́", "\x1c\x1fa\x1d b", "naïve café x​y", "漢字かな 한국어", "😀 smile😀smile 👩‍👩‍👧 ok", "ꟊ 𝔘 ½ ² ٣ Ⅷ 12345",
    "x" * 5_000, "word " * 3_000, "᠎ ᲀ ა Ა", "'S 's 'RE 'll 'd", "a\x00b�",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_counts_are_the_librarys(library):
    counter = WordCounter(PATH)
    assert counter.by_words
    assert counter.counts(ODD, {}).tolist() == library(ODD)
    # the same with a first tier, which must change nothing
    assert counter.counts(ODD, {"word": 1, "x": 1}).tolist() == library(ODD)


@pytest.mark.parametrize("around", [("a", "b"), ("1", " !"), ("'S", ""), ("Σ", "́")])
def test_every_character(library, around):
    texts = [around[0] + chr(c) + around[1] for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    assert WordCounter(PATH).counts(texts, {}).tolist() == library(texts)


def test_long_texts_and_full_caches(library, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_ENTRIES", 7)
    monkeypatch.setattr(tokencount, "LOOKUP", 5)
    texts = ["one two three four five six seven eight nine ten. " * 50 + "<|endoftext|>Ünïcode", None, "z" * 300 + " tail", *ODD]
    counter = WordCounter(PATH)
    monkeypatch.setattr(tokencount.stretches, "__defaults__", (40,))
    assert counter.counts(texts, {"two": 1}).tolist() == library(texts)
    assert "".join(stretches(texts[0], 40)) == texts[0]


def test_files_of_other_shapes():
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        counter = WordCounter(public_tokenizers.path(name))
        assert not counter.by_words
        got = counter.counts(["A small text.", "", None], {}).tolist()
        assert got[0] > 2 and got[1:] == [0, 0]


def test_query(spark, library):
    docs = table(spark, TINY, "documents").toPandas()
    got = op11_two_tier_counts(spark, TINY).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    assert got.loc[docs.doc_id, "n_tokens"].tolist() == library(docs.text)
    assert got.loc[docs.doc_id, "n_bytes"].tolist() == [len((t or "").encode()) for t in docs.text]
    assert (got.over_limit == (got.n_tokens > 2048)).all()


def test_edge_rows(spark, library):
    texts = [None, "", "Hello hello", "Hello hello", "tie", *ODD]
    rows = [(None if k == 2 else k % 7, t, "clash") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, token_counts(df, PATH, limit=3).select("doc_id", "n_tokens", "over_limit").collect()), key=str)
    assert got == sorted(((i, n, n > 3) for (i, _, _), n in zip(rows, library(texts), strict=True)), key=str)
    assert token_counts(df.limit(0), PATH).count() == 0


def test_table_is_small_and_sorted_by_count(spark):
    df = spark.createDataFrame([(f"the the the cat {k}",) for k in range(50)], "text string")
    lengths = frequent_lengths(df, PATH, entries=3)
    assert len(lengths) == 3 and next(iter(lengths)) == "the" and lengths["cat"] == 1


def test_nothing_is_shuffled(spark):
    plan = op11_two_tier_counts(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange", plan)
