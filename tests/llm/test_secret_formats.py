"""Operator 4 on rare formats, on what only looks like a credential, and on values that stand without their keyword."""

import random
import re

import pytest

from stemfold.llm import secrets
from tests.conftest import TINY

ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WORDS = "the of and harbour lantern quietly mountain yesterday understand somewhere international boatman gathering carefully nothing question seventeen".split()


def some(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


#: Format, and how many labelled examples it has.
RARE = {
    "upper": (6, lambda r: some(r, "0123456789ABCDEF", 40)),
    "github": (8, lambda r: "ghp_" + some(r, ALNUM, 36)),
    "slack": (10, lambda r: f"xoxb-{some(r, '0123456789', 11)}-{some(r, '0123456789', 12)}-{some(r, ALNUM, 24)}"),
    "base32": (20, lambda r: some(r, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r.choice((26, 32)))),
    "mixed": (12, lambda r: some(r, ALNUM, r.choice((20, 22, 24)))),
    "many": (150, lambda r: some(r, ALNUM, 32)),
}
HARMLESS = [
    "9f8a7c6d", "a1b2c3d4e5f6", "deadbeef", "0badc0de42", "2024-01-15", "2024-01-15T10:20:30", "20240115102030", "4111111111111111", "5500005555555559", "550e8400-e29b-41d4-a716-446655440000",
    "123e4567-e89b-12d3-a456-426614174000", "192.168.100.200", "v1.22.333-rc1", "index.html", "www.example.org/path/page", "somebody@example", "ISBN9783161484100", "Internationalization", "AB-1234-XY",
]


@pytest.fixture(scope="module")
def grammar():
    rng = random.Random(31)
    labelled = {"assign": [make(rng) for n, make in RARE.values() for _ in range(n)], "hex": [some(rng, "0123456789abcdef", 40) for _ in range(120)]}
    ordinary = ["".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(1500)] + [f"{rng.randrange(10**9, 10**10)}" for _ in range(40)] + [f"2023-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}" for _ in range(40)] + [f"{rng.choice(WORDS)}-{rng.choice(WORDS)}" for _ in range(300)] + [w.title() + rng.choice(WORDS) for w in WORDS * 10]
    return secrets.infer_grammar(labelled, sorted({x for x in ordinary if len(x) >= 8}))


@pytest.mark.parametrize("name", RARE)
def test_rare_formats_are_found_without_a_keyword(grammar, name):
    rng = random.Random(77)
    caught = 0
    for k in range(100):
        value = RARE[name][1](rng)
        text = f"see {value} here" if k % 2 else f"id={value}, and so on"
        spans = [text[a:b] for a, b, kind in secrets.scan_text(text, grammar)[0] if kind == "grammar"]
        assert not secrets.base_spans(text) or name == "upper"
        caught += value in spans
    assert caught >= 90


@pytest.mark.parametrize("token", HARMLESS)
def test_what_looks_like_a_credential_is_left(grammar, token):
    spans, score = secrets.scan_text(f"at {token} there", grammar)
    assert not spans and (score is None or score > -1e9)


def test_harmless_strings_of_many_kinds_are_left(grammar):
    rng = random.Random(5)
    made = [some(rng, "0123456789abcdef", rng.choice((7, 8, 10, 12))) for _ in range(300)] + ["-".join(some(rng, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12)) for _ in range(300)] + [some(rng, "0123456789", rng.choice((8, 12, 16, 19))) for _ in range(300)]
    wrong = [x for x in made if secrets.scan_text(f"at {x} there", grammar)[0]]
    assert len(wrong) <= 2, wrong


def test_one_labelled_value_is_known_again_but_no_word_is():
    rng = random.Random(9)
    value = some(rng, "0123456789ABCDEF", 40)
    g = secrets.infer_grammar({"assign": [value, "international"], "hex": [some(rng, "0123456789abcdef", 40) for _ in range(60)]}, sorted({rng.choice(WORDS) + rng.choice(WORDS) for _ in range(400)} | {w for w in WORDS if len(w) >= 8}))
    assert [s[2] for s in secrets.scan_text(f"so {value}.", g)[0]] == ["grammar"]
    assert secrets.scan_text("an international matter", g)[0] == []


def test_value_of_the_table_with_its_keyword_hidden(spark):
    docs = spark.read.parquet(TINY.replace("sf0.001", "sf0.1") + "/documents.parquet")
    g = secrets.infer_grammar(*secrets.labelled_credentials(docs))
    values = {m[2] for r in docs.where("text RLIKE '(?i)(password|passwd|secret|token|api_?key)'").select("text").collect() for m in re.finditer(secrets.ASSIGN, r.text, re.I | re.A) if len(m[2]) >= 8}
    assert any(v != v.lower() for v in values)
    hidden = [v for v in values if not [s for s in secrets.scan_text(f"so {v} it is", g)[0] if s[2] == "grammar"]]
    assert len(hidden) <= 0.02 * len(values) and all(v == v.lower() for v in hidden)
    for token in HARMLESS:
        assert not secrets.scan_text(f"at {token} there", g)[0], token
