"""Token counts by a two-tier lookup on the map side: a broadcast table of frequent pre-tokens, and worker caches for the rest."""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import hash_sample

#: How the vocabulary file of lower-case words cuts a text, as its own description states it.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: The same cuts of a lower-case text of ASCII characters; letters first, which no other part can begin with.
ASCII_PIECES = re.compile(r"[a-z]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9]+", re.ASCII)
#: Characters taken from a text at a time.
STRETCH = 1 << 20
#: Entries and characters of a worker's cache; a full cache is emptied.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 16_000_000
#: Pre-tokens looked up at a time.
LOOKUP = 100_000


def _spans(holds: Callable[[str], bool]) -> str:
    """The inside of a character class: the characters of the basic plane for which ``holds`` is true."""
    spans: list[list[int]] = []
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and holds(chr(c)):
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


@cache
def _classes() -> tuple[re.Pattern, re.Pattern]:
    """An odd character, and the pre-tokens of a lower-case text without odd characters.

    Odd is a character whose class the standard has changed since version 3.2,
    or has given out since, or that libraries take for white space or not.
    Libraries carry different versions of the standard; words with such
    characters are left to the tokenizer itself.
    """
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    known = _spans(lambda c: old(c) == new(c) and new(c) not in ("Cn", "Co") and c not in "\x1c\x1d\x1e\x1f")
    letters, numbers = _spans(lambda c: new(c)[0] == "L"), _spans(lambda c: new(c)[0] == "N")
    return re.compile(f"[^{known}]"), re.compile(rf"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^\s{letters}{numbers}]+")


class WordCounter:
    """Numbers of tokens of whole texts, as the vocabulary file at ``path`` gives them.

    ``table`` is the first tier: lengths of frequent pre-tokens. What it does
    not hold is looked up in a cache that lives as long as the worker, and
    encoded once if it is not there. Files of another shape than
    ``WORD_PIECES`` after ``WORD_NORMALIZERS`` are encoded text by text.
    """

    def __init__(self, path: str) -> None:
        self.cached: dict[str, int] = {}
        self.cached_chars = 0
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.by_words, self.whole = False, lambda text: len(model.encode(text, add_bos=False, add_eos=False))
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole: Callable[[str], int] = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_words = (
            (spec.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS
            and cuts[0] == {"type": "Split", "pattern": {"Regex": WORD_PIECES}, "behavior": "Removed", "invert": True}
            and [(c.get("type"), c.get("add_prefix_space"), c.get("use_regex")) for c in cuts[1:]] == [("ByteLevel", False, False)]
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
        )
        if self.by_words:
            names = sorted((t["content"] for t in added), key=len, reverse=True)
            self.special = re.compile("|".join(map(re.escape, names))) if names else None
            # pre-tokens are normalized already, and that is not always idempotent
            self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "truncation": None, "padding": None}))

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of tokens that are known without them."""
        out: list[str] = []
        known = 0
        if self.special is not None and self.special.search(text):
            known = sum(1 for _ in self.special.finditer(text))
            for part in self.special.split(text):
                more, n = self.pieces(part)
                out += more
                known += n
            return out, known
        if text.isascii() and not re.search("[\x1c-\x1f]", text):
            return ASCII_PIECES.findall(text.lower()), 0
        odd, cut = _classes()
        if odd.search(text):
            words = re.split("[ \t\n\r]+", text)
            strange = [bool(odd.search(w)) for w in words]
            known = sum(self.whole(w) for w, o in zip(words, strange, strict=True) if o)
            text = " ".join(w for w, o in zip(words, strange, strict=True) if not o)
        # letter by letter, capital sigma becomes the same letter everywhere
        return cut.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()), known

    def lengths(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token, by the tokenizer."""
        return [len(e.ids) for e in self.plain.encode_batch(pieces, add_special_tokens=False)]

    def lookup(self, pieces: list[str], table: dict[str, int]) -> np.ndarray:
        """Tokens of each pre-token: first tier, then the cache, then the tokenizer."""
        got = np.fromiter(map(table.get, pieces, repeat(-1)), np.int64, len(pieces))
        missed = np.flatnonzero(got < 0)
        if len(missed):
            rest = [pieces[k] for k in missed]
            new = {p for p in rest if p not in self.cached}
            if new and (len(self.cached) + len(new) > CACHE_ENTRIES or self.cached_chars > CACHE_CHARS):
                self.cached, self.cached_chars, new = {}, 0, set(rest)
            if new:
                ordered = list(new)
                self.cached.update(zip(ordered, self.lengths(ordered), strict=True))
                self.cached_chars += sum(map(len, ordered))
            got[missed] = [self.cached[p] for p in rest]
        return got

    def counts(self, texts: list[str | None], table: dict[str, int]) -> np.ndarray:
        """Tokens of whole texts. Long texts are taken in stretches that end at a space, which no pre-token holds."""
        out = np.zeros(len(texts), np.int64)
        if not self.by_words:
            out[:] = [self.whole(t) if t else 0 for t in texts]
            return out
        flat: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            if flat:
                np.add.at(out, np.repeat(*np.array(owners).T), self.lookup(flat, table))
            flat.clear()
            owners.clear()

        for k, text in enumerate(texts):
            for part in stretches(text or ""):
                pieces, known = self.pieces(part)
                out[k] += known
                flat += pieces
                owners.append((k, len(pieces)))
                if len(flat) > LOOKUP:
                    flush()
        flush()
        return out


def stretches(text: str, most: int = STRETCH) -> Iterator[str]:
    """Parts of a text of about ``most`` characters that end at a space; a longer run without one stays whole."""
    at = 0
    while len(text) - at > most:
        end = text.find(" ", at + most)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


@cache
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", entries: int = 16_384, sample: int = 1_000, per_task: int = 4_096) -> dict[str, int]:
    """Lengths of frequent pre-tokens, at most ``entries``.

    They come from about ``sample`` texts, each row drawn for itself by a hash of its place. Each task counts the
    texts it reads and sends its ``per_task`` most frequent ones, and no more tasks
    than texts send any, so the driver receives ``sample * per_task`` rows at most and
    nothing is shuffled. What the table holds changes the time that counting
    takes and never a count.
    """
    count = counter(path)
    if not count.by_words:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        split = counter(path).pieces
        for b in batches:
            for text in b.column(0).to_pylist():
                for part in stretches(text or ""):
                    seen.update(split(part)[0])
                    if len(seen) > 64 * per_task:
                        seen = Counter(dict(seen.most_common(8 * per_task)))
        if seen:
            pieces, n = zip(*sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:per_task], strict=True)
            yield pa.record_batch([pa.array(pieces), pa.array(n, pa.int64())], names=["piece", "n"])

    total: Counter[str] = Counter()
    drawn = hash_sample(docs.select(text_col, F.monotonically_increasing_id().alias("place")), sample, "place").select(text_col)
    sent = drawn.mapInArrow(run, "piece string, n bigint").toArrow()  # sample * per_task rows at most
    for piece, n in zip(sent.column(0).to_pylist(), sent.column(1).to_pylist(), strict=True):
        total[piece] += n
    pieces = [p for p, _ in islice(sorted(total.items(), key=lambda x: (-x[1], x[0])), entries)]
    return {p: n for p, n in zip(pieces, count.lengths(pieces), strict=True) if n < 256}


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, entries: int = 16_384) -> DataFrame:
    """One row for each row of ``docs``: its id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    Texts are counted where they are read; neither texts nor pre-tokens are
    shuffled. The broadcast table has ``entries`` entries at most, sent as one
    string and one byte for each length. Counts are those of the library that
    the file belongs to, without begin, end or other added tokens; a special
    token's string inside a text is that one token.

    A null or empty text has no bytes and no tokens; null ids stay null;
    repeated rows are counted each; an empty table gives an empty one. Extra columns
    are not read, and may have the names of the result's.
    """
    table = frequent_lengths(docs, tokenizer_path, text_col, entries)
    sent = docs.sparkSession.sparkContext.broadcast(("\n".join(table), bytes(table.values())))
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path).counts
        names, lengths = sent.value
        first = dict(zip(names.split("\n"), lengths, strict=True)) if lengths else {}
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                n = count(part.column(1).to_pylist(), first)
                yield pa.record_batch([part.column(0), part.column(2), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col), F.col(text_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
