"""Secret scans: fixed base rules, and probabilistic automata inferred from labelled credentials."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import cut, hash_sample

# --- fixed values: the base rules ----------------------------------------
ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_.=~-]{8,}"
KINDS = ("assign", "access", "hex", "grammar")
LEAST_ASSIGNED = 8

LONGEST = 512
#: What parts a candidate into parts that are candidates of their own, and what does not belong to its ends.
PARTS, ENDS = (re.compile(r"[^=]{8,}"), re.compile(r"[^=/.~]{8,}")), "._-=/+~"

_assign, _access, _hex, _token = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(HEX), re.compile(TOKEN)
_run = re.compile(r"[A-Z0-9a-z]{16,}")

Span = tuple[int, int, str]


def merge_classes(examples: list[str], alpha: float = 0.05) -> dict[str, int]:
    """Classes of the characters of the examples: those whose frequencies agree within Hoeffding bounds are one.

    Characters are taken from the most frequent down, and each joins the class
    before it if it agrees with that class's mean. So the digits of random
    keys become one symbol, and the letters of a fixed prefix stay themselves.
    """
    count = Counter(c for x in examples for c in x)
    total = max(1, sum(count.values()))
    bound = math.sqrt(0.5 * math.log(2 / alpha) / total) * 2
    out: dict[str, int] = {}
    number, own = -1, []
    for c, n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
        if not own or sum(own) / len(own) - n > bound * total:
            number, own = number + 1, []
        own.append(n)
        out[c] = number
    return out


def readings(run: str) -> list[list[tuple[int, int]]]:
    """The candidates in a maximal run of token characters, as places: the run without the marks at its ends; its parts around =; its parts between = / . and ~."""
    if run.isalnum():
        return [[(0, len(run))]]
    start, end = len(run) - len(run.lstrip(ENDS)), len(run.rstrip(ENDS))
    whole = [(a, b) for a, b in {(start, end), (start, len(run.rstrip(".")))} if b - a >= LEAST_ASSIGNED]
    return [[x] for x in sorted(whole)] + [[m.span() for m in p.finditer(run)] for p in PARTS]


@dataclass
class Automaton:
    """A deterministic probabilistic automaton over classes of characters.

    ``moves[s]`` maps a class to (next state, log probability); ``ends[s]`` is
    the log probability of stopping. A class's characters are equally likely.
    What was not seen in a state costs ``floor`` and stays there. With an
    ``alphabet`` a tenth of each state's probability is spread evenly over it, so
    that few examples do not rule out characters that they happen to lack.
    """

    classes: dict[str, int]
    moves: list[dict[int, tuple[int, float]]]
    ends: list[float]
    floor: float
    alphabet: str = ""

    def __post_init__(self) -> None:
        size = Counter(self.classes.values())
        members: dict[int, list[str]] = {}
        for c, k in self.classes.items():
            members.setdefault(k, []).append(c)
        # by character: the state it leads to and what it costs
        self.steps = [{c: (to, p - math.log(size[k])) for k, (to, p) in own.items() for c in members[k]} for own in self.moves]
        self.unseen = self.floor - math.log(64)
        if self.alphabet:
            spread = 0.1 / len(self.alphabet)
            for state, own in enumerate(self.steps):
                for c in self.alphabet:
                    to, p = own.get(c, (state, -math.inf))
                    own[c] = to, math.log(0.9 * math.exp(p) + spread)

    def nats(self, text: str) -> float:
        """Negative log likelihood of the characters, whatever the end."""
        steps, total = self.steps[0], 0.0
        unseen = self.unseen
        for c in text:
            if c in steps:
                state, p = steps[c]
                steps = self.steps[state]
                total += p
            else:
                total += unseen
        return -total

    def loss(self, text: str) -> float:
        """Mean negative log likelihood of a character, the end counted as one more."""
        steps, total = self.steps[0], 0.0
        state, unseen = 0, self.unseen
        for c in text:
            if c in steps:
                state, p = steps[c]
                steps = self.steps[state]
                total += p
            else:
                total += unseen
        return -(total + self.ends[state]) / (len(text) + 1)


def infer_automaton(examples: list[str], alpha: float = 0.05, least: int = 20, floor: float = 1e-4, alphabet: str = "") -> Automaton:
    """Merge the states of the examples' prefix tree whose symbol and end frequencies agree within Hoeffding bounds.

    Symbols are the classes that merge_classes finds. States are taken breadth
    first. A candidate is folded into the first accepted state with which it
    and all its descendants are compatible, else it is accepted. States passed
    by fewer than ``least`` examples carry no evidence of their own and are
    compared by their bounds only at their top.
    """
    classes = merge_classes(examples)
    count, ends, kids, freq = [0], [0], [{}], [{}]
    for text in examples:
        node = 0
        count[0] += 1
        for c in text:
            s = classes[c]
            if s not in kids[node]:
                kids[node][s], freq[node][s] = len(kids), 0
                count.append(0), ends.append(0), kids.append({}), freq.append({})
            freq[node][s] += 1
            node = kids[node][s]
            count[node] += 1
        ends[node] += 1
    width = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(a: int, n: int, b: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > width * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if differ(ends[a], count[a], ends[b], count[b]):
                return False
            for s in freq[a].keys() | freq[b].keys():
                if differ(freq[a].get(s, 0), count[a], freq[b].get(s, 0), count[b]):
                    return False
                if s in kids[a] and s in kids[b] and min(freq[a][s], freq[b][s]) >= least and kids[a][s] != kids[b][s]:
                    todo.append((kids[a][s], kids[b][s]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the tree below b to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            count[a] += count[b]
            ends[a] += ends[b]
            for s, j in kids[b].items():
                freq[a][s] = freq[a].get(s, 0) + freq[b][s]
                if s in kids[a]:
                    todo.append((kids[a][s], j))
                else:
                    kids[a][s] = j

    accepted, member = [0], {0}
    while True:
        blue = next(((r, s) for r in accepted for s in sorted(kids[r]) if kids[r][s] not in member), None)
        if blue is None:
            break
        parent, s = blue
        node = kids[parent][s]
        target = next((r for r in accepted if compatible(r, node)), None)
        if target is None:
            accepted.append(node), member.add(node)
        else:
            kids[parent][s] = target
            fold(target, node)
    number = {n: k for k, n in enumerate(accepted)}
    log = lambda part, whole: math.log(max(floor, part / max(whole, 1)))
    moves = [{s: (number[k], log(freq[n][s], count[n])) for s, k in kids[n].items()} for n in accepted]
    return Automaton(classes, moves, [log(ends[n], count[n]) for n in accepted], math.log(floor), alphabet)


#: Examples that make a format, characters of a prefix that tells one.
LEAST_EXAMPLES, PREFIX = 5, 4
#: Nats by which an arbitrary identifier is less likely than an ordinary string, and that a candidate must gain on both.
IDENTIFIER, EVIDENCE = 14.0, 10.0
#: Nats that each character of an arbitrary identifier costs besides the choice of it: long ones are rare.
PER_CHARACTER = 0.2
#: Nats that each character costs by which a candidate is longer or shorter than all examples of a format.
OFF_LENGTH = 1.0

_SIZES = ((frozenset("abcdefghijklmnopqrstuvwxyz"), 26), (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 26), (frozenset("0123456789"), 10))
_LETTERS = frozenset().union(*(k for k, _ in _SIZES))
_KINDS_OF_CHARACTERS = ("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789")


def alphabet_of(strings: list[str]) -> str:
    """The characters that strings like these may hold: whole kinds (hexadecimal letters, letters, digits) and the marks that occur."""
    seen = set("".join(strings))
    kinds = [k for k in _KINDS_OF_CHARACTERS if seen & set(k)]
    # letters past f bring those up to f with them
    for k, low in ((1, 0), (3, 2)):
        if _KINDS_OF_CHARACTERS[k] in kinds and _KINDS_OF_CHARACTERS[low] not in kinds:
            kinds.append(_KINDS_OF_CHARACTERS[low])
    return "".join(sorted(set("".join(kinds)) | {c for c in seen if not c.isalnum()}))


def identifier_nats(token: str) -> float:
    """What a token costs as an arbitrary string of the letters, digits and marks that it has, besides being one."""
    seen = set(token)
    size = sum(n for kind, n in _SIZES if not seen.isdisjoint(kind)) + len(seen - _LETTERS)
    return len(token) * (math.log(max(size, 1)) + PER_CHARACTER)


@dataclass
class Format:
    """One format of credentials: a fixed prefix (or none), an automaton for what follows, and the lengths seen.

    ``most`` is the loss a character that 99 % of the examples stay within.
    """

    prefix: str
    automaton: Automaton
    lengths: dict[int, int]
    most: float = 0.0

    def __post_init__(self) -> None:
        self.by_length = [self._length(n) for n in range(LONGEST + 1)]

    def nats(self, token: str) -> float:
        cost = self.by_length[len(token)] if len(token) <= LONGEST else self._length(len(token))
        if self.prefix:
            cost += 0.1 * len(self.prefix) if token.startswith(self.prefix) else -self.automaton.unseen * len(self.prefix)
            token = token.removeprefix(self.prefix)
        return cost + self.automaton.nats(token)

    def _length(self, n: int) -> float:
        total = sum(self.lengths.values())
        if n in self.lengths:
            return math.log((total + 1) / self.lengths[n])
        return math.log(total + 1) + OFF_LENGTH * min(abs(n - x) for x in self.lengths)


@dataclass
class Grammar:
    """The formats of credentials, an automaton of ordinary tokens, and labelled credentials of no format.

    A candidate's score is by how many nats a character the format that fits
    it best beats the ordinary automaton; every candidate has one. It is a credential
    from ``margin`` on, if the format also gains ``EVIDENCE`` nats in all on the ordinary automaton and on an arbitrary identifier:
    what is short, or as long as no example, has too little to tell it from a commit's or a part's number.
    """

    formats: dict[str, Format]
    ordinary: Automaton
    margin: float = 0.5
    single: frozenset[str] = frozenset()

    def fit(self, token: str) -> tuple[float, float, bool]:
        """The score, -inf only if no format was learned; by how much more than its own strings the best format loses on the token; whether the evidence is enough."""
        size = len(token) + 1
        nats, most = math.inf, 0.0
        for f in self.formats.values():
            n = f.nats(token)
            if n < nats:
                nats, most = n, f.most
        plain = self.ordinary.loss(token) * size
        score = (plain - nats) / size
        if token in self.single and plain > (other := identifier_nats(token)) + EVIDENCE:
            return max(self.margin, score, (plain - other) / size), 0.0, True
        enough = score >= self.margin and min(plain, identifier_nats(token) + IDENTIFIER) - nats >= EVIDENCE
        return score, max(0.0, nats / size - most - 1e-6), enough

    def score(self, token: str) -> float:
        return self.fit(token)[0]

    def candidates(self, run: str) -> tuple[tuple[tuple[int, int], ...], float]:
        """Where in a maximal run of token characters credentials are, and the best score of its candidates. Of the readings with credentials, that with the best fitting one counts, the first if they fit alike."""
        best, excess, found = -math.inf, math.inf, ()
        fits: dict[tuple[int, int], tuple[float, float, bool]] = {}
        for places in readings(run):
            for a, b in places:
                if (a, b) not in fits:
                    fits[a, b] = self.fit(run[a:b])
                    best = max(best, fits[a, b][0])
            own = [x for x in places if fits[x][0] >= self.margin and fits[x][2]]
            if own and min(fits[x][1] for x in own) < excess:
                excess, found = min(fits[x][1] for x in own), tuple(own)
        return found, best


def format_groups(examples: dict[str, list[str]]) -> tuple[dict[str, list[str]], list[str]]:
    """Examples by format, and those of none: of each kind, strings that share a prefix, else those of one alphabet, whatever their lengths."""
    groups: dict[str, list[str]] = {}
    single: list[str] = []
    for kind, strings in sorted(examples.items()):
        starts = Counter(x[:PREFIX] for x in set(strings))
        own: dict[str, list[str]] = {}
        for x in sorted(set(strings)):
            shared = starts[x[:PREFIX]] >= LEAST_EXAMPLES
            own.setdefault(f"{kind}:{x[:PREFIX]}*" if shared else f"{kind}:{alphabet_of([x])}", []).append(x)
        for name, members in own.items():
            if len(members) >= LEAST_EXAMPLES:
                groups[name] = members
            else:
                single += members
    return groups, single


def infer_format(examples: list[str]) -> Format:
    """One prefix tree over all examples of a format, whose compatible states merge; so lengths share states."""
    prefix = commonprefix(examples)
    prefix = prefix if len(prefix) >= PREFIX else ""
    rest = [x[len(prefix) :] for x in examples]
    out = Format(prefix, infer_automaton(rest, alphabet=alphabet_of(rest) or "0"), dict(Counter(map(len, examples))))
    losses = sorted(out.nats(x) / (len(x) + 1) for x in examples)
    out.most = losses[int(0.99 * len(losses))]
    return out


def infer_grammar(examples: dict[str, list[str]], ordinary: list[str], least_margin: float = 0.3) -> Grammar:
    """``examples``: credentials by kind, which fall into formats by prefix and alphabet.

    Fewer than ``LEAST_EXAMPLES`` alike make no format; they are known as they
    are. Ordinary strings of a length that a format has that fit it as well as nearly all of its own
    do are taken for unlabelled credentials and left out, unless that were most of them. The margin
    leaves out all but a thousandth of the ordinary strings that were kept from inference (every
    third), or if that would lose more, all but 98 % of the labelled ones.
    """
    groups, single = format_groups(examples)
    formats = {name: infer_format(own) for name, own in groups.items()}
    kept = sorted(ordinary)
    for f in formats.values():
        left = [x for x in kept if all(j - i not in f.lengths or f.nats(x[i:j]) / (j - i + 1) > f.most + 1e-6 for places in readings(x) for i, j in places)]
        if 2 * len(left) >= len(ordinary):
            kept = left
    out = Grammar(formats, infer_automaton([x for k, x in enumerate(kept) if k % 3]), least_margin, frozenset(single))
    if formats and kept:
        plain = sorted(out.score(x) for x in kept[::3])
        own = sorted(out.score(x) for strings in groups.values() for x in strings)
        out.margin = max(least_margin, min(plain[int(0.999 * len(plain))] + 0.05, own[int(0.02 * len(own))]))
    return out


def labelled_credentials(docs: DataFrame, text_col: str = "text", most: int = 2000, longest: int = LONGEST, most_ordinary: int = 6000, ordinary_docs: int = 4000) -> tuple[dict[str, list[str]], list[str]]:
    """Distinct credentials by kind as the base rules label them, without their keywords, and distinct ordinary candidates.

    Training data is bounded, each string by ``longest`` characters. Every
    text is searched for credentials, of which about ``most`` of each kind are
    drawn by hash; about ``most_ordinary`` ordinary strings are drawn from
    about ``ordinary_docs`` texts drawn by hash. Each string is counted once,
    however often it occurs.
    """
    text = F.col(text_col)
    found = lambda pattern, group: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    kinds = {"assign": F.filter(found(f"(?i){ASSIGN}", 2), lambda x: F.length(x) >= LEAST_ASSIGNED), "access": found(ACCESS, 0), "hex": found(HEX, 0)}
    rows = docs.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("found")) for k, v in kinds.items()))).alias("x")).select("x.kind", F.explode("x.found").alias("value"))
    distinct = cut(rows.where(F.length("value") <= longest).distinct(), "credentials")
    out: dict[str, list[str]] = {}
    for name in kinds:
        some = hash_sample(distinct.where(F.col("kind") == name), most, "value").collect()  # about ``most`` strings
        if some:
            out[name] = sorted(r["value"] for r in some)
    drawn = hash_sample(docs.select(text.alias("text")).where(text.isNotNull()), ordinary_docs, "text")
    runs = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    plain = drawn.select(F.explode(runs).alias("value")).where((F.length("value") <= longest) & ~F.col("value").rlike(f"{ACCESS}|{HEX}")).distinct()
    own = {x for strings in out.values() for x in strings}
    ordinary = [r["value"].strip(ENDS) for r in hash_sample(cut(plain, "ordinary"), most_ordinary, "value").collect()]
    return out, sorted({x for x in ordinary if len(x) >= LEAST_ASSIGNED and x not in own})


def base_spans(text: str) -> list[Span]:
    """Spans (start, end, kind) of the base rules in code points, in order of start, then of kind."""
    spans: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(*m.span(), "assign") for m in _assign.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    # access and hex matches lie within a long run of letters and digits
    for t in _run.finditer(text):
        spans += [(*m.span(), kind) for kind, p in (("access", _access), ("hex", _hex)) for m in p.finditer(text, *t.span())]
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


#: Words that a scanner remembers; when it is full, it starts again.
MEMORY = 200_000


class Scanner:
    """Scans texts with a grammar; a run of token characters that came before is not scored again."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar
        self.known: dict[str, tuple[tuple[tuple[int, int], ...], float]] = {}

    def __call__(self, text: str) -> tuple[list[Span], float | None]:
        """All spans of a text, those of the base rules and those that fit a learned format, and the best score of a candidate."""
        spans, best = base_spans(text), None
        for t in _token.finditer(text):
            run = t[0]
            if (got := self.known.get(run)) is None:
                got = self.grammar.candidates(run)
                if len(run) <= LONGEST:
                    if len(self.known) >= MEMORY:
                        self.known.clear()
                    self.known[run] = got
            if got[0]:
                spans += [(t.start() + a, t.start() + b, "grammar") for a, b in got[0]]
            if best is None or got[1] > best:
                best = got[1]
        return sorted(spans, key=_order), best


def scan_text(text: str, grammar: Grammar) -> tuple[list[Span], float | None]:
    return Scanner(grammar)(text)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each maximal run of spans replaced by ``mark``."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", grammar: Grammar | None = None) -> DataFrame:
    """One row for each row: id, spans (start, end, kind) of its whole text, and the best format score of its candidates.

    Every run of token characters is scored, in and outside of what the base rules find.

    A null text counts as empty; a row with a null id is scanned like any
    other; repeated rows give repeated results. Extra columns are not read.
    Without a ``grammar`` one is inferred from the labelled credentials of ``docs``.
    """
    own = grammar or infer_grammar(*labelled_credentials(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        scan = Scanner(own)
        for b in batches:
            found = [scan(t or "") for t in b.column(1).to_pylist()]
            spans = [[{"start": s, "end": e, "kind": k} for s, e, k in x] for x, _ in found]
            yield pa.record_batch([b.column(0), pa.array(spans, kind), pa.array([v for _, v in found], pa.float64())], names=[id_col, "spans", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, spans array<struct<start:bigint,end:bigint,kind:string>>, score double")


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None, grammar: Grammar | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with every span in the text masked; ``length_col``, if given, follows the new text.

    Null and empty texts, and rows without spans, stay as they are; null ids and
    repeated rows are rows like any others; an empty table stays empty. Other
    columns pass through whatever their names.
    """
    own = grammar or infer_grammar(*labelled_credentials(docs, text_col))
    at, n_at = docs.columns.index(text_col), docs.columns.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(own)
        for b in batches:
            columns = b.columns
            old = b.column(at).to_pylist()
            new = [t and redact(t, scan(t)[0]) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if n_at is not None:
                columns[n_at] = pa.array([n if x == y else len(y) for n, x, y in zip(b.column(n_at).to_pylist(), old, new, strict=True)], columns[n_at].type)
            yield pa.record_batch(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)
