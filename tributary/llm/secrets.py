"""Secret scans: fixed patterns, and formats inferred from labelled credentials.

The values that the patterns find in all documents are the labelled
credentials.  Per kind, their symbol strings build a prefix tree whose states
are merged where their counts are statistically compatible; the result is a
probabilistic automaton of that kind's format.  The tree has a state of its own
for every prefix of up to DEEPEST symbols that one in PREFIX_SHARE credentials
has; the rest of a string is counted in tail states, one for each symbol, so
that every credential counts whole and the tree stays bounded.  Every token of every text
that is as long as the shortest labelled credential, or has LONG characters, is
scored by the best automaton against a background chain of ordinary tokens of its band of length;
what scores above the band's calibrated threshold is a secret too.  Short
tokens are noisy: below LONG characters a larger margin holds, and at most as
many ordinary tokens pass as credentials of those lengths are labelled, or the
share that passes among long ones.  All
counts and thresholds are over all documents and tokens of any length; Spark
adds them up and the driver gets the bounded sums.

Defined cases: a null or empty text has no spans; whole texts of any length
are scanned; without labelled credentials only the patterns find spans;
repeated rows and null ids keep their rows; equal scores pass together; an
empty table gives no rows; extra columns are not read by ``secret_spans`` and
kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import map_rows, touching
from tributary.session import settled, ship_package

# fixed values: the patterns of the base kinds, in their order
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
ADDED = "format"
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")  # no labelled credential is shorter
DEEPEST, PREFIX_SHARE = 64, 2000
BANDS = (6, 8, 12, 16)  # least lengths of the bands
LONG = BANDS[-1]
SHORT_MARGIN = 0.5
MOST_CACHED = 1 << 16

# a kind's symbol is one of its members, so that a symbol string is its own: it scores as the tokens that it stands for
SYMBOL = str.maketrans({c: members[0] for members in ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ") for c in members})


def symbols(token: str) -> str:
    """The token with its characters replaced by their kinds; marks and symbols stay themselves."""
    return token.translate(SYMBOL)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base patterns, by start and then kind."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_VALUE:
            found.append((m.start(), m.end(), "assign", m[2]))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= LEAST_ACCESS:
            found.append((m.start(), m.end(), "access", m[0]))
    for m in HEX.finditer(text):
        found.append((m.start(), m.end(), "hex", m[0]))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Automaton:
    """Merged prefix tree: per state the visits, the ends and the next state and count of each symbol."""

    visits: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    arcs: list[dict[str, list[int]]] = field(default_factory=list)
    tails: dict[str, int] = field(default_factory=dict)  # state of each symbol beyond the tree
    floor: float = 1e-4

    def add_state(self) -> int:
        self.visits.append(0)
        self.ends.append(0)
        self.arcs.append({})
        return len(self.visits) - 1

    def log_likelihood(self, word: str) -> float:
        state, total = 0, 0.0
        for k, s in enumerate(word):
            arc = self.arcs[state].get(s)
            if arc is None:
                return total + (len(word) - k + 1) * math.log(self.floor)
            total += math.log(arc[1] / self.visits[state])
            state = arc[0]
        return total + math.log(max(self.floor, self.ends[state] / self.visits[state]))


def prefix_tree(words: Counter) -> Automaton:
    tree = Automaton()
    tree.add_state()
    for word, n in sorted(words.items()):
        state = 0
        tree.visits[0] += n
        for s in word:
            arc = tree.arcs[state].get(s)
            if arc is None:
                arc = tree.arcs[state][s] = [tree.add_state(), 0]
            arc[1] += n
            state = arc[0]
            tree.visits[state] += n
        tree.ends[state] += n
    return tree


def bounded_tree(prefixes: dict[str, tuple[int, int]], leaving: Counter, beyond: Counter) -> Automaton:
    """The tree of ``prefixes`` (visits, ends); strings go on in tail states.

    ``leaving`` counts (prefix, symbol) of the steps out of the tree, ``beyond``
    (symbol, next symbol or $) of the steps after them.
    """
    tree, of = Automaton(), {}
    for prefix, (visits, ends) in sorted(prefixes.items()):
        state = of[prefix] = tree.add_state()
        tree.visits[state], tree.ends[state] = visits, ends
        if prefix:
            tree.arcs[of[prefix[:-1]]][prefix[-1]] = [state, visits]
    for s in sorted({s for s, _ in beyond}):
        tree.tails[s] = tree.add_state()
    for (s, following), n in sorted(beyond.items()):
        tree.visits[tree.tails[s]] += n
        if following == "$":
            tree.ends[tree.tails[s]] += n
        else:
            tree.arcs[tree.tails[s]][following] = [tree.tails[following], n]
    for (prefix, s), n in sorted(leaving.items()):
        tree.arcs[of[prefix]][s] = [tree.tails[s], n]
    return tree


def walk(word: str, prefixes: frozenset[str] | dict) -> tuple[str, str]:
    """The longest beginning of ``word`` in the tree and the rest."""
    k = 0
    while k < len(word) and word[: k + 1] in prefixes:
        k += 1
    return word[:k], word[k:]


def differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    """Hoeffding test of two frequencies."""
    return abs(f1 / n1 - f2 / n2) > bound * (n1**-0.5 + n2**-0.5)


def compatible(a: Automaton, one: int, two: int, bound: float) -> bool:
    pairs, seen = [(one, two)], set()
    while pairs:
        x, y = pairs.pop()
        if (x, y) in seen:
            continue
        seen.add((x, y))
        nx, ny = a.visits[x], a.visits[y]
        if differ(a.ends[x], nx, a.ends[y], ny, bound):
            return False
        for s in a.arcs[x].keys() | a.arcs[y].keys():
            p, q = a.arcs[x].get(s), a.arcs[y].get(s)
            if differ(p[1] if p else 0, nx, q[1] if q else 0, ny, bound):
                return False
            if p and q and p[0] != q[0] and bound * (a.visits[p[0]] ** -0.5 + a.visits[q[0]] ** -0.5) < 1:
                pairs.append((p[0], q[0]))  # below, any two frequencies would pass
    return True


def merge(a: Automaton, keep: int, drop: int, parent: int, symbol: str) -> None:
    """Fold the tree below ``drop`` into ``keep``; tail states stay as they are."""
    tails = set(a.tails.values())
    a.arcs[parent][symbol][0] = keep
    pairs = [(keep, drop)]
    while pairs:
        x, y = pairs.pop()
        a.visits[x] += a.visits[y]
        a.ends[x] += a.ends[y]
        for s, (child, n) in a.arcs[y].items():
            if s in a.arcs[x]:
                a.arcs[x][s][1] += n
                if child not in tails:
                    pairs.append((a.arcs[x][s][0], child))
            else:
                a.arcs[x][s] = [child, n]


def infer(a: Automaton, alpha: float = 0.01) -> Automaton:
    """Merge compatible states of the prefix tree, nearest to the root first."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    kept = [0, *a.tails.values()]
    while True:
        inside = set(kept)
        edge = [(k, s, arc[0]) for k in kept for s, arc in sorted(a.arcs[k].items()) if arc[0] not in inside]
        if not edge:
            return a
        parent, symbol, state = edge[0]
        into = next((k for k in kept if compatible(a, k, state, bound)), None)
        if into is None:
            kept.append(state)
        else:
            merge(a, into, state, parent, symbol)


def steps(words: Counter) -> Counter:
    """Counts of neighbouring symbols, ^ before and $ after a word."""
    counts: Counter = Counter()
    for word, n in words.items():
        for a, b in zip("^" + word, word + "$"):
            counts[a + b] += n
    return counts


@dataclass
class Background:
    """First-order chain of the symbols of ordinary tokens."""

    counts: Counter
    totals: Counter
    size: int

    @classmethod
    def of(cls, counts: Counter) -> Background:
        """From the counts of ``steps``."""
        totals: Counter = Counter()
        for k, n in counts.items():
            totals[k[0]] += n
        return cls(counts, totals, len({k[1] for k in counts}) + 8)

    def log_likelihood(self, word: str) -> float:
        return sum(math.log((self.counts[a + b] + 0.5) / (self.totals[a] + 0.5 * self.size)) for a, b in zip("^" + word, word + "$"))


def band(n: int) -> int:
    """Least length of the band that ``n`` characters are in."""
    return BANDS[bisect_right(BANDS, n) - 1]


@dataclass
class Formats:
    automata: dict[str, Automaton]
    backgrounds: dict[int, Background]
    thresholds: dict[int, float] = field(default_factory=dict)
    least: int = LONG
    cached: dict[str, float] = field(default_factory=dict)

    def score(self, token: str) -> float:
        """Best log-likelihood ratio per symbol; tokens of the same symbols share it."""
        word = symbols(token)
        known = self.cached.get(word)
        if known is None:
            ground = self.backgrounds[band(len(word))].log_likelihood(word)
            known = max(a.log_likelihood(word) - ground for a in self.automata.values()) / (len(word) + 1)
            if len(self.cached) >= MOST_CACHED:
                self.cached.clear()
            self.cached[word] = known
        return known

    def passes(self, token: str) -> bool:
        return len(token) >= self.least and self.score(token) > self.thresholds[band(len(token))]


def formats_of(automata: dict[str, Automaton], chains: dict[int, Counter], least: int) -> Formats:
    """Formats without thresholds; a band without ordinary tokens takes the chain of all."""
    everything = sum(chains.values(), Counter())
    return Formats(automata, {b: Background.of(chains.get(b) or everything) for b in BANDS}, least=max(BANDS[0], min(LONG, least)))


def passing(b: int, ordinary: int, labelled: int, false_share: float) -> float:
    """How many ordinary tokens of a band may pass.

    The scanned tokens are the ordinary ones, so none would be found if none
    might pass.  Of short ones as many may be credentials without a keyword as
    are labelled, however few tokens there are.
    """
    return false_share * ordinary if b == LONG else max(false_share * ordinary, labelled)


def set_thresholds(formats: Formats, levels: dict[int, float], margin: float) -> None:
    """From the highest score of each band that more ordinary tokens reach than may pass.

    A short token passes only SHORT_MARGIN above it; a band without ordinary
    tokens has the threshold of the long ones.
    """
    for b in BANDS:
        formats.thresholds[b] = max(levels.get(b, 0.0), 0.0) + (margin if b == LONG else SHORT_MARGIN)
    for b in BANDS:
        if b not in levels:
            formats.thresholds[b] = max(formats.thresholds[b], formats.thresholds[LONG])


def learn(labelled: dict[str, Counter], ordinary: Counter, false_share: float = 0.0005, margin: float = 0.05) -> Formats | None:
    """What ``fit`` learns, from counts held in one process, with whole prefix trees.

    At most ``false_share`` of the long ordinary tokens pass; of short ones see ``passing``.
    """
    automata = {k: infer(prefix_tree(w)) for k, w in labelled.items() if w}
    if not automata:
        return None
    by_band: dict[int, Counter] = {}
    for word, n in ordinary.items():
        by_band.setdefault(band(len(word)), Counter())[word] += n
    formats = formats_of(automata, {b: steps(words) for b, words in by_band.items()}, min(len(w) for words in labelled.values() for w in words))
    known: Counter = Counter()
    for words in labelled.values():
        for word, n in words.items():
            known[band(len(word))] += n
    levels: dict[int, float] = {}
    for b, words in by_band.items():
        allowed, total = passing(b, sum(words.values()), known[b], false_share), 0
        for score, n in sorted(((formats.score(w), n) for w, n in words.items()), reverse=True):
            levels[b] = score
            total += n
            if total > allowed:
                break
    set_thresholds(formats, levels, margin)
    return formats


def ordinary_tokens(text: str, base: list) -> list[tuple[int, int]]:
    """Tokens that no base span touches."""
    touches = touching([s[:2] for s in base])
    return [m.span() for m in TOKEN.finditer(text) if not touches(*m.span())]


def word_counts(docs: DataFrame) -> DataFrame:
    """(kind, word, n) of the symbol strings of all labelled credentials and, by band, of all ordinary tokens."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        credentials, plain = Counter(), Counter()
        for text in filter(None, batch.column("text").to_pylist()):
            base = base_spans(text)
            credentials.update((kind, symbols(value)) for _, _, kind, value in base)
            found = [text[a:b] for a, b in ordinary_tokens(text, base)] if base else TOKEN.findall(text)
            plain.update(" ".join(found).translate(SYMBOL).split())
        rows = [(k, w, n) for (k, w), n in credentials.items()] + [(str(band(len(w))), w, n) for w, n in plain.items()]
        kinds, words, counts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["kind", "word", "n"])

    return map_rows(docs.select("text"), work, "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))


def added_up(words: DataFrame, of: Callable[[str, str, int], Iterator[tuple[str, str, int]]]) -> dict[str, Counter]:
    """Per kind the sums of what ``of`` (kind, word, n) gives; its names are few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("kind", "word", "n"))):
                for kind, name, n in of(*row):
                    sums[kind, name] += n
        kinds, names = zip(*sums) if sums else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(list(sums.values()), pa.int64())], ["kind", "name", "n"])

    ship_package(words.sparkSession)
    out: dict[str, Counter] = {}
    for r in words.mapInArrow(run, "kind string, name string, n long").groupBy("kind", "name").agg(F.sum("n").alias("n")).collect():
        out.setdefault(r["kind"], Counter())[r["name"]] = r["n"]
    return out


def trees(credentials: DataFrame) -> dict[str, Automaton]:
    """Per kind the bounded prefix tree of all credentials, not merged yet."""
    totals = {r["kind"]: r["n"] for r in credentials.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    places = F.explode(F.sequence(F.lit(0), F.least(F.length("word"), F.lit(DEEPEST))))
    begun = credentials.select("kind", "word", "n", places.alias("k")).groupBy("kind", F.expr("substring(word, 1, k)").alias("prefix")).agg(
        F.sum("n").alias("visits"), F.sum(F.when(F.length("word") == F.col("k"), F.col("n")).otherwise(0)).alias("ends"))
    total = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for k, n in totals.items()])
    prefixes: dict[str, dict[str, tuple[int, int]]] = {k: {} for k in totals}
    for r in begun.where(F.col("visits") * PREFIX_SHARE >= total).collect():  # at most PREFIX_SHARE for each of DEEPEST + 1 lengths
        prefixes[r["kind"]][r["prefix"]] = (r["visits"], r["ends"])
    inside = {k: frozenset(p) for k, p in prefixes.items()}

    def steps_beyond(kind: str, word: str, n: int) -> Iterator[tuple[str, str, int]]:
        begin, rest = walk(word, inside[kind])
        if rest:
            yield kind, f"{begin}>{rest[0]}", n
            for a, b in zip(rest, rest[1:] + "$"):
                yield kind, a + b, n

    out, found = {}, added_up(credentials, steps_beyond)
    for kind in sorted(totals):
        sums = found.get(kind, Counter())
        leaving = Counter({(name[:-2], name[-1]): n for name, n in sums.items() if name[-2] == ">"})
        beyond = Counter({(name[0], name[1]): n for name, n in sums.items() if name[-2] != ">"})
        out[kind] = bounded_tree(prefixes[kind], leaving, beyond)
    return out


def level(scores: DataFrame, allowed: float, parts: int = 1024) -> float:
    """The highest ``score`` that more than ``allowed`` of ``n`` reach, else the lowest, found exactly in narrowing ranges."""
    above = 0
    while True:
        low, high = scores.agg(F.min("score"), F.max("score")).first()
        if low == high:
            return low
        part = F.least(F.floor((F.col("score") - low) / (high - low) * parts), F.lit(parts - 1))
        ranges = scores.groupBy(part.alias("part")).agg(F.sum("n").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for r in sorted(ranges.collect(), key=lambda r: -r["part"]):
            if above + r["n"] > allowed:
                break
            above += r["n"]
        scores = scores.where(F.col("score").between(r["low"], r["high"]))


def fit(docs: DataFrame, false_share: float = 0.0005, margin: float = 0.05) -> Formats | None:
    """Learn from every credential and every ordinary token of all documents.

    The counts of their distinct symbol strings are stored; the automata, the
    chains and the levels are sums over them.  At most ``false_share`` of the
    long ordinary tokens pass; of short ones see ``passing``.
    """
    counts = settled(word_counts(docs))
    credentials = counts.where(F.col("kind").isin(*KINDS))
    automata = {k: infer(tree) for k, tree in trees(credentials).items()}
    if not automata:
        return None
    ordinary = counts.where(~F.col("kind").isin(*KINDS))
    chains = added_up(ordinary, lambda kind, word, n: ((kind, step, k) for step, k in steps(Counter({word: n})).items()))
    bands = F.greatest(*[F.when(F.length("word") >= b, b) for b in BANDS])
    known = {r["b"]: r for r in credentials.groupBy(bands.alias("b")).agg(F.sum("n").alias("n"), F.min(F.length("word")).alias("least")).collect()}
    formats = formats_of(automata, {int(k): c for k, c in chains.items()}, min(r["least"] for r in known.values()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([formats.score(w) for w in batch.column("word").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("kind"), scores, batch.column("n")], ["kind", "score", "n"])

    scored = settled(ordinary.mapInArrow(work, "kind string, score double, n long").groupBy("kind", "score").agg(F.sum("n").alias("n")))
    sizes = {int(r["kind"]): r["n"] for r in scored.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    levels = {b: level(scored.where(F.col("kind") == str(b)), passing(b, n, known[b]["n"] if b in known else 0, false_share)) for b, n in sizes.items()}
    set_thresholds(formats, levels, margin)
    formats.cached.clear()
    return formats


def scan(text: str, formats: Formats | None) -> list[tuple[int, int, str]]:
    """All spans of a text, by start and then kind; the base ones stay as they are."""
    base = base_spans(text)
    spans = [s[:3] for s in base]
    if formats:
        spans += [(a, b, ADDED) for a, b in ordinary_tokens(text, base) if formats.passes(text[a:b])]
    return sorted(spans, key=lambda s: (s[0], (*KINDS, ADDED).index(s[2])))


def rendered(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def secret_spans(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row."""
    formats = fit(docs, **options)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(t or "", formats) for t in batch.column("text").to_pylist()]
        count = lambda kind: pa.array([sum(s[2] == kind for s in spans) for spans in found], pa.int64())
        sums = [hashlib.sha256(rendered([s for s in spans if s[2] != ADDED]).encode()).hexdigest() for spans in found]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(count, KINDS), pa.array(sums), pa.array(map(rendered, found), pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """The rows with every span of ``text`` replaced by ``mark``; overlapping spans by one mark."""
    formats = fit(docs, **options)
    columns = docs.columns

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for a, b, _ in scan(text, formats) if text else ():
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return text if not out else "".join(out) + text[at:]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [clean(t) for t in batch.column("text").to_pylist()]
        new = {"text": pa.array(texts, pa.string())}
        if "n_chars" in columns:
            old = batch.column("n_chars").to_pylist()
            new["n_chars"] = pa.array([n if t == o else len(t) for n, t, o in zip(old, texts, batch.column("text").to_pylist())], pa.int64())
        return pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], columns)

    return map_rows(docs, work, docs.schema)
