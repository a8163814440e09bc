"""Personal data: overlapping candidate spans, boosted trees and calibrated thresholds.

Generators with high recall propose spans of every kind, overlapping where
their formats do; what fails the arithmetic of its kind (check digits, number
ranges) is not considered.  Boosted trees learn format and context from a
bounded sample of documents.  Positives are what the strict base patterns
accept, as it stands and rewritten into looser forms in its own context;
negatives are spans known to be something else: another kind, a piece of a
longer token, and order numbers, dates, times and versions, found or set in
the same contexts, in at most MOST_REWRITTEN places of a text, which bounds the
labelled rows.  Everything else is unlabelled.  Trees learn from one half of
the documents, by a hash of their text; per kind, the other half sets the lowest
threshold whose precision is good enough, by rows whose features the trees have
never seen; a kind without enough of both sorts adds nothing.  Base spans
always stay; selected candidates that touch none are added.

Defined cases: a null or empty text has no spans; whole texts of any length
are scanned, in time linear in their length; repeated rows and null ids keep
their rows, and equal labelled rows teach once; of candidates with equal scores
the first in order of kind and place is chosen; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.boosting import Boosted, boost
from tributary.llm.common import map_rows, touching
from tributary.session import settled

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# fixed values: the base patterns; possessive runs and look-behinds only keep them linear
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
HINT = r"@|[(\[]at[)\]]|[0-9]{3}"

# generators beside the base patterns
# each takes a whole run, however long, so that no span is a part of one; possessive runs keep them linear
LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20\.\x20|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+")
NUMBER = re.compile(r"(?<![0-9])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+")
DOTTED = re.compile(r"(?<![0-9.])[0-9]++(?:(?:[.:]|\x20\.\x20|\[\.\]|\x20?[(\[]dot[)\]]\x20?)[0-9]++){3,}+")
CUES = (("mail", "contact", "write"), ("ip", "host", "server", "address"), ("card", "visa", "credit", "pay"), ("phone", "tel", "call", "mobile", "fax"), ("order", "invoice", "version", "build", "release", "isbn", "serial", "ticket", "date", "time"))
AROUND, MOST_REWRITTEN = 48, 64  # characters of context, and hits of a text that are rewritten


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their at signs; every character is looked at a few times only."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", m.end() if m else at + 1)
    return out


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind and then start."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(map(small_part, m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of every generator, each under every kind it could be."""
    out = set(base)
    if "@" in text or "(at)" in text or "[at]" in text:
        out |= {("email", m.start(), m.end()) for m in LOOSE_EMAIL.finditer(text)}
    out |= {("ip", m.start(), m.end()) for m in DOTTED.finditer(text)}
    for m in NUMBER.finditer(text):
        n = len(DIGIT.findall(m[0]))
        start = m.start() + (m[0][0] == "(" and ")" not in m[0])
        if n >= 12:
            out.add(("card", start, m.end()))
        if n <= 16:
            out.add(("phone", start, m.end()))
    return sorted(out)


def possible(kind: str, span: str) -> bool:
    """Whether the digits could be of this kind at all."""
    if kind == "ip":
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(map(small_part, parts))
    digits = "".join(DIGIT.findall(span))
    return kind == "email" or (7 <= len(digits) <= 15 if kind == "phone" else 13 <= len(digits) <= 19 and luhn(digits))


def loose_forms(kind: str, span: str) -> list[str]:
    """A base hit as people write it to be read by people only, or without care."""
    if kind == "email":
        local, _, domain = span.rpartition("@")
        return [f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local}[at]{domain.replace('.', '[dot]')}", f"{local} [at] {domain}", f"{local} @ {domain}"]
    if kind == "ip":
        return [span.replace(".", mark) for mark in ("[.]", "(dot)", " . ", " [dot] ")]
    d = "".join(DIGIT.findall(span))
    if kind == "card":
        return [mark.join(d[i : i + 4] for i in range(0, len(d), 4)) for mark in (".", "  ", "- ", ". ")]
    parts = [d[:-10], d[-10:-7], d[-7:-4], d[-4:]] if len(d) > 10 else [d[:-7], d[-7:-4], d[-4:]]
    parts = [x for x in parts if x]
    forms = [span[1:].strip(), *(mark.join(parts) for mark in "-. ")]
    return [*forms, *([mark.join(parts[1:]) for mark in "-."] if len(d) > 10 else []), *([f"({parts[1]}) {parts[2]}-{parts[3]}"] if len(d) > 10 else [])]


def other_things(kind: str, before: str, rng: random.Random) -> list[str]:
    """What a candidate of this kind is mistaken for, some with a word ahead that says so."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(2, 20))) + rng.choice("abcdef")
    year, month, day, hour, minute, second = rng.randrange(1950, 2040), *(f"{rng.randrange(1, n):02}" for n in (13, 29, 24, 60, 60))
    named = rng.choice(("order", "order no", "invoice", "serial", "ticket"))
    if kind == "email":
        word = rng.choice(re.findall("[A-Za-z]+", before) or ["word"])
        return [f"{word} @ {number(2)}", f"{word} (at) {word}", f"{word} [at] {number(2)}", f"{word} @{word}"]
    if kind == "ip":
        mark = rng.choice(("[.]", "(dot)", " . "))
        return [f"{hour}:{minute}:{second}:{day}", f"time {hour}:{minute}:{second}:{month}", f"{rng.choice(('version', 'release', 'build'))} {mark.join(map(str, (rng.randrange(20), rng.randrange(40), rng.randrange(99), rng.randrange(256))))}"]
    if kind == "card":
        out = []
        for make in (
            lambda: f"{year}-{month}-{day}  {hour}.{minute}.{number(2)}", lambda: f"{day}.{month}.{year}  {hour}.{minute}.{number(2)}", lambda: f"{named} {'.'.join(number(4) for _ in range(4))}",
            lambda: f"isbn 978.{number(1)}.{number(2)}.{number(6)}.{number(1)}",
        ):
            out += next(([x] for x in (make() for _ in range(100)) if luhn("".join(DIGIT.findall(x)))), [])
        return out
    return [
        f"{year}-{month}-{day}", f"{day}.{month}.{year}", f"{year}-{month}-{day} {hour}", f"{named} {number(rng.randrange(7, 13))}", f"{named} {number(3)}-{number(3)}-{number(4)}",
        f"version {number(2)}.{number(3)}.{number(4)}", f"isbn 978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", f"{rng.choice('abcdef')}{number(rng.randrange(7, 13))}{rng.choice('abcdef')}",
        # a run of digits inside a longer token, at its start, end or middle
        *(f"{a}{number(rng.randrange(7, 16))}{b}" for a, b in ((token(), ""), ("", token()), (token(), token()))),
    ]


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    """Format of the span and what stands around it; nothing that needs arithmetic on its digits."""
    span, before, after = text[a:b], text[max(0, a - 24) : a], text[b : b + 12]
    n = b - a
    digits, letters = sum(c.isdigit() for c in span), sum(c.isalpha() for c in span)
    groups = re.findall(r"[0-9]+", span)
    marks = re.sub(r"[A-Za-z0-9]", "", span)
    words = re.findall(r"[a-z]+", before.lower())
    cue = [float(any(w.startswith(c) for w in words[-3:] for c in cues)) for cues in CUES]
    side = lambda c: 0.0 if not c or c.isspace() else 1.0 if c in ".,;:!?)\"'" else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0
    tail = re.search(r"\.([A-Za-z]+)$", span)
    return [
        float(KINDS.index(kind)), float(n), float(digits), float(letters), float(len(groups)), float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(len(marks)), float(len(set(marks))), float(marks.count(" ")), float(marks.count(".")), float(marks.count("-")), float("@" in span), float(span.startswith("+")), float("(" in span),
        float(len(tail[1]) if tail else 0), float(len(set(span)) / n), float(ord(span[0]) - 48 if span[0].isdigit() else -1),
        side(before[-1:]), side(after[:1]), float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)), *cue,
        float(marks.count(":")), float(len(re.findall(r"\.|[(\[]dot[)\]]", span))), float(len(groups[-1]) if groups else 0), float(len(groups[0]) if groups else 0),
    ]


@dataclass
class Selector:
    model: Boosted
    thresholds: dict[str, float]

    def added(self, text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates above their kind's threshold that touch no base span and no better candidate."""
        touches = touching([s[1:] for s in base])
        other = [c for c in candidates(text, base) if self.thresholds[c[0]] <= 1 and not touches(*c[1:]) and possible(c[0], text[c[1] : c[2]])]
        if not other:
            return []
        p = self.model.probabilities(np.array([features(text, *c) for c in other]))
        chosen: list[tuple[int, int, str]] = []  # apart from each other, by start
        for k in np.argsort(-p, kind="stable"):
            kind, a, b = other[k]
            at = bisect_left(chosen, (b,))
            if p[k] >= self.thresholds[kind] and not (at and chosen[at - 1][1] > a):
                insort(chosen, (a, b, kind))
        return [(kind, a, b) for a, b, kind in chosen]


def threshold(p: np.ndarray, y: np.ndarray, precision: float, least: int) -> float:
    """Lowest score from which at least ``precision`` of the labelled rows are right; 2 (none) without enough of both sorts."""
    if (y == 0).sum() < least or (y == 1).sum() < least:
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    last_of_score = np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero(last_of_score & (hits / np.arange(1, len(p) + 1) >= precision))
    return float(p[order][good[-1]]) if len(good) else 2.0


def learn(x: np.ndarray, y: np.ndarray, half: np.ndarray, precision: float = 0.98, least: int = 20) -> Selector | None:
    """Trees from half 0, thresholds from half 1."""
    one, two = half == 0, half == 1
    if not one.any() or not two.any() or y[one].min() == y[one].max():
        return None
    model = boost(x[one], y[one])
    p, kind = model.probabilities(x[two]), x[two, 0]
    return Selector(model, {k: threshold(p[kind == i], y[two][kind == i], precision, least) for i, k in enumerate(KINDS)})


def examples(text: str) -> list[tuple[list[float], int]]:
    """(features, label) of the spans of a text whose kind is known, and of rewritten ones in their contexts."""
    base = base_spans(text)
    strict, known = set(base), touching([s[1:] for s in base])
    own = {kind: touching([s[1:] for s in base if s[0] == kind]) for kind in KINDS}
    out = [(features(text, *c), 1) for c in base]
    for c in candidates(text, base):
        kind, a, b = c
        if c in strict or own[kind](a, b) or not possible(kind, text[a:b]):
            continue
        x = features(text, *c)
        inside = text[a - 1 : a].isalpha() and text[a].isdigit() or text[b : b + 1].isalpha() and text[b - 1].isdigit()
        named = any(w.startswith(CUES[-1]) for w in re.findall("[a-z]+", text[max(0, a - 24) : a].lower())[-3:])
        if known(a, b) or kind != "email" and (inside or named):
            out.append((x, 0))
    for kind in KINDS:
        for _, a, b in [s for s in base if s[0] == kind][:MOST_REWRITTEN]:
            before, after = text[max(0, a - AROUND) : a], text[b : b + AROUND]
            forms = [(form, 1) for form in loose_forms(kind, text[a:b])] + [(form, 0) for form in other_things(kind, before, random.Random(f"{before}{text[a:b]}"))]
            for form, good in forms:
                new, start, end = before + form + after, len(before), len(before) + len(form)
                strict_now = base_spans(new)
                if touching([s[1:] for s in strict_now])(start, end):
                    continue
                for k, i, j in candidates(new, strict_now):
                    right = bool(good) and k == kind and (i, j) == (start, end)
                    if i < end and j > start and possible(k, new[i:j]) and (right or not good or k != kind):
                        out.append((features(new, k, i, j), int(right)))
    return out


def labelled_rows(docs: DataFrame, sample: int = 6000, seed: int = 1) -> DataFrame:
    """Stored (x, y, half) of different labelled spans of at most ``sample`` documents; no ``x`` is in both halves."""
    known = docs.select("doc_id", "text").where("doc_id is not null")
    ids = known.where(F.col("text").rlike(HINT)).select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample).distinct()
    some = known.join(F.broadcast(ids), "doc_id")  # at most ``sample`` ids

    def labelled(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, marks, halves = [], [], []
        for text in batch.column("text").to_pylist():
            half = zlib.crc32((text or "").encode()) & 1
            for x, y in examples(text or ""):
                rows.append(x)
                marks.append(y)
                halves.append(half)
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(marks, pa.int32()), pa.array(halves, pa.int32())], ["x", "y", "half"])

    found = map_rows(some, labelled, "x array<double>, y int, half int")
    return settled(found.groupBy("x").agg(F.min("half").alias("half"), F.collect_set("y").alias("ys")).select("x", F.explode("ys").alias("y"), "half"))


def fit(docs: DataFrame, sample: int = 6000, taught: int = 20000, seed: int = 1) -> Selector | None:
    """Learn from about ``taught`` different labelled spans, at most, of at most ``sample`` documents."""
    rows = labelled_rows(docs, sample, seed)
    # a share by hash first, so that tasks send no more than what is learnt from
    share = min(1.0, 1.1 * taught / max(1, rows.count()))
    place = F.xxhash64("x", "y")
    drawn = rows.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(place, "x", "y").limit(taught).collect()
    return learn(*(np.array([r[c] for r in drawn]) for c in ("x", "y", "half"))) if drawn else None


def rendered(spans: list) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def personal_spans(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row; counts are of base spans."""
    selector = fit(docs, **options)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bases, every = [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            bases.append(base)
            every.append(base + selector.added(text, base) if selector and text else base)
        counts = [pa.array([sum(s[0] == k for s in base) for base in bases], pa.int64()) for k in KINDS]
        sums = [hashlib.sha256(rendered(base).encode()).hexdigest() for base in bases]
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array(sums), pa.array(list(map(rendered, every)), pa.string())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(rows, work, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
