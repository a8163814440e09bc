"""Quality scores by positive-unlabelled learning.

All trusted positives and all usable text as unlabelled give a linear model
over binned shape features that minimises the non-negative unbiased risk of the
squared loss, (1 + value) / 2 being the score; an unbiased estimate of the
negatives' risk below minus the tolerance counts as none.  The class prior is
estimated on a half of the rows that the classifier behind the estimate has not
seen, from the best bin of its scores.  Up to MOST_HERE rows are learnt from in
the driver.  More are counted by Spark: the squared loss needs nothing of the
rows but how often two bins meet, and the prior the counts of scores, both of a
size that does not grow with the rows.

Defined cases: a null or empty text is scored as an empty one; without any
trusted positive every score is 0.5; rows with null ids are scored and never
learnt from; repeated rows and labels teach once; equal scores stay equal;
whole texts of any length are read; an empty table gives no rows; extra columns
are not read by ``quality_scores`` and kept by ``accepted``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import WORD, id_remainder, map_groups, map_rows
from tributary.session import settled, ship_package

MOST_HERE = 6000
DROPPED_BITS = 10  # of a float's 23: edges have 14 significant bits
SCORE_PARTS = 4096
WORDS = re.compile(WORD)
CLASSES = 12


def _byte_classes() -> np.ndarray:
    """Class of every byte: lower, upper, digit, blank, newline, marks of several kinds, beyond ASCII."""
    of = np.full(256, 10, dtype=np.int64)
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:", "!?", "'\"()[]-", "#*$%&|<>", "/\\=_+~^@`{}")
    for k, members in enumerate(groups):
        of[[ord(c) for c in members]] = k
    of[128:] = 11
    return of


BYTE_CLASS = _byte_classes()


def shape(text: str) -> np.ndarray:
    """Features of a whole text: byte classes and their pairs, word and line statistics, compressibility."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(1, len(raw))
    kinds = BYTE_CLASS[raw]
    single = np.bincount(kinds, minlength=CLASSES)[:CLASSES] / n
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES) / n if len(raw) > 1 else np.zeros(CLASSES * CLASSES)
    words = WORDS.findall(text)
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    lines = text.split("\n")
    most = max(np.unique(np.fromiter(map(hash, words), dtype=np.int64, count=len(words)), return_counts=True)[1]) if words else 0
    more = [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 12).mean(),
        len(set(words)) / w, most / w, len(set(zip(words, words[1:]))) / w, len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)),
        sum(map(str.isupper, words)) / w, sum(map(str.istitle, words)) / w, len(zlib.compress(raw, 1)) / n,
    ]
    return np.concatenate([single, pairs, more]).astype(np.float32)


WIDTH = CLASSES + CLASSES * CLASSES + 14


def shapes(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the features of ``text``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.concatenate([shape(t or "") for t in batch.column("text").to_pylist()])
        lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * WIDTH, pa.array(values))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, "shape"])

    kinds = dict(docs.dtypes)
    return map_rows(docs.select(*keep, "text"), work, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", shape array<float>")


def matrix(lists: pa.Array) -> np.ndarray:
    """Stored features as rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), WIDTH)


@dataclass
class Model:
    """Bins per feature and a weight per bin."""

    edges: np.ndarray  # (features, edges)
    weights: np.ndarray  # (features, edges + 1)
    bias: float

    def values(self, x: np.ndarray) -> np.ndarray:
        value = np.full(len(x), self.bias)
        for k in range(x.shape[1]):
            value += self.weights[k][np.searchsorted(self.edges[k], x[:, k])]
        return value

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip((1 + self.values(x)) / 2, 0.0, 1.0)


def quantile_edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T.copy()


def one_hot(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    bins = edges.shape[1] + 1
    out = np.zeros((len(x), x.shape[1] * bins), dtype=np.float32)
    rows = np.arange(len(x))
    for k in range(x.shape[1]):
        out[rows, k * bins + np.searchsorted(edges[k], x[:, k])] = 1
    return out


def descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero; ``gradient(weights)`` includes the bias as the last weight."""
    w, m, v = (np.zeros(width, dtype=np.float32) for _ in range(3))
    for step in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.3) -> float:
    """Share of positives in unlabelled text: the smallest ratio of upper tails with a bound on its error.

    ``positive`` and ``unlabelled`` are scores of rows that the scorer has not seen.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.quantile(p, np.linspace(0, 1 - least_share, 200))
    tail_p = 1 - np.searchsorted(p, cuts) / len(p)
    tail_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((tail_u + slack) / tail_p)
    return float(np.clip(tail_u[best] / tail_p[best], 0.02, 0.98))


def learn(positive: np.ndarray, unlabelled: np.ndarray, bins: int = 8, steps: int = 300, rate: float = 0.02, decay: float = 1e-3, tolerance: float = 0.1) -> tuple[Model, float]:
    """The model and the estimated prior."""
    edges = quantile_edges(np.concatenate([positive, unlabelled]), bins)
    p, u = one_hot(positive, edges), one_hot(unlabelled, edges)
    add_one = lambda x: np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
    p, u = add_one(p), add_one(u)
    penalty = np.full(p.shape[1], decay, dtype=np.float32)
    penalty[-1] = 0

    # a plain classifier of positive against unlabelled, on either half, gives the prior on the other
    priors = []
    for half in (0, 1) if min(len(p), len(u)) > 3 else ():
        pt, ut, po, uo = p[half::2], u[half::2], p[1 - half :: 2], u[1 - half :: 2]
        plain = descend(lambda w: pt.T @ (sigmoid(pt @ w) - 1) / len(pt) + ut.T @ sigmoid(ut @ w) / len(ut) + 2 * penalty * w, p.shape[1], steps // 2, rate)  # noqa: B023
        priors.append(class_prior(po @ plain, uo @ plain))
    prior = float(np.mean(priors)) if priors else 0.5

    def gradient(w: np.ndarray) -> np.ndarray:
        gp, gu = p @ w, u @ w  # the squared loss of a positive is (1 - g)^2, of a negative (1 + g)^2
        negative_risk = ((1 + gu) ** 2).mean() - prior * ((1 + gp) ** 2).mean()
        of_positive = -2 * prior * (p.T @ (1 - gp)) / len(p) + 2 * penalty * w
        if negative_risk < -tolerance:  # counts as no risk
            return of_positive
        return of_positive + 2 * (u.T @ (1 + gu)) / len(u) - 2 * prior * (p.T @ (1 + gp)) / len(p)

    w = descend(gradient, p.shape[1], steps, rate)
    return Model(edges, w[:-1].reshape(edges.shape[0], bins), float(w[-1])), prior


def counted_edges(once: DataFrame, bins: int) -> np.ndarray:
    """Quantiles of every feature over positives and unlabelled rows, from counts of values at 14 significant bits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.ascontiguousarray(matrix(batch.column("shape")), dtype=np.float32).view(np.int32).astype(np.int64) >> DROPPED_BITS
                keys = x + (np.arange(WIDTH, dtype=np.int64) << 32)  # no feature is negative, so bits are in the order of values
                twice = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
                found, n = np.unique(np.concatenate([keys.ravel(), keys[twice].ravel()]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found >> 32), pa.array(found & 0xFFFFFFFF), pa.array(n)], ["feature", "value", "n"])

    counts = once.mapInArrow(work, "feature long, value long, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    of = Window.partitionBy("feature")  # as many rows as a float of 14 bits has values, at most
    upto = F.sum("n").over(of.orderBy("value")).alias("upto")
    reached = counts.select("feature", "value", "n", upto, F.sum("n").over(of).alias("total"))
    wanted = [F.when((F.col("upto") * bins >= k * F.col("total")) & ((F.col("upto") - F.col("n")) * bins < k * F.col("total")), F.lit(k)) for k in range(1, bins)]
    rows = reached.select("feature", "value", F.explode(F.array_compact(F.array(*wanted))).alias("k")).collect()  # one for each edge
    edges = np.zeros((WIDTH, bins - 1), dtype=np.int32)
    for r in rows:
        edges[r["feature"], r["k"] - 1] = (r["value"] << DROPPED_BITS) | ((1 << DROPPED_BITS) - 1)  # the highest float so counted
    return edges.view(np.float32).astype(np.float64)


def counted_meetings(once: DataFrame, edges: np.ndarray) -> np.ndarray:
    """(half, trusted or all, w, w): in how many rows two bins meet; the last bin is in every row.

    Every task adds up its rows and there are as many tasks as cores, so what
    is shuffled does not grow with the rows.
    """
    width = edges.size + WIDTH + 1
    upper = np.triu_indices(width)
    cuts = np.linspace(0, len(upper[0]), 33).astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2, width, width), dtype=np.float64)
        for batch in batches:
            for part in range(0, batch.num_rows, 2048):
                rows = batch.slice(part, 2048)
                x = one_hot(matrix(rows.column("shape")), edges)
                x = np.concatenate([x, np.ones((len(x), 1), dtype=np.float32)], axis=1)
                half, trusted = rows.column("half").to_numpy(), rows.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
                for h in (0, 1):
                    for k, mark in enumerate((half == h, (half == h) & trusted)):
                        if mark.any():
                            sums[h, k] += x[mark].T @ x[mark]  # whole numbers, exact
        for h in (0, 1):
            for k in (0, 1):
                if sums[h, k, -1, -1]:
                    flat = sums[h, k][upper].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([4 * c + 2 * h + k for c in range(32)]), pa.array([flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], ["piece", "counts"])

    def add(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        total = sum(np.frombuffer(c.as_py(), dtype=np.int64) for c in table.column("counts"))
        yield pa.RecordBatch.from_arrays([pa.array([int(key[0])]), pa.array([total.tobytes()], pa.binary())], ["piece", "counts"])

    ship_package(once.sparkSession)
    partial = once.select("half", "trusted", "shape").coalesce(once.sparkSession.sparkContext.defaultParallelism).mapInArrow(work, "piece long, counts binary")
    out = np.zeros((2, 2, width, width))
    for r in map_groups(partial, ["piece"], add, "piece long, counts binary").toLocalIterator():
        c, h, k = r["piece"] // 4, r["piece"] // 2 % 2, r["piece"] % 2
        at = slice(cuts[c], cuts[c + 1])
        out[h, k, upper[0][at], upper[1][at]] = np.frombuffer(r["counts"], dtype=np.int64)
        out[h, k, upper[1][at], upper[0][at]] = out[h, k, upper[0][at], upper[1][at]]
    return out


def counted_prior(counts: DataFrame, least_share: float = 0.3) -> float:
    """``class_prior`` from (part, p, u): how many positives and unlabelled rows score in each part of the scale."""
    rows = sorted(counts.collect(), reverse=True)  # as many as the scale has parts
    p, u = np.cumsum([r["p"] for r in rows]), np.cumsum([r["u"] for r in rows])
    tail_p, tail_u = p / p[-1], u / u[-1]
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(p[-1]) + 1 / np.sqrt(u[-1]))
    fit_for = tail_p >= least_share
    best = np.argmin((tail_u[fit_for] + slack) / tail_p[fit_for])
    return float(np.clip((tail_u[fit_for] / tail_p[fit_for])[best], 0.02, 0.98))


def learn_counted(once: DataFrame, bins: int = 8, steps: int = 300, rate: float = 0.02, decay: float = 1e-3, tolerance: float = 0.1) -> tuple[Model, float]:
    """``learn`` over stored rows of any number; the classifier behind the prior has the squared loss too."""
    edges = counted_edges(once, bins)
    meet = counted_meetings(once, edges)
    width = meet.shape[-1]
    penalty = np.full(width, decay)
    penalty[-1] = 0

    plain: dict[int, np.ndarray] = {}
    for h in (0, 1):
        if meet[h, 1, -1, -1] and meet[1 - h, 1, -1, -1]:
            u, p = (m / m[-1, -1] for m in meet[h])
            plain[1 - h] = np.linalg.solve(p + u + np.diag(penalty + 1e-9), p[-1] - u[-1]).astype(np.float64)
    priors = []
    for h, w in plain.items():
        table = Model(edges, w[:-1].reshape(WIDTH, bins), float(w[-1]))

        def work(batches: Iterator[pa.RecordBatch], table: Model = table) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = np.floor(np.clip(table.values(matrix(batch.column("shape"))), -8, 8) * SCORE_PARTS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part), batch.column("trusted")], ["part", "trusted"])

        seen = once.where(F.col("half") == h).select("trusted", "shape").mapInArrow(work, "part long, trusted boolean")
        priors.append(counted_prior(seen.groupBy("part").agg(F.count_if("trusted").alias("p"), F.count("*").alias("u"))))
    prior = float(np.mean(priors)) if priors else 0.5

    u, p = (m / m[-1, -1] for m in meet.sum(axis=0))

    def gradient(w: np.ndarray) -> np.ndarray:
        pw, uw = p @ w, u @ w
        negative_risk = (1 + 2 * uw[-1] + w @ uw) - prior * (1 + 2 * pw[-1] + w @ pw)
        of_positive = -2 * prior * (p[-1] - pw) + 2 * penalty * w
        if negative_risk < -tolerance:  # counts as no risk
            return of_positive
        return of_positive + 2 * (u[-1] + uw) - 2 * prior * (p[-1] + pw)

    w = descend(gradient, width, steps, rate)
    return Model(edges, w[:-1].reshape(WIDTH, bins), float(w[-1])), prior


def placed(docs: DataFrame, place: str, seed: int = 4) -> DataFrame:
    return docs.withColumn(place, F.xxhash64("doc_id", "text", F.lit(seed)))


def fit(shaped: DataFrame, labels: DataFrame, sample: int | None = None, seed: int = 4) -> tuple[Model, float] | None:
    """Learn from the rows (doc_id, place, shape); all are unlabelled, those with a label 1 are trusted too.

    A row is taken once however often it is repeated.  With ``sample`` only so
    many of either kind teach, those with the smallest places.
    """
    good = labels.where("quality = 1").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    distinct = shaped.where("doc_id is not null").groupBy("place", "doc_id").agg(F.min("shape").alias("shape"))
    marked = distinct.join(good, "doc_id", "left").select("place", "doc_id", F.pmod("place", F.lit(2)).cast("long").alias("half"), F.coalesce("trusted", F.lit(False)).alias("trusted"), "shape")
    once = settled(marked)
    n, trusted = once.agg(F.count("*"), F.count_if("trusted")).first()
    if not trusted:
        return None
    if sample is None and n > MOST_HERE:
        return learn_counted(once)
    first = lambda df, mark: (df.orderBy("place", "doc_id").limit(sample) if sample else df).withColumn("trusted", F.lit(mark))
    rows = first(once.where("trusted"), True).unionByName(first(once, False)).orderBy("place", "doc_id", "trusted").collect()  # at most 2 * MOST_HERE or 2 * sample
    x = np.array([r["shape"] for r in rows], dtype=np.float64).reshape(len(rows), WIDTH)
    mark = np.array([r["trusted"] for r in rows], dtype=bool)
    order = np.random.RandomState(seed).permutation(len(rows))
    x, mark = x[order], mark[order]
    return learn(x[mark], x[~mark])


def quality_scores(docs: DataFrame, labels: DataFrame, fold: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; remainder 0 of the id's crc32 is held out."""
    rows = placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_remainder("doc_id", fold) == 0).alias("held_out"), "text"), "place")
    shaped = settled(shapes(rows, "doc_id", "held_out", "place"))  # learnt from and scored
    fitted = fit(shaped.where("not held_out"), labels, **options)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = fitted[0].scores(matrix(batch.column("shape"))) if fitted else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return shaped.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, fold: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs``, whole, whose score reaches the threshold."""
    usable = docs.select("doc_id", "text").where(id_remainder("doc_id", fold) > 0)
    fitted = fit(shapes(placed(usable, "place"), "doc_id", "place"), labels, **options)  # texts are read again below: a stored copy would be as large as they

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = fitted[0].scores(np.stack([shape(t or "") for t in batch.column("text").to_pylist()])) if fitted else np.full(batch.num_rows, 0.5)
        return batch.filter(pa.array(score >= threshold))

    return map_rows(docs, work, docs.schema)
