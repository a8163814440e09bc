"""Language identification with a blended-spectrum string kernel.

A text is the set of its character n-grams, n = 1 to 4, hashed into one block
of columns per n.  The kernel of two texts counts their common n-grams, every
n with its weight, divided by the geometric mean of their own counts.  Against
a few landmark texts it gives the Nystroem features of a ridge regression, one
language versus the rest; texts are scored in batches by matrix products.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is every text if nothing could be learnt; whole texts of any length are read,
in blocks wide enough for millions of characters; rows with null ids are
predicted and never learnt from; repeated rows keep their rows and teach once;
equal scores go to the first language in order of code points; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import id_remainder, map_rows
from tributary.session import settled

UNKNOWN = "und"
ENTRIES = 1 << 15


@dataclass(frozen=True)
class Spectrum:
    """Columns (as powers of two) and weights of the n-gram blocks."""

    bits: tuple[int, ...] = (9, 12, 16, 18)
    weights: tuple[float, ...] = (0.5, 1.0, 1.5, 1.5)

    @property
    def width(self) -> int:
        return sum(1 << b for b in self.bits)

    def columns(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The columns of the n-grams of ``text``, in order, and their entries: a row of length one.

        The kernel of two texts is the product of their rows.
        """
        codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        grams, base, places, entries = np.zeros(len(codes), dtype=np.uint64), 0, [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.float32)]
        for n, (bits, weight) in enumerate(zip(self.bits, self.weights), 1):
            if len(codes) < n:
                break
            grams = (grams[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
            seen = np.unique((grams >> np.uint64(64 - bits)).astype(np.int64))
            places.append(base + seen)
            entries.append(np.full(len(seen), np.sqrt(weight), dtype=np.float32))
            base += 1 << bits
        place, entry = np.concatenate(places), np.concatenate(entries)
        return place, entry / max(float(np.linalg.norm(entry)), 1e-9)


@dataclass
class Model:
    languages: list[str]
    used: np.ndarray  # place of a column among those that a landmark has, or -1
    landmarks: np.ndarray  # (columns used, landmarks)
    weights: np.ndarray  # (landmarks, languages)
    bias: np.ndarray
    spectrum: Spectrum

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Kernel of texts and landmarks: a product of the texts' sparse rows and the landmarks, ENTRIES of them at a time."""
        out = np.zeros((len(texts), self.landmarks.shape[1]), dtype=np.float32)
        for k, text in enumerate(texts):
            place, entry = self.spectrum.columns(text)
            place = self.used[place]
            place, entry = place[place >= 0], entry[place >= 0]
            for a in range(0, len(place), ENTRIES):
                out[k] += entry[a : a + ENTRIES] @ self.landmarks[place[a : a + ENTRIES]]
        return out

    def margins(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights + self.bias


def ridge(kernel: np.ndarray, among: np.ndarray, target: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights per landmark and bias: ridge regression on features whitened by the landmarks' own kernel."""
    values, vectors = np.linalg.eigh(among.astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    z = kernel.astype(np.float64) @ whiten
    mean_z, mean_y = z.mean(axis=0), target.mean(axis=0)
    z, y = z - mean_z, target - mean_y
    w = np.linalg.solve(z.T @ z + penalty * np.eye(z.shape[1]), z.T @ y)
    return (whiten @ w).astype(np.float32), (mean_y - mean_z @ w).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit(docs: DataFrame, usable: Column, sample: int, landmarks: int, penalty: float, spectrum: Spectrum, seed: int = 3) -> Model | None:
    """Learn from at most ``sample`` different texts a language, the first ``landmarks`` of them as landmarks.

    A text that an id repeats counts once.  The samples' kernel values and the
    landmarks' rows are collected: both are bounded by the parameters.
    """
    known = docs.where(usable).where("lang is not null and text is not null and doc_id is not null").withColumn("place", F.xxhash64("doc_id", "text", F.lit(seed)))
    # short rows only, cut to the sample before they are shuffled to their language
    order = Window.partitionBy("lang").orderBy("place")
    ranked = known.select("lang", "place").distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    drawn = known.join(F.broadcast(ranked), ["lang", "place"])  # at most ``sample`` rows a language
    chosen = settled(drawn.groupBy("lang", "place").agg(F.min("rank").alias("rank"), F.min("doc_id").alias("doc_id"), F.min("text").alias("text")))

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [spectrum.columns(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.list_(pa.float32()))], ["lang", "rank", "place", "entry"])

    first = chosen.where(F.col("rank") <= landmarks).select("lang", "rank", "text")
    marks = map_rows(first, sparse, "lang string, rank int, place array<long>, entry array<float>").orderBy("lang", "rank").collect()
    if not marks:
        return None
    languages = sorted({r["lang"] for r in marks})
    columns = np.unique(np.concatenate([np.array(r["place"], dtype=np.int64) for r in marks]))
    used = np.full(spectrum.width, -1, dtype=np.int32)
    used[columns] = np.arange(len(columns))
    points = np.zeros((len(columns), len(marks)), dtype=np.float32)
    for k, r in enumerate(marks):
        points[used[r["place"]], k] = r["entry"]
    model = Model(languages, used, points, np.zeros((points.shape[1], len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32), spectrum)

    def kernels(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = model.kernel(batch.column("text").to_pylist())
        lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], pa.array(values.ravel()))
        return pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), lists], ["lang", "rank", "kernel"])

    rows = map_rows(chosen.select("lang", "rank", "text"), kernels, "lang string, rank int, kernel array<float>").orderBy("lang", "rank").collect()
    target = np.array([[1.0 if r["lang"] == k else -1.0 for k in languages] for r in rows])
    model.weights, model.bias = ridge(np.array([r["kernel"] for r in rows]), points.T @ points, target, penalty)
    return model


def languages(docs: DataFrame, fold: int = 3, held: int = 1, sample: int = 1000, landmarks: int = 40, penalty: float = 1e-2, spectrum: Spectrum = Spectrum()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; ids whose crc32 has remainder ``held`` teach nothing."""
    remainder = id_remainder("doc_id", fold)
    model = fit(docs.select("doc_id", "text", "lang"), remainder != held, sample, landmarks, penalty, spectrum)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        where = [k for k, t in enumerate(texts) if model and has_letter(t)]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for at in range(0, len(where), 256):
            part = where[at : at + 256]
            margins = model.margins([texts[k] for k in part])
            best = margins.argmax(axis=1)
            scores[part] = np.clip((1 + margins[np.arange(len(part)), best]) / 2, 0, 1)
            for k, b in zip(part, best):
                names[k] = model.languages[b]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder == held).alias("held_out"), "text")
    return map_rows(rows, work, "doc_id long, held_out boolean, lang_pred string, score double")
