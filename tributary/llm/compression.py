"""Quality rules from compression bands, beside a few counted rules.

A text whose zstandard ratio (bytes per compressed byte) lies above the band of
its length repeats itself; one below it is close to random.  The whole text
and every chunk of a fixed size are tested, each against the limits of its
own length.  The limits lie a stated margin outside what good text reaches.

Defined cases: a null or empty text has no words and fails the word count;
texts of any length are compressed whole; repeated rows and null ids keep
their rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WORD, map_rows

WORDS, BLANK, SYMBOLS, RUN = re.compile(WORD), " \t\n\x0b\x0c\r", "#*$%&|<>", 8


Limits = tuple[tuple[float, float, float], ...]

# least and largest ratio of the labelled good documents of sf0.1 that pass the base rules, by bytes; from 32768 bytes
# on, where it has none, the largest of good documents of one language laid end to end, and the least of the band before
GOOD: Limits = (
    (64, 0.0, 1.245), (128, 1.136, 1.245), (256, 1.150, 1.568), (512, 1.344, 1.838), (1024, 1.466, 1.973), (2048, 1.725, 2.148), (4096, 1.919, 2.216),
    (8192, 2.119, 2.341), (16384, 2.216, 2.407), (32768, 2.336, 2.480), (65536, 2.336, 2.611), (131072, 2.336, 2.798), (float("inf"), 2.336, 2.904),
)
GOOD_CHUNKS: Limits = tuple((8192, 2.074, 2.292) if band[0] == 8192 else band for band in GOOD)
BELOW, ABOVE = 0.10, 0.05  # margins under the least and over the largest


def around(good: Limits) -> Limits:
    return tuple((below, low * (1 - BELOW), high * (1 + ABOVE)) for below, low, high in good)


@dataclass(frozen=True)
class Bands:
    """Limits of whole texts and of chunks: (bytes below which it holds, least ratio, largest ratio), by rising length."""

    limits: Limits = around(GOOD)
    chunk_limits: Limits = around(GOOD_CHUNKS)
    chunk_bytes: int = 4096
    level: int = 3

    def inside(self, length: int, ratio: float, chunk: bool = False) -> bool:
        return next(low <= ratio <= high for below, low, high in (self.chunk_limits if chunk else self.limits) if length < below)


def repeat_words(words: list[str], run: int = RUN) -> int:
    """Words inside runs of ``run`` words that occur twice or more.

    Runs get exact numbers by doubling: a run of 2k words is the pair of the
    numbers of its halves.
    """
    n = len(words) - run + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    length, base = 1, len(words) + 1
    while length < run:
        pairs = ids[: len(ids) - length] * base + ids[length:]
        ids = np.unique(pairs, return_inverse=True)[1]
        length *= 2
    again = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + run, -1)
    return int((np.cumsum(cover) > 0).sum())


def counted(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words)


def ratios(raw: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, float, float, bool]:
    """Ratio of the whole, least and largest ratio of a chunk, and whether all are inside their bands."""
    if not raw:
        return 0.0, 0.0, 0.0, False
    whole = len(raw) / len(packer.compress(raw))
    good = bands.inside(len(raw), whole)
    view, parts = memoryview(raw), []
    # a rest of less than half a chunk, mostly frame overhead alone, belongs to the chunk before it
    starts = [0, *range(bands.chunk_bytes, len(raw) - bands.chunk_bytes // 2 + 1, bands.chunk_bytes)]
    for at, end in zip(starts, [*starts[1:], len(raw)]):
        chunk = view[at:end]
        parts.append(len(chunk) / len(packer.compress(chunk)))
        good = good and bands.inside(len(chunk), parts[-1], chunk=True)
    return whole, min(parts), max(parts), good


def compression_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document with the counts, the ratios and the verdict."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=bands.level)
        out = []
        for text in batch.column("text").to_pylist():
            n, chars, symbols, dup, repeated = counted(text)
            failed = n < 20 or 100 * repeated > 30 * n
            whole, low, high, good = ratios(text.encode(), packer, bands)
            out.append((n, chars, symbols, dup, repeated, failed, not failed and good, whole, low, high))
        columns = list(zip(*out))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "least_chunk_ratio", "most_chunk_ratio"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, ratio double, least_chunk_ratio double, most_chunk_ratio double"
    )
    return map_rows(rows, work, schema)
