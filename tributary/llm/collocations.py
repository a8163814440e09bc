"""Phrase collocations, counted in quotient filters.

Words that occur often enough get dense ids.  An n-gram's ids are packed into
one integer, which a permutation with an inverse spreads evenly; its top bits
name the shard and, below them, the quotient, and all the bits left are the
remainder.  A filter stores run lengths per quotient, remainders and small
counters, so it is compact and nothing is lost: every entry can be turned back
into its words.  Tasks emit one sorted filter per shard, and shards merge them.

Ids are dense for at most ``most_words`` of the most frequent words of up to
``LONGEST_WORD`` bytes, the only table sent to all tasks.  N-grams with a
frequent word beyond it are counted by their text instead, so results do not
depend on that bound.  Words rarer than ``least`` are in no candidate and part
n-grams.

Defined cases: a null text is empty; a null language is ``und``; repeated rows
count once per row; texts of any length are whole; equal scores are ordered by
count and phrase; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import map_groups, slices
from tributary.session import settled, ship_package

LEAST = 10
TOP = 2000
MOST_WORDS = 1 << 19
LONGEST_WORD = 64
HELD_GRAMS = 1 << 21  # n-grams a task holds before it emits its filters
SHARD_GRAMS = 1 << 21  # n-grams of a shard, about
HELD_WORDS = 1 << 18
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

# one pass over the bytes: A-Z in lower case, tabs to blanks, the characters that part pieces to line ends
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def pieces_of(texts: list[str | None]) -> bytes:
    """The texts as blank-separated words, with a line end as a word of its own between pieces."""
    return "\n".join(t or "" for t in texts).encode().translate(PLAIN).replace(b"\n", b" \n ")


def permuted(keys: np.ndarray, bits: int) -> np.ndarray:
    """Integers of ``bits`` bits, spread evenly over all of them; ``restored`` is the inverse."""
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for odd in ODD:
        keys = (keys * np.uint64(odd)) & mask
        keys = keys ^ (keys >> half)
    return keys


def restored(keys: np.ndarray, bits: int) -> np.ndarray:
    mask, half = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
    for odd in reversed(ODD):
        keys = keys ^ (keys >> half)
        keys = (keys * np.uint64(pow(odd, -1, 1 << 64))) & mask
    return keys


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")  # sorted runs are merged, not sorted anew
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    sums = np.diff(np.append(starts, len(keys))) if counts is None else np.add.reduceat(counts, starts) if len(starts) else counts
    return keys[starts], sums.astype(np.int64)


def filter_of(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of sorted distinct keys of ``bits`` bits.

    Layout: entries, quotient bits and width of a run length; run lengths by
    quotient; remainders; counters of one byte, those of 255 and more apart.
    """
    n = len(keys)
    quotient_bits = min(bits, max(0, n.bit_length() - 1))
    rest = bits - quotient_bits
    runs = np.bincount((keys >> np.uint64(rest)).astype(np.int64), minlength=1 << quotient_bits)
    width = 1 if runs.max(initial=0) < 256 else 4
    remainder = (keys & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-rest // 8)]
    large = counts >= 255
    head = np.array([n, quotient_bits, width], dtype="<u8").tobytes()
    return b"".join([head, runs.astype(f"<u{width}").tobytes(), remainder.tobytes(), np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def entries_of(block: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of a filter: ``filter_of`` turned back."""
    n, quotient_bits, width = (int(x) for x in np.frombuffer(block, "<u8", 3))
    rest, at = bits - quotient_bits, 24
    runs = np.frombuffer(block, f"<u{width}", 1 << quotient_bits, at).astype(np.int64)
    at += width << quotient_bits
    size = -(-rest // 8)
    bytes_ = np.zeros((n, 8), dtype=np.uint8)
    bytes_[:, :size] = np.frombuffer(block, np.uint8, n * size, at).reshape(n, size)
    at += n * size
    counts = np.frombuffer(block, np.uint8, n, at).astype(np.int64)
    large = np.frombuffer(block, "<i8", -1, at + n)
    counts[counts == 255] = large
    quotient = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), runs)
    return (quotient << np.uint64(rest)) | bytes_.view("<u8").ravel(), counts


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list]]:
    groups: dict[str, list] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        groups.setdefault("und" if lang is None else lang, []).append(text)
    yield from groups.items()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n); a null word has the count of all words of the language."""
    schema = "lang string, word string, n long"

    def run(batches):
        held: dict[str, Counter] = {}

        def flush():
            for lang, counts in held.items():
                words = [w.decode() for w in counts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(words) + 1), pa.string()), pa.array([*words, None], pa.string()), pa.array([*counts.values(), counts.total()], pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, 1 << 20) if batch.num_rows else ():
                for lang, texts in by_language(part):
                    # split() parts at blanks and line ends alike: both are no words here
                    held.setdefault(lang, Counter()).update(pieces_of(texts).split())
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    partial = docs.select("lang", "text").mapInArrow(run, schema)
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Ids:
    """Dense ids, from 1, of the words of a bounded table."""

    def __init__(self, langs: list[str], words: list[str]):
        self.langs, self.words = langs, words
        self.bits = max(4, len(words).bit_length())
        self.table: dict[str, dict[bytes, int]] = {}
        for i, (lang, word) in enumerate(zip(langs, words), 1):
            self.table.setdefault(lang, {})[word.encode()] = i

    def __reduce__(self):
        return Ids, (self.langs, self.words)

    def of(self, lang: str) -> dict[bytes, int]:
        """Ids of a language's words; -1 for the empty word, which is none, and 0 for the line end, which parts n-grams."""
        return self.table.get(lang, {}) | MARKS


MARKS = {b"": -1, b"\n": 0}


def gram_filters(docs: DataFrame, ids: Ids, shard_bits: int) -> DataFrame:
    """(shard, filter): what each task counted, in sorted quotient filters."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)
    b = ids.bits

    def run(batches):
        known = shared.value
        tables = {lang: known.of(lang) for lang in known.table}
        waiting: list[np.ndarray] = []
        held = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))

        def merged(held):
            new = counted(permuted(np.concatenate(waiting), 3 * b)) if waiting else held
            waiting.clear()
            if new is held or not len(held[0]):
                return new
            return counted(np.concatenate([held[0], new[0]]), np.concatenate([held[1], new[1]]))

        def flush(held):
            keys, counts = held
            local = 3 * b - shard_bits
            shard = (keys >> np.uint64(local)).astype(np.int64)
            cuts = np.searchsorted(shard, np.arange((1 << shard_bits) + 1))
            for start in range(0, 1 << shard_bits, 64):
                some = [s for s in range(start, min(start + 64, 1 << shard_bits)) if cuts[s + 1] > cuts[s]]
                blocks = [filter_of(keys[cuts[s] : cuts[s + 1]] & np.uint64((1 << local) - 1), counts[cuts[s] : cuts[s + 1]], local) for s in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blocks, pa.binary())], names=["shard", "filter"])

        waits = 0
        for batch in batches:
            for part in slices(batch, 1 << 20) if batch.num_rows else ():
                for lang, texts in by_language(part):
                    words = pieces_of(texts).split(b" ")
                    row = np.fromiter(map(tables.get(lang, MARKS).get, words, repeat(0)), dtype=np.int64, count=len(words))
                    row = row[row != -1].astype(np.uint64)
                    two = (row[:-1] << np.uint64(2 * b)) | (row[1:] << np.uint64(b))
                    whole = (row[:-1] > 0) & (row[1:] > 0)
                    three = (two[:-1] | row[2:])[whole[:-1] & (row[2:] > 0)] if len(row) > 2 else two[:0]
                    waiting += [two[whole], three]
                    waits += len(waiting[-1]) + len(waiting[-2])
                if waits > HELD_GRAMS:
                    held, waits = merged(held), 0
                    if len(held[0]) > HELD_GRAMS:
                        yield from flush(held)
                        held = (held[0][:0], held[1][:0])
        held = merged(held)
        if len(held[0]):
            yield from flush(held)

    return docs.select("lang", "text").mapInArrow(run, "shard int, filter binary")


def merged_filters(filters: DataFrame, ids: Ids, shard_bits: int, least: int) -> DataFrame:
    """(lang, phrase, n) of the n-grams found ``least`` times or more, each shard's filters merged."""
    shared = filters.sparkSession.sparkContext.broadcast(ids)
    b = ids.bits

    def work(key, table):
        known, local = shared.value, 3 * b - shard_bits
        parts = [entries_of(block, local) for block in table.column("filter").to_pylist()]
        keys, counts = counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        often = counts >= least
        keys = restored(keys[often] | np.uint64(int(key[0]) << local), 3 * b).astype(np.int64)
        mask, words = (1 << b) - 1, known.words
        one, two, three = (keys >> 2 * b).tolist(), ((keys >> b) & mask).tolist(), (keys & mask).tolist()
        phrases = [f"{words[x - 1]} {words[y - 1]} {words[z - 1]}" if z else f"{words[x - 1]} {words[y - 1]}" for x, y, z in zip(one, two, three)]
        yield pa.RecordBatch.from_arrays([pa.array([known.langs[x - 1] for x in one], pa.string()), pa.array(phrases, pa.string()), pa.array(counts[often], pa.int64())], names=["lang", "phrase", "n"])

    return map_groups(filters, ["shard"], work, "lang string, phrase string, n long")


def other_grams(docs: DataFrame, ids: Ids, least: int) -> DataFrame:
    """(lang, phrase, n) of the n-grams with a word beyond the table, counted by their text."""
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in slices(batch, 1 << 20) if batch.num_rows else ():
                for lang, texts in by_language(part):
                    words = [w for w in pieces_of(texts).split(b" ") if w]
                    row = np.fromiter(map(known.of(lang).get, words, repeat(-2)), dtype=np.int64, count=len(words))
                    apart, beyond = row == 0, row == -2
                    counts: Counter = Counter()
                    for k in (2, 3):
                        n = len(words) - k + 1
                        if n <= 0:
                            continue
                        cut = np.any([apart[i : i + n] for i in range(k)], axis=0)
                        new = np.any([beyond[i : i + n] for i in range(k)], axis=0)
                        counts.update(b" ".join(words[i : i + k]).decode() for i in np.flatnonzero(new & ~cut).tolist())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "phrase", "n"])

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, n long")
    return partial.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def score_of(a: Column, first: Column, rest: Column) -> Column:
    """floor(1000000 a a / (first rest)) in whole numbers; at most 1000000, since a is in both."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    return F.call_function("div", wide(a, 15) * wide(a, 15) * F.lit(1000000).cast("decimal(7,0)"), wide(first, 19) * wide(rest, 19)).cast("long")


def phrase_counts(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: words (lang, phrase, n) and phrases (lang, phrase, n), ``least`` times or more, and totals (lang, n)."""
    spark = docs.sparkSession
    ship_package(spark)
    stored = settled(word_counts(docs).where((F.col("n") >= least) | F.col("word").isNull()))
    totals = stored.where("word is null").select("lang", "n")
    words = stored.where("word is not null").select("lang", F.col("word").alias("phrase"), "n")
    short = words.where(F.octet_length("phrase") <= LONGEST_WORD)
    table = short.orderBy(F.desc("n"), "lang", "phrase").limit(most_words).toArrow()
    ids = Ids(table.column("lang").to_pylist(), table.column("phrase").to_pylist())
    grams = 2 * (totals.agg(F.sum("n")).first()[0] or 0)
    shard_bits = max(4, (-(-grams // SHARD_GRAMS)).bit_length())
    if 3 * ids.bits < shard_bits + 4:
        shard_bits = 4
    counts = merged_filters(gram_filters(docs, ids, shard_bits), ids, shard_bits, least)
    if words.count() > len(ids.words):
        counts = counts.unionByName(other_grams(docs, ids, least))
    return words, settled(counts), totals


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, covered: int = 50, most_words: int = MOST_WORDS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a phrase around it has ``covered`` percent of its count or more.
    """
    words, phrases, totals = phrase_counts(docs, least, most_words)
    parts = F.split("phrase", " ")
    seen = phrases.select("lang", "phrase", F.col("n").alias("a"), parts.alias("w"), F.size(parts).alias("k"))
    join = lambda *c: F.array_join(F.array(*[F.col("w")[i] for i in c]), " ")
    around = seen.where("k = 3").select("lang", F.explode(F.array(join(0, 1), join(1, 2))).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = seen.join(around, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * covered)).drop("longest")
    cut = lambda k, first, rest: F.struct(F.lit(k).alias("k"), first.alias("first"), rest.alias("rest"))
    cuts = F.when(F.col("k") == 2, F.array(cut(1, join(0), join(1)))).otherwise(F.array(cut(1, join(0), join(1, 2)), cut(2, join(0, 1), join(2))))
    rows = kept.select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    known = words.unionByName(phrases.where(F.size(parts) == 2))
    rows = rows.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    rows = rows.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    scored = rows.select("lang", "phrase", "a", F.struct(score_of(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("s"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min("s").alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
