import re
from collections import Counter

import numpy as np
import pytest

from tests.oracle import compare, connect
from tributary.llm import collocations as C
from tributary.llm.queries import QUERIES, SQL


def brute(rows, top, least, covered=50):
    """The contract in plain Python."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {}
    for key, a in counts.items():
        if len(key) < 3 or a < least:
            continue
        lang, *w = key
        if len(w) == 2 and any(n >= least and len(t) == 4 and t[0] == lang and (list(t[1:3]) == w or list(t[2:4]) == w) and 100 * n >= covered * a for t, n in counts.items()):
            continue
        cuts = [(1000000 * a * a // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k, counts[(lang, *w[:k])], counts[(lang, *w[k:])]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, left, right, totals[lang], -s) for lang, rows in found.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def texts():
    rng = np.random.RandomState(3)
    common = ["The", "of", "New", "York", "aé", "中文", "x" * 80, "it's"]
    rare = [f"r{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice(["New York City", "the end of", rng.choice(common), rng.choice(rare), "x" * 80 + " of"], 1).tolist()
            words.append(str(rng.choice([" ", "  ", "\t", ". ", ",", "\r\n", "\x0b", "\x0c", ";", " !? "])))
        rows.append((["en", "de", None, "und"][i % 4], "".join(w + (" " if rng.rand() < 0.7 else "") for w in words)))
    return rows + [("en", None), ("en", ""), (None, " . "), ("fr", "one two"), ("en", rows[0][1])] * 2 + [("en", "hot pair " * 3000)]


@pytest.mark.parametrize("most_words", [1 << 19, 3, 1])
def test_equals_brute_force(spark, most_words):
    rows = texts()
    df = spark.createDataFrame([(lang, text, 1, "k") for lang, text in rows], "lang string, text string, n int, phrase string").repartition(5)
    got = sorted(map(tuple, C.collocations(df, top=25, least=4, most_words=most_words).collect()))
    assert got == brute(rows, 25, 4) and got


def test_small_buffers_give_the_same(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name in ("HELD_GRAMS", "SHARD_GRAMS", "HELD_WORDS"):
        monkeypatch.setattr(C, name, 50)
    assert sorted(map(tuple, C.collocations(df, top=2000, least=4).collect())) == brute(rows, 2000, 4)


def test_empty_table(spark):
    for rows in ([], [(None, None)], [("en", "one two three")]):
        assert C.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


@pytest.mark.parametrize("bits", [12, 13, 51, 60])
def test_filters_lose_nothing(bits):
    rng = np.random.RandomState(bits)
    keys = rng.randint(0, 1 << bits, 3000).astype(np.uint64)
    assert (C.restored(C.permuted(keys, bits), bits) == keys).all() and C.permuted(keys, bits).max() < 1 << bits
    for some in (keys, keys[:1], keys[:0], np.repeat(keys[:3], 400)):
        sorted_keys, counts = C.counted(some)
        back = C.entries_of(C.filter_of(sorted_keys, counts, bits), bits)
        assert (back[0] == sorted_keys).all() and (back[1] == counts).all() and counts.sum() == len(some)
        twice = C.counted(np.concatenate([sorted_keys, sorted_keys]), np.concatenate([counts, counts]))
        assert (twice[0] == sorted_keys).all() and (twice[1] == 2 * counts).all()
    sparse = C.filter_of(np.arange(300, dtype=np.uint64), np.full(300, 1 << 40), bits)  # one quotient, large counters
    assert (C.entries_of(sparse, bits)[1] == 1 << 40).all()


def test_scores_beyond_64_bits(spark):
    big = 10**14 + 7
    df = spark.createDataFrame([(big, big + 3, 10**15 + 1), (1, 3, 3), (10, 10, 10)], "a long, l long, r long")
    from pyspark.sql import functions as F

    got = [r[0] for r in df.select(C.score_of(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000000 * big * big // ((big + 3) * (10**15 + 1)), 111111, 1000000]


def test_query_equals_its_twin(spark, sf_dir):
    assert not compare(QUERIES["op13_collocations"](spark, sf_dir), connect(sf_dir), SQL["op13_collocations"])


def test_a_task_holds_a_bounded_number_of_grams():
    """Waiting n-grams, their sorted copy and the merged ones with counts, in bytes; six tasks share an executor of 3000 MB."""
    assert 6 * C.HELD_GRAMS * (8 + 8 + 16 + 16) <= 640 << 20
