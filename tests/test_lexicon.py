"""Classes spread over a word graph against a plain walk."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.operators import lexicon as L


def walk(texts, seeds, rounds):
    weights = defaultdict(Counter)
    for t in texts:
        words = [w for w in re.split(r"[^a-zà-ÿ]+", (t or "").lower()) if w]
        for a, b in zip(words, words[1:]):
            if a != b:
                weights[a][b] += 1
                weights[b][a] += 1
    labels = dict(seeds)
    for _ in range(rounds):
        new = {}
        for word, around in weights.items():
            votes = Counter()
            for other, n in around.items():
                if other in labels:
                    votes[labels[other]] += n
            if votes:
                new[word] = min(votes, key=lambda c: (-votes[c], c))
        new |= seeds
        if new == labels:
            break
        labels = new
    return labels


@pytest.mark.parametrize("rounds", [0, 1, 3, 50])
def test_classes_spread_as_in_a_walk(spark, rounds):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzé"]
    texts = [" ".join(words[(start + rng.choice([0, 1, 1, 2]) * k) % len(words)] for k in range(rng.randrange(0, 9))) + rng.choice(["!", ". New", ""]) for start in range(60)]
    texts += [None, "", "alone", "same same same", "island reef"]
    seeds = {"ax": 4, "bz": 0, "cé": 3}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    given = spark.createDataFrame([*seeds.items(), ("ax", 9)], "word string, class int")
    want = walk(texts, seeds, rounds)
    for parts in (1, 7):
        got = {r.word: r["class"] for r in L.induced_lexicon(df.repartition(parts), "text", given, rounds).collect()}
        assert got == want
    assert "island" not in want and ("alone" not in want)


def test_seeds_and_empty_corpus(spark):
    df = spark.createDataFrame([("b b b a a c",), (None,)], "text string")
    assert sorted(map(tuple, L.frequent_seeds(df, "text", 2).collect())) == [("a", 1), ("b", 0)]
    seeds = spark.createDataFrame([("x", 1)], "word string, class int")
    assert [tuple(r) for r in L.induced_lexicon(df.limit(0), "text", seeds).collect()] == [("x", 1)]
    assert L.frequent_seeds(df.where(F.lit(False)), "text").count() == 0
