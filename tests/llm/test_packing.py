import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import packing as P
from tributary.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return lambda texts: [[*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(pieces, ids, window=2048):
    """Every id of every document (by place) in exactly one piece; sequences gapless and without padding."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(ids)
    for doc, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids[doc])
            assert p.ids_crc32 == zlib.crc32(np.array(ids[doc][at : at + p.length], dtype="<u4").tobytes())
            at += p.length
        assert at == len(ids[doc])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)
    total = sum(map(len, ids.values()))
    # only the last window's worth of tokens is in shorter sequences
    assert len(by_sequence) <= total // window + window.bit_length()
    return by_doc, by_sequence


def test_odd_rows(spark, library):
    rng = np.random.RandomState(0)
    words = ["one", "Two", "中文字", "é", "  ", "\n", "123", "<|endoftext|>", "_", " ", "😀", "don't", "don’t"]
    texts = [None, "", "x", " " * 50, "word " * 70_000, "a" * 3000] + [" ".join(rng.choice(words, rng.randint(1, 900))) for _ in range(150)] + ["same text"] * 700
    rows = [(i, t, 7, "s") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rest int, part string").repartition(4)
    got = P.packed(df, RANKS, PATTERN).collect()
    by_doc, _ = check(got, dict(enumerate(library(texts))))
    assert sum(len(v) > 1 + sum(p.length == 2048 for p in v) for v in by_doc.values()) < 150  # most rests are whole
    assert sorted(got) == sorted(P.packed(df, RANKS, PATTERN).collect())


@pytest.mark.parametrize("window", [16, 64])
def test_small_windows(spark, library, window):
    texts = ["a b c " * (i % 23) for i in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check(P.packed(df, RANKS, PATTERN, window=window).collect(), dict(enumerate(library(texts))), window)


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "one two"), (1, "three"), (1, "three"), (None, None)], "doc_id long, text string")
    got = P.packed(df, RANKS, PATTERN).collect()
    assert Counter(p.doc_id for p in got if p.start == 0) == {None: 2, 1: 2} and sum(p.length for p in got) == sum(p.doc_tokens for p in got if p.start == 0)
    assert P.packed(df.limit(0), RANKS, PATTERN).collect() == []


def test_combinations_and_repeats():
    window, depth = 24, 4
    lengths = list(range(1, window))
    found = P.combinations(lengths, window, depth)
    brute = set()
    for a in lengths:
        for b in [0, *range(1, a)]:
            for i in range(1, depth + 1):
                for j in range(1, depth + 1) if b else [0]:
                    if i + j <= depth and i * a + j * b == window:
                        brute.add(((a, i), (b, j)) if b else ((a, i),))
    assert set(found) == brute and len(found) == len(brute)
    rng = np.random.RandomState(1)
    histogram = {int(k): int(v) for k, v in enumerate(rng.randint(0, 500, window)) if k and v}
    used = Counter()
    for c, n in P.repeats(histogram, window, depth):
        used.update({k: m * n for k, m in c})
    assert all(used[k] <= v for k, v in histogram.items())
    left = {k: v - used[k] for k, v in histogram.items()}
    assert not any(all(left.get(k, 0) >= m for k, m in c) for c in found)  # greedy left no combination over


def test_least_squares_meets_its_conditions():
    rng = np.random.RandomState(2)
    target = {k: int(rng.randint(1, 1000)) for k in range(1, 16)}
    columns = P.combinations(sorted(target), 16, 4)
    x = np.array(P.least_squares(columns, target, 20_000))
    a = np.zeros((16, len(columns)))
    for p, c in enumerate(columns):
        for k, m in c:
            a[k, p] = m
    slope = a.T @ (a @ x - np.array([0, *target.values()]))
    assert (x >= 0).all() and slope.min() > -0.1 and np.abs(slope[x > 1e-3]).max() < 0.1  # Karush, Kuhn, Tucker


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_the_librarys(library, text):
    assert [[*P.encoding(RANKS, PATTERN).encode_ordinary(text), 1]] == library([text])


def test_query_over_its_table(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op11_packing"](spark, sf_dir).collect(), dict(zip([r.doc_id for r in rows], library([r.text for r in rows]))))
