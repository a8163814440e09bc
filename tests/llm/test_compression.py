import random
import re

import zstandard

from tributary.llm import compression as C
from tributary.llm.queries import QUERIES


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 8))
    dup, seen = 0, set()
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " ", "\n\n", "a\nb\na\n \n", "a b c d e f g h " * 3, "x\x85y z"]
    texts += [" ".join(rng.choice(["a", "b#", "c\n"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    for text in texts:
        assert C.counted(text) == slow_counts(text), text


def test_query_rows(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op6_compression"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    packer, bands = zstandard.ZstdCompressor(level=3), C.Bands()
    assert len(got) == len(docs)
    for d in docs:
        r, text = got[d.doc_id], d.text or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == slow_counts(text)[:4] if len(text) < 3000 else True
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and (not r.kept or not failed)
        if text:
            ratio = len(text.encode()) / len(packer.compress(text.encode()))
            assert r.ratio == ratio and (not r.kept or bands.inside(len(text.encode()), ratio))


def test_a_short_rest_is_no_chunk_of_its_own():
    rng, packer = random.Random(3), zstandard.ZstdCompressor(level=3)
    raw = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(4000)).encode()
    for length in (1, 4095, 4096, 4097, 4100, 6143, 6144, 8192, 8200, 12290):
        whole, low, high, good = C.ratios(raw[:length], packer, C.Bands())
        assert good and low > (0.05 if length < 64 else 1.5), length


def test_clean_stays_and_junk_goes(spark):
    rng = random.Random(2)
    clean = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(400))
    noise = "".join(chr(rng.randrange(0x4E00, 0x9000)) + " " * (rng.random() < 0.1) for _ in range(8000))
    mixed = clean + " " + "z" * 9000
    rows = [(1, clean), (2, "word " * 300), (3, noise), (4, mixed), (5, None), (None, clean), (1, clean), (6, clean * 1)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = [(r.doc_id, r.kept) for r in C.compression_rules(df).collect()]
    assert sorted(got, key=str) == sorted([(1, True), (2, False), (3, False), (4, False), (5, False), (None, True), (1, True), (6, True)], key=str)
    assert C.compression_rules(df.limit(0)).count() == 0


def test_bands_part_good_from_bad(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op6_compression"](spark, sf).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert len(good) > 300 and all(good)
    assert len(bad) > 20 and 3 * sum(bad) <= 2 * len(bad)
