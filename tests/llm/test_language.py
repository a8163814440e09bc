import zlib

import numpy as np

from tributary.llm import language as L
from tributary.llm.queries import QUERIES


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op3_language"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = []
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == d.lang)
    assert np.mean(right) > 0.97


def grams(text, bits, n):
    """The hashed n-grams of a text, by the recurrence of the module in plain Python."""
    out, mask = set(), (1 << 64) - 1
    codes = [ord(c) for c in text.lower()]
    for i in range(len(codes) - n + 1):
        h = 0
        for c in codes[i : i + n]:
            h = (h + c + 1) * 0x9E3779B97F4A7C15 & mask
            h ^= h >> 29
        out.add(h >> (64 - bits))
    return out


def brute_kernel(a, b, s):
    common = lambda x, y: sum(w * len(grams(x, bits, n) & grams(y, bits, n)) for n, (bits, w) in enumerate(zip(s.bits, s.weights), 1))
    return common(a, b) / np.sqrt(common(a, a) * common(b, b))


def test_kernel_counts_common_grams():
    s = L.Spectrum(bits=(16, 16), weights=(1.0, 2.0))
    product = lambda s, a, b: sum(x * y for p, x in zip(*s.columns(a)) for q, y in zip(*s.columns(b)) if p == q)
    # 1-grams abc / abd share a, b; 2-grams ab, bc, ca / ab, bd share ab
    assert abs(product(s, "abcab", "abd") - (2 + 2 * 1) / np.sqrt((3 + 2 * 3) * (3 + 2 * 2))) < 1e-5
    for a, b in (("the cat sat", "The hat"), ("é中文 x", "中文"), ("a", "b"), ("abcd" * 9, "dcba")):
        assert abs(product(L.Spectrum(), a, b) - brute_kernel(a, b, L.Spectrum())) < 1e-5


def texts_of(rng, words, n, length):
    return [" ".join(rng.choice(words, length)) for _ in range(n)]


def test_predictions_equal_a_plain_ridge(spark):
    """The query's scores against kernel ridge regression written out with the brute-force kernel."""
    rng = np.random.RandomState(0)
    en, de = "the cat and a dog sat on that mat with me".split(), "der hund und die katze sass auf dem weg mit mir".split()
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in texts_of(rng, en, 12, 5)] + [(t, "de") for t in texts_of(rng, de, 12, 5)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    learnt = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    # all learnt texts are landmarks, so features whitened by their kernel stand for the kernel itself
    k = np.array([[brute_kernel(a, b, L.Spectrum()) for b, _ in learnt] for a, _ in learnt])
    values, vectors = np.linalg.eigh(k)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    z, y = k @ whiten, np.array([[1.0 if lang == x else -1.0 for x in ("de", "en")] for _, lang in learnt])
    w = np.linalg.solve((z - z.mean(0)).T @ (z - z.mean(0)) + 1e-2 * np.eye(z.shape[1]), (z - z.mean(0)).T @ (y - y.mean(0)))
    for r in L.languages(docs).collect():
        text = rows[r.doc_id][1]
        m = np.array([brute_kernel(text, b, L.Spectrum()) for b, _ in learnt]) @ whiten @ w + y.mean(0) - z.mean(0) @ w
        assert r.lang_pred == ("de", "en")[int(m.argmax())] and abs(r.score - np.clip((1 + m.max()) / 2, 0, 1)) < 2e-3


def test_much_repeated_ids(spark):
    for repeated in (1, 8):
        rows = [(repeated, "the cat and dog", "en")] * 5000 + [(i, f"der hund und katze {i}", "de") for i in range(20, 40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        got = L.languages(docs, sample=30).groupBy("doc_id", "lang_pred").count().collect()
        assert len(got) == 21 and all(r.lang_pred == "de" for r in got if r.doc_id >= 20)
        remainder = zlib.crc32(str(repeated).encode()) % 3
        assert {r.lang_pred for r in got if r.doc_id == repeated} == {"de" if remainder == 1 else "en"}
        alone = L.languages(docs.where(f"doc_id = {repeated}"))
        assert {r.lang_pred for r in alone.select("lang_pred").distinct().collect()} == {"und" if remainder == 1 else "en"}


def test_texts_of_millions_of_characters(spark):
    rng = np.random.RandomState(1)
    make = lambda letters: ["".join(rng.choice(list(letters), rng.randint(2, 9))) for _ in range(4000)]
    words = {"xa": make("etaoinshrdlu" * 3 + "bcfgkmpvwy"), "xb": make("enisratdhulc" * 3 + "gmobwfkzvp")}
    rows = [(f"{lang}{i}", t, lang) for lang in words for i, t in enumerate(texts_of(rng, words[lang], 120, 80))]
    long = [(lang, " ".join(rng.choice(words[lang], 500_000))) for lang in words]
    docs = spark.createDataFrame([(i, t, lang) for i, (_, t, lang) in enumerate(rows)] + [(1000 + i, t, None) for i, (_, t) in enumerate(long)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.languages(docs).where("doc_id >= 1000").collect()}
    assert min(len(t) for _, t in long) > 2_500_000 and got == {1000 + i: lang for i, (lang, _) in enumerate(long)}


def test_defined_cases(spark):
    rows = [(k, f"the cat and dog {k}", "en", "x") for k in range(12)] + [(k, f"der hund und katze {k}", "de", "x") for k in range(12, 24)]
    rows += [(24, None, "en", "x"), (25, "", None, "x"), (26, "12 ²!", "de", "x"), (None, "the dog", "de", "x"), (27, "der hund " * 20000, None, "x"), (0, "the cat and dog 0", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = [(r.doc_id, r.lang_pred) for r in L.languages(docs).collect()]
    assert len(got) == len(rows) and got.count((0, "en")) == 2
    pred = dict(got)
    assert [pred[k] for k in (24, 25, 26, None, 27)] == ["und", "und", "und", "en", "de"]
    unknown = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in L.languages(unknown).collect()} == {"und"}
    assert L.languages(docs.limit(0)).count() == 0
