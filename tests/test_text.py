import random

from pyspark.sql import functions as F

from tributary.operators import text as X
from tributary.operators.filters import keyword_filter


def test_similar_texts_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = rng.sample(vocabulary, rng.randint(1, 15))
        rows.append((i, " ".join(words), i % 2))
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]  # a crowd of copies
    df = X.word_sets(spark.createDataFrame(rows, "id long, text string, g long"), "text")
    copies, pairs = X.similar_texts(df.select("id", "g", "words"), "id", "words", ["g"])
    first = {r["id"]: r["first"] for r in copies.collect()}
    assert len(first) == len(rows) and all(first[1000 + i] == 0 for i in range(40))
    sets = {(g, frozenset(t.split())): i for i, t, g in reversed(rows)}
    firsts = {i: (g, s) for (g, s), i in sets.items()}
    expected = {
        (a, b) for a in firsts for b in firsts
        if a < b and firsts[a][0] == firsts[b][0] and len(firsts[a][1] & firsts[b][1]) / len(firsts[a][1] | firsts[b][1]) > 0.3
    }
    assert {(r["a"], r["b"]) for r in pairs.collect()} == expected and expected


def test_similar_texts_meet_in_blocks_and_not_by_word(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 7, raising=False)
    monkeypatch.setattr(X, "WORDS_AT_ONCE", 5, raising=False)
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{k}" for k in rng.sample(range(30), rng.randint(0, 12)))) for i in range(90)]
    df = X.word_sets(spark.createDataFrame([*rows, (None, "w1 w2"), (500, "")], "id long, text string"), "text")
    copies, pairs = X.similar_texts(df.select("id", "words"), "id", "words")
    firsts = {}
    for i, t in rows:
        firsts.setdefault(frozenset(t.split()), i)
    expected = {(a, b): len(s & t) / len(s | t) for s, a in firsts.items() for t, b in firsts.items() if a < b and s and t}
    expected = {k: v for k, v in expected.items() if v > 0.3}
    assert {(r.a, r.b): r.similarity for r in pairs.collect()} == expected and expected
    assert pairs.count() == len(expected)
    assert "explode(__words" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_connected_groups(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (205, 200), (203, 205)]
    got = {r["node"]: r["cluster"] for r in X.connected_groups(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0}
    assert got[101] == 100 and {got[n] for n in (200, 203, 205)} == {200}
    assert len(got) == 46


def test_sentences_and_labels(spark):
    lexicon = spark.createDataFrame([("good", 4), ("bad", 0), ("fine", 3)], "word string, class int")
    rows = [(1, "Good good bad. Fine!"), (2, ""), (3, "unknown words"), (4, "bad")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r["id"]: (r["score"], r["sentiment"]) for r in X.text_sentiment(df, "id", "text", lexicon).collect()}
    assert got == {1: (3.5, "POSITIVE"), 2: (-1.0, "NOT_UNDERSTOOD"), 3: (2.0, "NEUTRAL"), 4: (0.0, "VERY_NEGATIVE")}
    conf = {r["id"]: round(r["confidence"], 4) for r in X.sentiment_confidence(df, "id", "text", lexicon).collect()}
    assert conf == {1: round((2 / 3 + 1) / 2, 4), 2: 0.0, 3: 0.0, 4: 1.0}
    asp = {(r["id"], r["aspect"]): r["score"] for r in X.aspect_sentiment(df, "id", "text", lexicon, ["GOOD", "fine"]).collect()}
    assert asp[(1, "GOOD")] == 4.0 and asp[(1, "fine")] == 3.0 and asp[(4, "fine")] == -1.0 and len(asp) == 8


def test_many_keywords(spark):
    df = spark.createDataFrame([(1, "The Quick fox"), (2, "lazy dog"), (3, None), (4, "a.b")], "id long, text string")
    few = keyword_filter(df, "text", ["quick", "A.B"])
    many = keyword_filter(df, "text", ["quick", "A.B", *[f"zz{i}" for i in range(100)]])
    assert {r["id"] for r in few.collect()} == {r["id"] for r in many.collect()} == {1, 4}
    assert keyword_filter(df, "text", []).count() == 0
    assert keyword_filter(df, "text", ["axb"]).count() == 0
    for more in ([], [f"zz{i}" for i in range(100)]):  # an empty keyword is in every text, however long the list
        assert {r["id"] for r in keyword_filter(df, "text", ["", *more]).collect()} == {1, 2, 4}


def test_expensive_words_boundary(spark):
    df = spark.createDataFrame([(0, "abcdefghi"), (1, "abcdefghij")], "sec int, word string").withColumn("ts", F.timestamp_seconds("sec"))
    out = X.expensive_words(df, "ts", "word").collect()
    assert len(out) == 3 and {r["dollars"] for r in out} == {2}


def test_pause_gate(spark):
    from tributary.operators.filters import pause_gate

    rng = random.Random(4)
    rows = spark.createDataFrame([(i, rng.randint(0, 1000)) for i in range(300)], "id long, sec int").select("id", F.timestamp_seconds("sec").alias("ts"))
    said = [(rng.randint(0, 1000), rng.choice(["pause", "RESUME", "Pause", "noise"])) for _ in range(30)]
    said = list({s: (s, c) for s, c in said}.values())
    commands = spark.createDataFrame(said, "sec int, c string").select(F.timestamp_seconds("sec").alias("at"), "c")
    expected = set()
    for r in rows.collect():
        before = [c.lower() for s, c in sorted(said) if s <= r["ts"].timestamp() and c != "noise"]
        if not before or before[-1] == "resume":
            expected.add(r["id"])
    for slot in ("7 seconds", "5 minutes", "1 day"):
        assert {r["id"] for r in pause_gate(rows, commands, "ts", "at", "c", slot).collect()} == expected
    # rows without a time stay; at equal times resume wins; a command without a time says nothing
    odd = spark.createDataFrame([(1, None), (2, 10), (3, 20), (4, 30)], "id long, sec int").select("id", F.timestamp_seconds("sec").alias("ts"))
    said = [(10, "pause"), (10, "resume"), (20, "resume"), (20, "pause"), (30, "pause"), (None, "pause")]
    told = spark.createDataFrame(said, "sec int, c string").select(F.timestamp_seconds("sec").alias("at"), "c")
    assert {r["id"] for r in pause_gate(odd, told, "ts", "at", "c").collect()} == {1, 2, 3}


def test_distinct_texts_are_scored_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, f"good day {i % 150}. bad night. so so {'x' * (i % 150)}") for i in range(300)], "id long, text string").coalesce(1).write.parquet(path)
    df, lexicon = spark.read.parquet(path), spark.createDataFrame([("good", 4), ("bad", 0)], "word string, class int")
    monkeypatch.setattr(X, "SCORED_BYTES", 100)
    scored, score = [], X.text_sentiment
    monkeypatch.setattr(X, "text_sentiment", lambda once, *rest: scored.append(once.rdd.getNumPartitions()) or score(once, *rest))
    got = X.text_sentiment_distinct(df, "id", "text", lexicon).select("id", "score", "sentiment").collect()
    assert scored[0] >= 20
    assert sorted(got) == sorted(score(df, "id", "text", lexicon).select("id", "score", "sentiment").collect())
