import zlib

import numpy as np

from tributary.llm import quality as Q
from tributary.llm.queries import QUERIES


def auc(score, y):
    pairs = score[y == 1][:, None] - score[y == 0][None, :]
    return ((pairs > 0) + 0.5 * (pairs == 0)).mean()


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op4_quality"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in got]
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in labels if got[r.doc_id].held_out]
    score, y = np.array([got[r.doc_id].score for r in held]), np.array([r.quality for r in held])
    assert auc(score, y) > 0.95 and (score[y == 1] >= 0.3).mean() > 0.98


def test_prior_and_risk_on_known_mixture():
    rng = np.random.RandomState(0)
    draw = lambda n, share: np.where(rng.rand(n, 1) < share, rng.normal(1.5, 1, (n, 6)), rng.normal(-1.5, 1, (n, 6)))
    model, prior = Q.learn(draw(3000, 1.0), draw(3000, 0.6))
    assert abs(prior - 0.6) < 0.08
    assert (model.scores(draw(1000, 1.0)) >= 0.3).mean() > 0.95 and (model.scores(draw(1000, 0.0)) >= 0.3).mean() < 0.1


def test_defined_cases(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", "x"), (None, "text", "x"), (4, "word " * 20000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shape string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = Q.quality_scores(docs, labels).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, 1, 1, 2, 3, 4]
    assert all(r.held_out is not None and 0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id in (2, 3)]
    assert same[0] == same[1]
    nothing = Q.quality_scores(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert Q.quality_scores(docs.limit(0), labels).count() == 0


def test_the_sample_is_bounded_by_rows(spark, monkeypatch):
    seen = []
    real = Q.learn
    monkeypatch.setattr(Q, "learn", lambda p, u, **k: seen.append((len(p), len(u))) or real(p, u, **k))
    rows = [(2, f"hot id text {i % 3000}") for i in range(20_000)] + [(i, f"some words here {i}") for i in range(10, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1)] * 50 + [(i, i % 2) for i in range(10, 300)], "doc_id long, quality int")
    assert Q.quality_scores(docs, labels, sample=50).count() == len(rows)
    assert seen == [(50, 50)]


def test_scores_equal_a_plain_walk_over_the_same_sample(spark):
    """The registered form on Spark against the model learnt and applied row by row in this process."""
    rng = np.random.RandomState(5)
    good = [" ".join(rng.choice("a lovely small house stands near the old river bank".split(), 30)) + "." for _ in range(40)]
    bad = ["".join(rng.choice(list("#$%&|<>!1234 "), 200)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    teaches = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    places = {r[0]: r[1] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text, 4)").collect()}
    order = sorted((places[i], i, trusted) for i in range(80) if teaches(i) for trusted in ([False, True] if i < 40 else [False]))
    x, mark = np.array([Q.shape(rows[i][1]) for _, i, _ in order], dtype=np.float64), np.array([t for *_, t in order])
    shuffled = np.random.RandomState(4).permutation(len(order))
    x, mark = x[shuffled], mark[shuffled]
    model, _ = Q.learn(x[mark], x[~mark])
    got = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    for i, t in rows:
        assert abs(got[i] - model.scores(Q.shape(t)[None, :])[0]) < 1e-9
    assert min(got[i] for i in range(40)) > max(got[i] for i in range(40, 80))


def test_every_row_teaches(spark, monkeypatch):
    """More rows than are learnt from in the driver: all are counted once, and the scores are those of the plain walk."""
    rng = np.random.RandomState(8)
    good = [" ".join(rng.choice("a lovely small house stands near the old river bank".split(), 20 + k % 30)) + "." for k in range(900)]
    bad = [" ".join("".join(rng.choice(list("#$%&|<>!1234ab"), 6)) for _ in range(10 + k % 30)) for k in range(600)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows + rows[:200] + [(None, "text")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i < 900)) for i in range(0, 1500, 2)] * 2, "doc_id long, quality int")
    few = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}

    seen, real = [], Q.counted_meetings
    monkeypatch.setattr(Q, "MOST_HERE", 100)
    monkeypatch.setattr(Q, "counted_meetings", lambda once, edges: seen.append(real(once, edges)) or seen[0])
    many = {r.doc_id: r.score for r in Q.quality_scores(docs, labels).collect()}
    teaches = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    trusted = [i for i in teaches if i < 900 and i % 2 == 0]
    assert tuple(seen[0].sum(axis=0)[:, -1, -1]) == (len(teaches), len(trusted))
    edges = Q.counted_edges(spark.createDataFrame([(i in trusted, [float(v) for v in Q.shape(rows[i][1])]) for i in teaches], "trusted boolean, shape array<float>"), 8)
    x = np.stack([Q.shape(rows[i][1]) for i in teaches for _ in range(1 + (i in trusted))])
    want = np.quantile(x, np.linspace(0, 1, 9)[1:-1], axis=0, method="inverted_cdf").T
    assert (edges >= want).all() and (edges <= want * (1 + 2**-12) + 1e-30).all()
    hot = Q.one_hot(np.stack([Q.shape(rows[i][1]) for i in teaches]), edges)
    assert np.array_equal(seen[0].sum(axis=0)[0, :-1, :-1], hot.T @ hot)
    assert max(abs(few[i] - many[i]) for i in few) < 0.1 and all((few[i] >= 0.3) == (many[i] >= 0.3) for i in few)
