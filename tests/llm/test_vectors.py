import numpy as np
import pytest

from tests.oracle import compare, connect
from tributary.llm import vectors as V
from tributary.llm.queries import QUERIES, SQL


def brute(rows):
    """n_links and component of every row, by its place."""
    good = []
    for i, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.append(i)
    link = np.zeros((len(rows), len(rows)), dtype=bool)
    for i in good:
        for j in good:
            a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
            if i != j and len(a) == len(b):
                link[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in zip(*np.nonzero(link)):
            label[i] = label[j] = min(label[i], label[j])
    named = {}
    for i, k in enumerate(label):
        if rows[i][0] is not None:
            named[k] = min(named.get(k, rows[i][0]), rows[i][0])
    return sorted([(r[0], int(link[i].sum()), named.get(label[i])) for i, r in enumerate(rows)], key=str)


def found(df):
    rows = V.near_duplicates(df, recall=1 - 1e-9).collect()  # so that no pair is missed here
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in rows], key=str)


@pytest.mark.parametrize("chunk", [512, 7])
def test_groups_chains_and_odd_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(V, "SKETCH_CHUNK", chunk)
    monkeypatch.setattr(V, "STRIP", chunk)
    rng = np.random.RandomState(0)
    unit = lambda v: v / np.linalg.norm(v)
    rows, centre = [], unit(rng.standard_normal(16))
    for _ in range(60):  # a group that is all near
        rows.append(unit(centre + 0.02 * rng.standard_normal(16)))
    for angle in np.arange(0, 3.0, 0.1):  # a chain
        rows.append(np.concatenate([[np.cos(angle), np.sin(angle)], np.zeros(14)]))
    rows += [rng.standard_normal(16) for _ in range(80)]
    data = [(int(i) + 10, [float(x) for x in v]) for i, v in zip(rng.permutation(len(rows)), rows)]
    data += [(3, None), (4, [0.0] * 16), (5, [float("nan")] * 16), (6, [1.0, None]), (7, []), (8, [2.0, 0.0]), (None, [4.0, 0.0]), (data[0][0], data[0][1]), (9, data[70][1]), (2, [float("inf")] * 16)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], "vec_id long, embedding array<float>, n_links int")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(df) == brute(data)
    assert V.near_duplicates(df.limit(0)).count() == 0


def test_plan_reaches_the_recall():
    for n in (100, 10_000, 10**9):
        k, tables = V.plan(n, 0.9, 0.97)
        assert 1 - (1 - V.collision(np.sqrt(0.2)) ** k) ** tables >= 0.97
    rng = np.random.RandomState(1)
    u = rng.standard_normal((2000, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    side = rng.standard_normal(u.shape)
    side -= (side * u).sum(axis=1, keepdims=True) * u
    w = 0.9 * u + np.sqrt(1 - 0.81) * side / np.linalg.norm(side, axis=1, keepdims=True)
    k, tables = V.plan(10_000, 0.9, 0.97)
    assert (V.bucket_keys(u, k, tables) == V.bucket_keys(w, k, tables)).any(axis=1).mean() > 0.95


def test_query_equals_its_twin(spark, sf_dir):
    assert not compare(QUERIES["op5_vectors"](spark, sf_dir), connect(sf_dir), SQL["op5_vectors"])


def test_production_recall_misses_no_pair_near_the_threshold(spark):
    rng = np.random.RandomState(7)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    u = unit(rng.standard_normal((2000, 64)))
    side = rng.standard_normal(u.shape)
    side = unit(side - (side * u).sum(axis=1, keepdims=True) * u)
    cosine = rng.uniform(0.9001, 0.95, (len(u), 1))
    w = cosine * u + np.sqrt(1 - cosine**2) * side
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.stack([u, w], axis=1).reshape(-1, 64))]
    v = np.array([x for _, x in rows])
    close = v @ v.T >= 0.9
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert (close.sum(axis=1) == 2).all() and got == {i: (1, i - i % 2) for i, _ in rows}
    for n in (100, 10_000, 10**9):
        k, tables = V.plan(n, 0.9, V.RECALL)
        assert (1 - V.collision(np.sqrt(0.2)) ** k) ** tables <= 1e-5


def test_signs_allow_what_is_near():
    assert V.sign_limit(1.0) == 0 and V.sign_limit(0.0) > 128
    rng = np.random.RandomState(3)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    u = unit(rng.standard_normal((4000, 48)))
    side = rng.standard_normal(u.shape)
    side = unit(side - (side * u).sum(axis=1, keepdims=True) * u)
    w = 0.9 * u + np.sqrt(1 - 0.81) * side
    differ = np.bitwise_count(V.sketch(u) ^ V.sketch(w)).sum(axis=1)
    limit = V.sign_limit(0.9)
    assert differ.max() <= limit and limit < 80
    far = np.bitwise_count(V.sketch(u[:500])[:, None] ^ V.sketch(u[500:1000])[None]).sum(axis=2)
    assert (far <= limit).mean() < 1e-4


def test_partners_equal_a_double_loop():
    rng = np.random.RandomState(4)
    s = rng.randint(0, 1 << 62, (30, 4)).astype(np.uint64)
    s[10:20] = s[:10] ^ np.uint64(5)
    part, keys = np.arange(30) % 2, rng.randint(0, 2, (30, 3)).astype(np.int32)
    for one, two, table in ((0, 0, 0), (0, 1, 0), (0, 0, 2), (0, 1, 3)):
        want = [
            any(i != j and np.bitwise_count(s[i] ^ s[j]).sum() <= 66 and (one == two or part[i] != part[j]) and not (keys[i, :table] == keys[j, :table]).any() for j in range(30))
            for i in range(30)
        ]
        assert V.partners(s, part, one, two, 66, keys, table).tolist() == want
