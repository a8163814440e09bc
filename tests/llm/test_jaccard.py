import random
import re

import numpy as np
import pytest

from tests.oracle import compare, connect
from tributary.llm import jaccard as J
from tributary.llm.queries import QUERIES, SQL


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    link = [[i != j and bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if link[i][j] and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    named = {}
    for i, k in enumerate(label):
        if rows[i][0] is not None:
            named[k] = min(named.get(k, rows[i][0]), rows[i][0])
    return sorted([(r[0], named.get(label[i]), sum(link[i])) for i, r in enumerate(rows)], key=str)


def texts(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []

    def add(words):
        rows.append((1000 - len(rows), " ".join(words)))

    base = [word() for _ in range(120)]
    for _ in range(50):  # near copies, many pairs about the threshold
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(120)] = word()
        add(copy)
    passage = [word() for _ in range(60)]
    for _ in range(40):  # a shared passage that is not enough
        add([word() for _ in range(60)] + passage)
    chain = [word() for _ in range(100)]
    for k in range(0, 60, 4):  # each linked to its neighbours only
        add(chain[k:] + [f"t{k}{i}" for i in range(0)] + [f"c{i}" for i in range(k)])
    for _ in range(30):
        add([word() for _ in range(rng.randrange(1, 40))])
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "one two"), (5004, "one  two"), (5005, "one"), (None, rows[0][1]), rows[1], (5006, " ".join(base) + "\n" + "x " * 20000)]
    return rows


@pytest.mark.parametrize("plan", [J.Plan(), J.Plan(small=6), J.Plan(small=6, alike=2.0, levels=3)], ids=["one block", "blocks", "always split"])
def test_equals_brute_force(spark, plan):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sketch string, rid int")
    got = J.jaccard_join(df, plan).collect()
    assert sorted([(r.doc_id, r.class_id, r.n_links) for r in got], key=str) == brute(rows)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.class_id) for r in got)


def test_one_of_each_group_stays(spark):
    rows = texts(1)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row string")
    left = J.one_of_each(df)
    assert left.columns == df.columns
    classes = {c for _, c, n in brute(rows)}
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=str) == sorted(classes, key=str) and len(ids) == len(set(ids))
    assert J.jaccard_join(df.limit(0)).count() == 0 and J.one_of_each(df.limit(0)).count() == 0


def test_no_square_of_a_hot_word(spark):
    rows = [(k, f"a b c d e f g u{k} v{k} w{k} x{k} y{k} z{k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert J.jaccard_join(df).where("n_links > 0").count() == 0


def test_plan_keeps_pairs_at_the_threshold():
    assert J.Plan().runs <= 12
    rng = np.random.RandomState(0)
    shared, missed = rng.randint(0, 1 << 62, 800).astype(np.uint64), 0
    for _ in range(300):
        a = np.concatenate([shared, rng.randint(0, 1 << 62, 100).astype(np.uint64)])
        b = np.concatenate([shared, rng.randint(0, 1 << 62, 100).astype(np.uint64)])
        shared = rng.randint(0, 1 << 62, 800).astype(np.uint64)
        same = J.sketch(a) == J.sketch(b)
        missed += not same[: J.Plan().runs].any() or same.sum() < J.Plan().least_matches
    assert missed == 0


def test_query_equals_its_twin(spark, sf_dir):
    assert not compare(QUERIES["op2_jaccard"](spark, sf_dir), connect(sf_dir), SQL["op2_jaccard"])
