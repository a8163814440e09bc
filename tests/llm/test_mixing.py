import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.oracle import compare, connect
from tributary.llm import mixing as M
from tributary.llm.queries import QUERIES, SQL

SIZE = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def by_hand(rows, block):
    """Targets by raising and resharing, and words taken from each row by walking its source's axis."""
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(SIZE(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, free = {}, set(sources)
    while True:
        left = sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * size[s] for s in over}
        free -= over
    taken = {}
    for s in sources:
        mine = sorted(((hashlib.md5(str(i if i is not None else t or "").encode()).hexdigest(), i, SIZE(t)) for i, t, x in rows if x == s), key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2]))
        words, at, out = min(round(target[s]), 3 * size[s]), 0, []
        turns, rest = divmod(words, size[s]) if size[s] else (0, 0)
        for _, i, n in mine:
            out.append((i, n, turns * n + max(0, min(rest - at, n))))
            at += n
        taken[s] = sorted(out, key=str)
    return size, target, taken


@pytest.mark.parametrize("block", [7, 50, 4096])
def test_equals_a_walk(spark, block):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(0, 60))), rng.choice(["a", "a", "a", "b", "c", "é", "~"])) for i in range(300)]
    rows += [(300, None, "a"), (301, "", "b"), (302, "one two three", None), (None, "x y", "a"), (1, rows[1][1], rows[1][2]), (303, "lonely word", "zz"), (304, "w " * 5000, "c"), (305, "  ", "empty")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, size int")
    size, target, taken = by_hand(rows, block)
    got = M.mix(df.repartition(5), block_words=block, keep=("text",)).collect()
    assert len(got) == len(rows)
    mine = defaultdict(list)
    for r in got:
        assert r.size == SIZE(r.text) and r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-5
        assert r.taken <= 3 * r.size and (r.first_slot is None) == (r.taken == 0)
        mine[r.source].append((r.doc_id, r.size, r.taken))
    assert {s: sorted(v, key=str) for s, v in mine.items()} == taken
    again = M.mix(df.repartition(2), block_words=block, keep=("text",)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    assert M.mix(df.limit(0)).count() == 0


def test_slots_of_a_source_are_spread(spark):
    rows = [(i, "w " * 20, "abc"[i % 3]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.select("doc_id", "source", M.word_count(df.text).alias("__size"), M.F.md5(df.doc_id.cast("string")).alias("__key"))
    targets = M.source_targets(sized)
    slots = M.schedule(targets, 20).orderBy("slot").collect()
    share = {r.s: r.words / sum(x.words for x in targets.collect()) for r in targets.collect()}
    seen = Counter()
    for n, r in enumerate(slots[:-5], 1):  # at every prefix each source is within a few slots of its share
        seen[r.s] += 1
        assert all(abs(seen[s] - n * share[s]) < 4 for s in share)


def test_mixed_documents_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "a b  c\nd", "x", 8), (2, "e f", "y", 3), (3, None, "y", None)], "doc_id long, text string, source string, n_chars long")
    out = M.mixed_documents(df, block_words=2)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r.source] += SIZE(r.text)
        assert r.n_chars == len(r.text)
    assert words == {"x": 4, "y": 2}  # of 6 words, 5/7 and 2/7, rounded


def test_query_equals_its_twin(spark, sf_dir):
    assert not compare(QUERIES["op10_mixing"](spark, sf_dir), connect(sf_dir), SQL["op10_mixing"])


NAMES = "size target taken source_size first_slot s block slot turn n_docs weight __row __size words level".split()


def test_columns_of_any_name_are_kept(spark):
    rows = [(i, "w " * (i % 7), "abc"[i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", *[M.F.concat(M.F.lit(n), M.F.col("doc_id")).alias(n) for n in NAMES])
    out = M.mixed_documents(df, block_words=5)
    assert out.columns == df.columns
    got = out.collect()
    assert got and all(r[n] == f"{n}{r.doc_id}" for r in got for n in NAMES)
    plain = M.mixed_documents(df.select("doc_id", "text", "source"), block_words=5).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in plain)
    assert len(M.mix(df).collect()) == 60


def test_mixture_is_in_schedule_order_and_repeats_stand_apart(spark):
    rows = [(i, f"d{i} " * 10, "ab"[i >= 30]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.source) for r in M.mixed_documents(df, block_words=10).collect()]
    places = defaultdict(list)
    for k, (i, _) in enumerate(got):
        places[i].append(k)
    times = [len(v) for i, v in places.items() if i < 30]
    assert max(times) == 3 and min(min(b - a for a, b in zip(v, v[1:])) for v in places.values() if len(v) > 1) > 20
    share = sum(s == "a" for _, s in got) / len(got)
    for n in range(20, len(got), 20):  # every prefix has the sources in their shares
        assert abs(sum(s == "a" for _, s in got[:n]) - n * share) < 4


def test_an_id_with_a_third_of_all_rows(spark):
    rows = [(1, "x y z", "a")] * 2000 + [(i, "a b c d", "ab"[i % 2]) for i in range(2, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(df).agg(M.F.count("*").alias("n"), M.F.sum("taken").alias("taken"), M.F.max(M.F.col("taken") / M.F.col("size")).alias("most")).first()
    assert got.n == len(rows) and abs(got.taken - 2000 * 3 - 3998 * 4) <= 2 and got.most <= 3
