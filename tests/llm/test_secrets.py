import hashlib
import random
import re
from collections import Counter

import pytest

from tributary.llm import secrets as S
from tributary.llm.queries import QUERIES


def slow_base(text):
    """The contract's patterns, read literally."""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [x[2] for x in sorted(found)]


def test_query_keeps_the_base_spans(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op7_secrets"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in got.values()) > 0
    for d in docs:
        base, r = slow_base(d.text or ""), got[d.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in S.KINDS)
        assert set(base) <= set(r.spans.split(","))


def reachable(automaton):
    seen, todo = {0}, [0]
    while todo:
        for state, _ in automaton.arcs[todo.pop()].values():
            if state not in seen:
                seen.add(state)
                todo.append(state)
    return len(seen)


def test_automaton_learns_a_format():
    rng = random.Random(1)
    draw = lambda: "sk_" + "".join(rng.choice("0123456789abcdef") for _ in range(20))
    ordinary = Counter(S.symbols("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(16, 30)))) for _ in range(500))
    formats = S.learn({"assign": Counter(S.symbols(draw()) for _ in range(400))}, ordinary)
    tree = S.prefix_tree(Counter(S.symbols(draw()) for _ in range(400)))
    assert reachable(formats.automata["assign"]) < 30 and len(tree.visits) > 1000
    assert all(formats.passes(draw()) for _ in range(50))
    assert not any(formats.passes("".join(rng.choice("etaoinshrdlu") for _ in range(24))) for _ in range(50))


def test_short_formats_are_found_and_short_words_are_not():
    rng = random.Random(4)
    draw = lambda: "".join(rng.choice("0123456789") if k % 2 else rng.choice("GHJKLMNP") for k in range(8))
    word = lambda: "".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randrange(6, 12)))
    ordinary = Counter(S.symbols(word()) for _ in range(3000)) + Counter(S.symbols(word() + str(rng.randrange(100))) for _ in range(300))
    formats = S.learn({"assign": Counter(S.symbols(draw()) for _ in range(300))}, ordinary)
    assert formats.least == 8
    text = f"the key {draw()} or {word()} and order {rng.randrange(10**7, 10**8)}"
    assert [text[a:b] for a, b, k in S.scan(text, formats) if k == S.ADDED] == [text.split()[2]]
    assert not any(formats.passes(word()) for _ in range(2000))


def test_added_spans_equal_a_plain_walk(spark):
    """Every token of every text against the learnt formats, without the cache and the scan."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    formats = S.fit(docs)
    got = {r.doc_id: r.spans for r in S.secret_spans(docs).collect()}
    for d in docs.collect():
        taken = [tuple(map(int, s.split(":")[1:])) for s in slow_base(d.text or "")]
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{6,}", d.text or ""):
            if any(a < m.end() and m.start() < b for a, b in taken) or len(m[0]) < formats.least:
                continue
            word, b = S.symbols(m[0]), max(x for x in S.BANDS if x <= len(m[0]))
            ratio = max(a.log_likelihood(word) for a in formats.automata.values()) - formats.backgrounds[b].log_likelihood(word)
            if ratio / (len(word) + 1) > formats.thresholds[b]:
                want.append(f"{S.ADDED}:{m.start()}:{m.end()}")
        assert [s for s in got[d.doc_id].split(",") if s.startswith(S.ADDED)] == want


def test_scan_and_redaction(spark):
    rng = random.Random(2)
    value = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(k, f'see PassWord = "{value(18)}" and words{"o" * 12} more', "en", "s", 1) for k in range(60)]
    rows += [(60, None, None, None, None), (61, "", "en", "s", 0), (None, "token: abc", "en", "s", 10), (0, rows[0][1], "en", "s", 1), (62, "x" * 30000 + " AKIA" + "Z9" * 10, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, n_chars long")
    got = S.secret_spans(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[60].spans == "" and by[61].spans == "" and by[None].n_assign == 0 and by[62].n_access == 1
    assert all(by[k].spans.startswith("assign:4:") and by[k].n_assign == 1 for k in range(60))
    clean = {r.doc_id: r for r in S.redacted(docs).collect()}
    assert clean[3].text.startswith("see [SECRET]") and clean[3].n_chars == len(clean[3].text) and clean[60].text is None
    assert S.secret_spans(docs.limit(0)).count() == 0


def test_ordinary_tokens_avoid_base_spans():
    text = "password=abcdef0123456789abcdef " + "Q" * 20 + " token='x1y2z3' " + "9" * 16
    base = S.base_spans(text)
    assert [text[a:b] for a, b in S.ordinary_tokens(text, base)] == ["Q" * 20, "9" * 16]


def test_every_credential_and_token_teaches(spark, monkeypatch):
    rng = random.Random(3)
    value = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC012") for _ in range(n))
    rows = [(k if k % 7 else None, f"{value(30)} and {word(24)} then {word(9)}") for k in range(7000)] + [(1, "token=" + "Z" * 300), (1, "secret: a1b2c3d4")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    formats = S.fit(docs)
    credentials, ordinary = {k: Counter() for k in S.KINDS}, Counter()
    for _, text in rows:
        base = S.base_spans(text)
        for *_, kind, v in base:
            credentials[kind][S.symbols(v)] += 1
        ordinary.update(S.symbols(text[a:b]) for a, b in S.ordinary_tokens(text, base))
    for b in S.BANDS:
        words = Counter({w: n for w, n in ordinary.items() if S.band(len(w)) == b})
        assert formats.backgrounds[b] == S.Background.of(S.steps(words or ordinary))
    scores = sorted((formats.score(w) for w in ordinary.elements() if len(w) >= S.LONG), reverse=True)
    assert formats.thresholds[S.LONG] == max(scores[int(0.0005 * len(scores))], 0.0) + 0.05

    monkeypatch.setattr(S, "PREFIX_SHARE", 20)  # most strings leave the tree
    counts = S.word_counts(docs).where("kind in ('assign', 'hex')")
    for kind, tree in S.trees(counts).items():
        assert tree.visits[0] == credentials[kind].total() and sum(tree.ends) == credentials[kind].total()
        assert all(v == e + sum(n for _, n in arcs.values()) for v, e, arcs in zip(tree.visits, tree.ends, tree.arcs))
        assert sum(tree.visits) == sum((len(w) + 1) * n for w, n in credentials[kind].items()) and len(tree.visits) < 400


def test_small_tables_learn_what_a_plain_walk_learns(spark):
    rng = random.Random(6)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(k, f"token=sk_{draw('0123456789abcdef', 12)} {draw('0123456789abcdef', 26)} {draw('etaoinGH', rng.randrange(6, 30))}") for k in range(200)]
    docs = spark.createDataFrame([*rows, (None, None), (7, "")], "doc_id long, text string")
    credentials, ordinary = {k: Counter() for k in S.KINDS}, Counter()
    for _, text in rows:
        base = S.base_spans(text)
        for *_, kind, v in base:
            credentials[kind][S.symbols(v)] += 1
        ordinary.update(S.symbols(text[a:b]) for a, b in S.ordinary_tokens(text, base))
    want, got = S.learn(credentials, ordinary), S.fit(docs)
    assert got.least == want.least and got.thresholds.keys() == want.thresholds.keys()
    assert all(abs(got.thresholds[b] - want.thresholds[b]) < 1e-9 for b in S.BANDS)
    assert all(abs(got.score(w) - want.score(w)) < 1e-9 for w in [*ordinary][:500])


@pytest.mark.parametrize("odd", ["0123456789", "ghjkmnpq"])
def test_short_credentials_of_the_scanned_texts_are_found(spark, odd):
    """Formats learnt from the very documents that are scanned find their bare short credentials, and no words."""
    rng = random.Random(8)
    draw = lambda: "".join(rng.choice(odd) if k % 2 else rng.choice("GHJKLMNP") for k in range(8))
    word = lambda: "".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randrange(6, 12)))
    rows = [(k, f"{word()} password: {draw()} {word()} {word()}{rng.randrange(100)}") for k in range(150)]
    bare = {k: draw() for k in range(150, 190)}
    rows += [(k, f"{word()} {v} {word()} {word()}") for k, v in bare.items()] + [(k, " ".join(word() for _ in range(5))) for k in range(190, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    formats = S.fit(docs)
    assert formats.least == 8
    found = {}
    for r in S.secret_spans(docs).collect():
        found[r.doc_id] = [rows[r.doc_id][1][a:b] for a, b in (map(int, s.split(":")[1:]) for s in r.spans.split(",") if s.startswith(S.ADDED))]
    assert {k: v for k, v in found.items() if v} == {k: [v] for k, v in bare.items()}
    assert all(("[SECRET]" in r.text) == (r.doc_id < 190) for r in S.redacted(docs).collect())


def test_levels_leave_out_as_many_tokens_as_may_pass(spark):
    scores = spark.createDataFrame([(3.0, 2), (2.0, 3), (1.0, 4)], "score double, n long")
    assert [S.level(scores, n) for n in (0, 1, 2, 4, 5, 8, 9, 20)] == [3.0, 3.0, 2.0, 2.0, 1.0, 1.0, 1.0, 1.0]
    assert S.passing(S.LONG, 4000, 50, 0.0005) == 2.0 and S.passing(8, 4000, 50, 0.0005) == 50 and S.passing(8, 4000, 0, 0.0005) == 2.0


def test_symbol_strings_score_as_their_tokens():
    rng = random.Random(9)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    labelled = {"assign": Counter(S.symbols(draw("0123456789abcdefGH", 9)) for _ in range(200))}
    formats = S.learn(labelled, Counter(S.symbols(draw("etaoinshr", rng.randrange(6, 20))) for _ in range(900)))
    for token in [draw("0123456789abcdefGHxyzABC+/_.=-", rng.randrange(6, 30)) for _ in range(300)]:
        assert S.symbols(S.symbols(token)) == S.symbols(token) and formats.score(S.symbols(token)) == formats.score(token)
