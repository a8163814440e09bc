"""Text queries.  The lexicon is induced from the benchmark texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import lexicon as induced
from tributary.operators import text as X
from tributary.plans.registry import query
from tributary.plans.windowed import sent
from tributary.session import work_dir
from tributary.streaming import sinks
from tributary.streaming.replay import for_each_batch, stage

ROUNDS = 3
MOST_BATCHES = 24  # micro-batches of posts, which are labelled one by one, get longer as the table does


def _round(n: int) -> str:
    """Label round ``n`` from the one before, in SQL."""
    return f"""v{n} AS (SELECT e.word, l.class, sum(weight) AS n FROM edges e JOIN l{n - 1} l ON e.other = l.word GROUP BY ALL),
    l{n} AS (SELECT * FROM l0 UNION ALL SELECT word, arg_max(class, n * 10 - class) AS class FROM v{n} WHERE word NOT IN (SELECT word FROM l0) GROUP BY word)"""


LEXICON = rf"""corpus AS (SELECT list_filter(string_split_regex(lower(text), '[^\p{{L}}]+'), lambda x: x <> '') AS ws FROM benchmark),
    l0 AS (SELECT word, CAST((row_number() OVER (ORDER BY n DESC, word) - 1) % 5 AS INTEGER) AS class
           FROM (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM corpus) GROUP BY 1) QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 25),
    beside AS (SELECT ws[i] AS a, ws[i + 1] AS b FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM corpus)),
    once AS (SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS weight FROM beside WHERE a <> b GROUP BY ALL),
    edges AS (SELECT a AS word, b AS other, weight FROM once UNION ALL SELECT b, a, weight FROM once),
    {", ".join(map(_round, range(1, ROUNDS + 1)))},
    lexicon AS (SELECT word, class FROM l{ROUNDS})"""


def lexicon(t):
    """Classes of the benchmark's most frequent words, spread to the words around them."""
    spoken = t("benchmark", "text")
    return induced.induced_lexicon(spoken, "text", induced.frequent_seeds(spoken, "text"), ROUNDS)


@query("induced_lexicon", "J1 J4", f"WITH {LEXICON} SELECT * FROM lexicon")
def _(t):
    return lexicon(t)


def scored(table: str, key: str) -> str:
    return rf"""{LEXICON},
    said AS (SELECT {key} AS key, list_filter(string_split_regex(text, '[.!?\n]+'), lambda x: trim(x) <> '') AS ss FROM {table}),
    sent AS (SELECT key, i AS no, ss[i] AS sentence FROM said, LATERAL (SELECT unnest(range(1, len(ss) + 1)) AS i)),
    spoken AS (SELECT key, no, unnest(string_split_regex(lower(sentence), '[^\p{{L}}]+')) AS word FROM sent),
    votes AS (SELECT key, no, class, count(*) AS n FROM spoken JOIN lexicon USING (word) GROUP BY ALL),
    won AS (SELECT key, no, arg_max(class, n * 10 - class) AS class, max(n) / sum(n) AS confidence FROM votes GROUP BY ALL),
    scores AS (SELECT sent.key, sent.no, sentence, coalesce(class, 2) AS class, coalesce(confidence, 0.0) AS confidence
               FROM sent LEFT JOIN won ON sent.key = won.key AND sent.no = won.no),
    totals AS (SELECT said.key, coalesce(avg(class), -1.0) AS score, coalesce(avg(confidence), 0.0) AS confidence FROM said LEFT JOIN scores ON said.key = scores.key GROUP BY 1)"""


LABEL = """CASE WHEN score < 0 THEN 'NOT_UNDERSTOOD' WHEN score < 1 THEN 'VERY_NEGATIVE' WHEN score < 2 THEN 'NEGATIVE'
    WHEN score < 3 THEN 'NEUTRAL' WHEN score < 4 THEN 'POSITIVE' WHEN score < 5 THEN 'VERY_POSITIVE' ELSE 'NOT_UNDERSTOOD' END"""
SENTIMENT_SQL = f"WITH {scored('documents', 'doc_id')} SELECT key AS doc_id, round(score, 8) AS score, {LABEL} AS sentiment FROM totals"


def _docs(t):
    return t("documents", "doc_id", "text")


def _rounded(df):
    return df.withColumn("score", F.round("score", 8))


@query("document_sentiment", "J1 B29", SENTIMENT_SQL)
def _(t):
    return _rounded(X.text_sentiment(_docs(t), "doc_id", "text", lexicon(t)))


@query("document_sentiment_distinct", "J2", SENTIMENT_SQL)
def _(t):
    return _rounded(X.text_sentiment_distinct(_docs(t), "doc_id", "text", lexicon(t)))


@query("document_sentiment_confidence", "J4", f"""
    WITH {scored('documents', 'doc_id')} SELECT key AS doc_id, round(score, 8) AS score, round(confidence, 8) AS confidence, {LABEL} AS sentiment FROM totals""")
def _(t):
    return _rounded(X.sentiment_confidence(_docs(t), "doc_id", "text", lexicon(t))).withColumn("confidence", F.round("confidence", 8))


ASPECTS = ["ation", "The ", "eaux"]


@query("aspect_sentiment", "J3", f"""
    WITH {scored('documents', 'doc_id')}, aspects AS (SELECT unnest(['ation', 'The ', 'eaux']) AS aspect),
    m AS (SELECT key, aspect, avg(class) AS score FROM scores JOIN aspects ON contains(lower(sentence), lower(aspect)) GROUP BY ALL),
    o AS (SELECT said.key, a.aspect, coalesce(m.score, -1.0) AS score FROM said CROSS JOIN aspects a LEFT JOIN m ON m.key = said.key AND m.aspect = a.aspect)
    SELECT key AS doc_id, aspect, round(score, 8) AS score, {LABEL} AS sentiment FROM o""")
def _(t):
    return _rounded(X.aspect_sentiment(_docs(t), "doc_id", "text", lexicon(t), ASPECTS))


@query("stream_annotated_posts", "J5", f"""
    WITH {scored('(SELECT conv_id * 1000 + turn AS id, text FROM conversations)', 'id')}
    SELECT conv_id * 1000 + turn AS id, 'User ' || role || ' (' || turn || ' followers) says ' || {LABEL} || ': ' || text AS line
    FROM conversations JOIN totals ON key = conv_id * 1000 + turn""")
def _(t):
    posts = sent(t).join(t("conversations", "conv_id", "turn", "role"), ["conv_id", "turn"]).withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    staged = stage(posts, "ts", 7200, f"{t.sf_dir}/posts", most=MOST_BATCHES)
    out = work_dir(t.spark, "annotated")
    write = sinks.exactly_once(out)
    words = lexicon(t)  # stored; every micro-batch reads it

    def annotate(batch, n):
        write(X.annotate_posts(batch, "id", "role", "turn", "text", words), n)

    for_each_batch(t.spark, staged.stream, annotate)
    return t.spark.read.schema("id bigint, line string, batch_id bigint").parquet(out).drop("batch_id")


_SETS = r"""w AS (SELECT doc_id, make_timestamp(doc_id * 1000000 // 600000000 * 600000000) AS window_start,
    list_sort(list_filter(list_distinct(string_split_regex(regexp_replace(lower(text), '[^a-zA-Z0-9\s]', '', 'g'), '\s+')), lambda x: x <> '')) AS ws FROM documents),
    f AS (SELECT window_start, ws, min(doc_id) AS first FROM w GROUP BY ALL),
    p AS (SELECT x.window_start, x.first AS a, y.first AS b, len(list_intersect(x.ws, y.ws)) AS i, len(x.ws) + len(y.ws) AS n
          FROM f x JOIN f y ON x.window_start = y.window_start AND x.first < y.first
          AND least(len(x.ws), len(y.ws)) > 0.3 * greatest(len(x.ws), len(y.ws))),
    pairs AS (SELECT window_start, a, b, i / (n - i) AS similarity FROM p WHERE i / (n - i) > 0.3)"""


def _timed(t):
    return _docs(t).withColumn("ts", F.timestamp_seconds("doc_id"))


@query("similar_text_pairs", "J6", f"WITH {_SETS} SELECT window_start, a, b, round(similarity, 8) AS similarity FROM pairs")
def _(t):
    sets = X.word_sets(_timed(t).withColumn("window_start", F.window("ts", "10 minutes").start), "text")
    _, pairs = X.similar_texts(sets.select("doc_id", "window_start", "words"), "doc_id", "words", ["window_start"])
    return pairs.withColumn("similarity", F.round("similarity", 8))


@query("text_clusters", "J6", f"""WITH RECURSIVE {_SETS}, e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    r AS (SELECT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
    c AS (SELECT node, min(seen) AS cluster FROM r GROUP BY 1)
    SELECT doc_id, w.window_start, coalesce(cluster, first) AS cluster FROM w JOIN f ON w.window_start = f.window_start AND w.ws = f.ws LEFT JOIN c ON first = node""")
def _(t):
    return X.text_clusters(_timed(t), "doc_id", "text", "ts", "10 minutes")
