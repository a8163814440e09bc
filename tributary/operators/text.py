"""Text jobs: word prices, sentence scores, similarity groups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.scalar import describe_post, normalize_text, sentiment_label
from tributary.operators.windows import sliding
from tributary.session import estimated_bytes, settled, shared_base

SENTENCE_END = r"[.!?\n]+"
NOT_A_LETTER = r"[^\p{L}]+"
NEUTRAL = 2
BLOCK, WORDS_AT_ONCE = 1024, 4096
SCORED_BYTES = 4 * 1024 * 1024


def expensive_words(df: DataFrame, time: str, word: str, at_least: int = 10, price: int = 2, size: str = "30 seconds", slide: str = "10 seconds") -> DataFrame:
    """Words of ten letters or more at two dollars each, per sliding window."""
    long_words = df.where(F.length(word) >= at_least)
    return sliding(long_words, time, size, slide, {"__n": ("count", "*")}).select("start", "end", (F.col("__n") * price).alias("dollars"))


def sentence_scores(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Class (0 to 4) and confidence of every sentence.

    ``lexicon`` has word and class.  Each known word of a sentence votes; the
    class with most votes wins, the lower one on a tie, neutral without votes.
    Confidence is the winner's share of the votes.  A text without sentences
    keeps one row without class.
    """
    pieces = F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")
    return _voted(df.select(key, F.posexplode_outer(pieces).alias("no", "sentence")), key, lexicon)


def _voted(said: DataFrame, key: str, lexicon: DataFrame) -> DataFrame:
    """Class and confidence of the given sentences (key, no, sentence)."""
    spoken = said.select(key, "no", F.explode_outer(F.split(F.lower("sentence"), NOT_A_LETTER)).alias("__word"))
    known = lexicon.select(F.col("word").alias("__known"), F.col("class").cast("int").alias("__class"))
    votes = spoken.join(known, F.col("__word") == F.col("__known"), "left").groupBy(key, "no", "__class").agg(F.count("__word").alias("__n"))
    counted = F.col("__class").isNotNull()
    winner = F.max(F.when(counted, F.struct(F.col("__n"), (-F.col("__class")).alias("__rank"))))
    scored = votes.groupBy(key, "no").agg(winner.alias("__w"), F.sum(F.when(counted, F.col("__n"))).alias("__all"))
    return scored.select(
        key, "no",
        F.when(F.col("no").isNotNull(), F.coalesce(-F.col("__w.__rank"), F.lit(NEUTRAL))).alias("class"),
        F.when(F.col("no").isNotNull(), F.coalesce(F.col("__w.__n") / F.col("__all"), F.lit(0.0))).alias("confidence"),
    )


def _label(df: DataFrame, key: str, *more: Column) -> DataFrame:
    scored = df.groupBy(key).agg(F.coalesce(F.avg("class"), F.lit(-1.0)).alias("score"), *more)
    return scored.withColumn("sentiment", sentiment_label(F.col("score")))


def text_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean sentence class of each text (-1 without sentences) and its label."""
    return _label(sentence_scores(df, key, text, lexicon), key)


def text_sentiment_distinct(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """The same, but every distinct text is scored once and its copies share the result.

    A text becomes many times its size while its words are counted, so the
    distinct texts are dealt to tasks by ``SCORED_BYTES`` of input.
    """
    marked = df.select(key, text, F.sha2(text, 256).alias("__sha"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // SCORED_BYTES))
    once = marked.groupBy("__sha").agg(F.any_value(text).alias(text)).repartition(tasks, "__sha")
    scores = text_sentiment(once, "__sha", text, lexicon)
    return marked.drop(text).join(scores, "__sha").drop("__sha")


def sentiment_confidence(df: DataFrame, key: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Label of the mean class and mean confidence; (NOT_UNDERSTOOD, 0.0) without sentences."""
    confidence = F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("confidence")
    return _label(sentence_scores(df, key, text, lexicon), key, confidence)


def aspect_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame, aspects: Sequence[str]) -> DataFrame:
    """Per text and aspect the mean class of the sentences naming it, ignoring case; -1 when none does.

    The aspects are a short list of the caller; sentences carry only the
    aspects they mention.
    """
    pieces = F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")
    said = df.select(key, F.posexplode(pieces).alias("no", "sentence"))
    named = F.array_compact(F.array(*[F.when(F.lower("sentence").contains(a.lower()), F.lit(a)) for a in aspects]))
    # only sentences that name an aspect are scored
    naming = said.withColumn("__named", named).where(F.size("__named") > 0)
    mentions = naming.select(key, "no", F.explode("__named").alias("aspect"))
    scores = mentions.join(_voted(naming, key, lexicon), [key, "no"]).groupBy(key, "aspect").agg(F.avg("class").alias("__score"))
    asked = df.select(key, F.explode(F.array(*[F.lit(a) for a in aspects])).alias("aspect"))
    out = asked.join(scores, [key, "aspect"], "left").withColumn("score", F.coalesce("__score", F.lit(-1.0)))
    return out.withColumn("sentiment", sentiment_label(F.col("score"))).drop("__score")


def annotate_posts(df: DataFrame, key: str, name: str, followers: str, text: str, lexicon: DataFrame) -> DataFrame:
    """``User ... (n followers) says <label>: text``; on a stream use it per micro-batch."""
    labels = text_sentiment(df, key, text, lexicon)
    line = describe_post(F.col(name), F.col(followers), F.col(text), F.col("sentiment"))
    return df.join(labels, key).select(key, line.alias("line"))


def word_sets(df: DataFrame, text: str, name: str = "words") -> DataFrame:
    """The set of normalized words of each text."""
    pieces = F.split(normalize_text(text), r"\s+")
    return df.withColumn(name, F.array_sort(F.array_remove(F.array_distinct(pieces), "")))


def similar_texts(df: DataFrame, key: str, words: str, group: Sequence[str] = (), threshold: float = 0.3) -> tuple[DataFrame, DataFrame]:
    """(copies, pairs) of texts whose word sets have a Jaccard similarity above the threshold.

    ``copies`` maps every text to the first text of its group with exactly the
    same words.  ``pairs`` lists similar texts among those first texts only, so
    a crowd of copies never multiplies.

    Pairs are found exactly.  Each group is cut into blocks of about ``BLOCK``
    texts and every two blocks meet in a task, which counts the words that their
    texts share as products of 0/1 matrices, ``WORDS_AT_ONCE`` words at a time.
    """
    group = list(group)
    marked = df.withColumn("__sha", F.sha2(F.concat_ws(" ", words), 256))
    # used twice below; computed and stored once
    firsts = settled(marked.groupBy(*group, "__sha").agg(F.min(key).alias("first"), F.any_value(words).alias("__words")))
    copies = marked.select(*group, key, "__sha").join(firsts.drop("__words"), [*group, "__sha"]).select(*group, key, "first")

    named = firsts.where(F.col("first").isNotNull() & (F.size("__words") > 0))
    sizes = named.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("__blocks"))
    dealt = named.join(sizes, group) if group else named.crossJoin(F.broadcast(sizes))
    own = F.pmod(F.xxhash64("__sha"), F.col("__blocks"))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)).alias("__other")
    placed = dealt.withColumn("__own", own).select(*group, "first", "__words", "__own", meets)
    low, high = F.least("__own", "__other").alias("__low"), F.greatest("__own", "__other").alias("__high")
    met = placed.select(*group, low, high, "__own", "first", "__words")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = pc.list_flatten(table["__words"]).dictionary_encode().combine_chunks()
        sizes = pc.list_value_length(table["__words"]).to_numpy()
        codes = lists.indices.to_numpy(zero_copy_only=False)
        owners = np.repeat(np.arange(table.num_rows), sizes)
        order = np.argsort(codes, kind="stable")
        codes, owners = codes[order], owners[order]
        is_low = table["__own"].to_numpy() == table["__low"].to_numpy()
        one = np.flatnonzero(is_low)
        two = one if is_low.all() and table["__low"][0] == table["__high"][0] else np.flatnonzero(~is_low)
        shared = np.zeros((len(one), len(two)), dtype=np.float32)
        bounds = np.searchsorted(codes, np.arange(0, len(lists.dictionary) + WORDS_AT_ONCE, WORDS_AT_ONCE))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            has = np.zeros((table.num_rows, WORDS_AT_ONCE), dtype=np.float32)
            has[owners[a:b], codes[a:b] - k * WORDS_AT_ONCE] = 1
            shared += has[one] @ has[two].T
        shared = shared.astype(np.int64)
        similarity = shared / (sizes[one][:, None] + sizes[two][None, :] - shared)
        found = similarity > threshold
        if two is one:
            found = np.triu(found, 1)
        x, y = np.nonzero(found)
        first, values = table["first"].to_numpy(), similarity[x, y]
        a, b = first[one[x]], first[two[y]]
        kept = {g: table[g].take(pa.array(one[x])) for g in group}
        return pa.table({**kept, "a": pa.array(np.minimum(a, b), table.schema.field("first").type), "b": pa.array(np.maximum(a, b), table.schema.field("first").type), "similarity": pa.array(values)})

    kinds = dict(firsts.dtypes)
    schema = ", ".join([*(f"`{g}` {kinds[g]}" for g in group), f"a {kinds['first']}", f"b {kinds['first']}", "similarity double"])
    pairs = met.groupBy(*group, "__low", "__high").applyInArrow(compare, schema)
    return copies, pairs.where("a < b")  # texts of equal first keys are no pair


def connected_groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, cluster)``: every node of the pairs with the smallest node it is linked to.

    Alternating star contraction: edges are re-pointed to smaller neighbours
    until only stars remain, in a number of rounds that grows with the
    logarithm of the longest chain.  The edge list is checkpointed per round.
    """
    shared_base(pairs.sparkSession)
    edges = pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    while True:
        before = edges
        # large star: larger neighbours move to the smallest neighbour
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: smaller neighbours and the node itself move to the smallest one
        below = large.where("u <> v").distinct()
        least = below.groupBy("u").agg(F.min("v").alias("m"))
        small = below.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = small.where("u <> v").distinct().checkpoint()
        if edges.exceptAll(before).isEmpty() and before.exceptAll(edges).isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("cluster")).unionByName(
        roots.select("node", F.col("node").alias("cluster"))
    )


def text_clusters(df: DataFrame, key: str, text: str, time: str, size: str = "30 seconds", threshold: float = 0.3) -> DataFrame:
    """Cluster of every text among the texts of its time window.

    Texts are linked when their word sets are similar enough; a cluster is a
    linked group, named by its smallest key.  Unlike a walk in arrival order
    the result does not depend on the order of the texts.
    """
    windowed = word_sets(df.withColumn("window_start", F.window(time, size).start), text)
    copies, pairs = similar_texts(windowed.select(key, "window_start", "words"), key, "words", ["window_start"], threshold)
    groups = connected_groups(pairs)
    joined = copies.join(groups, F.col("first") == F.col("node"), "left")
    return joined.select(key, "window_start", F.coalesce("cluster", "first").alias("cluster"))
