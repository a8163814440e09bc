"""A sentiment lexicon induced from a corpus.

A few seed words have a class.  Classes spread over the graph of words that
stand next to each other: in every round each other word takes the class with
the largest weight among its neighbours, the smaller class on a tie, until
nothing changes or a number of rounds is reached.  Weights are whole counts and
all words move at once, so the result does not depend on partitions or order.
Every round is stored; a lost executor costs one round.

Defined cases: null texts have no words; words apart from all seeds get no
class; a seed keeps its class; a seed named twice has its smaller class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.text import NOT_A_LETTER
from tributary.session import settled


def spoken_words(text: str):
    return F.filter(F.split(F.lower(text), NOT_A_LETTER), lambda w: w != "")


def frequent_seeds(df: DataFrame, text: str, n: int = 25, classes: int = 5) -> DataFrame:
    """(word, class): the ``n`` most frequent words, classes dealt by rank; for corpora without a seed list."""
    counts = df.select(F.explode(spoken_words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("__n"))
    first = counts.orderBy(F.desc("__n"), "word").limit(n)
    ranks = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__n")).alias("a"), "word"))), lambda x, i: F.struct(x["word"].alias("word"), (i % classes).alias("class")))
    return first.agg(F.explode(ranks).alias("s")).select("s.*")  # at most n rows meet


def neighbours(df: DataFrame, text: str) -> DataFrame:
    """(word, other, weight), both ways, of different words that stand side by side."""
    words = df.select(spoken_words(text).alias("w"))
    pairs = words.where(F.size("w") > 1).select(F.explode(F.arrays_zip(F.expr("slice(w, 1, size(w) - 1)").alias("a"), F.expr("slice(w, 2, size(w) - 1)").alias("b"))).alias("p"))
    once = pairs.select(F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b")).where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight"))
    return once.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), F.col("a").alias("other")))).alias("e"), "weight").select("e.*", "weight")


def induced_lexicon(df: DataFrame, text: str, seeds: DataFrame, rounds: int = 20) -> DataFrame:
    """(word, class) of every word that a seed's class has reached."""
    edges = settled(neighbours(df, text))
    fixed = settled(seeds.groupBy("word").agg(F.min("class").cast("int").alias("class")))
    labels = fixed
    for _ in range(rounds):
        votes = edges.join(labels.withColumnRenamed("word", "other"), "other").groupBy("word", "class").agg(F.sum("weight").alias("__n"))
        winner = F.max(F.struct(F.col("__n"), (-F.col("class")).alias("__rank")))
        moved = votes.groupBy("word").agg((-winner["__rank"]).alias("class")).join(fixed.select("word"), "word", "left_anti")
        following = settled(fixed.unionByName(moved))
        same = following.join(labels.withColumnRenamed("class", "__old"), "word", "left").agg(
            F.count_if(F.col("__old").isNull() | (F.col("__old") != F.col("class")))).first()[0] == 0
        labels = following
        if same:
            break
    return labels
