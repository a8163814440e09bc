"""Mixing sources to target weights by a low-discrepancy source schedule.

Each source's documents are shuffled by a hash and laid end to end on a word
axis, which is cut into blocks of equal words.  Slot ``k`` of the schedule has
the golden-ratio point ``frac(k * 0.618...)``; mapped through the cumulative
targets it names a source, and the slot's rank among the slots of its source
names the block.  All of it is DataFrame work: no Python runs on rows.

Defined cases: a null text has no words; a null source is a source of its own,
last in order; a row without words is never placed; repeated rows are separate
rows; null ids are spread by their text; texts of any length are cut into blocks
like others; equal hashes are ordered by id and size; an empty table gives no
rows; extra columns of any name are kept by ``mixed_documents`` and never read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import WORD
from tributary.session import settled

POINTS = 1 << 32
GOLDEN = 2654435769  # POINTS / golden ratio, rounded to an odd number
CELLS = 4096
BLOCK_WORDS = 4096
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: place in order, size, weight, target, whole words to take.

    A target is ``min(most * size, level * weight)``; the water level follows
    from the sources sorted by ``most * size / weight``: it is the largest of
    (what the sources before leave) / (weights from here on).
    """
    sources = sized.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("s", place).withColumn("weight", F.element_at(table, (F.col("s") % len(weights)).cast("int") + 1))
    cap = F.col("source_size") * F.lit(float(most))
    by_cap = Window.orderBy(cap / F.col("weight"), "s")
    before = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - before) / rest
    sources = sources.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    sources = sources.withColumn("target", F.round(F.least(cap, F.col("level") * F.col("weight")), 6))
    words = F.least(F.round("target").cast("long"), F.col("source_size") * most)
    sources = sources.withColumn("words", words)
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    ends = F.sum("words").over(upto)
    total = F.greatest(F.sum("words").over(everything), F.lit(1))
    point = lambda c: F.floor(c.cast("double") * float(POINTS) / total)
    return sources.select("source", "s", "source_size", "n_docs", "target", "words", point(ends - F.col("words")).alias("low"), point(ends).alias("high"))


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every block to take: (s, block, turn, slot, words).

    Sources meet points in cells of the unit interval (an equi-join, whatever
    the number of sources); ranks are counted in two steps so that no task
    holds all slots of a source.  A needed block that no slot reached, by the
    small discrepancy of the sequence, comes after the last slot.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("words")).first()[0] or 0
    slots = -(-total // block_words)
    chunk = 1 << max(1, (max(1, slots).bit_length() + 1) // 2)
    points = spark.range(slots).withColumn("point", (F.col("id") * F.lit(GOLDEN)).bitwiseAND(F.lit(POINTS - 1)))
    points = points.withColumn("cell", F.floor(F.col("point") / (POINTS // CELLS)))
    bounds = targets.where("high > low").select(
        "s", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / (POINTS // CELLS)), F.floor((F.col("high") - 1) / (POINTS // CELLS)))).alias("cell"))
    chosen = points.join(bounds, "cell").where("point >= low and point < high").select("id", "s", F.floor(F.col("id") / chunk).alias("part"))
    counts = chosen.groupBy("s", "part").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    inside = F.row_number().over(Window.partitionBy("s", "part").orderBy("id")) - 1
    ranked = chosen.withColumn("inside", inside).join(counts.select("s", "part", ahead.alias("ahead")), ["s", "part"])
    ranked = ranked.select("s", (F.col("ahead") + F.col("inside")).alias("rank"), F.col("id").alias("slot"))

    blocks = F.ceil(F.col("source_size") / block_words)
    per_round, rounds = F.greatest(blocks, F.lit(1)), F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))
    left = F.col("words") - rounds * F.col("source_size")
    needed = targets.where("words > 0").select("s", "source_size", "words", per_round.alias("blocks"), (rounds * blocks + F.ceil(left / block_words)).alias("n"))
    needed = needed.select("s", "source_size", "words", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("rank"))
    block, turn = F.col("rank") % F.col("blocks"), F.floor(F.col("rank") / F.col("blocks"))
    length = F.least(F.lit(block_words), F.col("source_size") - block * block_words, F.col("words") - turn * F.col("source_size") - block * block_words)
    return needed.join(ranked, ["s", "rank"], "left").select(
        "s", block.alias("block"), turn.alias("turn"), F.coalesce("slot", F.lit(slots) + F.col("rank")).alias("slot"), length.alias("words"))


def laid_out(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with their source's place and their first word's place on its axis.

    Offsets are summed in two steps, over about sqrt(rows) buckets a source.
    """
    key_number = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    rows = sized.join(targets.select(F.col("source").alias("__source"), F.col("s").alias("__s"), "n_docs"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("__bucket", F.floor(key_number * F.ceil(F.sqrt("n_docs")) / POINTS)).drop("n_docs")
    order = Window.partitionBy("__s", "__bucket").orderBy("__key", "doc_id", "__size")
    inside = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    totals = rows.groupBy("__s", "__bucket").agg(F.sum("__size").alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy("__s").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    rows = rows.withColumn("__inside", inside).join(totals.select("__s", "__bucket", ahead.alias("__ahead")), ["__s", "__bucket"])
    return rows.withColumn("__start", F.col("__ahead") + F.col("__inside")).drop("__bucket", "__inside", "__ahead")


def pieces(rows: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What each slot takes of each row: (s, start, turn, slot, first word, end word) of the row."""
    first, last = F.floor(F.col("__start") / block_words), F.floor((F.col("__start") + F.col("__size") - 1) / block_words)
    parts = rows.where("__size > 0").select(F.col("__s").alias("s"), "__start", "__size", F.explode(F.sequence(first, last)).alias("block"))
    joined = parts.join(slots, ["s", "block"])
    begin = F.greatest(F.col("__start"), F.col("block") * block_words)
    end = F.least(F.col("__start") + F.col("__size"), F.col("block") * block_words + F.col("words"))
    return joined.where(end > begin).select(F.col("s").alias("__s"), "__start", "turn", "slot", (begin - F.col("__start")).alias("word_from"), (end - F.col("__start")).alias("word_to"))


def laid_plan(docs: DataFrame, weights: tuple[int, ...], most: int, block_words: int, ident: tuple[str, ...], keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(stored rows, rows on their source's axis, targets, what each slot takes); ``ident`` names the columns that know a row."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")))
    stored = settled(docs.select(*ident, "doc_id", "source", word_count(F.col("text")).alias("__size"), key.alias("__key"), *keep))
    targets = settled(source_targets(stored.select("source", "__size"), weights, most))
    rows = laid_out(stored.select(*ident, "doc_id", "source", "__size", "__key"), targets)
    # a row without words shares its start with the next row and takes nothing
    rows = rows.withColumn("__at", F.when(F.col("__size") > 0, F.col("__start")))
    return stored, rows, targets, pieces(rows.select("__s", "__start", "__size"), schedule(targets, block_words), block_words)


def with_places(docs: DataFrame) -> DataFrame:
    """The rows with the file and the row number in it that they come from; what is no plain scan is stored first."""
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row_no")]
    try:
        return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *place)
    except AnalysisException:
        return with_places(settled(docs))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``docs`` with size, source_size, target, taken and first_slot.

    ``taken`` counts the words of all slots that take from the row; a source's
    words are its target rounded, so a row is taken at most ``most`` times.
    ``keep`` names further columns to carry along.
    """
    numbered = docs.withColumn("__rid", F.monotonically_increasing_id())
    stored, rows, targets, takes = laid_plan(numbered, weights, most, block_words, ("__rid",), keep)
    taken = takes.groupBy("__s", F.col("__start").alias("__at")).agg(F.sum(F.col("word_to") - F.col("word_from")).alias("__taken"), F.min("slot").alias("__first"))
    rows = rows.join(taken, ["__s", "__at"], "left")
    sizes = targets.select(F.col("s").alias("__s"), "source_size", "target")
    mixed = rows.join(sizes, "__s").select(
        "__rid", "doc_id", F.col("__size").alias("size"), "source_size", "target", F.coalesce("__taken", F.lit(0)).cast("long").alias("taken"),
        F.col("__first").alias("first_slot"), *(["source"] if keep else []))
    if keep:  # long columns travel once, to the finished rows
        mixed = mixed.join(stored.select("__rid", *keep), "__rid")
    return mixed.drop("__rid")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixture itself, in the order of the schedule: each row once for every turn, at the turn's first slot.

    The last turn of a source may take a part of one row, its first words.
    Partitions hold runs of slots, and rows are ordered by slot within them.
    """
    columns = docs.columns
    whole_rows = with_places(docs)
    ident = ("__file", "__row_no")
    short = whole_rows.select(*ident, *[F.col(f"__row.{c}").alias(c) for c in ("doc_id", "text", "source")])
    _, rows, _, takes = laid_plan(short, weights, most, block_words, ident, ())
    turns = takes.groupBy("__s", F.col("__start").alias("__at"), "turn").agg(F.sum(F.col("word_to") - F.col("word_from")).alias("__words"), F.min("slot").alias("__slot"))
    # short rows, stored: where they are few, the documents need not be shuffled to meet them
    placed = settled(rows.select(*ident, "__s", "__at", "__size").join(turns, ["__s", "__at"]).select(*ident, "__size", "__words", "__slot", "__s", "__at"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = (placed.agg(F.max("__slot")).first()[0] or 0) + 1
    part = F.floor(F.col("__slot") * parts / F.lit(last)).cast("int")
    laid = placed.join(whole_rows, list(ident)).repartitionById(parts, part).sortWithinPartitions("__slot", "__s", "__at")
    text = F.col("__row.text")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), 1, F.col("__words").cast("int")), "")
    laid = laid.withColumn("__whole", F.col("__words") == F.col("__size")).withColumn("__text", F.when(F.col("__whole"), text).otherwise(cut))
    new = {"text": F.col("__text"), "n_chars": F.when(F.col("__whole"), F.col("__row.n_chars") if "n_chars" in columns else F.lit(None)).otherwise(F.char_length("__text").cast("long"))}
    return laid.select(*[new.get(c, F.col(f"__row.`{c}`")).alias(c) for c in columns])
