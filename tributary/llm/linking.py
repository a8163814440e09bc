"""What joins on pairs have in common: bounded blocks of buckets, components, and results per row.

Buckets are compared in blocks: a bucket of many members is dealt into chunks,
and every pair of chunks is a task of its own, so no task grows with a bucket
and no member is left out.  Blocks return sums of links and spanning trees of
what they found, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.session import settled

CHUNK = 512


def matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(lists), -1)


def in_blocks(members: DataFrame, bucket: str, member: str, n: str, chunk: int = CHUNK) -> DataFrame:
    """Members of buckets (of ``n`` members each) once per pair of chunks they take part in.

    Adds ``one`` and ``two``, the pair's chunks, and ``part``, the member's own.
    """
    chunks = F.ceil(F.col(n) / chunk).cast("int")
    own = F.pmod(F.xxhash64(member, bucket), chunks).cast("int")
    rows = members.withColumn("part", own).withColumn("__other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return rows.withColumn("one", F.least("part", "__other")).withColumn("two", F.greatest("part", "__other")).drop("__other", n)


def eligible(part: np.ndarray, one: int, two: int) -> np.ndarray:
    """Which pairs (row before column) belong to the block of these chunks."""
    n = len(part)
    pairs = np.triu(np.ones((n, n), dtype=bool), 1)
    if one != two:
        pairs &= part[:, None] != part[None, :]
    return pairs


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable by the links (a, b), for each of ``n`` members."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, by alternating large and small stars.

    Each round is written to the shared folder, so a lost executor costs one
    round; rounds go on until nothing changes.
    """
    pairs = settled(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settled(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        pairs = settled(small.where("u <> v").distinct())
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(row)


def per_row(rows: DataFrame, classes: DataFrame, found: DataFrame, ident: str) -> DataFrame:
    """Links and component of every row.

    ``rows``: (rid, ``ident``, f1, f2, linked) with equal (f1, f2) for equal
    content; ``classes``: (f1, f2, cid, weight); ``found``: (cid, links, root),
    links counted in rows of other classes, stored.  Rows that are not ``linked`` stand
    alone.  Adds n_links, component_id (smallest ``ident`` of the component).
    """
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    tree = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    known = settled(classes.join(links, "cid", "left").join(tree.withColumnRenamed("node", "cid"), "cid", "left").select(
        "f1", "f2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "cid").alias("label")).where("n_links > 0"))
    # only rows with a link are looked up; all others stand alone
    joined = rows.join(known, ["f1", "f2"], "left")
    lonely = ~F.col("linked") | F.col("label").isNull()
    named = joined.where(~lonely).groupBy("label").agg(F.min(ident).alias("component_id"))
    return joined.join(settled(named), "label", "left").select(
        *rows.columns, F.when(lonely, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(lonely, F.col(ident)).otherwise(F.col("component_id")).alias("component_id"), F.when(lonely, F.lit(None)).otherwise(F.col("label")).alias("label"))
