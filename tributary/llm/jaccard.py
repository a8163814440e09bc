"""Near-duplicate texts by a chosen-path join on word shingles.

A text is its set of five-word shingles (one of all its words if it has
fewer).  Sets are split on sampled shared tokens, here minhash coordinates:
every run starts from another coordinate; a bucket that is still large is
split again on coordinates drawn from its own path, unless its sets are so
alike that splitting would only multiply them.  Small and alike buckets are
compared by brute force, in bounded blocks: sketches choose the pairs, the
first common bucket of a pair compares its whole shingle sets exactly.

A pair at similarity s survives a level of b coordinates with chance
1 - (1 - s q)^b, q being its chance below; ``runs`` is chosen so that a pair
right at the threshold is missed with at most 1 - recall in the worst case
of ``levels`` levels.

Equal shingle sets are one class and compared once.  Defined cases: null texts
and texts without words link with nothing; texts of any length are read
whole; repeated rows are equal texts; a null id takes part and names no
class unless all of its class are null; an empty table gives no rows; extra
columns may have any names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import linking
from tributary.llm.common import WORD, map_groups, map_rows, runtime_filters
from tributary.session import settled

WORDS = re.compile(WORD)
SHINGLE = 5
COORDINATES = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.RandomState(2)
FACTORS = (_RANDOM.randint(0, 1 << 62, COORDINATES).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
TERMS = _RANDOM.randint(0, 1 << 62, COORDINATES).astype(np.uint64)


@dataclass(frozen=True)
class Plan:
    threshold: float = 0.8
    recall: float = 0.99999
    branches: int = 3
    levels: int = 4
    small: int = linking.CHUNK
    alike: float = 0.4  # mean share of common coordinates from which a bucket is not split
    least_matches: int = 34  # of 64 sketch coordinates; a pair at 0.8 has fewer once in a million

    @property
    def runs(self) -> int:
        q = 1.0
        for _ in range(self.levels - 1):
            q = 1 - (1 - self.threshold * q) ** self.branches
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold * q))


def shingles(text: str | None, seen: dict[str, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; ``seen`` remembers hashes of words."""
    words = WORDS.findall(text) if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    for w in set(words).difference(seen):
        seen[w] = xxhash.xxh3_64_intdigest(w)
    ids = np.fromiter(map(seen.__getitem__, words), dtype=np.uint64, count=len(words))
    run = min(SHINGLE, len(ids))
    value = np.full(len(ids) - run + 1, run, dtype=np.uint64)
    for k in range(run):
        value = (value ^ ids[k : len(ids) - run + 1 + k]) * MIX
        value ^= value >> np.uint64(29)
    return np.unique(value)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Least value of every coordinate's own hash of the set."""
    least = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(hashes), 4096):
        values = (FACTORS[:, None] * hashes[None, at : at + 4096] + TERMS[:, None]) >> np.uint64(32)
        np.minimum(least, values.min(axis=1).astype(np.uint32), out=least)
    return least.view(np.int32)


def signatures(rows: DataFrame) -> DataFrame:
    """(rid, n, f1, f2, sketch) of rows (rid, text); equal sets have equal (f1, f2)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: dict[str, int] = {}
        n, f1, f2, all_sketches = [], [], [], []
        for text in batch.column("text").to_pylist():
            h = shingles(text, seen)
            digest = hashlib.md5(h.tobytes()).digest()
            n.append(len(h))
            f1.append(int.from_bytes(digest[:8], "little", signed=True))
            f2.append(int.from_bytes(digest[8:], "little", signed=True))
            all_sketches.append(sketch(h))
        lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * COORDINATES, pa.array(np.concatenate(all_sketches)))
        return pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), lists], ["rid", "n", "f1", "f2", "sketch"])

    return map_rows(rows, work, "rid long, n long, f1 long, f2 long, sketch array<int>")


def leaves(reps: DataFrame, plan: Plan) -> DataFrame:
    """(leaf, n, cid): the buckets to compare by brute force and their members."""
    start = F.posexplode(F.slice("sketch", 1, plan.runs))
    nodes = reps.select("cid", start.alias("run", "value")).select(F.xxhash64("run", "value").alias("node"), "cid")
    sizes = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    level = settled(nodes.join(sizes, "node"))
    done = level.where(F.col("n") <= plan.small)
    large = level.where(F.col("n") > plan.small)
    for depth in range(1, plan.levels + 1):
        if large.isEmpty():
            break
        if depth == plan.levels:  # what agrees on so many coordinates is compared whole
            done = done.unionByName(large)
            break
        picks = F.explode(F.sequence(F.lit(0), F.lit(plan.branches - 1)))
        children = large.join(reps.select("cid", "sketch"), "cid").withColumn("pick", picks)
        children = children.withColumn("coordinate", F.pmod(F.xxhash64("node", F.lit("split"), "pick"), F.lit(COORDINATES)))
        children = children.withColumn("child", F.xxhash64("node", "coordinate", F.element_at("sketch", F.col("coordinate").cast("int") + 1)))
        children = settled(children.select("node", "n", "pick", "child", "cid"))
        counts = settled(children.groupBy("node", "n", "pick", "child").agg(F.count("*").alias("m")))
        same = counts.groupBy("node", "n").agg((F.sum(F.col("m").cast("double") * F.col("m")) / plan.branches).alias("pairs"))
        alike = settled(same.where(F.col("pairs") >= plan.alike * F.col("n").cast("double") * F.col("n")).select("node"))
        done = done.unionByName(large.join(alike, "node", "left_semi"))
        split = children.select("node", "child", "cid").distinct().join(alike, "node", "left_anti")
        level = settled(split.join(counts.groupBy("node", "child").agg(F.max("m").alias("n")).where("n > 1"), ["node", "child"]).select(F.col("child").alias("node"), "n", "cid"))
        done = done.unionByName(level.where(F.col("n") <= plan.small))
        large = level.where(F.col("n") > plan.small)
    return done.select(F.col("node").alias("leaf"), "n", "cid")


def candidate_pairs(blocks: DataFrame, plan: Plan) -> DataFrame:
    """(leaf, one, two, cid, weight, partners): members of blocks with the partners to verify, each pair once."""

    def choose(group: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        leaf, one, two = group
        cid, size, part = (rows.column(c).to_numpy() for c in ("cid", "size", "part"))
        order = np.argsort(cid, kind="stable")
        cid, size, part = cid[order], size[order], part[order]
        pairs = linking.eligible(part, one, two)
        pairs &= np.minimum.outer(size, size) >= plan.threshold * np.maximum.outer(size, size)
        a, b = np.nonzero(pairs)
        if not len(a):
            return
        values = linking.matrix(rows.column("sketch"), np.int32)[order]
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), 65536):
            part_of = slice(at, at + 65536)
            keep[part_of] = (values[a[part_of]] == values[b[part_of]]).sum(axis=1) >= plan.least_matches
        a, b = a[keep], b[keep]
        # a pair belongs to its first common leaf only
        lists = rows.column("leaves").combine_chunks().take(pa.array(order))
        owner = np.repeat(np.arange(len(cid)), lists.value_lengths().to_numpy(zero_copy_only=False))
        named = lists.flatten().to_numpy(zero_copy_only=False)
        earlier = named < leaf
        names, column = np.unique(named[earlier], return_inverse=True)
        for at in range(0, len(names), 4096):
            if not len(a):
                return
            inside = (column >= at) & (column < at + 4096)
            member = np.zeros((len(cid), min(4096, len(names) - at)), dtype=np.float32)
            member[owner[earlier][inside], column[inside] - at] = 1
            common = (member @ member.T) > 0
            new = ~common[a, b]
            a, b = a[new], b[new]
        if not len(a):
            return
        some = np.unique(np.concatenate([a, b]))
        counts = np.bincount(a, minlength=len(cid))
        partners = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32), pa.array(cid[b[np.argsort(a, kind="stable")]]))
        same = lambda v, kind: pa.array(np.full(len(some), v), kind)
        yield pa.RecordBatch.from_arrays([same(leaf, pa.int64()), same(one, pa.int32()), same(two, pa.int32()), pa.array(cid[some]), partners], ["leaf", "one", "two", "cid", "partners"])

    return map_groups(blocks, ["leaf", "one", "two"], choose, "leaf long, one int, two int, cid long, partners array<long>")


def similar(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the Jaccard similarity of each pair of sets reaches the threshold."""
    sizes = np.array([len(s) for s in sets])
    if len(a) * int(sizes.mean()) < len(sets) ** 2 * 8:
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)])
    else:  # many pairs: products of the sets' rows over the shingles that two sets have at least
        owner = np.repeat(np.arange(len(sets)), sizes)
        names, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        number = np.cumsum(shared) - 1
        owner, column = owner[shared[column]], number[column[shared[column]]]
        total = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for at in range(0, int(shared.sum()), 8192):
            inside = (column >= at) & (column < at + 8192)
            rows = np.zeros((len(sets), 8192), dtype=np.float32)
            rows[owner[inside], column[inside] - at] = 1
            total += rows @ rows.T
        common = np.rint(total[a, b]).astype(np.int64)
    return common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9


def verified(pairs: DataFrame, plan: Plan) -> DataFrame:
    """(cid, links, root) of blocks (leaf, one, two, cid, weight, partners, text)."""

    def compare(_: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cid, weight = rows.column("cid").to_numpy(), rows.column("weight").to_numpy()
        seen: dict[str, int] = {}
        sets = [shingles(t, seen) for t in rows.column("text").to_pylist()]
        order = np.argsort(cid, kind="stable")
        partners = rows.column("partners").combine_chunks()
        a = np.repeat(np.arange(len(cid)), partners.value_lengths().to_numpy(zero_copy_only=False))
        b = order[np.searchsorted(cid[order], partners.flatten().to_numpy(zero_copy_only=False))]
        good = similar(sets, a, b, plan.threshold)
        a, b = a[good], b[good]
        links = np.bincount(a, weight[b], len(cid)) + np.bincount(b, weight[a], len(cid))
        root = linking.roots(len(cid), a, b)
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(links[some].astype(np.int64)), pa.array(cid[root[some]])], ["cid", "links", "root"])

    return map_groups(pairs, ["leaf", "one", "two"], compare, "cid long, links long, root long")


def linked_rows(docs: DataFrame, plan: Plan = Plan()) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id, n_links, component_id, label) and (rid, text, row): the group of every row, and the row itself.

    ``rid`` numbers the rows; ``label`` is the rid that names a group, null for a row without links.
    """
    rows = settled(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row")))
    marks = settled(signatures(rows.select("rid", "text")))
    classes = settled(marks.where("n > 0").groupBy("f1", "f2").agg(F.min("rid").alias("cid"), F.count("*").alias("weight")))
    reps = settled(marks.join(classes.select("cid", "weight"), F.col("rid") == F.col("cid")).select("cid", "weight", F.col("n").alias("size"), "sketch"))
    # few sets have company: their sketches and texts alone travel, which Spark ensures
    # by runtime filters where a join's small side is a filtered scan (the filters hold for all rows)
    with runtime_filters(docs.sparkSession):
        buckets = settled(leaves(reps, plan)).where("n > 1")
        own = buckets.groupBy("cid").agg(F.collect_set("leaf").alias("leaves"))
        blocks = linking.in_blocks(buckets, "leaf", "cid", "n", plan.small)
        wide = blocks.join(reps.drop("weight").join(own, "cid"), "cid")
        pairs = settled(candidate_pairs(wide, plan))
        chosen = settled(pairs.select("cid").distinct()).where("cid >= 0")
        texts = settled(rows.select(F.col("rid").alias("cid"), "text").join(chosen, "cid", "left_semi"))
        found = settled(verified(pairs.join(reps.select("cid", "weight"), "cid").join(texts, "cid"), plan))
    listed = marks.select("rid", "f1", "f2", (F.col("n") > 0).alias("linked")).join(rows.select("rid", "doc_id"), "rid")
    return linking.per_row(listed, classes, found, "doc_id").select("rid", "doc_id", "n_links", "component_id", "label"), rows


def jaccard_join(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """(doc_id, class_id, n_links, kept): class_id is the smallest id that links reach."""
    rows, _ = linked_rows(docs.select("doc_id", "text"), plan)
    return rows.select("doc_id", F.col("component_id").alias("class_id"), "n_links", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs`` without links, and of every group the row with the smallest id (of repeated ids, one row)."""
    marked, rows = linked_rows(docs, plan)
    first = marked.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first"))
    keep = marked.where("label is null").select("rid").unionByName(first.select("first.rid"))
    return rows.join(keep, "rid").select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
