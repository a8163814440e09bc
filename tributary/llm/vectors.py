"""Near-duplicate vectors by p-stable hashing with exact cosine checks.

Vectors of length one within cosine ``c`` are within Euclidean distance
sqrt(2 - 2c).  A table hashes a vector to the quantised values of a few random
Gaussian projections; two vectors that share a bucket in any table are compared.
Buckets hold ids and sketches, the signs of SKETCH further projections, and only
those members travel on that have a partner with as few differing signs as a
pair at the threshold may have: first with their keys, to leave each pair to the
first table that brings it together, then with their vectors, to be compared
exactly.  The number of projections follows the number of vectors, so that
buckets of unrelated vectors stay small, and the number of tables follows from
the recall wanted for a pair right at the threshold; closer pairs are missed
far more rarely.  Equal vectors are one class and compared once.

Defined cases: null or zero vectors and such with null or non-finite parts
link with nothing; vectors of different lengths do not link; repeated rows
link as equal vectors; a null id takes part, and never names a component
unless the component has no other; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import linking
from tributary.llm.common import map_groups
from tributary.session import settled

WIDTH = 2.0
FEW = 1024  # unrelated vectors in a bucket, about: sketches are compared cheaply, and larger buckets need fewer tables for the same recall
SEED = 5
RECALL = 0.99999  # of a pair right at the threshold
SKETCH = 256  # signs
SKETCH_MISS = 1e-7  # chance that a pair at the threshold differs in more signs than are allowed
SKETCH_CHUNK = 2048  # members of a bucket that are compared at once
STRIP = 256


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection agrees for two points at this distance."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    k = max(2, math.ceil(math.log(max(n, 2) / FEW) / math.log(1 / far))) if n > FEW else 2
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))


def bucket_keys(units: np.ndarray, k: int, tables: int) -> np.ndarray:
    """One key per table for every row of length one."""
    rng = np.random.RandomState(SEED)
    directions = rng.standard_normal((units.shape[1], tables * k))
    shift = rng.uniform(0, WIDTH, tables * k)
    cells = np.floor((units @ directions + shift) / WIDTH).astype(np.int64).reshape(len(units), tables, k)
    key = np.full((len(units), tables), units.shape[1], dtype=np.uint64)
    for i in range(k):
        key = (key ^ cells[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(units: np.ndarray) -> np.ndarray:
    """Signs of SKETCH projections of every row of length one, 64 to a number."""
    directions = np.random.RandomState(SEED + 1).standard_normal((units.shape[1], SKETCH))
    return np.packbits(units @ directions > 0, axis=1, bitorder="little").view("<u8").astype(np.uint64)


def sign_limit(threshold: float) -> int:
    """Most signs in which a pair at the threshold differs, but for a chance of SKETCH_MISS."""
    p = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    left = 1.0
    for d in range(SKETCH + 1):
        left -= math.comb(SKETCH, d) * p**d * (1 - p) ** (SKETCH - d)
        if left <= SKETCH_MISS:
            return d
    return SKETCH


def partners(sketches: np.ndarray, part: np.ndarray, one: int, two: int, limit: int, keys: np.ndarray | None = None, table: int = 0) -> np.ndarray:
    """Which members of a block have a partner in it that they may be near to; with ``keys``, one not met in an earlier table."""
    n = len(sketches)
    found = np.zeros(n, dtype=bool)
    for a in range(0, n, STRIP):
        strip = slice(a, min(a + STRIP, n))
        differ = sum(np.bitwise_count(sketches[strip, None, i] ^ sketches[None, :, i]).astype(np.int16) for i in range(sketches.shape[1]))
        near = differ <= limit
        near[np.arange(near.shape[0]), np.arange(a, a + near.shape[0])] = False
        if one != two:
            near &= part[strip, None] != part[None, :]
        if keys is not None and table:
            i, j = np.nonzero(near)
            met = (keys[a + i, :table] == keys[j, :table]).any(axis=1)
            near[i[met], j[met]] = False
        found[strip] |= near.any(axis=1)
    return found


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    embedding = F.col("embedding").cast("array<double>")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists(embedding, lambda x: x != 0)
    rows = settled(vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"),
        F.coalesce(finite & nonzero, F.lit(False)).alias("linked")))
    rows = rows.withColumn("f1", F.xxhash64("embedding")).withColumn("f2", F.xxhash64(F.lit(1), "embedding"))
    classes = settled(rows.where("linked").groupBy("f1", "f2").agg(F.min("rid").alias("cid"), F.count("*").alias("weight")))
    k, tables = plan(classes.count(), threshold, recall)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("embedding")
            lengths = values.value_lengths().to_numpy(zero_copy_only=False)
            keys = np.zeros((batch.num_rows, tables), dtype=np.int32)
            signs = np.zeros((batch.num_rows, SKETCH // 64), dtype=np.uint64)
            flat, cuts = values.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                v = np.stack([flat[cuts[i] : cuts[i] + d] for i in at])
                v = v / np.abs(v).max(axis=1, keepdims=True)
                units = v / np.linalg.norm(v, axis=1, keepdims=True)
                keys[at], signs[at] = bucket_keys(units, k, tables), sketch(units)
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * tables, pa.array(keys.ravel()))
            columns = [pa.array(signs[:, i].view(np.int64)) for i in range(signs.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("weight"), values, lists, *columns], ["cid", "weight", "embedding", "keys", *signs_of])

    signs_of = [f"s{i}" for i in range(SKETCH // 64)]
    limit = sign_limit(threshold)
    reps = rows.join(classes.select("cid", "weight"), F.col("rid") == F.col("cid")).select("cid", "weight", "embedding")
    reps = settled(reps.mapInArrow(hashed, "cid long, weight long, embedding array<double>, keys array<int>, " + ", ".join(f"{c} long" for c in signs_of)))
    members = reps.select("cid", *signs_of, F.posexplode("keys").alias("table", "key"))
    # only the counts of large buckets are needed: those are dealt into chunks and compared by pairs of chunks
    large = settled(members.groupBy("table", "key").agg(F.count("*").alias("n")).where(F.col("n") > SKETCH_CHUNK))
    whole = members.join(large.select("table", "key"), ["table", "key"], "left_anti").select("*", *[F.lit(0).alias(c) for c in ("part", "one", "two")])
    dealt = members.join(large, ["table", "key"]).withColumn("bucket", F.xxhash64("table", "key"))
    dealt = linking.in_blocks(dealt, "bucket", "cid", "n", SKETCH_CHUNK).select(*whole.columns)
    place = ["table", "key", "one", "two"]

    def alike(group: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        part = rows.column("part").to_numpy()
        signs = np.stack([rows.column(c).to_numpy().view(np.uint64) for c in signs_of], axis=1)
        keys = linking.matrix(rows.column("keys"), np.int32) if "keys" in rows.column_names else None
        some = np.flatnonzero(partners(signs, part, group[2], group[3], limit, keys, int(group[0])))
        if len(some):
            fixed = [pa.array(np.full(len(some), v, dtype=np.int32)) for v in group]
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(part[some].astype(np.int32)), pa.array(rows.column("cid").to_numpy()[some])], [*place, "part", "cid"])

    schema = "table int, key int, one int, two int, part int, cid long"
    near = settled(map_groups(whole.unionByName(dealt), place, alike, schema))
    # the same with keys: a pair is left to the first table that brings it together
    keyed = near.join(reps.select("cid", "keys", *signs_of), "cid")
    blocks = settled(map_groups(keyed, place, alike, schema))

    def compare(group: tuple, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        table, _, one, two = group
        cid, weight, part = (rows.column(c).to_numpy() for c in ("cid", "weight", "part"))
        lengths = rows.column("embedding").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        out = []
        for d in np.unique(lengths):  # a hashed key may bring lengths together; they do not link
            at = np.flatnonzero(lengths == d)
            if len(at) < 2:
                continue
            v = linking.matrix(rows.column("embedding").take(pa.array(at)), np.float64)
            v = v / np.abs(v).max(axis=1, keepdims=True)
            length = np.linalg.norm(v, axis=1)
            a, b = np.nonzero((v @ v.T >= threshold * np.outer(length, length)) & linking.eligible(part[at], one, two))
            keys = linking.matrix(rows.column("keys").take(pa.array(at)), np.int32)[:, :table]
            new = ~(keys[a] == keys[b]).any(axis=1)  # a pair counts in the first table that brings it together
            a, b = a[new], b[new]
            if len(a):
                w = weight[at]
                links = np.bincount(a, w[b], len(at)) + np.bincount(b, w[a], len(at))
                root = linking.roots(len(at), a, b)
                some = np.flatnonzero(links)
                out.append((cid[at][some], links[some].astype(np.int64), cid[at][root[some]]))
        for columns in out:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["cid", "links", "root"])

    wide = blocks.join(reps.select("cid", "weight", "embedding", "keys"), "cid")
    found = map_groups(wide, place, compare, "cid long, links long, root long")
    result = linking.per_row(rows.select("rid", "vec_id", "f1", "f2", "linked"), classes, settled(found), "vec_id")
    return result.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
