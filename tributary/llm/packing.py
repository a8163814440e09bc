"""Packing documents into windows by non-negative least squares over length combinations.

A document's tokens fill whole windows first; what is left, its rest, is shorter
than a window.  Shallow combinations of rests fill a window exactly: some
pieces of one length and some of another.  How often each is used solves a
non-negative least squares problem against the histogram of rests, and is
rounded; a greedy walk over the combinations then packs what rounding left.
Rests that fit no combination any more are laid end to end and cut at window
ends, the last part at powers of two, so no sequence is padded.

Only the histogram, at most a window's length, goes through the driver.  Rests
are numbered per length, in tasks and then over tasks, and look up their place;
tokens are shuffled only for the rests that are cut.

Ids come from the byte-level BPE vocabulary, encoded with tiktoken where its
ranks are given, which yields the same ids as the tokenizers library several
times as fast; special tokens in a text are ordinary text.

Defined cases: a null text is empty and is its end mark alone; null and
repeated ids are separate rows; texts of any length are whole; ties between
combinations follow their order; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import runtime_filters, slices
from tributary.session import settled, ship_package

WINDOW = 2048
END = 1
DEPTH = 6  # pieces of a combination
SWEEPS = 60
PART_BITS = 40  # rows, windows and sequences of a part are numbered below 2^40


@lru_cache(maxsize=2)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, ident: str, ranks_path: str, pattern: str, window: int, end: int) -> DataFrame:
    """Rows by part and place: token counts, checksums of whole windows, the rest and running numbers of the part.

    ``nth`` numbers the part's rests of one length, ``windows_before`` its whole windows.
    """
    kind = docs.schema[ident].dataType.simpleString()
    schema = f"part int, place long, id {kind}, doc_tokens long, full_crcs array<long>, windows_before long, rest int, nth long, rest_crc long, rest_ids binary"

    def run(batches):
        encode = encoding(ranks_path, pattern).encode_ordinary
        part, place, windows = TaskContext.get().partitionId(), 0, 0
        seen = [0] * window

        for batch in batches:
            for some in slices(batch, 1 << 20) if batch.num_rows else ():
                out = []
                for text in some.column("text").to_pylist():
                    ids = np.array([*encode(text or ""), end], dtype="<u4")
                    full = len(ids) // window
                    left = ids[full * window :]
                    crcs = [crc(ids[k * window : (k + 1) * window]) for k in range(full)]
                    out.append((place, len(ids), crcs, windows, len(left), seen[len(left)], crc(left), left.tobytes()))
                    place, windows = place + 1, windows + full
                    seen[len(left)] += 1
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                names = ["part", "place", "id", "doc_tokens", "full_crcs", "windows_before", "rest", "nth", "rest_crc", "rest_ids"]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), part, dtype=np.int32)), arrays[0], some.column("id"), *arrays[1:]], names=names)

    return docs.select(F.col(ident).alias("id"), "text").mapInArrow(run, schema)


def combinations(lengths: list[int], window: int, depth: int = DEPTH) -> list[tuple[tuple[int, int], ...]]:
    """All ((length, pieces), ...) of one or two of the lengths, ``depth`` pieces at most, that fill a window exactly."""
    known, found = set(lengths), []
    for a in sorted(lengths, reverse=True):
        if window % a == 0 and window // a <= depth:
            found.append(((a, window // a),))
        for i, j in product(range(1, depth), repeat=2):
            if i + j <= depth and window > i * a and (window - i * a) % j == 0:
                b = (window - i * a) // j
                if b < a and b in known:
                    found.append(((a, i), (b, j)))
    return found


def least_squares(columns: list[tuple[tuple[int, int], ...]], target: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Non-negative counts x that minimise |A x - target|^2, by exact steps in one count at a time.

    Column ``p`` of A has the pieces of combination ``p`` by length.  Steps start
    at zero, so combinations that are not needed stay there.
    """
    left = {k: float(v) for k, v in target.items()}
    x = [0.0] * len(columns)
    norms = [sum(m * m for _, m in c) for c in columns]
    enough = 1e-6 * max(target.values(), default=0)
    for _ in range(sweeps):
        most = 0.0
        for p, c in enumerate(columns):
            step = sum(m * left[k] for k, m in c) / norms[p]
            if step < -x[p]:
                step = -x[p]
            if step:
                x[p] += step
                for k, m in c:
                    left[k] -= m * step
                most = max(most, abs(step))
        if most <= enough:
            break
    return x


def repeats(histogram: dict[int, int], window: int, depth: int = DEPTH) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """(combination, how often), never using more rests of a length than there are."""
    columns = combinations(sorted(histogram), window, depth)
    x = least_squares(columns, histogram)
    left, used = dict(histogram), [0] * len(columns)
    order = sorted(range(len(columns)), key=lambda p: (-x[p], p))
    for greedy in (False, True):  # first the rounded solution, then whatever still fits
        for p in order:
            n = min(left[k] // m for k, m in columns[p])
            n = n if greedy else min(n, round(x[p]))
            if n:
                used[p] += n
                for k, m in columns[p]:
                    left[k] -= m * n
    return [(c, n) for c, n in zip(columns, used) if n]


def powers(n: int) -> list[int]:
    """The powers of two that ``n`` is the sum of, falling."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def packed(docs: DataFrame, ranks_path: str, pattern: str, ident: str = "doc_id", window: int = WINDOW, end: int = END, depth: int = DEPTH) -> DataFrame:
    """Pieces (``ident``, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = settled(tokenised(docs, ident, ranks_path, pattern, window, end))
    counts = settled(rows.where("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n")))
    histogram = {r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = repeats(histogram, window, depth)

    # where the rests of a length go, by their number: a few ranges a length
    ranges, used, sequences = [], dict.fromkeys(histogram, 0), 0
    for combination, n in plan:
        offset = 0
        for length, pieces in combination:
            ranges.append((length, used[length], used[length] + n * pieces, sequences, pieces, offset))
            used[length] += n * pieces
            offset += length * pieces
        sequences += n
    # all other rests lie end to end, long ones first
    axis, at = [], 0
    for length in sorted(histogram, reverse=True):
        axis.append((length, used[length], at))
        at += (histogram[length] - used[length]) * length
    whole_end = at // window * window
    bounds = [whole_end]
    for n in powers(at - whole_end):
        bounds.append(bounds[-1] + n)

    ahead = F.sum("n").over(Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    light = rows.where("rest > 0").select("part", "place", "id", "doc_tokens", "rest", "nth", "rest_crc")
    light = light.join(counts.select("part", "rest", ahead.alias("ahead")), ["part", "rest"]).withColumn("rank", F.col("ahead") + F.col("nth")).drop("ahead", "nth")
    placed_at = spark.createDataFrame(ranges, "rest int, low long, high long, first long, pieces int, base int") if ranges else None
    axis_at = spark.createDataFrame(axis, "rest int, used long, axis long") if axis else None
    start = (F.col("doc_tokens") - F.col("rest")).alias("start")
    own = [F.col("id").alias(ident)]

    full = rows.where("size(full_crcs) > 0").select("id", "doc_tokens", "part", "windows_before", F.posexplode("full_crcs").alias("k", "ids_crc32")).select(
        *own, (F.col("k").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.shiftleft(F.col("part").cast("long") + 1, PART_BITS) + F.col("windows_before") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if axis_at is None:
        return full
    pieces = full
    if placed_at is not None:
        # one row per range: at most a few thousand, whatever the number of documents
        hit = light.join(F.broadcast(placed_at), "rest").where("rank >= low and rank < high")
        order = F.col("rank") - F.col("low")
        pieces = pieces.unionByName(hit.select(
            *own, start, F.col("rest").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
            (F.col("first") + F.floor(order / F.col("pieces"))).alias("sequence_id"), (F.col("base") + order % F.col("pieces") * F.col("rest")).cast("long").alias("offset")))

    laid = light.join(F.broadcast(axis_at), "rest").where("rank >= used").withColumn("from", F.col("axis") + (F.col("rank") - F.col("used")) * F.col("rest"))
    ends = F.array(*[F.lit(b).cast("long") for b in bounds])
    # how many of the last bounds are at or before a place; 1 where the whole windows have not ended
    index = lambda c: F.when(c < whole_end, F.floor(c / window)).otherwise(whole_end // window + F.size(F.filter(ends, lambda b: b <= c)) - 1)
    laid = laid.withColumn("first", index(F.col("from"))).withColumn("last", index(F.col("from") + F.col("rest") - 1))
    begin = F.when(F.col("first") * window < whole_end, F.col("first") * window).otherwise(F.element_at(ends, (F.col("first") - whole_end // window + 1).cast("int")))
    uncut = laid.where(F.col("first") == F.col("last")).select(
        *own, start, F.col("rest").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
        (F.lit(sequences) + F.col("first")).alias("sequence_id"), (F.col("from") - begin).cast("long").alias("offset"))
    cut = settled(laid.where(F.col("first") < F.col("last")).select("part", "place", "from"))

    def cuts(batches):
        for batch in batches:
            out = []
            for i, (a, tokens, ids) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("from", "doc_tokens", "rest_ids")))):
                ids = np.frombuffer(ids, dtype="<u4")
                done, before = 0, tokens - len(ids)
                while done < len(ids):
                    here = a + done
                    if here < whole_end:
                        sequence, low, high = here // window, here // window * window, (here // window + 1) * window
                    else:
                        k = max(k for k, b in enumerate(bounds) if b <= here)
                        sequence, low, high = whole_end // window + k, bounds[k], bounds[k + 1]
                    n = min(high - here, len(ids) - done)
                    out.append((i, before + done, n, crc(ids[done : done + n]), tokens, sequences + sequence, here - low))
                    done += n
            if out:
                columns = list(zip(*out))
                names = [ident, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(columns[0])), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names)

    kind = docs.schema[ident].dataType.simpleString()
    with runtime_filters(spark):  # few rests are cut: the others' tokens need not be shuffled
        tokens = rows.select("part", "place", "id", "doc_tokens", "rest_ids").join(cut, ["part", "place"])
        crossing = tokens.mapInArrow(cuts, f"`{ident}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
        return pieces.unionByName(uncut).unionByName(settled(crossing))
