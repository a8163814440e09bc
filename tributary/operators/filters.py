"""Filters steered by control tables: thresholds, keywords, pauses, tenants."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.intervals import floor_div, seconds
from tributary.session import settled


def threshold_filter(df: DataFrame, column: str, threshold: DataFrame, default: float = 0.0) -> DataFrame:
    """Rows above the one value in ``threshold``; 0 when it is empty or not a number."""
    name = threshold.columns[0]
    limit = threshold.agg(F.coalesce(F.max(F.col(name).try_cast("double")), F.lit(default)).alias("limit"))
    return df.where(F.col(column) > limit.scalar())


def _one_of(words: set[str]) -> str:
    """A regular expression for any of the words, with common beginnings shared."""
    if "" in words:  # whatever follows, this much is enough
        return ""
    by_first: dict[str, set[str]] = {}
    for w in words:
        by_first.setdefault(w[0], set()).add(w[1:])
    parts = [re.escape(c) + _one_of(rest) for c, rest in sorted(by_first.items())]
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def keyword_filter(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Rows whose text contains a keyword, ignoring case; an empty keyword is in every text.

    ``keywords`` is a control list of the application, of any length: it
    becomes one expression that shares common beginnings.
    """
    if not keywords:
        return df.limit(0)
    return df.where(F.col(text).rlike("(?iu)" + _one_of(set(keywords))))


def pause_intervals(commands: DataFrame, time: str, command: str) -> DataFrame:
    """Commands -> pause intervals [paused, resumed); an open pause has no end.

    At equal times resume wins.  Commands without a time are ignored.  The
    control table holds an operator's commands, few beside the rows.
    """
    known = commands.where(F.lower(command).isin("pause", "resume") & F.col(time).isNotNull()).select(time, F.lower(command).alias("c"))
    order = Window.orderBy(time, "c")
    turns = known.withColumn("before", F.lag("c").over(order)).where(F.col("c") != F.coalesce("before", F.lit("resume")))
    return turns.withColumn("resumed", F.lead(time).over(order)).where("c = 'pause'").select(F.col(time).alias("paused"), "resumed")


def pause_gate(df: DataFrame, commands: DataFrame, time: str, command_time: str, command: str, slot: str = "1 day") -> DataFrame:
    """Drop rows that arrive while paused; rows without a time stay.

    Pauses are listed per time slot they touch and joined to the rows by slot,
    so a row meets the pauses of its own slot only.  The list is small beside
    the rows, and Catalyst broadcasts it whenever its size allows.
    """
    width = seconds(slot) * 1_000_000
    spans = settled(pause_intervals(commands, command_time, command))
    open_since = spans.where("resumed is null").agg(F.min("paused").alias("since"))
    closed = spans.where("resumed is not null and resumed > paused")
    slots = F.sequence(floor_div(F.unix_micros("paused"), width), floor_div(F.unix_micros("resumed") - 1, width))
    per_slot = closed.withColumn("__slot", F.explode(slots)).groupBy("__slot").agg(F.collect_list(F.struct("paused", "resumed")).alias("__spans"))
    inside = F.exists("__spans", lambda s: (F.col(time) >= s["paused"]) & (F.col(time) < s["resumed"]))
    never_again = F.col(time) >= open_since.scalar()
    paused = F.coalesce(inside, F.lit(False)) | F.coalesce(never_again, F.lit(False))
    return df.withColumn("__slot", floor_div(F.unix_micros(time), width)).join(per_slot, "__slot", "left").where(~paused).select(*df.columns)


def route_by_tenant(df: DataFrame, tenants: DataFrame, tenant: str, api_key: str) -> DataFrame:
    """Add ``topic``: the tenant's own, ``unknown`` without producer, ``unauthorized`` on a bad key.

    ``tenants`` has tenant_id, key and has_producer.
    """
    side = tenants.select(F.col("tenant_id").alias("__t"), F.col("key").alias("__k"), F.col("has_producer").alias("__p"))
    joined = df.join(side, F.col(tenant) == F.col("__t"), "left")
    allowed = F.coalesce(F.col("__k") == F.col(api_key), F.lit(False))
    own = F.concat(F.lit("science-"), F.col(tenant))
    topic = F.when(~allowed, "unauthorized").when(F.col("__p"), own).otherwise("unknown")
    return joined.withColumn("topic", topic).drop("__t", "__k", "__p")


def envelope(session: str, time: str, tenant: str, body: str, batch: str | None = None, index: str | None = None) -> Column:
    """A routed row's message: session, time in milliseconds, tenant, its place in an upload if it has one, and the body."""
    place = [F.col(c).alias(n) for n, c in (("batch", batch), ("index", index)) if c]
    return F.to_json(F.struct(F.col(session).alias("session"), F.unix_millis(time).alias("time"), F.col(tenant).alias("tenant"), *place, F.col(body).alias("body")))


def batch_upload_lines(df: DataFrame, body: str) -> DataFrame:
    """One row per non-blank line of an upload, numbered from 0."""
    lines = F.filter(F.split(body, "\n"), lambda line: F.trim(line) != "")
    rest = [c for c in df.columns if c != body]
    return df.select(*rest, F.posexplode(lines).alias("index", "line"))
