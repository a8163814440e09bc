"""Pieces of SQL the twins share."""

from __future__ import annotations


def start(seconds: int, ts: str = "ts") -> str:
    """Start of the tumbling window holding ``ts``."""
    w = seconds * 1_000_000
    return f"make_timestamp(epoch_us({ts}) // {w} * {w})"


def plus(ts: str, seconds: int) -> str:
    return f"({ts} + INTERVAL {seconds} SECOND)"


def slid(table: str, size: int, slide: int, ts: str = "ts") -> str:
    """``table`` once per sliding window, with columns ws and we."""
    s = slide * 1_000_000
    return (
        f"(SELECT *, make_timestamp((epoch_us({ts}) // {s} - k) * {s}) AS ws,"
        f" make_timestamp((epoch_us({ts}) // {s} - k) * {s} + {size * 1_000_000}) AS we"
        f" FROM {table}, range({size // slide}) r(k))"
    )


def sessioned(table: str, limit_us: int, key: str = "user_id", ts: str = "ts") -> str:
    """``table`` with column s: the start of the row's session."""
    return (
        f"(SELECT *, max(CASE WHEN opens THEN {ts} END) OVER (PARTITION BY {key} ORDER BY {ts}) AS s FROM"
        f" (SELECT *, coalesce(epoch_us({ts}) - lag(epoch_us({ts})) OVER (PARTITION BY {key} ORDER BY {ts}) >= {limit_us}, true) AS opens"
        f" FROM {table}))"
    )
