"""Name -> (query, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import use_utc
from tributary.sources.tables import Tables, without_zone


@dataclass(frozen=True)
class Registered:
    name: str
    rows: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return without_zone(self.build(Tables(use_utc(spark), sf_dir)))


REGISTRY: dict[str, Registered] = {}


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Lists and dates as text, so that results compare the same everywhere."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), ",") if kinds[c].startswith("array") else F.col(c).cast("string") for c in columns}
    )


def query(name: str, rows: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` with its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Registered(name, tuple(rows.split()), build, sql)
        return build

    return register
