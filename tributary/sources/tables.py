"""The driver tables, read with fixed schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp"
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; the timestamps become TIMESTAMP, fit for watermarks.

    The schema is given, so no inference job runs and filters on the time
    column still reach the parquet scan.
    """
    df = spark.read.schema(table_schema(name)).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def without_zone(df: DataFrame) -> DataFrame:
    """Give zone-less timestamps back, as the tables store them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


@dataclass(frozen=True)
class Tables:
    """Handle on one data folder: ``t("events", "ts", "value")``."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str, *columns: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, *columns)
