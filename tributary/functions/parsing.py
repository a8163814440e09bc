"""Text to typed rows, with the broken rows set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BROKEN = "_broken"


def _with_broken(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BROKEN, StringType())])


def parse_json(df: DataFrame, column: str, schema: str | StructType, name: str = "parsed") -> DataFrame:
    """Add struct ``name`` and boolean ``valid``.

    PERMISSIVE parsing gives a struct of nulls for text that is not JSON, so
    validity comes from the corrupt-record column and a blank-text test.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(column, _with_broken(fields), {"columnNameOfCorruptRecord": BROKEN})
    ok = F.col(name).isNotNull() & F.col(f"{name}.{BROKEN}").isNull() & (F.trim(column) != "")
    return df.withColumn(name, parsed).withColumn("valid", F.coalesce(ok, F.lit(False)))


def json_columns(df: DataFrame, column: str, schema: str | StructType) -> DataFrame:
    """Replace the JSON text by its fields."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.from_json(column, fields).alias("__j")).select(*rest, "__j.*")


def split_valid_json(df: DataFrame, column: str, schema: str | StructType) -> tuple[DataFrame, DataFrame]:
    """(valid rows as columns, invalid original rows)."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rest = [c for c in df.columns if c != column]
    parsed = parse_json(df, column, fields, "__j")
    valid = parsed.where("valid").select(*rest, *[F.col(f"__j.{f.name}") for f in fields.fields])
    return valid, parsed.where(~F.col("valid")).select(*rest, column)


def parse_positional(df: DataFrame, column: str, schema: str, sep: str = ":", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Separated line to typed columns."""
    rest = [c for c in df.columns if c != column]
    options = {"sep": sep, "dateFormat": date_format}
    return df.select(*rest, F.from_csv(column, schema, options).alias("__c")).select(*rest, "__c.*")


def dead_letter_csv(df: DataFrame, column: str = "value", date_format: str = "MMM d yyyy") -> tuple[DataFrame, DataFrame]:
    """Stock lines ``company,date,value`` -> (valid, errors).

    A line without exactly three fields is ``Malformed line: ...``; one whose
    date or number does not parse is ``Error parsing line: ...``.
    """
    rest = [c for c in df.columns if c != column]
    fields = F.split(column, ",")
    typed = df.withColumns(
        {
            "__n": F.size(fields),
            "__date": F.to_date(F.try_to_timestamp(F.try_element_at(fields, F.lit(2)), F.lit(date_format))),
            "__value": F.try_element_at(fields, F.lit(3)).try_cast("double"),
        }
    )
    good = (F.col("__n") == 3) & F.col("__date").isNotNull() & F.col("__value").isNotNull()
    valid = typed.where(good).select(
        *rest, fields[0].alias("company"), F.col("__date").alias("date"), F.col("__value").alias("value")
    )
    prefix = F.when(F.col("__n") == 3, "Error parsing line: ").otherwise("Malformed line: ")
    errors = typed.where(~F.coalesce(good, F.lit(False))).select(*rest, F.concat(prefix, F.col(column)).alias("error"))
    return valid, errors


ORDER_SCHEMA = "orderId string, customerId string, amount double, timestamp bigint"


def parse_orders_json(df: DataFrame, column: str = "value") -> DataFrame:
    """JSON orders as columns; rows that do not parse or lack a field are dropped."""
    valid, _ = split_valid_json(df, column, ORDER_SCHEMA)
    return valid.dropna(subset=["orderId", "customerId", "amount", "timestamp"])


def message_values(df: DataFrame) -> DataFrame:
    """Topic and decoded value of key/value messages."""
    return df.select("topic", F.col("value").cast("string").alias("actualValue"))


def to_key_value(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def to_json_key_value(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Key and the columns as one JSON text (null fields are left out)."""
    return to_key_value(df, F.col(key), F.to_json(F.struct(*columns)))
