"""Column functions: casts, parsing, labels, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Horsepower-style brackets (upper bound, label); above the last one "200+".
BRACKETS = [(100, "0-100"), (150, "101-150"), (200, "151-200")]
TOP_BRACKET = "200+"

# Sentiment labels by upper score bound; below 0 and from 5 up nothing is understood.
SENTIMENT_LABELS = [
    (1, "VERY_NEGATIVE"),
    (2, "NEGATIVE"),
    (3, "NEUTRAL"),
    (4, "POSITIVE"),
    (5, "VERY_POSITIVE"),
]
NOT_UNDERSTOOD = "NOT_UNDERSTOOD"


def not_equal(column: str, value) -> Column:
    """Rows with another value; null rows do not qualify."""
    return F.col(column) != F.lit(value)


def at_most_chars(column: str, n: int = 5) -> Column:
    return F.length(column) <= n


def cast_number(column: str, kind: str = "int") -> Column:
    """Number from text, null when it is not one (never an error)."""
    return F.col(column).try_cast(kind)


def from_epoch_ms(column: str) -> Column:
    return F.timestamp_millis(F.col(column))


def key_mod(column: str, m: int = 100) -> Column:
    return (F.col(column) % m).cast("string")


def split_field(column: str, index: int, sep: str = ",", kind: str = "string") -> Column:
    """Field ``index`` (from 0) of a separated line, null when missing or not a ``kind``."""
    return F.try_element_at(F.split(column, sep), F.lit(index + 1)).try_cast(kind)


def extract_time(column: str) -> Column:
    """The time after ``timestamp=``; null without the marker."""
    text = F.regexp_extract(column, "timestamp=([^,]+)", 1)
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def lag_seconds(later: str, earlier: str) -> Column:
    """Whole-second difference (both sides are cut to seconds first)."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def lag_millis(later: str, earlier: str) -> Column:
    return lag_seconds(later, earlier) * 1000


def numeric_only(df: DataFrame, column: str, name: str = "number") -> DataFrame:
    """Keep texts of digits only and add them as double."""
    return df.where(F.col(column).rlike(r"^\d+$")).withColumn(name, F.col(column).cast("double"))


def prefix_id(column: str, n: int = 3) -> Column:
    return F.substring(column, 1, n)


def bracket(column: str) -> Column:
    out = None
    for bound, label in BRACKETS:
        rule = F.col(column) <= bound
        out = F.when(rule, label) if out is None else out.when(rule, label)
    return out.otherwise(TOP_BRACKET)


def sentiment_label(score: Column) -> Column:
    out = F.when(score < 0, NOT_UNDERSTOOD)
    for bound, label in SENTIMENT_LABELS:
        out = out.when(score < bound, label)
    return out.otherwise(NOT_UNDERSTOOD)


def age_years(birth: str, asof: Column) -> Column:
    """Completed years between two dates."""
    before_birthday = F.date_format(asof, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(asof) - F.year(birth) - before_birthday.cast("int")


def describe_post(name: Column, followers: Column, text: Column, label: Column | None = None) -> Column:
    says = F.lit(" followers) says: ") if label is None else F.concat(F.lit(" followers) says "), label, F.lit(": "))
    return F.concat(F.lit("User "), name, F.lit(" ("), followers.cast("string"), says, text)


def explode_fields(columns: Sequence[str], name: str = "field") -> Column:
    return F.explode(F.array(*columns)).alias(name)


def words(column: str, name: str = "word") -> Column:
    """One row per piece between single spaces."""
    return F.explode(F.split(column, " ")).alias(name)


def hashtags(df: DataFrame, text: str, name: str = "hashtag") -> DataFrame:
    return df.select(*[c for c in df.columns if c != text], words(text, name)).where(
        F.col(name).startswith("#")
    )


def above(column: str, limit: float) -> Column:
    return F.col(column) > limit


def null_safe_above(column: str, limit: float, default: float = 0) -> Column:
    return F.coalesce(F.col(column), F.lit(default)) > limit


def normalize_text(column: str) -> Column:
    """Lower case; only ASCII letters, digits and white space stay."""
    return F.regexp_replace(F.lower(column), r"[^a-zA-Z0-9\s]", "")


def flatten_window(df: DataFrame, column: str = "window") -> DataFrame:
    rest = [c for c in df.columns if c != column]
    return df.select(F.col(f"{column}.start").alias("start"), F.col(f"{column}.end").alias("end"), *rest)
