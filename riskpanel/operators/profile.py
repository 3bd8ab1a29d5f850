"""Read-only profile of an unfamiliar source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, normalise

# Header words that mark a column as a category, an area, a
# coordinate or a time.
CATEGORY_WORDS = ("TIPO", "CATEGORIA", "INCIDENTE", "SERVICIO")
AREA_WORDS = ("CANTON", "CIUDAD")
COORDINATE_WORDS = ("LAT", "LON", "LNG", "X", "Y", "COORD")
TIME_WORDS = ("FECHA", "HORA")


def columns_like(columns: Sequence[str], words: Sequence[str]) -> list[str]:
    return [c for c in columns if any(w in fold(c) for w in words)]


def null_shares(rows: DataFrame) -> DataFrame:
    """Percentage of NULLs per column, in one pass."""
    shares = rows.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("int")) * 100).alias(c) for c in rows.columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_pct")) for c in rows.columns]
    return shares.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def samples(rows: DataFrame, column: str, count: int = 3) -> DataFrame:
    """A few non-null values."""
    return rows.select(F.col(f"`{column}`").alias("value")).filter(F.col("value").isNotNull()).limit(count)


def top_values(rows: DataFrame, column: str, word: str, count: int = 12) -> DataFrame:
    """Most frequent normalised values and whether they contain ``word``."""
    text = normalise(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("nan")))
    tally = rows.groupBy(text.alias("value")).agg(F.count("*").alias("rows"))
    top = tally.orderBy(F.desc("rows"), "value").limit(count)
    return top.withColumn("flagged", F.contains("value", F.lit(word)))


def numeric_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range, NULL and zero percentages of columns that hold any number."""
    parsed = {c: F.col(f"`{c}`").try_cast("double") for c in columns}
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), number.alias("number")) for c, number in parsed.items()]
    )
    long = rows.select(F.explode(entries).alias("e")).select("e.*")
    profile = long.groupBy("column").agg(
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        (F.avg(F.col("number").isNull().cast("int")) * 100).alias("null_pct"),
        (F.avg(F.coalesce(F.col("number") == 0, F.lit(False)).cast("int")) * 100).alias("zero_pct"),
    )
    return profile.filter(F.col("min").isNotNull())


def value_counts(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per (keys, value); the mergeable table that a whole profile follows from."""
    return values.groupBy(*keys, "value").agg(F.count("*").alias("rows"))


def column_profile(counts: DataFrame, keys: Sequence[str], sample_size: int = 3) -> DataFrame:
    """Per column: rows, NULL share, range and zero share of its numbers, and a sample of its values.

    The sample are the values with the smallest digests, the same however the rows lie. Columns
    without any number have no range.
    """
    number = F.col("value").try_cast("double")
    finite = F.when(~F.isnan(number), number)
    sums = counts.withColumn("number", finite).groupBy(*keys).agg(
        F.sum("rows").alias("total"),
        F.sum(F.when(F.col("value").isNull(), F.col("rows")).otherwise(0)).alias("nulls"),
        F.count(F.when(F.col("value").isNotNull(), 1)).alias("distinct_values"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        F.sum(F.when(F.col("number") == 0, F.col("rows")).otherwise(0)).alias("zeros"),
    )
    share = lambda c: F.col(c) * 100.0 / F.col("total")
    order = Window.partitionBy(*keys).orderBy(F.md5(F.col("value").cast("binary")), "value")
    chosen = counts.filter(F.col("value").isNotNull()).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample_size)
    picked = F.sort_array(F.collect_list(F.struct("nth", "value")))  # at most sample_size values
    samples = chosen.groupBy(*keys).agg(F.transform(picked, lambda v: v["value"]).alias("sample"))
    none = F.array().cast("array<string>")
    return sums.join(samples, list(keys), "left").select(
        *keys,
        F.col("total").alias("rows"),
        share("nulls").alias("null_pct"),
        "distinct_values",
        F.coalesce("sample", none).alias("sample"),
        "min",
        "max",
        F.when(F.col("min").isNotNull(), share("zeros")).alias("zero_pct"),
    )


def frequent_values(counts: DataFrame, keys: Sequence[str], limit: int = 12) -> DataFrame:
    """The most frequent normalised values per column, in order: ``nth``, ``value``, ``rows``; NULL reads as ``nan``."""
    text = normalise(F.coalesce("value", F.lit("nan")))
    merged = counts.select(*keys, text.alias("value"), "rows").groupBy(*keys, "value").agg(F.sum("rows").alias("rows"))
    order = Window.partitionBy(*keys).orderBy(F.desc("rows"), "value")
    return merged.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= limit)
