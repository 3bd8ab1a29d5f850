"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel import session

#: Rows of an Arrow batch. Whole texts may be long, and Spark's 10,000 of them would be held
#: several times over, in the executor and in its Python workers.
BATCH_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, and let the session's Arrow batches be no larger than ``BATCH_ROWS``."""
    session.ship(spark)
    if not 0 < int(spark.conf.get(_ROWS_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_ROWS_SETTING, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_of(c: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def packed(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name of a caller's table can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def local_rows(spark: SparkSession, columns: dict[str, list], types: dict[str, str]) -> DataFrame:
    """A small constant table, built from literals only."""
    size = len(next(iter(columns.values())))
    if size == 0:
        return spark.range(0).select(*[F.lit(None).cast(types[c]).alias(c) for c in columns])
    rows = [F.struct(*[F.lit(columns[c][i]).cast(types[c]).alias(c) for c in columns]) for i in range(size)]
    return spark.range(1).select(F.inline(F.array(*rows)))
