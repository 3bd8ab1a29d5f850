"""Baselines that only read labels: persistence, historical mode, majority."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def persistence(labelled: DataFrame) -> DataFrame:
    """Predict the previous week's label of the same unit and weekday (0 in week 0)."""
    by_week = Window.partitionBy("unit_id", "dow").orderBy("week_idx")
    return labelled.withColumn("pred", F.coalesce(F.lag("label", 1).over(by_week), F.lit(0)))


def historical_mode(labelled: DataFrame) -> DataFrame:
    """Predict the most frequent training label of the unit and weekday, lowest on ties."""
    group = Window.partitionBy("unit_id", "dow")
    train = F.col("split") == "train"
    tally = [F.count_if(train & (F.col("label") == k)).over(group) for k in range(3)]
    counts = F.array(*tally)
    pick = (F.array_position(F.col("_tally"), F.array_max("_tally")) - 1).cast("int")
    return labelled.withColumn("_tally", counts).withColumn("pred", pick).drop("_tally")


def majority(labelled: DataFrame) -> DataFrame:
    """Predict the most frequent label of the eligible training rows, lowest on ties."""
    rows = labelled.filter((F.col("split") == "train") & F.col("eligible"))
    top = rows.agg(F.mode("label", True).alias("pred"))
    return labelled.withColumn("pred", top.scalar())
