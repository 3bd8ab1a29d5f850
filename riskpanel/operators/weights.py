"""Class weights that balance the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_weights(rows: DataFrame, label: str = "label", n_classes: int = 3, power: float = 1.0) -> DataFrame:
    """``(label, cells, weight)`` with weight (n / (K n_k))^power, 0 for an absent class."""
    tally = rows.agg(*[F.count_if(F.col(label) == k).alias(f"c{k}") for k in range(n_classes)])
    long = tally.select(
        F.posexplode(F.array(*[F.col(f"c{k}") for k in range(n_classes)])).alias("label", "cells")
    )
    total = F.sum("cells").over(Window.partitionBy(F.lit(0)))  # one row per class
    balanced = F.pow(total / (F.lit(n_classes) * F.col("cells")), F.lit(float(power)))
    return long.select(
        "label", "cells", F.when(F.col("cells") > 0, balanced).otherwise(F.lit(0.0)).alias("weight")
    )


def with_row_weights(rows: DataFrame, weights: DataFrame, label: str = "label") -> DataFrame:
    """Add each row's class weight (a lookup in one row per class)."""
    lookup = F.broadcast(weights.select(F.col("label").alias("_label"), "weight"))
    return rows.join(lookup, F.col(label) == F.col("_label"), "left").drop("_label")
