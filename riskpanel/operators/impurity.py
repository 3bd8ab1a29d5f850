"""Weighted Gini impurity and the best binned split, per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a split must beat the parent's impurity by more than this.
MIN_IMPROVEMENT = 1e-12


def gini(class_sums: Sequence[Column]) -> Column:
    """1 - sum of squared class shares; 0 for an empty node."""
    total = reduce(add, class_sums)
    squares = reduce(add, [F.try_divide(w, total) * F.try_divide(w, total) for w in class_sums])
    return F.when(total > 0, F.lit(1.0) - squares).otherwise(F.lit(0.0))


def _class_sums(label: str, weight: str, n_classes: int) -> list[Column]:
    w = F.col(weight)
    return [
        F.sum(F.when(F.col(label) == k, w).otherwise(F.lit(0.0))).alias(f"w{k}") for k in range(n_classes)
    ]


def gini_by_group(
    rows: DataFrame, groups: Sequence[str], label: str = "label", weight: str = "weight", n_classes: int = 3
) -> DataFrame:
    sums = rows.groupBy(*groups).agg(F.count("*").alias("cells"), *_class_sums(label, weight, n_classes))
    return sums.select(*groups, "cells", gini([F.col(f"w{k}") for k in range(n_classes)]).alias("impurity"))


def best_split(
    rows: DataFrame,
    features: Sequence[str],
    groups: Sequence[str] = (),
    *,
    label: str = "label",
    weight: str = "weight",
    min_leaf: int = 5,
    n_bins: int = 32,
    n_classes: int = 3,
) -> DataFrame:
    """The cut "bin <= b" with the least weighted impurity, one row per group.

    Rows are reduced to a histogram per (group, feature, bin); both children
    need ``min_leaf`` rows. Ties go to the first feature, then the first bin.
    Groups that no cut improves are left out.
    """
    groups = list(groups)
    classes = range(n_classes)
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("feature_idx"), F.lit(f).alias("feature"), F.col(f).cast("int").alias("bin"))
            for i, f in enumerate(features)
        ]
    )
    long = rows.select(*groups, F.col(label).alias("_y"), F.col(weight).alias("_w"), F.explode(entries).alias("e"))
    keys = [*groups, "feature_idx", "feature"]
    bins = (
        long.select(*groups, "_y", "_w", "e.*")
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("cells"), *_class_sums("_y", "_w", n_classes))
    )
    node = Window.partitionBy(*keys)  # at most n_bins rows each
    upto = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = bins.select(
        *keys,
        "bin",
        F.sum("cells").over(upto).alias("n_left"),
        F.sum("cells").over(node).alias("n_all"),
        *[F.sum(f"w{k}").over(upto).alias(f"l{k}") for k in classes],
        *[F.sum(f"w{k}").over(node).alias(f"t{k}") for k in classes],
    )
    left = [F.col(f"l{k}") for k in classes]
    total = [F.col(f"t{k}") for k in classes]
    right = [t - lft for t, lft in zip(total, left)]
    whole = reduce(add, total)
    children = (reduce(add, left) * gini(left) + reduce(add, right) * gini(right)) / whole
    cuts = (
        sums.filter((F.col("n_left") >= min_leaf) & (F.col("n_all") - F.col("n_left") >= min_leaf))
        .filter(F.col("bin") < n_bins - 1)
        .withColumn("parent", gini(total))
        .withColumn("whole", whole)
        .withColumn("criterion", children)
        .filter(F.col("criterion") < F.col("parent") - MIN_IMPROVEMENT)
    )
    first = F.struct(F.round("criterion", 12), "feature_idx", "bin")
    pick = F.struct("feature", "bin", ((F.col("parent") - F.col("criterion")) * F.col("whole")).alias("gain"))
    best = F.min_by(pick, first).alias("best")
    chosen = cuts.groupBy(*groups).agg(best) if groups else cuts.agg(best).filter(F.col("best").isNotNull())
    return chosen.select(*groups, "best.feature", "best.bin", "best.gain")
