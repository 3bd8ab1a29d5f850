"""Quantile bins per feature, fitted on eligible training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import quantile_aggregates, running_total

N_BINS = 32


def feature_histogram(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per distinct value of each feature, partially aggregated before the shuffle."""
    values = rows.select(*[F.col(f).cast("double").alias(f) for f in features])
    long = values.unpivot([], list(features), "feature", "value")
    return long.groupBy("feature", "value").agg(F.count("*").alias("cells"))


def fit_bin_edges(rows: DataFrame, features: Sequence[str], n_bins: int = N_BINS) -> DataFrame:
    """``(feature, edges ARRAY<DOUBLE>)``: each edge is the upper bound of its bin.

    A feature with at most ``n_bins`` distinct values is cut at each of them but
    the largest; a constant is cut below its value. Others are cut at their
    distinct interior quantiles, computed exactly on the distributed histogram.
    """
    histogram = feature_histogram(rows, features).withColumn("one", F.lit(1))
    ranked = running_total(histogram, "value", ["cells", "one"], ["feature"])
    few = F.col("one_total") <= n_bins
    aggregates, quantiles = quantile_aggregates("value", "cells", [k / n_bins for k in range(1, n_bins)])
    fitted = ranked.groupBy("feature").agg(
        F.sort_array(F.collect_list(F.when(few, F.col("value")))).alias("v"),  # at most n_bins values
        *aggregates,
    )
    below_largest = F.slice("v", F.lit(1), F.size("v") - 1)
    return fitted.select(
        "feature",
        F.when(F.size("v") == 0, F.array_distinct(quantiles))
        .when(F.size("v") == 1, F.array(F.col("v")[0] - 1))
        .otherwise(below_largest)
        .alias("edges"),
    )


def apply_bins(rows: DataFrame, edges: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace each feature by its bin: the number of edges strictly below the value."""
    table = edges.agg(F.map_from_entries(F.collect_list(F.struct("feature", "edges"))).alias("cuts"))
    keyed = rows.withColumn("cuts", table.scalar())  # eleven short arrays

    def bin_of(feature: str) -> Column:
        return F.size(F.filter(F.col("cuts")[feature], lambda edge: edge < F.col(feature))).cast("int")

    return keyed.withColumns({f: bin_of(f) for f in features}).drop("cuts")
