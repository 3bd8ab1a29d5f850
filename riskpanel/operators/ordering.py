"""Running totals and exact quantiles that never sort a whole column in one task.

Both start from rows that are already aggregated to distinct values, so a value
shared by a third of the data is a single row. Rows are range-partitioned,
written once, summed per range, and only the per-range sums (one row per range
and group) are accumulated, as short arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def running_total(
    distinct_rows: DataFrame,
    order: str,
    amounts: Sequence[str],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Add ``<amount>_before`` (exclusive running sum by ``order``) and ``<amount>_total``.

    ``distinct_rows`` holds one row per (groups, order) value.
    """
    groups = list(groups)
    ranged = materialise(
        distinct_rows.repartitionByRange(*groups, order).withColumn("range_id", F.spark_partition_id()),
        "ranges",
    )
    sums = ranged.groupBy(*groups, "range_id").agg(*[F.sum(a).alias(f"{a}_sum") for a in amounts])
    listed = F.sort_array(F.collect_list(F.struct("range_id", *[f"{a}_sum" for a in amounts]))).alias("listed")
    listed = sums.groupBy(*groups).agg(listed) if groups else sums.agg(listed)  # one entry per range

    def added(values: Column, name: str) -> Column:
        return F.aggregate(values, F.lit(0).cast(kinds[f"{name}_sum"]), lambda total, x: total + F.coalesce(x[f"{name}_sum"], F.lit(0)))

    kinds = dict(sums.dtypes)
    places = listed.select(*groups, "listed", F.posexplode("listed").alias("place", "range"))
    earlier = F.slice("listed", F.lit(1), F.col("place"))
    offsets = places.select(
        *groups,
        F.col("range.range_id").alias("range_id"),
        *[added(earlier, a).alias(f"{a}_offset") for a in amounts],
        *[added(F.col("listed"), a).alias(f"{a}_total") for a in amounts],
    )
    within = (
        Window.partitionBy("range_id", *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = ranged.join(offsets, [*groups, "range_id"])
    return joined.select(
        *distinct_rows.columns,
        *[
            (F.col(f"{a}_offset") + F.coalesce(F.sum(a).over(within), F.lit(0))).alias(f"{a}_before")
            for a in amounts
        ],
        *[F.col(f"{a}_total") for a in amounts],
    )


def quantile_aggregates(
    value: str, frequency: str, probabilities: Sequence[float]
) -> tuple[list[Column], Column]:
    """Aggregates over ``running_total`` rows, and the interpolated quantiles from them.

    Each order statistic falls into exactly one row of the histogram, so a plain
    conditional maximum finds it.
    """
    before, total = F.col(f"{frequency}_before"), F.col(f"{frequency}_total")

    def at(rank: Column) -> Column:
        inside = (before <= rank) & (rank < before + F.col(frequency))
        return F.max(F.when(inside, F.col(value)))

    aggregates = [F.max(total).alias("total")]
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (total - 1)
        aggregates += [at(F.floor(position)).alias(f"lo_{i}"), at(F.ceil(position)).alias(f"hi_{i}")]

    def interpolated(i: int, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("total") - 1)
        lo, hi = F.col(f"lo_{i}").cast("double"), F.col(f"hi_{i}").cast("double")
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (position - F.floor(position)))

    return aggregates, F.array(*[interpolated(i, p) for i, p in enumerate(probabilities)])


def exact_quantiles(
    histogram: DataFrame,
    value: str,
    frequency: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles of a weighted column, exact at any size.

    Returns ``(*groups, quantiles ARRAY<DOUBLE>)`` in the order of ``probabilities``.
    """
    groups = list(groups)
    aggregates, quantiles = quantile_aggregates(value, frequency, probabilities)
    ranked = running_total(histogram, value, [frequency], groups)
    return ranked.groupBy(*groups).agg(*aggregates).select(*groups, quantiles.alias("quantiles"))


def with_ordinal(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Number the distinct ``key`` values 0, 1, ... in their sort order."""
    counted = running_total(rows.withColumn("one", F.lit(1)), key, ["one"])
    return counted.select(*rows.columns, F.col("one_before").cast("int").alias(name))
