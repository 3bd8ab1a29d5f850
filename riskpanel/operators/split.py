"""Chronological split and eligibility, both decided from the training weeks."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BURN_IN_WEEKS = 12


def split_of(train_end: Date | str, val_end: Date | str, burn_in: int = BURN_IN_WEEKS) -> Column:
    """Name of the split a week belongs to, judged by the date of its Monday."""
    start = F.col("week_start")
    return (
        F.when(F.col("n").isNull(), "future")
        .when(F.col("week_idx") < burn_in, "burn_in")
        .when(start <= F.lit(train_end).cast("date"), "train")
        .when(start <= F.lit(val_end).cast("date"), "val")
        .otherwise("test")
    )


def temporal_split(
    panel: DataFrame, train_end: Date | str, val_end: Date | str, burn_in: int = BURN_IN_WEEKS
) -> DataFrame:
    return panel.withColumn("split", split_of(train_end, val_end, burn_in))


def frozen_train_weeks(
    panel: DataFrame, first_weeks: int, train_end: Date | str, burn_in: int = BURN_IN_WEEKS
) -> DataFrame:
    """Mark the original training weeks; weeks added later can never qualify."""
    original = (
        (F.col("week_idx") < first_weeks)
        & (F.col("week_idx") >= burn_in)
        & (F.col("week_start") <= F.lit(train_end).cast("date"))
        & F.col("n").isNotNull()
    )
    return panel.withColumn("split", F.when(original, "train").when(F.col("n").isNull(), "future").otherwise("later"))


_LEVEL_KEYS = {"unit": ("unit_id",), "unit_day": ("unit_id", "dow")}


def _keys(level: str) -> tuple[str, ...]:
    if level not in _LEVEL_KEYS:
        raise ValueError("level must be 'unit' or 'unit_day'")
    return _LEVEL_KEYS[level]


def eligible_pairs(split_panel: DataFrame, level: str = "unit") -> DataFrame:
    """Unit-weekday pairs and whether the training weeks hold events for them."""
    return with_eligibility(split_panel, level).select("unit_id", "dow", "eligible").distinct()


def with_eligibility(split_panel: DataFrame, level: str = "unit") -> DataFrame:
    """Add ``eligible``; a window on the panel's own partitioning, so no join."""
    group = Window.partitionBy(*_keys(level))
    train_events = F.sum(F.when(F.col("split") == "train", F.col("n"))).over(group)
    return split_panel.withColumn("eligible", F.coalesce(train_events > 0, F.lit(False)))


def apply_mask(split_panel: DataFrame, mask: DataFrame) -> DataFrame:
    """Add ``eligible`` from a frozen ``(unit_id, dow, eligible)`` table."""
    joined = split_panel.join(mask.select("unit_id", "dow", "eligible"), ["unit_id", "dow"], "left")
    return joined.withColumn("eligible", F.coalesce("eligible", F.lit(False)))


def model_rows(split_panel: DataFrame, *splits: str) -> DataFrame:
    """Eligible rows of the given splits."""
    return split_panel.filter(F.col("eligible") & F.col("split").isin(*splits))
