"""Leakage-free features: nothing reads the week being described or a later one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import is_holiday
from .panel import cell_date

LAGS = (1, 2, 3, 4)
WINDOWS = (4, 12)


def feature_names(level: str = "parroquia") -> tuple[str, ...]:
    """The feature order a trained model expects."""
    return (
        "dia_semana",
        "es_fin_de_semana",
        "mes",
        "es_feriado",
        *[f"rezago_{k}" for k in LAGS],
        *[f"media_movil_{w}" for w in WINDOWS],
        f"densidad_historica_{level}",
    )


def with_density(panel: DataFrame, name: str) -> DataFrame:
    """Mean weekly total of the unit over all earlier weeks (0 in week 0).

    The RANGE frame leaves out the other weekdays of the same week.
    """
    earlier = (
        Window.partitionBy("unit_id").orderBy("week_idx").rangeBetween(Window.unboundedPreceding, -1)
    )
    total = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    mean = F.coalesce(F.try_divide(total.cast("double"), F.col("week_idx")), F.lit(0.0))
    return panel.withColumn(name, mean)


def with_lags(panel: DataFrame, lags: tuple[int, ...] = LAGS) -> DataFrame:
    """Counts of the same unit and weekday k weeks earlier, 0 where none exists."""
    by_week = Window.partitionBy("unit_id", "dow").orderBy("week_idx")
    return panel.withColumns(
        {f"rezago_{k}": F.coalesce(F.lag("n", k).over(by_week), F.lit(0)).cast("double") for k in lags}
    )


def with_moving_means(panel: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Mean of up to w earlier weeks, without the current one (0 in week 0)."""
    by_week = Window.partitionBy("unit_id", "dow").orderBy("week_idx")
    return panel.withColumns(
        {
            f"media_movil_{w}": F.coalesce(F.avg("n").over(by_week.rowsBetween(-w, -1)), F.lit(0.0))
            for w in windows
        }
    )


def with_calendar(panel: DataFrame) -> DataFrame:
    """Weekday, weekend, month and holiday of each cell's own date."""
    return panel.withColumns(
        {
            "dia_semana": F.col("dow").cast("double"),
            "es_fin_de_semana": (F.col("dow") >= 5).cast("double"),
            "mes": F.month(cell_date()).cast("double"),
            "es_feriado": is_holiday(cell_date()).cast("double"),
        }
    )


def build_features(panel: DataFrame, level: str = "parroquia") -> DataFrame:
    """All eleven features as DOUBLE columns next to the panel's own columns.

    The unit-level window comes first: its partitioning also serves the windows
    on (unit, weekday), so the panel is shuffled at most once.
    """
    names = feature_names(level)
    wide = with_calendar(with_moving_means(with_lags(with_density(panel, names[-1]))))
    return wide.select(*panel.columns, *names)


def next_week_rows(featured: DataFrame) -> DataFrame:
    """Rows of the unobserved week to score."""
    return featured.filter(F.col("n").isNull())


def check_feature_contract(actual: tuple[str, ...] | list[str], expected: tuple[str, ...] | list[str]) -> None:
    """Order-sensitive; raised before anything is saved."""
    if list(actual) != list(expected):
        raise ValueError(f"features {list(actual)} do not match the frozen model's {list(expected)}")
