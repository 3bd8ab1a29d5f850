"""From events to the dense unit x weekday x week panel.

Raw events are reduced once to one row per unit and day (a partial aggregate
takes care of hot units before the shuffle); all later steps read that table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_key, week_start
from ..functions.text import normalise
from ..session import materialise
from .ordering import running_total

PANEL_KEYS = ("unit_id", "dow", "week_idx")


def daily_counts(
    events: DataFrame, unit: str | Column, date: str | Column, weight: str | Column | None = None
) -> DataFrame:
    """Events per unit and day: ``(unit_id, event_date, n)``."""
    unit = F.col(unit) if isinstance(unit, str) else unit
    date = F.col(date) if isinstance(date, str) else date
    amount = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    keyed = events.select(
        unit.cast("string").alias("unit_id"),
        date.cast("date").alias("event_date"),
        amount.cast("bigint").alias("n"),
    )
    return keyed.groupBy("unit_id", "event_date").agg(F.sum("n").alias("n"))


def panel_meta(daily: DataFrame, *, origin: Date | str | None = None, trim: bool = True) -> DataFrame:
    """One row: week origin, last observed date, whole weeks kept, weeks dropped.

    ``origin`` freezes the first Monday; otherwise it is the Monday on or before
    the earliest date. ``trim`` drops a trailing week that is not complete.
    """
    first_monday = week_start(F.min("event_date")) if origin is None else F.lit(origin).cast("date")
    bounds = daily.agg(
        first_monday.alias("origin"), F.max("event_date").alias("last_date"), F.sum("n").alias("events")
    )
    span = F.datediff("last_date", "origin")
    seen = (F.floor(span / 7) + 1).cast("int")
    complete = (F.floor((span - 6) / 7) + 1).cast("int")
    kept = complete if trim else seen
    return bounds.select(
        "origin",
        "last_date",
        "events",
        kept.alias("n_weeks"),
        (seen - kept).alias("weeks_dropped"),
    )


@dataclass(frozen=True)
class PanelMeta:
    """The bounds of a panel, read to the driver once (a single row)."""

    origin: Date
    last_date: Date
    events: int
    n_weeks: int
    weeks_dropped: int

    @property
    def next_week(self) -> Date:
        """Monday of the first week that is not observed."""
        return self.origin + timedelta(weeks=self.n_weeks)


def read_meta(daily: DataFrame, *, origin: Date | str | None = None, trim: bool = True) -> PanelMeta:
    """Collect the bounds; an empty table is an error, not an empty panel."""
    row = panel_meta(daily, origin=origin, trim=trim).first()
    if row["last_date"] is None:
        raise ValueError("no events are left: check category, area and dates")
    return PanelMeta(**row.asDict())


def dense_panel(
    daily: DataFrame,
    meta: PanelMeta | None = None,
    *,
    units: DataFrame | None = None,
    future_weeks: int = 0,
) -> DataFrame:
    """Every unit, weekday and week with its count: ``(unit_id, dow, week_idx, week_start, n)``.

    Days without events count 0. ``units`` freezes the catalogue: other units are
    left out. One unobserved week may be appended, with ``n`` NULL. The result is
    hash-partitioned by unit, which every later per-unit window reuses; a unit
    has at most one row per calendar day, however many events it holds.
    """
    if future_weeks not in (0, 1):
        raise ValueError("only the week after the last observed one can be appended")
    meta = read_meta(daily) if meta is None else meta
    catalogue = (daily if units is None else units).select("unit_id").distinct()
    origin = F.lit(meta.origin)
    observed = max(meta.n_weeks, 0) * 7
    last_day = observed + future_weeks * 7 - 1

    days = F.sequence(F.lit(0), F.lit(last_day)) if last_day >= 0 else F.array().cast("array<int>")
    blank = catalogue.select("unit_id", F.explode(days).alias("day")).withColumn(
        "n", F.when(F.col("day") < observed, F.lit(0)).cast("bigint")
    )
    counted = daily.select("unit_id", F.datediff("event_date", origin).alias("day"), "n").filter(
        (F.col("day") >= 0) & (F.col("day") < observed)
    )
    if units is not None:
        counted = counted.join(catalogue, "unit_id", "left_semi")
    cells = blank.unionByName(counted).repartition("unit_id").groupBy("unit_id", "day").agg(F.sum("n").alias("n"))
    week = F.floor(F.col("day") / 7).cast("int")
    return cells.select(
        "unit_id",
        F.pmod("day", F.lit(7)).alias("dow"),
        week.alias("week_idx"),
        F.date_add(origin, week * 7).alias("week_start"),
        "n",
    )


def cell_date() -> Column:
    """The calendar day of a panel cell."""
    return F.date_add("week_start", F.col("dow"))


def before_origin(daily: DataFrame, origin: Date | str) -> DataFrame:
    """How many events precede a frozen origin; must be zero before rebuilding."""
    early = F.col("event_date") < F.lit(origin).cast("date")
    return daily.agg(F.coalesce(F.sum(F.when(early, F.col("n"))), F.lit(0)).alias("events_before_origin"))


def panel_totals(panel: DataFrame) -> DataFrame:
    """Events, cells, mean per cell and share of zero cells."""
    return panel.agg(
        F.sum("n").alias("events"),
        F.count("n").alias("cells"),
        F.avg("n").alias("mean_per_cell"),
        (F.avg((F.col("n") == 0).cast("int")) * 100).alias("zero_pct"),
    )


def weekly_series(panel: DataFrame) -> DataFrame:
    return panel.groupBy("week_idx", "week_start").agg(F.sum("n").alias("events"))


def empty_weeks(panel: DataFrame) -> DataFrame:
    """Weeks without a single event; training must not start while any exist."""
    return weekly_series(panel).filter(F.col("events") == 0).select("week_idx", "week_start")


def require_contiguous(panel: DataFrame) -> None:
    gaps = empty_weeks(panel).count()
    if gaps:
        raise ValueError(f"{gaps} week(s) hold no events: lags and thresholds would be distorted")


def events_by_dow(panel: DataFrame) -> DataFrame:
    return panel.groupBy("dow").agg(F.sum("n").alias("events"))


def unit_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("unit_id").agg(F.sum("n").alias("events"))


def top_units(panel: DataFrame, limit: int = 8) -> DataFrame:
    return unit_totals(panel).orderBy(F.desc("events"), "unit_id").limit(limit)


def unit_share(panel: DataFrame) -> DataFrame:
    """Share of all events per unit, and whether it reaches one percent."""
    totals = materialise(unit_totals(panel), "unit-totals")
    everything = totals.agg(F.sum("events").alias("all_events")).scalar()
    share = F.coalesce(F.try_divide(F.col("events").cast("double"), everything), F.lit(0.0))
    return totals.withColumn("share", share).withColumn("at_least_one_pct", F.col("share") >= 0.01)


def dominance(panel: DataFrame) -> DataFrame:
    """Largest share, number of units with at least 1 %, and the > 90 % warning."""
    return unit_share(panel).agg(
        F.max("share").alias("dominant_share"),
        F.count_if("at_least_one_pct").alias("units_at_least_one_pct"),
        (F.max("share") > 0.9).alias("one_unit_dominates"),
    )


def count_histogram(panel: DataFrame, *groups: str) -> DataFrame:
    """Cells per distinct count.

    With N events there are at most sqrt(2N) distinct counts (they sum to N at
    least pairwise different), about 1.4 million for 10^12 events.
    """
    return panel.filter(F.col("n").isNotNull()).groupBy(*groups, "n").agg(F.count("*").alias("cells"))


def cumulative_share(histogram: DataFrame) -> DataFrame:
    """Empirical distribution F(c <= n) over a count histogram ``(n, cells)``."""
    ranked = running_total(histogram, "n", ["cells"])
    share = (F.col("cells_before") + F.col("cells")) / F.col("cells_total")
    return ranked.withColumn("cumulative", share).drop("cells_before", "cells_total")


def count_cdf(panel: DataFrame, limit: int | None = 8) -> DataFrame:
    """The report of the first distinct counts with their cumulative share."""
    cdf = cumulative_share(count_histogram(panel))
    return cdf if limit is None else cdf.orderBy("n").limit(limit)


def unit_attributes(
    events: DataFrame, unit: str, name: str, area: str, order: tuple[str, ...]
) -> DataFrame:
    """First non-null name and area per unit; ``order`` makes "first" deterministic.

    A unit without a name is called by its id, one without an area gets ''.
    """
    # repeated descriptions shrink to one row before any ordering is compared
    seen = events.select(F.col(unit).cast("string").alias("unit_id"), name, area, *order).distinct()
    rank = F.struct(*[F.col(c) for c in order], F.col(name), F.col(area))
    first = seen.groupBy("unit_id").agg(
        F.min_by(name, F.when(F.col(name).isNotNull(), rank)).alias("name"),
        F.min_by(area, F.when(F.col(area).isNotNull(), rank)).alias("area"),
    )
    return first.select(
        "unit_id",
        F.coalesce(F.col("name").cast("string"), "unit_id").alias("name"),
        normalise(F.coalesce(F.col("area"), F.lit(""))).alias("area"),
    )


def months(daily: DataFrame) -> DataFrame:
    """Distinct calendar months with events."""
    return daily.select(month_key(F.col("event_date")).alias("month")).distinct()
