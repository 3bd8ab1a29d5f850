"""The carried state of a panel: what the features of the next week need, and no history.

Per unit and weekday the state holds the counts of the last twelve whole weeks, the unit's
running total, and the daily counts of the week that is not complete yet. A batch of
daily counts advances it by one aggregate over the batch and one join with the state, whose
size is the catalogue's and not the history's. Counts add up, so a batch may bring late days of
earlier weeks, and a batch that replaces another one is the difference of the two: batches
in any order and cut give the state of the panel that all their days make.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .features import LAGS, WINDOWS, feature_names, with_calendar

WEEKS = max(*LAGS, *WINDOWS)  # counts that any feature looks back on


@dataclass(frozen=True)
class PanelState:
    """Bounds, and two small tables.

    ``cells``: unit_id, dow, recent (the last ``WEEKS`` weekly counts, oldest first, 0 before
    the origin), total (of the unit, all weekdays). ``open_days``: unit_id, event_date, n of
    days behind the last whole week.
    """

    origin: Date
    n_weeks: int
    last_date: Date | None
    cells: DataFrame
    open_days: DataFrame

    @property
    def next_week(self) -> Date:
        return self.origin + timedelta(weeks=self.n_weeks)


def empty_state(units: DataFrame, origin: Date) -> PanelState:
    """No counts yet, for a frozen catalogue of units."""
    days = units.select("unit_id").distinct().select("unit_id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow"))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), WEEKS).alias("recent")
    cells = days.select("unit_id", "dow", zeros, F.lit(0).cast("bigint").alias("total"))
    open_days = units.sparkSession.createDataFrame([], "unit_id string, event_date date, n bigint")
    return PanelState(origin, 0, None, cells, open_days)


def _whole_weeks(origin: Date, last: Date) -> int:
    return ((last - origin).days - 6) // 7 + 1


def _window(recent: Column, shift: int) -> Column:
    """The counts moved ``shift`` weeks into the past, zeros behind them."""
    kept = max(0, WEEKS - shift)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), WEEKS - kept)
    return F.concat(F.slice(recent, WEEKS - kept + 1, kept), zeros) if kept else zeros


def advanced(state: PanelState, daily: DataFrame) -> PanelState:
    """The state after more daily counts ``(unit_id, event_date, n)``; ``n`` may be negative.

    Units outside the catalogue are left out. Days before the origin are an error. The last
    date is that of any day seen so far, so taking days away never removes a week.
    """
    known = daily.join(state.cells.select("unit_id").distinct(), "unit_id", "left_semi").select("unit_id", "event_date", "n")
    first, last = known.agg(F.min("event_date"), F.max("event_date")).first()
    if last is None:
        return state
    if first < state.origin:
        raise ValueError(f"event(s) from {first} on precede the frozen origin {state.origin}")
    last = max(last, state.last_date or last)
    n_weeks = max(state.n_weeks, _whole_weeks(state.origin, last), 0)
    day = F.datediff("event_date", F.lit(state.origin))
    both = state.open_days.unionByName(known).withColumn("day", day)
    closed = both.filter(F.col("day") < n_weeks * 7)
    behind = (F.lit(n_weeks - 1) - F.floor(F.col("day") / 7)).cast("int")  # 0 is the last whole week
    counts = closed.groupBy("unit_id", F.pmod("day", F.lit(7)).alias("dow"), behind.alias("behind")).agg(F.sum("n").alias("n"))
    recent = [F.coalesce(F.sum(F.when(F.col("behind") == w, F.col("n"))), F.lit(0)) for w in range(WEEKS - 1, -1, -1)]
    by_day = counts.groupBy("unit_id", "dow").agg(F.array(*recent).alias("more"))
    by_unit = counts.groupBy("unit_id").agg(F.sum("n").alias("more_total"))
    moved = _window(F.col("recent"), min(WEEKS, n_weeks - state.n_weeks))
    nothing = F.array_repeat(F.lit(0).cast("bigint"), WEEKS)
    cells = state.cells.join(by_day, ["unit_id", "dow"], "left").join(by_unit, "unit_id", "left")
    cells = cells.select(
        "unit_id",
        "dow",
        F.zip_with(moved, F.coalesce("more", nothing), lambda a, b: a + b).alias("recent"),
        (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("total"),
    )
    open_days = both.filter(F.col("day") >= n_weeks * 7).groupBy("unit_id", "event_date").agg(F.sum("n").alias("n"))
    return PanelState(state.origin, n_weeks, last, cells, open_days.filter(F.col("n") != 0))


def next_week_features(state: PanelState, level: str = "parroquia") -> DataFrame:
    """The features of the first week that is not whole: unit_id, dow, week_idx, week_start and all features."""
    names = feature_names(level)
    weeks = state.n_weeks
    at = lambda k: F.col("recent")[WEEKS - k].cast("double")
    lags = {f"rezago_{k}": at(k) for k in LAGS}
    means = {}
    for w in WINDOWS:
        seen = min(w, weeks)
        total = sum((at(k) for k in range(1, seen + 1)), F.lit(0.0))
        means[f"media_movil_{w}"] = total / seen if seen else F.lit(0.0)
    density = F.col("total").cast("double") / weeks if weeks else F.lit(0.0)
    rows = state.cells.withColumns({"week_idx": F.lit(weeks), "week_start": F.lit(state.next_week), **lags, **means, names[-1]: density})
    return with_calendar(rows).select("unit_id", "dow", "week_idx", "week_start", *names)


def save_state(state: PanelState, path: str) -> None:
    state.cells.write.mode("overwrite").parquet(f"{path}/cells")
    state.open_days.write.mode("overwrite").parquet(f"{path}/open_days")
    bounds = [(state.origin, state.n_weeks, state.last_date)]
    spark = state.cells.sparkSession
    spark.createDataFrame(bounds, "origin date, n_weeks int, last_date date").coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")


def load_state(spark: SparkSession, path: str) -> PanelState:
    row = spark.read.parquet(f"{path}/bounds").first()
    return PanelState(row["origin"], row["n_weeks"], row["last_date"], spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/open_days"))


def written(state: PanelState) -> PanelState:
    """The state with both tables written, so that a chain of batches does not grow the plan."""
    return replace(state, cells=materialise(state.cells, "state-cells"), open_days=materialise(state.open_days, "state-days"))
