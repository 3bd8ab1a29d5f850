import datetime

import pytest
from pyspark.sql import functions as F

from riskpanel.operators import features, panel, split

D = datetime.date


def _daily(spark, rows):
    return spark.createDataFrame(rows, "unit_id string, event_date date, n long")


def test_sunday_belongs_to_the_week_of_its_monday(spark):
    daily = _daily(spark, [("a", D(2026, 1, 5), 1), ("a", D(2026, 1, 11), 2), ("a", D(2026, 1, 12), 3)])
    cells = panel.dense_panel(daily, panel.read_meta(daily, trim=False))
    seen = {(r["dow"], r["week_idx"]): r["n"] for r in cells.filter("n > 0").collect()}
    assert seen == {(0, 0): 1, (6, 0): 2, (0, 1): 3}
    assert cells.count() == 14


def test_identical_events_all_count(spark):
    events = spark.createDataFrame([("a", D(2026, 1, 5))] * 5, "u string, d date")
    assert panel.daily_counts(events, "u", "d").first()["n"] == 5


def test_trailing_partial_week_is_dropped(spark):
    start, end = D(2025, 11, 24), D(2025, 12, 31)
    days = [("a", start + datetime.timedelta(i), 1) for i in range((end - start).days + 1)]
    meta = panel.read_meta(_daily(spark, days))
    cells = panel.dense_panel(_daily(spark, days), meta)
    assert (meta.n_weeks, meta.weeks_dropped, meta.next_week) == (5, 1, D(2025, 12, 29))
    totals = cells.agg(F.sum("n").alias("n"), F.max("week_start").alias("last")).first()
    assert totals["n"] == 35 and totals["last"] == D(2025, 12, 22)


def test_complete_weeks_are_kept(spark):
    days = [("a", D(2025, 12, 1) + datetime.timedelta(i), 1) for i in range(28)]
    meta = panel.read_meta(_daily(spark, days))
    assert meta.weeks_dropped == 0
    assert panel.panel_totals(panel.dense_panel(_daily(spark, days), meta)).first()["events"] == 28


def test_gap_weeks_are_found_and_block_training(spark):
    daily = _daily(spark, [("a", D(2026, 1, 5), 1), ("a", D(2026, 3, 2), 1)])
    cells = panel.dense_panel(daily, panel.read_meta(daily, trim=False))
    weeks = cells.select("week_idx").distinct().count()
    assert panel.empty_weeks(cells).count() == weeks - 2 == 7
    with pytest.raises(ValueError, match="7 week"):
        panel.require_contiguous(cells)


def test_no_events_is_an_error(spark):
    with pytest.raises(ValueError, match="no events"):
        panel.read_meta(_daily(spark, []))


def test_span_below_one_week_gives_an_empty_panel(spark):
    daily = _daily(spark, [("a", D(2026, 1, 6), 1)])
    meta = panel.read_meta(daily)
    assert meta.n_weeks == 0 and panel.dense_panel(daily, meta).count() == 0


def test_only_one_future_week(spark):
    daily = _daily(spark, [("a", D(2026, 1, 5), 1), ("a", D(2026, 1, 18), 1)])
    with pytest.raises(ValueError):
        panel.dense_panel(daily, future_weeks=2)
    future = panel.dense_panel(daily, future_weeks=1).filter(F.col("n").isNull())
    assert {r["week_start"] for r in future.collect()} == {D(2026, 1, 19)} and future.count() == 7


def test_month_and_holiday_follow_the_day_not_the_monday(spark):
    # the week of 30 November 2026 changes month on Tuesday
    daily = _daily(spark, [("a", D(2026, 11, 30), 1), ("a", D(2026, 12, 6), 1)])
    rows = features.with_calendar(panel.dense_panel(daily)).orderBy("dow").collect()
    assert [r["mes"] for r in rows] == [11.0] + [12.0] * 6
    daily = _daily(spark, [("a", D(2025, 12, 22), 1), ("a", D(2025, 12, 28), 1)])
    rows = features.with_calendar(panel.dense_panel(daily)).orderBy("dow").collect()
    assert [r["es_feriado"] for r in rows] == [0, 0, 0, 1, 0, 0, 0]


def _counts(spark, tensor):
    """Panel from a dict (unit, dow, week) -> n."""
    rows = [(u, d, w, D(2023, 1, 2) + datetime.timedelta(7 * w), n) for (u, d, w), n in tensor.items()]
    return spark.createDataFrame(rows, "unit_id string, dow int, week_idx int, week_start date, n long")


def test_eligibility_is_decided_by_training_weeks_only(spark):
    active = {"0": 0, "1": 0, "2": 0, "3": 25, "4": 99}  # first active week
    tensor = {(u, d, w): int(w >= start) for u, start in active.items() for d in range(4) for w in range(30)}
    cells = split.frozen_train_weeks(_counts(spark, tensor), 20, "2030-01-01")
    chosen = split.eligible_pairs(cells).filter("eligible").select("unit_id").distinct()
    assert {r["unit_id"] for r in chosen.collect()} == {"0", "1", "2"}


def test_eligibility_by_unit_and_weekday(spark):
    tensor = {(str(u), d, w): int(d in (1, 3, 5)) for u in range(4) for d in range(7) for w in range(15)}
    cells = split.temporal_split(_counts(spark, tensor), "2030-01-01", "2031-01-01")
    assert split.eligible_pairs(cells, "unit").filter("eligible").count() == 28
    assert split.eligible_pairs(cells, "unit_day").filter("eligible").count() == 12
    with pytest.raises(ValueError):
        split.with_eligibility(cells, "canton")


def test_splits_are_disjoint_and_leave_out_the_burn_in(spark):
    tensor = {("a", 0, w): 1 for w in range(40)}
    cells = split.temporal_split(_counts(spark, tensor), "2023-06-30", "2023-08-31")
    weeks = {}
    for r in cells.collect():
        weeks.setdefault(r["split"], set()).add(r["week_idx"])
    assert weeks["burn_in"] == set(range(12))
    assert max(weeks["train"]) < min(weeks["val"]) and max(weeks["val"]) < min(weeks["test"])
    assert sum(len(v) for v in weeks.values()) == 40
