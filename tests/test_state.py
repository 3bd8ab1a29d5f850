"""The carried panel state against the rebuilt panel, and the batch ledger when things go wrong."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskpanel import session
from riskpanel.operators import features, panel, state, validation
from riskpanel.session import create_small, materialise, names_in, read_small, temporary_tables
from riskpanel.sources import history

D = datetime.date
ORIGIN = D(2023, 1, 2)
DAILY = "unit_id string, event_date date, n long"


def daily_rows(seed, days):
    rng = np.random.default_rng(seed)
    rows = [(u, ORIGIN + datetime.timedelta(i), int(rng.poisson(r))) for u, r in (("a", 6.0), ("b", 0.4)) for i in range(days)]
    return [r for r in rows if r[2]]


def rebuilt(spark, rows, units):
    daily = panel.daily_counts(spark.createDataFrame(rows, DAILY), "unit_id", "event_date", "n")
    meta = panel.read_meta(daily, origin=ORIGIN)
    cells = panel.dense_panel(daily, meta, units=units, future_weeks=1)
    names = features.feature_names()
    wide = features.next_week_rows(features.build_features(cells))
    return {(r.unit_id, r.dow): [round(r[c], 9) for c in names] + [r.week_idx, r.week_start] for r in wide.collect()}


def carried(found):
    names = features.feature_names()
    return {(r.unit_id, r.dow): [round(r[c], 9) for c in names] + [r.week_idx, r.week_start] for r in state.next_week_features(found).collect()}


@pytest.mark.parametrize("days", [5, 30, 83, 84, 201])
def test_any_cut_of_the_days_gives_the_rebuilt_panel(spark, days):
    """Batches in date order and shuffled, with late days, days of open weeks and a unit without events."""
    units = spark.createDataFrame([("a",), ("b",), ("never",)], "unit_id string")
    rows = daily_rows(days, days)
    want = rebuilt(spark, rows, units)
    order = np.random.default_rng(1).permutation(len(rows))
    for cut in ([rows[: len(rows) // 3], rows[len(rows) // 3 :]], [[rows[i] for i in order[k::3]] for k in range(3)]):
        found = state.empty_state(units, ORIGIN)
        for part in cut:
            found = state.advanced(found, spark.createDataFrame([*part, ("unknown", ORIGIN, 5)], DAILY))
        assert carried(found) == want
    assert state.advanced(found, spark.createDataFrame([], DAILY)) is found


def test_a_batch_can_be_taken_back(spark, tmp_path):
    units = spark.createDataFrame([("a",), ("b",)], "unit_id string")
    rows, wrong = daily_rows(3, 120), daily_rows(4, 90)
    found = state.advanced(state.empty_state(units, ORIGIN), spark.createDataFrame([*rows, *wrong], DAILY))
    state.save_state(found, str(tmp_path))
    found = state.load_state(spark, str(tmp_path))
    found = state.advanced(found, spark.createDataFrame([(u, d, -n) for u, d, n in wrong], DAILY))
    assert carried(found) == rebuilt(spark, rows, units)


def test_days_before_the_origin_are_an_error(spark):
    units = spark.createDataFrame([("a",)], "unit_id string")
    with pytest.raises(ValueError, match="precede"):
        state.advanced(state.empty_state(units, ORIGIN), spark.createDataFrame([("a", D(2022, 12, 31), 1)], DAILY))


def events(spark, first, days, unit="a"):
    rows = [(first + datetime.timedelta(i), unit, "P", "C", "f") for i in range(days)]
    return spark.createDataFrame(rows, history.HISTORY_SCHEMA)


def counts(spark, path):
    return {r.batch: r["count"] for r in history.read_history(spark, path).groupBy("batch").count().collect()}


def test_a_writer_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    history.write_batch(events(spark, ORIGIN, 40), path, "one")
    before = history.snapshot(spark, path)
    for step in ("daily_counts", "_commit"):
        with monkeypatch.context() as stopped, pytest.raises(RuntimeError):
            stopped.setattr(history, step, lambda *_a, **_k: (_ for _ in ()).throw(RuntimeError("stopped")))
            history.write_batch(events(spark, ORIGIN, 5), path, "one")
        assert history.snapshot(spark, path) == before and counts(spark, path) == {"one": 40}
        assert history.read_daily(spark, path).agg(F.sum("n")).first()[0] == 40
    # a ledger file whose writer stopped is passed over, and its number is not used again
    assert create_small(spark, f"{path}/ledger/{before.number + 1:020d}", '{"batches"')
    assert history.snapshot(spark, path) == before
    assert history.write_batch(events(spark, ORIGIN, 3), path, "one").number == before.number + 2
    assert counts(spark, path) == {"one": 3}


def test_an_open_snapshot_stays_whole_until_vacuum(spark, tmp_path):
    path = str(tmp_path / "h")
    history.write_batch(events(spark, ORIGIN, 40), path, "one")
    old = history.read_history(spark, path)
    history.write_batch(events(spark, ORIGIN, 7), path, "one")
    history.write_batch(events(spark, ORIGIN, 2), path, "two")
    assert old.count() == 40 and counts(spark, path) == {"one": 7, "two": 2}
    gone = history.vacuum(spark, path)
    assert len([g for g in gone if "version=" in g]) == 2 and counts(spark, path) == {"one": 7, "two": 2}
    assert history.snapshot(spark, path).months == ["2023-01"] and history.snapshot(spark, path).records == 9


def test_two_writers_of_one_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "h")
    real = history._commit

    def overtaken(spark, path, batch, *rest):
        monkeypatch.setattr(history, "_commit", real)
        history.write_batch(events(spark, ORIGIN, 4), path, batch)
        history.write_batch(events(spark, ORIGIN, 6), path, "other")
        return real(spark, path, batch, *rest)

    monkeypatch.setattr(history, "_commit", overtaken)
    with pytest.raises(history.BatchConflict):
        history.write_batch(events(spark, ORIGIN, 9), path, "one")
    assert counts(spark, path) == {"one": 4, "other": 6}


def test_a_state_is_valid_only_for_its_batches(spark, tmp_path, monkeypatch):
    """Another batch that comes in between leaves the events of both, and no state."""
    path, units = str(tmp_path / "h"), spark.createDataFrame([("a",)], "unit_id string")
    found = state.advanced(state.empty_state(units, ORIGIN), panel.daily_counts(events(spark, ORIGIN, 20), "unit_id", "event_date"))
    valid = history.write_batch(events(spark, ORIGIN, 20), path, "one", state=found)
    assert carried(history.read_state(spark, path, valid)) == carried(found)
    real = history._commit

    def overtaken(spark, path, *rest):
        monkeypatch.setattr(history, "_commit", real)
        history.write_batch(events(spark, ORIGIN, 6), path, "other")
        return real(spark, path, *rest)

    monkeypatch.setattr(history, "_commit", overtaken)
    assert history.write_batch(events(spark, ORIGIN, 9), path, "two", state=found).state is None
    assert counts(spark, path) == {"one": 20, "other": 6, "two": 9}


def test_many_batches_are_judged_in_one_pass(spark):
    """Details name what the sender must mend; null units are unknown, batches without rows are empty."""
    units = spark.createDataFrame([("a",), ("b",)], "unit_id string")
    loaded = spark.createDataFrame([("2023-01",), ("2023-01",)], "month string")
    rows = [("new", "a", D(2023, 2, 1), 2), ("new", "b", D(2023, 2, 2), 1), ("old", "a", D(2023, 1, 5), 1), ("far", "a", D(2024, 1, 5), 4)]
    rows += [("odd", u, D(2023, 3, 1), 1) for u in ("z", "y", "y", "a")] + [("both", "a", D(2023, m, 1), 1) for m in (1, 2)]
    batches = spark.createDataFrame(rows, "batch string, unit_id string, event_date date, n long")
    names = ["new", "old", "far", "odd", "both", "both, strict", "none"]
    batches = batches.unionByName(batches.filter("batch = 'both'").withColumn("batch", F.lit("both, strict")))
    settings = spark.createDataFrame([(b, D(2023, 12, 31), b.endswith("strict")) for b in names], "batch string, today date, strict boolean")
    got = {r.batch: r for r in validation.judge_batches(batches, units, loaded, settings).collect()}
    assert {b: (r.reason, r.detail) for b, r in got.items()} == {
        "new": (None, None), "both": (None, None), "none": ("empty", "no record is left in scope"),
        "old": ("months already loaded", "2023-01"), "both, strict": ("months already loaded", "2023-01"),
        "far": ("future dates", "4 record(s) after 2023-12-31"), "odd": ("unknown units", "y, z"),
    }
    assert got["new"].records == 3 and got["new"].days == 2 and got["new"].partial_month


def test_temporary_tables_go_and_kept_ones_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _spark: str(tmp_path))
    with temporary_tables(spark) as outer:
        with temporary_tables(spark) as keep:
            inner = materialise(spark.range(3).toDF("a"), "inner")
            kept = keep(inner.withColumn("b", F.col("a") + 1), "kept")
        assert [n.rsplit("-", 1)[0] for n in names_in(spark, f"{tmp_path}/riskpanel")] == ["kept"]
        last = outer(kept, "last")
    assert [n.rsplit("-", 1)[0] for n in names_in(spark, f"{tmp_path}/riskpanel")] == ["last"] and last.count() == 3
    assert create_small(spark, f"{tmp_path}/x", "é\n") and not create_small(spark, f"{tmp_path}/x", "y")
    assert read_small(spark, f"{tmp_path}/x") == "é\n"
