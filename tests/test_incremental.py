"""Batches against a frozen package: verdicts, untouched history, golden rebuild."""

import datetime

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from riskpanel.operators import models, panel, risk
from riskpanel.operators.cleaning import Scope
from riskpanel.plans import incremental, training
from riskpanel.sources import artefacts, history
from riskpanel.streaming import monthly

D = datetime.date
ORIGIN, WEEKS = D(2023, 1, 2), 30
TODAY = D(2050, 1, 1)
HEADER = "Fecha;provincia;Canton;Cod_Parroquia;Parroquia;Servicio;Subtipo"


@pytest.fixture(scope="module")
def seed_rows():
    rng = np.random.default_rng(11)
    rows = []
    for unit, rate in (("111", 8.0), ("222", 1.5)):
        for day in range(7 * WEEKS):
            rows += [(ORIGIN + datetime.timedelta(day), unit, f"PARROQUIA {unit}", "GUAYAQUIL", "seed.csv")] * int(rng.poisson(rate))
    rows.append((ORIGIN, "111", "PARROQUIA 111", "GUAYAQUIL", "seed.csv"))
    rows.append((ORIGIN + datetime.timedelta(7 * WEEKS - 1), "111", "PARROQUIA 111", "GUAYAQUIL", "seed.csv"))
    return rows


@pytest.fixture(scope="module")
def package(spark, seed_rows, tmp_path_factory):
    events = spark.createDataFrame(seed_rows, history.HISTORY_SCHEMA)
    daily = panel.daily_counts(events, "unit_id", "event_date")
    prepared = training.prepare(daily, D(2023, 5, 31), D(2023, 6, 30))
    model = models.forest(prepared.rows("train"), prepared.features, trees=5, depth=5)
    units = spark.createDataFrame([(u, f"PARROQUIA {u}", "GUAYAQUIL") for u in ("111", "222")], "unit_id string, name string, area string")
    path = str(tmp_path_factory.mktemp("package"))
    frozen = training.freeze(prepared, models.Fitted("forest", model, {"depth": 5}, 0.5), units)
    artefacts.save_package(frozen, path)
    return artefacts.load_package(spark, path)


@pytest.fixture
def store(spark, seed_rows, tmp_path):
    path = str(tmp_path / "history")
    history.write_batch(spark.createDataFrame(seed_rows, history.HISTORY_SCHEMA), path, "seed")
    return path


def _csv(folder, name, days, unit="111", canton="GUAYAQUIL", service="Tránsito y Movilidad"):
    lines = [f"{d.day}/{d.month}/{d.year};GUAYAS;{canton};{unit};PARROQUIA {unit};{service};Choque" for d in days]
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def _days(first, last):
    return [first + datetime.timedelta(i) for i in range((last - first).days + 1)]


AUGUST = _days(D(2023, 8, 1), D(2023, 8, 31))


def _score(spark, path, package, store, batch="b1", today=TODAY, **options):
    return incremental.score_csv(spark, path, package, store, batch, today, Scope(), **options)


def test_package_round_trip(package):
    assert package.origin == ORIGIN and package.n_weeks == WEEKS and package.model_name == "forest"
    assert package.features[-1] == "densidad_historica_parroquia" and package.config == {"depth": 5}
    assert package.mask.filter("eligible").count() == 14 and package.thresholds.count() == 7


def test_new_month_is_scored_and_loaded_once(spark, package, store, tmp_path):
    before = history.read_history(spark, store).count()
    path = _csv(tmp_path, "aug.csv", AUGUST * 2)
    result = _score(spark, path, package, store)
    assert result.accepted and result.new_records == 62 and result.history_records == before + 62
    assert result.target_week == D(2023, 8, 28) and not result.partial_month
    rows = result.matrix.collect()
    assert len(rows) == 14 and sum(result.summary.values()) == 14
    assert {r["semana_objetivo"] for r in rows} == {"2023-08-28"}
    assert [f.name for f in result.matrix.schema] == [
        "unidad_id", "unidad", "canton", "unidad_idx", "dia_idx", "dia_semana", "nivel_cod", "nivel",
        "prob_clase_predicha", "p_bajo", "p_medio", "p_alto", "semana_objetivo",
    ]
    # identical rows all count, and the same file is not loaded twice
    assert history.read_history(spark, store).count() == before + 62
    again = _score(spark, path, package, store, "b2")
    assert not again.accepted and again.reason == "months already loaded"
    assert history.read_history(spark, store).count() == before + 62


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"days": _days(D(2023, 7, 1), D(2023, 7, 30))}, "months already loaded"),
        ({"unit": "999"}, "unknown units"),
        ({"canton": "DURAN"}, "empty"),
        ({"service": "Seguridad Ciudadana"}, "empty"),
        ({"today": D(2023, 8, 15)}, "future dates"),
        ({"strict": True, "days": _days(D(2023, 7, 25), D(2023, 8, 31))}, "months already loaded"),
    ],
)
def test_rejected_batches_change_nothing(spark, package, store, tmp_path, change, reason):
    before = history.read_history(spark, store).count()
    options = {k: change[k] for k in ("today", "strict") if k in change}
    content = {k: v for k, v in change.items() if k in ("unit", "canton", "service")}
    result = _score(spark, _csv(tmp_path, "x.csv", change.get("days", AUGUST), **content), package, store, **options)
    assert not result.accepted and result.reason == reason and result.matrix is None and result.new_records == 0
    assert history.read_history(spark, store).count() == before


def test_a_batch_sent_again_counts_once(spark, package, store, tmp_path):
    before = history.read_history(spark, store).count()
    assert _score(spark, _csv(tmp_path, "a.csv", AUGUST), package, store).accepted
    longer = _csv(tmp_path, "b.csv", [*AUGUST[10:], *_days(D(2023, 9, 1), D(2023, 9, 30))])
    result = _score(spark, longer, package, store)
    assert result.accepted and result.new_records == 51 and result.history_records == before + 51
    assert history.read_history(spark, store).count() == before + 51
    assert history.read_daily(spark, store).agg(F.sum("n")).first()[0] == before + 51


def test_a_rewritten_batch_leaves_no_month_behind(spark, seed_rows, tmp_path):
    events = spark.createDataFrame(seed_rows, history.HISTORY_SCHEMA)
    path = str(tmp_path / "store")
    history.write_batch(events, path, "b 1/2=x%")
    history.write_batch(events.filter(F.col("event_date") < F.lit("2023-07-01").cast("date")), path, "b 1/2=x%")
    rows = history.read_history(spark, path).agg(F.max("event_date").alias("last"), F.max("batch").alias("batch")).first()
    assert rows["last"] == D(2023, 6, 30) and rows["batch"] == "b 1/2=x%"
    assert history.loaded_months(history.read_daily(spark, path)).count() == 6


def test_a_replay_gives_the_same_result(spark, package, store, tmp_path):
    path = _csv(tmp_path, "aug.csv", AUGUST)
    first = _score(spark, path, package, store, replay=True)
    second = _score(spark, path, package, store, replay=True)
    assert second.accepted and second.history_records == first.history_records
    assert second.matrix.exceptAll(first.matrix).count() == 0 and second.matrix.count() == first.matrix.count()


def test_unusable_file_is_rejected_without_an_exception(spark, package, store, tmp_path):
    (tmp_path / "bad.csv").write_text("a;b\n1;2\n")
    result = _score(spark, str(tmp_path / "bad.csv"), package, store)
    assert not result.accepted and result.reason.startswith("unusable")


def test_partial_month_is_accepted_with_a_warning(spark, package, store, tmp_path):
    result = _score(spark, _csv(tmp_path, "p.csv", AUGUST[:2]), package, store)
    assert result.accepted and result.partial_month and result.new_records == 2
    assert result.target_week == D(2023, 7, 31)


def test_overlapping_batch_is_accepted_by_default(spark, package, store, tmp_path):
    result = _score(spark, _csv(tmp_path, "o.csv", _days(D(2023, 7, 25), D(2023, 8, 31))), package, store)
    assert result.accepted and result.new_records == 38


def test_week_across_two_months_joins_old_and_new_rows(spark, package, store, tmp_path):
    july31 = spark.createDataFrame([(D(2023, 7, 31), "111", "P", "GUAYAQUIL", "x")] * 3, history.HISTORY_SCHEMA)
    history.write_batch(july31, store, "late july")
    path = _csv(tmp_path, "aug.csv", _days(D(2023, 8, 1), D(2023, 8, 6)))
    result = _score(spark, path, package, store)
    assert result.accepted and result.target_week == D(2023, 8, 7)
    daily = panel.daily_counts(history.read_history(spark, store), "unit_id", "event_date")
    meta = panel.read_meta(daily, origin=package.origin)
    week = panel.dense_panel(daily, meta, units=package.units).filter((F.col("week_idx") == WEEKS) & (F.col("unit_id") == "111"))
    assert {r["dow"]: r["n"] for r in week.collect()} == {0: 3, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}


def test_scoring_never_fits(spark, package, store, tmp_path, monkeypatch):
    def blocked(*_args, **_kwargs):
        raise AssertionError("training during scoring")

    monkeypatch.setattr(Pipeline, "fit", blocked)
    monkeypatch.setattr(training.labels, "fit_thresholds", blocked)
    monkeypatch.setattr(training.binning, "fit_bin_edges", blocked)
    assert _score(spark, _csv(tmp_path, "aug.csv", AUGUST), package, store, save=False).accepted
    assert history.read_history(spark, store).filter("batch <> 'seed'").count() == 0


def test_rebuild_equals_the_original_panel(spark, package, seed_rows):
    daily = panel.daily_counts(spark.createDataFrame(seed_rows, history.HISTORY_SCHEMA), "unit_id", "event_date")
    original = panel.dense_panel(daily)
    rebuilt = panel.dense_panel(daily, panel.read_meta(daily, origin=package.origin), units=package.units)
    assert original.exceptAll(rebuilt).count() == 0 and rebuilt.exceptAll(original).count() == 0


def test_events_before_the_frozen_origin_stop_the_scoring(spark, package):
    daily = spark.createDataFrame([("111", D(2022, 12, 30), 1), ("111", D(2023, 9, 1), 1)], "unit_id string, event_date date, n long")
    with pytest.raises(ValueError, match="precede"):
        incremental.score_next_week(daily, package)


def test_ineligible_units_are_not_scored(spark, package):
    scored = package.mask.withColumns({"p_low": F.lit(0.2), "p_medium": F.lit(0.2), "p_high": F.lit(0.6)})
    scored = scored.withColumn("eligible", F.col("unit_id") == "111")
    rows = risk.risk_matrix(scored, package.units, D(2023, 8, 7)).collect()
    by_unit = {r["unidad_id"]: r for r in rows}
    assert by_unit["222"]["nivel"] == risk.NOT_SCORED and by_unit["222"]["p_alto"] is None
    assert by_unit["222"]["nivel_cod"] == -1 and by_unit["222"]["prob_clase_predicha"] is None
    assert by_unit["111"]["nivel"] == "Alto" and by_unit["111"]["unidad_idx"] == 0


def test_only_eligible_cells_reach_the_model(spark, package, store, monkeypatch):
    from dataclasses import replace

    seen = []
    scorer = models.score
    monkeypatch.setattr(models, "score", lambda m, rows: seen.append(rows.select("unit_id").distinct().collect()) or scorer(m, rows))
    half = replace(package, mask=package.mask.withColumn("eligible", F.col("unit_id") == "111"))
    _, matrix = incremental.score_next_week(history.read_daily(spark, store), half)
    assert [[r["unit_id"] for r in rows] for rows in seen] == [["111"]]
    levels = {r["unidad_id"]: r["levels"] for r in matrix.groupBy("unidad_id").agg(F.array_agg("nivel_cod").alias("levels")).collect()}
    assert levels["222"] == [-1] * 7 and -1 not in levels["111"]


def test_history_is_built_once_from_seed_files(spark, tmp_path):
    _csv(tmp_path, "seed.csv", AUGUST)
    path = str(tmp_path / "store")
    assert history.load_or_build_history(spark, path, None, Scope()).count() == 0
    assert history.load_or_build_history(spark, path, str(tmp_path / "seed.csv"), Scope()).count() == 31
    assert history.load_or_build_history(spark, path, "/nowhere", Scope()).count() == 31


def test_stream_scores_each_new_file_once(spark, package, store, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    _csv(inbox, "2023-08.csv", AUGUST)
    seen = {}

    def run():
        monthly.score_arrivals(
            spark, str(inbox), package, store, str(tmp_path / "checkpoint"), Scope(), lambda: TODAY, seen.__setitem__
        ).awaitTermination(300)

    run()
    assert list(seen) == ["2023-08.csv"] and seen["2023-08.csv"].accepted
    _csv(inbox, "2023-09.csv", _days(D(2023, 9, 1), D(2023, 9, 30)))
    run()
    assert seen["2023-09.csv"].accepted and seen["2023-09.csv"].target_week == D(2023, 9, 25)
    assert history.loaded_months(history.read_daily(spark, store)).filter("month >= '2023-08'").count() == 2
