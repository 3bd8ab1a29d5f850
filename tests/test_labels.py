import datetime

import numpy as np
import pytest
from pyspark.errors import PySparkException

from catalogue import fixtures
from riskpanel.operators import labels

D = datetime.date


def _histogram(spark, counts):
    """counts: list of (dow, n) cells."""
    tally = {}
    for key in counts:
        tally[key] = tally.get(key, 0) + 1
    rows = [(int(d), int(n), c) for (d, n), c in tally.items()]
    return spark.createDataFrame(rows, "dow int, n long, cells long")


def _ladder(spark, counts, **options):
    return {r["rung"]: r for r in labels.threshold_ladder(_histogram(spark, counts), **options).collect()}


def _chosen(spark, counts, **options):
    rows = labels.chosen_thresholds(labels.threshold_ladder(_histogram(spark, counts), **options)).collect()
    return {r["rung"] for r in rows}.pop(), {r["dow"]: (r["low"], r["high"]) for r in rows}


def test_more_high_than_medium_is_legitimate(spark):
    counts = [(i % 7, n) for n, times in ((0, 850), (1, 50), (2, 100)) for i in range(times)]
    rung = _ladder(spark, counts)["global"]
    assert (rung["low"], round(rung["high"], 9)) == (0.0, 1.1)
    assert (rung["share_low"], rung["share_medium"], rung["share_high"]) == (0.85, 0.05, 0.1)
    assert rung["viable"] and rung["high_exceeds_medium"] and rung["mass_low_pct"] == 85.0
    assert _chosen(spark, counts)[0] == "global"


def test_poisson_counts_use_global_percentiles(spark):
    values = np.random.default_rng(1).poisson(6, 7000)
    name, cuts = _chosen(spark, [(i % 7, v) for i, v in enumerate(values)])
    assert name == "global" and set(cuts.values()) == {tuple(np.percentile(values, [60, 90]))}


def test_rare_events_fall_back_to_forced_cuts(spark):
    values = np.random.default_rng(2).poisson(0.08, 20000)
    counts = [(i % 7, v) for i, v in enumerate(values)]
    ladder = _ladder(spark, counts)
    assert not ladder["global"]["viable"] and not ladder["positivos"]["viable"]
    assert ladder["discreto"]["viable"] and not ladder["discreto"]["matches_percentiles"]
    assert _chosen(spark, counts)[0] == "discreto"


def test_few_active_cells_use_positive_percentiles(spark):
    rng = np.random.default_rng(3)
    values = np.where(rng.random(7000) < 0.05, rng.poisson(40, 7000), 0)
    name, cuts = _chosen(spark, [(i % 7, v) for i, v in enumerate(values)])
    assert name == "positivos"
    assert set(cuts.values()) == {tuple(np.percentile(values[values > 0], [60, 90]))}


def test_one_collapsed_weekday_rejects_the_weekday_rule(spark):
    rng = np.random.default_rng(4)
    counts = [(d, int(v)) for d in range(7) for v in (rng.poisson(8, 300) if d < 2 else rng.poisson(0.05, 300))]
    rung = _ladder(spark, counts, rungs=["por_dia"])["por_dia"]
    assert rung["collapsed_days"] == 5 and not rung["viable"] and rung["mass_low_pct"] is None
    assert _ladder(spark, counts, rungs=["por_dia"], max_collapsed_days=5)["por_dia"]["viable"]


def test_weekday_thresholds_differ(spark):
    rng = np.random.default_rng(5)
    data = {d: rng.poisson(1 + 11 * d / 6, 400) for d in range(7)}
    name, cuts = _chosen(spark, [(d, int(v)) for d, vs in data.items() for v in vs], rungs=["por_dia"], max_collapsed_days=1)
    assert name == "por_dia"
    assert cuts == {d: tuple(np.percentile(v, [60, 90])) for d, v in data.items()}


def test_rules_that_do_not_apply_are_absent(spark):
    ladder = _ladder(spark, [(d, 0) for d in range(7)])
    assert set(ladder) == {"global", "por_dia"}
    with pytest.raises(ValueError):
        labels.threshold_ladder(_histogram(spark, [(0, 0)]), rungs=["median"])


def test_no_viable_rule_raises(spark):
    cells = fixtures.split_panel(spark, "/root/testdata/sf0.001")
    with pytest.raises(PySparkException, match="no threshold rule"):
        labels.fit_thresholds(cells).collect()
