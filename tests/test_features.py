"""Features read the past only; bins and thresholds read training weeks only."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import binning, features, labels, split

D = datetime.date
ORIGIN = D(2023, 1, 2)
WEEKS, CUT = 40, 30
NAMES = features.feature_names("u")


def _panel(spark, tensor):
    """tensor[unit, dow, week] plus one unobserved week."""
    rows = []
    for u in range(tensor.shape[0]):
        for d in range(7):
            for w in range(tensor.shape[2] + 1):
                n = int(tensor[u, d, w]) if w < tensor.shape[2] else None
                rows.append((str(u), d, w, ORIGIN + datetime.timedelta(7 * w), n))
    cells = spark.createDataFrame(rows, "unit_id string, dow int, week_idx int, week_start date, n long")
    train_end = ORIGIN + datetime.timedelta(7 * (CUT - 1))
    cells = split.temporal_split(cells, train_end, train_end + datetime.timedelta(35))
    return split.with_eligibility(cells)


@pytest.fixture(scope="module")
def tensor():
    return np.random.default_rng(7).poisson(3, (2, 7, WEEKS))


def _rows(df):
    return {(r["unit_id"], r["dow"], r["week_idx"]): r for r in df.collect()}


def test_values_against_brute_force(spark, tensor):
    got = _rows(features.build_features(_panel(spark, tensor), "u"))
    for (u, d, w), row in got.items():
        past = tensor[int(u), d, :w]
        for k in features.LAGS:
            assert row[f"rezago_{k}"] == (past[w - k] if w >= k else 0)
        for m in features.WINDOWS:
            assert row[f"media_movil_{m}"] == pytest.approx(past[max(0, w - m):].mean() if w else 0.0)
        density = tensor[int(u), :, :w].sum() / w if w else 0.0
        assert row["densidad_historica_u"] == pytest.approx(density)


def test_later_weeks_never_leak(spark, tensor):
    changed = tensor.copy()
    changed[:, :, CUT:] = 50
    before, after = _panel(spark, tensor), _panel(spark, changed)
    fa, fb = (features.build_features(p, "u") for p in (before, after))
    early = F.col("week_idx") <= CUT
    a, b = (_rows(f.filter(early).select("unit_id", "dow", "week_idx", *NAMES)) for f in (fa, fb))
    assert a == b

    def edges(f):
        rows = binning.fit_bin_edges(split.model_rows(f, "train"), NAMES).collect()
        return {r["feature"]: r["edges"] for r in rows}

    def cuts(p):
        return sorted(tuple(r) for r in labels.fit_thresholds(p).collect())

    assert edges(fa) == edges(fb) and cuts(before) == cuts(after)
    # control: a change inside the training weeks shows up in all three
    inside = tensor.copy()
    inside[:, :, 15:20] += np.random.default_rng(8).poisson(20, (2, 7, 5))
    control = _panel(spark, inside)
    fc = features.build_features(control, "u")
    assert _rows(fc.filter(early).select("unit_id", "dow", "week_idx", *NAMES)) != a
    assert edges(fc) != edges(fa) and cuts(control) != cuts(before)


def test_ineligible_units_do_not_shape_the_bins(spark, tensor):
    three = np.concatenate([tensor, np.zeros((1, 7, WEEKS), dtype=int)])
    three[2, :, CUT + 2:] = 99

    def edges(t):
        rows = split.model_rows(features.build_features(_panel(spark, t), "u"), "train")
        return {r["feature"]: r["edges"] for r in binning.fit_bin_edges(rows, NAMES).collect()}

    assert edges(three) == edges(tensor)


def test_bins_keep_the_two_highest_values_apart(spark):
    rng = np.random.default_rng(9)
    values = rng.normal(size=500)
    rows = spark.createDataFrame(
        [(float(i % 2), 4.0, float(i % 5), float(v)) for i, v in enumerate(values)],
        "flag double, constant double, few double, many double",
    )
    names = ["flag", "constant", "few", "many"]
    fitted = {r["feature"]: r["edges"] for r in binning.fit_bin_edges(rows, names).collect()}
    assert fitted["flag"] == [0.0] and fitted["constant"] == [3.0] and fitted["few"] == [0.0, 1.0, 2.0, 3.0]
    np.testing.assert_allclose(fitted["many"], np.quantile(values, np.arange(1, 32) / 32), atol=1e-12)
    edges = spark.createDataFrame(list(fitted.items()), "feature string, edges array<double>")
    binned = binning.apply_bins(rows, edges, names)
    assert {r["flag"] for r in binned.select("flag").distinct().collect()} == {0, 1}
    assert {r["constant"] for r in binned.select("constant").distinct().collect()} == {1}
    want = np.bincount(np.searchsorted(np.array(fitted["many"]), values, side="left"))
    got = {r["many"]: r["count"] for r in binned.groupBy("many").count().collect()}
    assert got == {i: c for i, c in enumerate(want) if c}


def test_feature_contract_is_order_sensitive():
    features.check_feature_contract(NAMES, list(NAMES))
    with pytest.raises(ValueError):
        features.check_feature_contract(NAMES[::-1], NAMES)
