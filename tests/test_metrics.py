import numpy as np
import pytest

from riskpanel.operators import metrics

GOLDEN = [[581, 94, 0], [104, 96, 0], [0, 0, 175]]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(i, j) for i in range(3) for j in range(3) for _ in range(GOLDEN[i][j])]
    return spark.createDataFrame(rows, "label int, pred int")


def test_golden_confusion_matrix(golden):
    cells = {(r["label"], r["pred"]): r["cells"] for r in metrics.confusion_matrix(golden).collect()}
    assert cells == {(i, j): GOLDEN[i][j] for i in range(3) for j in range(3)}


def test_golden_report(golden):
    r = metrics.macro_report(golden).first()
    assert round(r["accuracy"], 4) == 0.8114 and round(r["f1_macro"], 4) == 0.7822
    assert [round(r[f"f1_{k}"], 4) for k in ("low", "medium", "high")] == [0.8544, 0.4923, 1.0]


def test_absent_class_counts_as_zero(spark):
    rows = spark.createDataFrame([(0, 0), (0, 0), (1, 1)], "label int, pred int")
    assert metrics.macro_report(rows).first()["f1_macro"] == pytest.approx(2 / 3)
    by_class = {r["label"]: r for r in metrics.class_metrics(rows).collect()}
    assert by_class[2]["support"] == 0 and by_class[2]["f1"] == 0.0


def _scored(spark, n, seed):
    rng = np.random.default_rng(seed)
    p = np.round(rng.dirichlet([1, 1, 1], n), 1)
    y = rng.integers(0, 3, n)
    rows = [(int(a), *map(float, b)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "label int, p_low double, p_medium double, p_high double"), y, p


def test_auc_with_ties_equals_pair_counting(spark):
    df, y, p = _scored(spark, 300, 3)
    got = {r["class"]: r["auc"] for r in metrics.auc_ovr(df).collect()}
    for k in range(3):
        pos, neg = p[y == k, k], p[y != k, k]
        wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
        assert got[k] == pytest.approx(wins / (len(pos) * len(neg)))


def test_auc_is_null_without_both_sides(spark):
    df, _, _ = _scored(spark, 20, 1)
    only = df.selectExpr("0 AS label", "p_low", "p_medium", "p_high")
    assert [r["auc"] for r in metrics.auc_ovr(only).collect()] == [None, None, None]


def test_brier_and_calibration(spark):
    df, y, p = _scored(spark, 400, 4)
    assert metrics.brier(df).first()["brier"] == pytest.approx(((p - np.eye(3)[y]) ** 2).sum(1).mean())
    confidence, hit = p.max(1), (p.argmax(1) == y).astype(float)
    bins = np.digitize(confidence, np.linspace(0, 1, 11)[1:-1])
    got = {r["bin"]: (r["confidence"], r["hit_rate"], r["cells"]) for r in metrics.calibration(df).collect()}
    assert set(got) == set(bins)
    for b in set(bins):
        m = bins == b
        assert got[b] == pytest.approx((confidence[m].mean(), hit[m].mean(), m.sum()))


def test_argmax_takes_the_lowest_class_on_ties(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.0, 0.1, 0.9)], "p_low double, p_medium double, p_high double")
    assert [r["k"] for r in df.select(metrics.argmax().alias("k")).collect()] == [0, 1, 2]
