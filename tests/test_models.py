"""Learners on small separable data; never compared with another library's numbers."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import baselines, metrics, models, weights

FEATURES = ("f0", "f1", "f2", "f3", "f4")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(180, 5))
    line = x @ np.array([1.2, -0.8, 0.5, 0.0, 0.0])
    y = (line > -0.45).astype(int) + (line > 0.65).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(180)]
    df = spark.createDataFrame(rows, "id int, label int, " + ", ".join(f"{f} double" for f in FEATURES)).cache()
    return df.filter("id < 110"), df.filter("id >= 110 AND id < 145"), df.filter("id >= 145")


@pytest.fixture(scope="module")
def fitted(data):
    train, val, _ = data
    return models.fit_families(
        train, val, FEATURES,
        forest_grid=[{"depth": 4, "power": 1.0}], no_bootstrap_grid=[{"depth": 4, "min_leaf": 1}],
        logistic_grid=[{"C": 0.01}, {"C": 1.0}], boosting_grid=[{"iterations": 3, "rate": 0.1, "depth": 2}],
        perceptron_grid=[{"layers": (8,)}], trees=10, search_trees=5, no_bootstrap_trees=10, perceptron_iterations=30,
    )


def test_selection_cannot_see_the_test_split():
    for f in (models.fit_families, models.search, models.tune_forest):
        assert not [p for p in inspect.signature(f).parameters if "test" in p]


def test_five_families_are_compared_and_evaluated(spark, data, fitted):
    table = models.validation_table(spark, fitted).collect()
    assert len(table) == 5 and [r["f1_macro_val"] for r in table] == sorted((r["f1_macro_val"] for r in table), reverse=True)
    assert models.select_family(fitted).f1_validation == max(f.f1_validation for f in fitted)
    report = models.evaluate(fitted, data[2]).collect()
    assert {r["model"] for r in report} == {f.name for f in fitted}
    assert all(0 <= r["f1_macro"] <= 1 and r["brier"] >= 0 and r["n"] == 35 for r in report)
    both = models.compared(models.validation_table(spark, fitted), models.evaluate(fitted, data[2]).drop("family_order"))
    assert both.filter("f1_macro IS NULL").count() == 0


def test_probabilities_sum_to_one(data, fitted):
    for f in fitted:
        total = models.score(f.model, data[2]).select((F.col("p_low") + F.col("p_medium") + F.col("p_high")).alias("s"))
        assert all(abs(r["s"] - 1) < 1e-9 for r in total.collect()), f.name


def test_first_candidate_wins_ties():
    assert models.best_of([("a", {}, 0.5), ("b", {}, 0.5 + 1e-13), ("c", {}, 0.4)])[0] == "a"
    with pytest.raises(ValueError):
        models.best_of([])


def test_scaler_is_fitted_on_train_only(data):
    train, val, _ = data
    shifted = val.withColumns({f: F.col(f) + 100 for f in FEATURES})
    model = models.search("logistic", lambda t, **c: models.logistic(t, FEATURES, **c), [{"C": 1.0}], train, shifted).model
    mean = train.agg(F.avg("f0")).first()[0]
    assert model.mean[0] == pytest.approx(mean)


def test_separable_rows_are_learned_and_the_seed_repeats(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 32, (3000, 4))
    y = (x[:, 0] > 10).astype(int) + (x[:, 0] > 21).astype(int)
    rows = [(int(y[i]), *map(int, x[i])) for i in range(3000)]
    df = spark.createDataFrame(rows, "label int, a int, b int, c int, d int").cache()
    first, second = (models.forest(df, ["a", "b", "c", "d"], trees=15, depth=8) for _ in range(2))
    scored = models.score(first, df)
    assert metrics.macro_report(scored).first()["accuracy"] > 0.99
    again = {r["p_low"] for r in models.score(second, df).select("p_low").distinct().collect()}
    assert {r["p_low"] for r in scored.select("p_low").distinct().collect()} == again
    assert models.importances(first, ["a", "b", "c", "d"]).first()["feature"] == "a"
    stats = models.tree_stats(first).collect()
    assert len(stats) == 15 and all(r["nodes"] >= 3 and r["depth"] <= 8 for r in stats)
    curve = {r["trees"]: r["f1_macro"] for r in models.convergence(first, df, (1, 5, 15, 50)).collect()}
    assert set(curve) == {1, 5, 15} and curve[15] == pytest.approx(models.macro_f1(scored))


def test_balanced_repeats_keep_every_row(data):
    train = data[0].filter("label < 2 OR id % 4 = 0")
    repeated = models.balanced_repeats(train, ["id"])
    assert repeated.select("id").distinct().count() == train.count()
    counts = [r["cells"] for r in weights.class_weights(repeated).collect()]
    assert max(counts) / min(counts) < 1.5


def test_baselines(spark):
    labels = {("a", 0): [0, 1, 1, 2, 1, 1], ("a", 1): [2, 2, 0, 0, 1, 2]}
    splits = ["train"] * 4 + ["test"] * 2
    rows = [(u, d, w, ys[w], splits[w], True) for (u, d), ys in labels.items() for w in range(6)]
    df = spark.createDataFrame(rows, "unit_id string, dow int, week_idx int, label int, split string, eligible boolean")

    def preds(out, d):
        return [r["pred"] for r in out.filter(F.col("dow") == d).orderBy("week_idx").collect()]

    assert preds(baselines.persistence(df), 0) == [0, 0, 1, 1, 2, 1]
    assert set(preds(baselines.historical_mode(df), 0)) == {1}
    assert set(preds(baselines.historical_mode(df), 1)) == {0}  # 0 and 2 tie
    assert set(preds(baselines.majority(df), 1)) == {0}  # 0 and 2 tie over all training rows
