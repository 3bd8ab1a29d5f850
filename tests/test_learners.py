"""Learners that fit a grid in shared passes: gradients, sums, trees and saved models against plain numpy."""

import numpy as np
import pytest

from riskpanel.operators import boosting, metrics, models, networks, passes
from riskpanel.sources import artefacts

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (900, 3)).astype(float)
    score = x[:, 0] - 0.7 * x[:, 1] + rng.normal(0, 1.5, 900)
    y = (score > 0).astype(int) + (score > 7).astype(int)
    rows = [(int(k), float(w), *map(float, r)) for k, w, r in zip(y, rng.uniform(0.5, 2, 900), x, strict=True)]
    df = spark.createDataFrame(rows, "label int, weight double, " + ", ".join(f"{n} double" for n in NAMES)).repartition(5).cache()
    return df, x, y, np.array([r[1] for r in rows])


@pytest.mark.parametrize("hidden", [(), (5,), (6, 4)])
def test_gradients_equal_differences(hidden):
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(40, 3)), rng.integers(0, 3, 40), rng.uniform(0.5, 2, 40)
    layers = (3, *hidden, 3)
    flat = rng.normal(size=sum(a * b for a, b in networks._shapes(layers)))
    found = networks.loss_and_gradient(x, y, w, flat, layers)
    for i in rng.choice(len(flat), 12, replace=False):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up, down = (networks.loss_and_gradient(x, y, w, flat + s * step, layers)[0] for s in (1, -1))
        assert found[1 + i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-4)


def test_a_pass_adds_up_whatever_the_parts(spark, data, monkeypatch):
    df, x, _, w = data
    want = np.append(x.T @ w, len(x))
    for parts in (1, 7, 40):
        p = passes.Pass(passes.training_rows(df.repartition(parts), NAMES))
        got = p.total(lambda b: np.append(passes.matrix(b.column("x"), 3).T @ b.column("weight").to_numpy(), b.num_rows), 4)
        p.release()
        assert np.allclose(got, want)
    none = passes.Pass(passes.training_rows(df.limit(0), NAMES))
    assert none.total(lambda b: np.ones(2), 2).tolist() == [0, 0]


def test_logistic_reaches_the_optimum(data):
    df, x, y, w = data
    (model,) = networks.fit_networks(df, NAMES, [{"hidden": (), "l2": 0.01}], max_iter=500, tolerance=1e-10)
    z = (x - model.mean) / model.scale
    gradient = networks.loss_and_gradient(z, y, w, model.flat, model.layers)[1:] / w.sum()
    assert np.abs(gradient + networks._penalised(model.layers, 0.01) * model.flat).max() < 1e-4


def test_settings_fitted_together_equal_single_fits(data):
    df = data[0]
    grid = [{"hidden": (4,), "l2": 1e-3}, {"hidden": (), "l2": 0.1}]
    both = networks.fit_networks(df, NAMES, grid, max_iter=30)
    for setting, model in zip(grid, both, strict=True):
        (alone,) = networks.fit_networks(df, NAMES, [setting], max_iter=30)
        assert np.allclose(alone.flat, model.flat, atol=1e-6)
    trees = [{"iterations": n, "rate": r, "depth": d} for n, r, d in ((3, 0.3, 2), (6, 0.3, 2), (4, 0.1, 3))]
    for setting, model in zip(trees, boosting.fit_boosting(df, NAMES, trees), strict=True):
        (alone,) = boosting.fit_boosting(df, NAMES, [setting])
        assert len(model.trees.value) == 3 * setting["iterations"]
        assert np.allclose(alone.predict(data[1]), model.predict(data[1]))


def numpy_boosting(x, y, w, rounds, rate, depth):
    """The same trees grown row by row in one place."""
    start = np.log([w[y == k].sum() for k in range(3)])
    margins = np.tile(start - start.mean(), (len(x), 1))
    for _ in range(rounds):
        p = passes.softmax(margins)
        added = np.zeros_like(margins)
        for k in range(3):
            g, h = (p[:, k] - (y == k)) * w, p[:, k] * (1 - p[:, k]) * w
            nodes = [np.ones(len(x), bool)]
            for _ in range(depth):
                split = []
                for rows in nodes:
                    value = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
                    best = (1e-12, None)
                    for f in range(x.shape[1]):
                        for cut in np.unique(x[:, f])[:-1]:
                            low, high = rows & (x[:, f] <= cut), rows & (x[:, f] > cut)
                            if h[low].sum() > 1e-3 and h[high].sum() > 1e-3:
                                gain = value(low) + value(high) - value(rows)
                                if gain > best[0] + 1e-9:
                                    best = (gain, (low, high))
                    split += best[1] or (rows, np.zeros(len(x), bool))
                nodes = split
            for rows in nodes:
                added[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + 1)
        margins += added
    return passes.softmax(margins)


def test_boosting_equals_plain_trees(data):
    df, x, y, w = data
    (model,) = boosting.fit_boosting(df, NAMES, [{"iterations": 25, "rate": 0.2, "depth": 2}])
    assert np.allclose(model.predict(x), numpy_boosting(x, y, w, 25, 0.2, 2), atol=1e-8)


def test_models_are_saved_and_read_back(spark, data, tmp_path):
    df, x, _, _ = data
    fitted = [
        boosting.fit_boosting(df, NAMES, [{"iterations": 3, "rate": 0.1, "depth": 2}])[0],
        networks.fit_networks(df, NAMES, [{"hidden": (3,), "l2": 0.0}], max_iter=5)[0],
    ]
    for i, model in enumerate(fitted):
        artefacts.save_model(spark, model, f"{tmp_path}/{i}")
        again = artefacts.load_model(spark, f"{tmp_path}/{i}", "own")
        assert np.array_equal(again.predict(x), model.predict(x)) and models.input_features(again) == list(NAMES)
        scored = models.score(again, df)
        assert scored.columns == [*df.columns, *metrics.PROBABILITIES, "pred"] and scored.count() == 900


def test_a_class_without_rows_is_never_predicted(data):
    df, x, _, _ = data
    two = df.filter("label < 2")
    for model in (
        boosting.fit_boosting(two, NAMES, [{"iterations": 5, "rate": 0.1, "depth": 2}])[0],
        networks.fit_networks(two, NAMES, [{"hidden": (), "l2": 0.01}], max_iter=50)[0],
    ):
        p = model.predict(x)
        assert np.isfinite(p).all() and (p.argmax(axis=1) < 2).all()
