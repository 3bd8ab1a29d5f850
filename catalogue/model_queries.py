"""Fitted classifiers over the region panel. Results depend on the learners, so
these have no SQL equivalent; tests hold them against the baselines instead. Every
search runs the library's whole grid at full size.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import functions as F

from riskpanel.operators import metrics, models, split
from riskpanel.plans import incremental, training
from riskpanel.session import fresh_path, materialise
from riskpanel.sources import artefacts, history

from .fixtures import LEVEL, TRAIN_END, VAL_END, nation_daily, region_daily
from .ingest_queries import HISTORY_END, _order_events
from .report_queries import nation_catalogue

def prepared_panel(spark, sf_dir) -> training.Prepared:
    daily = materialise(region_daily(spark, sf_dir), "daily")
    return training.prepare(daily, Date.fromisoformat(TRAIN_END), Date.fromisoformat(VAL_END), level="region")


def forest_test_report(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    model = models.forest(p.rows("train"), p.features)
    return metrics.full_report(materialise(models.score(model, p.rows("test")), "scored"))


def forest_details(spark, sf_dir):
    """Importance per feature, with the mean tree size alongside."""
    p = prepared_panel(spark, sf_dir)
    model = models.forest(p.rows("train"), p.features)
    size = models.tree_stats(model).agg(F.avg("nodes").alias("nodes"))
    return models.importances(model, p.features).withColumn("mean_nodes", size.scalar())


def forest_convergence(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    model = models.forest(p.rows("train"), p.features)
    return models.convergence(model, p.rows("val"))


def forest_raw_benchmark(spark, sf_dir):
    """The same forest on binned and on raw features."""
    p = prepared_panel(spark, sf_dir)
    raw = materialise(training.features.build_features(p.panel, p.level), "raw")
    binned = models.forest(p.rows("train"), p.features)
    unbinned = models.forest(split.model_rows(raw, "train"), p.features)
    return models.evaluate([models.Fitted("binned", binned)], p.rows("test")).unionByName(
        models.evaluate([models.Fitted("raw", unbinned)], split.model_rows(raw, "test"))
    )


def _searched(spark, sf_dir, find):
    """Every setting of one family's grid with its validation score."""
    p = prepared_panel(spark, sf_dir)
    return models.settings_table(spark, [find(p, p.rows("train"), p.rows("val"))])


def forest_grid(spark, sf_dir):
    return _searched(spark, sf_dir, lambda p, train, val: models.tune_forest(train, val, p.features))


def no_bootstrap_search(spark, sf_dir):
    def find(p, train, val):
        fit = lambda t, **c: models.forest(t, p.features, trees=300, bootstrap=False, **c)
        return models.search("forest_no_bootstrap", fit, models.NO_BOOTSTRAP_GRID, train, val)

    return _searched(spark, sf_dir, find)


def _searched_together(spark, sf_dir, name, fit, grid):
    return _searched(spark, sf_dir, lambda p, train, val: models.search_together(name, lambda t, g: fit(t, p.features, g), grid, train, val))


def logistic_search(spark, sf_dir):
    return _searched_together(spark, sf_dir, "logistic", models.fit_logistic, models.LOGISTIC_GRID)


def boosting_search(spark, sf_dir):
    return _searched_together(spark, sf_dir, "boosting", models.fit_boosting, models.BOOSTING_GRID)


def perceptron_search(spark, sf_dir):
    return _searched_together(spark, sf_dir, "perceptron", models.fit_perceptrons, models.PERCEPTRON_GRID)


def family_selection(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    fitted = models.fit_families(p.rows("train"), p.rows("val"), p.features)
    test = models.evaluate(fitted, p.rows("test")).drop("family_order")
    return models.compared(models.validation_table(spark, fitted).drop("seconds"), test)


def incremental_scoring(spark, sf_dir):
    """Freeze a model on the history, then score the week after all that came later."""
    daily = nation_daily(spark, sf_dir)
    end = F.lit(HISTORY_END).cast("date")
    past = training.prepare(
        daily.filter(F.col("event_date") <= end), Date(1998, 12, 31), Date(1999, 12, 31), level=LEVEL, check_gaps=False
    )
    model = models.forest(past.rows("train"), past.features)
    path = fresh_path(spark, "package")
    frozen = training.freeze(past, models.Fitted("forest", model, {"trees": 100}), nation_catalogue(spark, sf_dir))
    artefacts.save_package(frozen, path)
    package = artefacts.load_package(spark, path)

    events = _order_events(spark, sf_dir)
    store = fresh_path(spark, "history")
    history.write_batch(events.filter(F.col("event_date") <= end), store, "seed")
    later = events.filter(F.col("event_date") > end)
    return incremental.score_batch(later, package, store, "later", Date(2100, 1, 1)).matrix


QUERIES = {
    "forest_test_report": forest_test_report,
    "forest_details": forest_details,
    "forest_convergence": forest_convergence,
    "forest_raw_benchmark": forest_raw_benchmark,
    "forest_grid": forest_grid,
    "no_bootstrap_search": no_bootstrap_search,
    "logistic_search": logistic_search,
    "boosting_search": boosting_search,
    "perceptron_search": perceptron_search,
    "family_selection": family_selection,
    "incremental_scoring": incremental_scoring,
}
ORACLES: dict[str, str] = {}
