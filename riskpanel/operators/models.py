"""Classifier families, tuned on the chronological validation split.

Forests are MLlib pipelines, fitted several settings at a time; boosting, softmax regression
and perceptrons are fitted a whole grid at once (``boosting``, ``networks``). All read the same
feature columns, and their rows carry ``label`` and ``weight``. Nothing here ever sees the
test split, except ``evaluate``, which fits nothing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import BoostedModel, fit_boosting
from .metrics import PROBABILITIES, argmax, full_report, macro_report
from .networks import NetworkModel, fit_networks
from .passes import ProbabilityModel
from .weights import class_weights, with_row_weights

# Seed, bootstrap cap per tree, bins, and the tuning grids.
SEED = 42
MAX_ROWS_PER_TREE = 200_000
MAX_BINS = 32
DEEPEST = 30  # MLlib's limit, where the grid says "no limit"
TIE = 1e-12
FOREST_GRID = tuple({"depth": d, "power": p} for d, p in product((8, 12, 16), (1.0, 0.5)))
NO_BOOTSTRAP_GRID = tuple({"depth": d, "min_leaf": m} for d, m in product((8, 16, DEEPEST), (1, 5)))
LOGISTIC_GRID = tuple({"C": c} for c in (0.01, 0.1, 1.0, 10.0, 100.0))
BOOSTING_GRID = tuple(
    {"iterations": n, "rate": r, "depth": d} for n, r, d in product((100, 200), (0.05, 0.10), (2, 3))
)
PERCEPTRON_GRID = tuple({"layers": h, "alpha": a} for h, a in product(((32,), (64, 32), (128, 64)), (1e-4, 1e-3)))
CONVERGENCE_SIZES = (1, 5, 10, 25, 50, 75, 100)

#: Settings of a search that are fitted at a time.
PARALLEL_FITS = 4


@dataclass
class Fitted:
    """A family frozen after validation; ``tried`` holds every setting with its score."""

    name: str
    model: PipelineModel | ProbabilityModel
    config: dict = field(default_factory=dict)
    f1_validation: float = float("nan")
    seconds: float = float("nan")
    tried: list[tuple[dict, float]] = field(default_factory=list)


def weighted(rows: DataFrame) -> DataFrame:
    """Rows with the balanced weight of their class."""
    return with_row_weights(rows, class_weights(rows))


@contextmanager
def training_set(rows: DataFrame) -> Iterator[DataFrame]:
    """Weighted rows, cached for the many passes of a fit or search and released after it.

    Rows are dealt by their values into a number of parts that only their count decides,
    and sorted there, so the learners' seeds give the same samples on every cluster. Rows
    that already have a weight are used as they are.
    """
    if "weight" in rows.columns:
        yield rows
        return
    count = rows.count()
    parts = max(1, min(256, count // 4_000), count // 1_000_000)
    out = weighted(rows)
    cached = out.repartition(parts, *out.columns).sortWithinPartitions(*out.columns).persist()
    try:
        yield cached
    finally:
        cached.unpersist()


def _pipeline(features: Sequence[str], classifier: Estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), classifier])


def forest(
    train: DataFrame,
    features: Sequence[str],
    *,
    trees: int = 100,
    depth: int = 16,
    min_leaf: int = 5,
    power: float = 1.0,
    bootstrap: bool = True,
    rows_per_tree: int | None = MAX_ROWS_PER_TREE,
    seed: int = SEED,
) -> PipelineModel:
    """Random forest on class-weighted rows.

    ``power`` softens the weights. With ``bootstrap``, a tree samples ``rows_per_tree``
    rows, or as many as there are if that is None or more. Node ids are cached per row,
    which spares deep forests from shipping all trees with every pass.
    """
    classifier = RandomForestClassifier(
        labelCol="label",
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        maxBins=MAX_BINS,
        featureSubsetStrategy="sqrt",
        bootstrap=bootstrap,
        cacheNodeIds=True,
        seed=seed,
    )
    with training_set(train) as rows:
        if bootstrap and rows_per_tree is not None:
            classifier.setSubsamplingRate(min(1.0, rows_per_tree / max(rows.count(), 1)))
        return _pipeline(features, classifier).fit(rows.withColumn("weight", F.pow("weight", F.lit(float(power)))))


def fit_logistic(train: DataFrame, features: Sequence[str], grid: Sequence[dict], *, max_iter: int = 2000) -> list[NetworkModel]:
    """Multinomial logistic regressions on standardised features, balanced weights, one per ``C`` of the grid.

    With balanced weights the weight sum is the row count, which turns the inverse penalty C
    into an L2 penalty on the mean loss.
    """
    with training_set(train) as rows:
        n = max(rows.count(), 1)
        settings = [{"hidden": (), "l2": 1.0 / (c["C"] * n)} for c in grid]
        return fit_networks(rows, features, settings, max_iter=max_iter, tolerance=1e-6, patience=3)


def logistic(train: DataFrame, features: Sequence[str], *, C: float = 1.0, max_iter: int = 2000) -> NetworkModel:
    return fit_logistic(train, features, [{"C": C}], max_iter=max_iter)[0]


def boosting(train: DataFrame, features: Sequence[str], *, iterations: int = 100, rate: float = 0.1, depth: int = 3) -> BoostedModel:
    """Multiclass gradient-boosted trees on weighted rows."""
    with training_set(train) as rows:
        return fit_boosting(rows, features, [{"iterations": iterations, "rate": rate, "depth": depth}])[0]


def balanced_repeats(train: DataFrame, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """Repeat rows until the classes balance; no row is ever left out.

    The fractional part of a repeat count is decided by a hash of the row's
    keys, so a recomputed partition repeats the same rows.
    """
    if "weight" not in train.columns:
        train = weighted(train)
    least = train.agg(F.min("weight").alias("w")).scalar()
    copies = train.withColumn("copies", F.col("weight") / least)
    chance = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    whole = F.floor("copies")
    count = (whole + (chance < F.col("copies") - whole).cast("int")).cast("int")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1), count))).drop("copies", "copy", "weight")


def fit_perceptrons(train: DataFrame, features: Sequence[str], grid: Sequence[dict], *, max_iter: int = 800) -> list[NetworkModel]:
    """Multilayer perceptrons on standardised features, one per ``layers`` and ``alpha`` of the grid.

    Rows count by their class weight; ``alpha`` is the L2 penalty of a whole training set.
    """
    with training_set(train) as rows:
        n = max(rows.count(), 1)
        settings = [{"hidden": tuple(c["layers"]), "l2": c.get("alpha", 1e-4) / n} for c in grid]
        return fit_networks(rows, features, settings, max_iter=max_iter, tolerance=1e-4, seed=SEED)


def perceptron(train: DataFrame, features: Sequence[str], *, max_iter: int = 800, **config) -> NetworkModel:
    return fit_perceptrons(train, features, [config], max_iter=max_iter)[0]


def score(model: PipelineModel | ProbabilityModel, rows: DataFrame) -> DataFrame:
    """Add ``p_low, p_medium, p_high`` and ``pred`` (lowest class on ties)."""
    out = model.transform(rows)
    p = F.col("probability") if isinstance(model, ProbabilityModel) else vector_to_array("probability")
    scored = out.withColumn("_p", p).withColumns({c: F.col("_p")[k] for k, c in enumerate(PROBABILITIES)})
    return scored.select(*rows.columns, *PROBABILITIES).withColumn("pred", argmax())


def input_features(model: PipelineModel | ProbabilityModel) -> list[str]:
    """The columns a fitted model reads, in its order."""
    return list(model.features) if isinstance(model, ProbabilityModel) else list(model.stages[0].getInputCols())


def macro_f1(scored: DataFrame) -> float:
    return float(macro_report(scored).first()["f1_macro"])


def best_of(candidates: Iterable[tuple[PipelineModel, dict, float]]) -> tuple[PipelineModel, dict, float]:
    """Highest validation score; the first one wins a tie."""
    best = None
    for candidate in candidates:
        if best is None or candidate[2] > best[2] + TIE:
            best = candidate
    if best is None:
        raise ValueError("the grid is empty")
    return best


def search(
    name: str,
    fit: Callable[..., PipelineModel],
    grid: Iterable[dict],
    train: DataFrame,
    val: DataFrame,
    *,
    parallelism: int = PARALLEL_FITS,
) -> Fitted:
    """Fit every configuration on train, keep the best on the validation weeks.

    ``parallelism`` settings are fitted at a time, as the jobs of one fit leave most of a
    cluster idle; the order of the grid decides ties, whichever fit ends first.
    """
    start = time.perf_counter()
    with training_set(train) as rows, ThreadPool(max(1, parallelism)) as pool:

        def tried(config: dict) -> tuple[PipelineModel, dict, float]:
            model = fit(rows, **config)
            return model, config, macro_f1(score(model, val))

        found = pool.map(tried, list(grid), chunksize=1)
    model, config, f1 = best_of(found)
    scores = [(dict(c), f) for _, c, f in found]
    return Fitted(name, model, dict(config), f1, time.perf_counter() - start, scores)


def search_together(
    name: str,
    fit: Callable[..., Sequence[ProbabilityModel]],
    grid: Iterable[dict],
    train: DataFrame,
    val: DataFrame,
) -> Fitted:
    """Like ``search``, for a learner that fits the whole grid at once: ``fit(rows, grid)``."""
    start, grid = time.perf_counter(), list(grid)
    with training_set(train) as rows:
        found = fit(rows, grid)
    scored = [score(m, val).select(F.lit(i).alias("setting"), "label", "pred") for i, m in enumerate(found)]
    report = macro_report(reduce(DataFrame.unionByName, scored), ["setting"]).collect() if scored else []
    f1 = {r["setting"]: float(r["f1_macro"]) for r in report}
    tried = [(m, dict(c), f1.get(i, float("nan"))) for i, (m, c) in enumerate(zip(found, grid, strict=True))]
    model, config, best = best_of(tried)
    return Fitted(name, model, config, best, time.perf_counter() - start, [(c, f) for _, c, f in tried])


def tune_forest(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    *,
    grid: Iterable[dict] = FOREST_GRID,
    search_trees: int = 30,
    trees: int = 100,
    rows_per_tree: int | None = MAX_ROWS_PER_TREE,
) -> Fitted:
    """Search depth and weight power with few trees, refit the winner with all."""
    start = time.perf_counter()
    with training_set(train) as rows:
        found = search(
            "forest",
            lambda t, **c: forest(t, features, trees=search_trees, rows_per_tree=rows_per_tree, **c),
            grid,
            rows,
            val,
        )
        model = forest(rows, features, trees=trees, rows_per_tree=rows_per_tree, **found.config)
    config = {**found.config, "trees": trees}
    return Fitted("forest", model, config, macro_f1(score(model, val)), time.perf_counter() - start, found.tried)


def fit_families(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    *,
    forest_grid: Iterable[dict] = FOREST_GRID,
    no_bootstrap_grid: Iterable[dict] = NO_BOOTSTRAP_GRID,
    logistic_grid: Iterable[dict] = LOGISTIC_GRID,
    boosting_grid: Iterable[dict] = BOOSTING_GRID,
    perceptron_grid: Iterable[dict] = PERCEPTRON_GRID,
    trees: int = 100,
    search_trees: int = 30,
    no_bootstrap_trees: int = 300,
    perceptron_iterations: int = 800,
) -> list[Fitted]:
    """Five families from train and validation rows, several at a time; there is no test argument.

    ``forest_no_bootstrap`` stands where MLlib lacks extremely randomised trees.
    """
    val = val.persist()
    with training_set(train) as rows, ThreadPool(PARALLEL_FITS) as pool:
        families = [
            lambda: tune_forest(rows, val, features, grid=forest_grid, search_trees=search_trees, trees=trees),
            lambda: search(
                "forest_no_bootstrap",
                lambda t, **c: forest(t, features, trees=no_bootstrap_trees, bootstrap=False, **c),
                no_bootstrap_grid,
                rows,
                val,
            ),
            lambda: search_together("logistic", lambda t, g: fit_logistic(t, features, g), logistic_grid, rows, val),
            lambda: search_together("boosting", lambda t, g: fit_boosting(t, features, g), boosting_grid, rows, val),
            lambda: search_together(
                "perceptron", lambda t, g: fit_perceptrons(t, features, g, max_iter=perceptron_iterations), perceptron_grid, rows, val
            ),
        ]
        fitted = pool.map(lambda family: family(), families, chunksize=1)
    val.unpersist()
    return fitted


def settings_table(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """Every setting tried, in the order of its grid, with its validation macro F1."""
    rows = [(f.name, i, json.dumps(c), round(f1, 6)) for f in fitted for i, (c, f1) in enumerate(f.tried)]
    return spark.createDataFrame(rows, "model string, setting int, config string, f1_macro_val double")


def validation_table(spark: SparkSession, fitted: Sequence[Fitted]) -> DataFrame:
    """Families by falling validation macro F1, in family order on ties."""
    rows = [
        (i, f.name, round(f.f1_validation, 6), round(f.seconds, 3), json.dumps(f.config)) for i, f in enumerate(fitted)
    ]
    table = spark.createDataFrame(rows, "family_order int, model string, f1_macro_val double, seconds double, config string")
    return table.orderBy(F.desc("f1_macro_val"), "family_order")


def select_family(fitted: Sequence[Fitted]) -> Fitted:
    return best_of([(f, {}, f.f1_validation) for f in fitted])[0]


def evaluate(fitted: Sequence[Fitted], test: DataFrame) -> DataFrame:
    """Test report per frozen family, by falling macro F1. Fits nothing."""
    out = None
    for i, f in enumerate(fitted):
        rows = score(f.model, test).select(
            F.lit(i).alias("family_order"), F.lit(f.name).alias("model"), "label", "pred", *PROBABILITIES
        )
        out = rows if out is None else out.unionByName(rows)
    return full_report(out, ["family_order", "model"]).orderBy(F.desc("f1_macro"), "family_order")


def compared(validation: DataFrame, test: DataFrame) -> DataFrame:
    """Validation and test figures side by side."""
    return validation.join(test, "model", "left")


def _trees(model: PipelineModel):
    return model.stages[-1].trees


def importances(model: PipelineModel, features: Sequence[str], limit: int | None = None) -> DataFrame:
    """Normalised impurity reduction per feature, largest first."""
    spark = SparkSession.active()
    values = [(f, float(v)) for f, v in zip(features, model.stages[-1].featureImportances.toArray())]
    table = spark.createDataFrame(values, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table if limit is None else table.limit(limit)


def tree_stats(model: PipelineModel) -> DataFrame:
    """Depth and node count per tree."""
    rows = [(i, t.depth, t.numNodes) for i, t in enumerate(_trees(model))]
    return SparkSession.active().createDataFrame(rows, "tree int, depth int, nodes int")


def convergence(model: PipelineModel, rows: DataFrame, sizes: Sequence[int] = CONVERGENCE_SIZES) -> DataFrame:
    """Macro F1 with the first B trees, for several B, in one pass over the rows."""
    trees = _trees(model)
    sizes = [b for b in sizes if b <= len(trees)]
    out = model.stages[0].transform(rows)
    for i, tree in enumerate(trees[: max(sizes)]):
        out = tree.copy().setProbabilityCol(f"_t{i}").setPredictionCol("").setRawPredictionCol("").transform(out)
        vote = vector_to_array(f"_t{i}")
        sums = vote if i == 0 else F.zip_with("_sum", vote, lambda a, b: a + b)
        out = out.withColumn("_sum", sums).drop(f"_t{i}")
        if i + 1 in sizes:
            out = out.withColumn(f"_pred{i + 1}", (F.array_position("_sum", F.array_max("_sum")) - 1).cast("int"))
    wide = out.select("label", *[F.col(f"_pred{b}").alias(str(b)) for b in sizes])
    long = wide.unpivot(["label"], [str(b) for b in sizes], "trees", "pred")
    report = macro_report(long, ["trees"])
    return report.select(F.col("trees").cast("int").alias("trees"), "f1_macro")
