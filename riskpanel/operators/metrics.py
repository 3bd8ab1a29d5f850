"""Classification metrics as aggregates over scored rows.

Every function takes optional group columns, so the same code reports overall,
per model or per unit. Rows hold ``label``, ``pred`` and, where needed, the
class probabilities ``p_low``, ``p_medium``, ``p_high``, NULL where a model gives none.

``tally`` reduces scored rows to their distinct outcomes with a count; tallies of parts add
up, and all functions read a tally like the rows it stands for. A report thus reads the
scored rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .ordering import running_total

CLASSES = range(3)
NAMES = ("low", "medium", "high")
PROBABILITIES = ("p_low", "p_medium", "p_high")


def _grouped(rows: DataFrame, groups: Sequence[str], *aggregates: Column) -> DataFrame:
    return rows.groupBy(*groups).agg(*aggregates) if groups else rows.agg(*aggregates)


def tally(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Rows per group, label, prediction and probabilities, as ``cells``."""
    absent = [F.lit(None).cast("double").alias(p) for p in PROBABILITIES if p not in rows.columns]
    keys = [*groups, "label", "pred", *PROBABILITIES]
    return rows.select("*", *absent).groupBy(*keys).agg(F.sum(_weight(rows)).alias("cells"))


def _weight(rows: DataFrame) -> Column:
    """How many rows a row stands for."""
    return F.col("cells") if "cells" in rows.columns else F.lit(1).cast("bigint")


def _total(rows: DataFrame, condition: Column | None = None) -> Column:
    amount = _weight(rows)
    return F.coalesce(F.sum(amount if condition is None else F.when(condition, amount)), F.lit(0).cast("bigint"))


def _cells(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The nine cells of the confusion matrix as columns ``m<real><predicted>``."""
    return _grouped(
        rows,
        groups,
        _total(rows).alias("n"),
        *[
            _total(rows, (F.col("label") == i) & (F.col("pred") == j)).alias(f"m{i}{j}")
            for i in CLASSES
            for j in CLASSES
        ],
    )


def confusion_matrix(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """All nine (label, pred) cells, zeros included."""
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("label"), F.lit(j).alias("pred"), F.col(f"m{i}{j}").alias("cells"))
            for i in CLASSES
            for j in CLASSES
        ]
    )
    return _cells(rows, groups).select(*groups, F.explode(cells).alias("c")).select(*groups, "c.*")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _per_class() -> list[tuple[Column, Column, Column, Column]]:
    """(support, precision, recall, f1) per class from the nine cells."""
    out = []
    for k in CLASSES:
        hit = F.col(f"m{k}{k}")
        predicted = sum((F.col(f"m{i}{k}") for i in CLASSES), F.lit(0))
        real = sum((F.col(f"m{k}{j}") for j in CLASSES), F.lit(0))
        precision, recall = _ratio(hit, predicted), _ratio(hit, real)
        out.append((real, precision, recall, _ratio(2 * precision * recall, precision + recall)))
    return out


def class_metrics(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 per class; undefined ratios are 0."""
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("label"),
                real.alias("support"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1.alias("f1"),
            )
            for k, (real, precision, recall, f1) in enumerate(_per_class())
        ]
    )
    return _cells(rows, groups).select(*groups, F.explode(entries).alias("c")).select(*groups, "c.*")


def _macro_columns() -> list[Column]:
    """Accuracy, macro F1 and the per-class figures from the nine cells."""
    per_class = _per_class()
    hits = sum((F.col(f"m{k}{k}") for k in CLASSES), F.lit(0))
    f1 = [c[3] for c in per_class]
    return [
        F.col("n"),
        _ratio(hits, F.col("n")).alias("accuracy"),
        ((f1[0] + f1[1] + f1[2]) / 3).alias("f1_macro"),
        *[f.alias(f"f1_{name}") for f, name in zip(f1, NAMES)],
        per_class[2][2].alias("recall_high"),
        per_class[2][1].alias("precision_high"),
    ]


def macro_report(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 (absent classes count as 0) and the per-class figures."""
    return _cells(rows, groups).select(*groups, *_macro_columns())


def metrics_by_unit(rows: DataFrame, unit: str = "unit_id") -> DataFrame:
    """The report per unit with its class counts, since few rows make F1 unstable."""
    real = [c[0] for c in _per_class()]
    macro = _cells(rows, [unit]).select(
        unit,
        *_macro_columns(),
        sum(((r > 0).cast("int") for r in real), F.lit(0)).alias("classes_present"),
        F.concat_ws("/", *[r.cast("string") for r in real]).alias("dist_low_medium_high"),
    )
    return macro.drop(*[f"f1_{name}" for name in NAMES])


def brier(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Mean squared distance of the probability vector to the one-hot label."""
    error = sum(
        (
            F.pow(F.col(p) - (F.col("label") == k).cast("double"), F.lit(2.0))
            for k, p in enumerate(PROBABILITIES)
        ),
        F.lit(0.0),
    )
    weight = F.when(error.isNotNull(), _weight(rows))
    return _grouped(rows, groups, F.try_divide(F.sum(error * weight), F.sum(weight).cast("double")).alias("brier"))


def auc_ovr(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """One-against-rest AUC per class from mid-ranks; NULL when a side is empty or there are no scores.

    Rows are first reduced to distinct scores, so a score shared by many rows is
    one row, and ranks come from a running total that no single task computes.
    """
    groups = list(groups)
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("class"), F.col(p).alias("score"), (F.col("label") == k).cast("int").alias("hit"))
            for k, p in enumerate(PROBABILITIES)
        ]
    )
    scores = (
        rows.select(*groups, _weight(rows).alias("w"), F.explode(entries).alias("e"))
        .select(*groups, "w", "e.*")
        .groupBy(*groups, "class", "score")
        .agg(F.sum("w").alias("rows"), F.sum(F.col("hit") * F.col("w")).alias("hits"))
    )
    keys = [*groups, "class"]
    ranked = running_total(scores, "score", ["rows"], keys)
    mid_rank = F.col("rows_before") + (F.col("rows") + 1) / 2
    sums = ranked.groupBy(*keys).agg(
        F.sum(F.col("hits") * mid_rank).alias("rank_sum"),
        F.sum("hits").cast("double").alias("hits"),
        F.sum("rows").cast("double").alias("rows"),
        F.bool_and(F.col("score").isNotNull()).alias("scored"),
    )
    hits, misses = F.col("hits"), F.col("rows") - F.col("hits")
    auc = F.when(F.col("scored"), F.try_divide(F.col("rank_sum") - hits * (hits + 1) / 2, hits * misses))
    return sums.select(*keys, auc.alias("auc"))


def calibration(rows: DataFrame, groups: Sequence[str] = (), n_bins: int = 10) -> DataFrame:
    """Mean confidence against hit rate in equal-width bins; empty bins are dropped."""
    confidence = F.greatest(*PROBABILITIES)
    # bin edges i * (1/n), spelled out so that ties fall where the floats do
    edges = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    bin_idx = sum(((confidence >= F.lit(e)).cast("int") for e in edges), F.lit(0))
    hit = (argmax() == F.col("label")).cast("double")
    weight = _weight(rows).alias("w")
    binned = rows.select(*groups, bin_idx.alias("bin"), confidence.alias("confidence"), hit.alias("hit"), weight)
    mean = lambda c: F.sum(F.col(c) * F.col("w")) / F.sum("w")
    return binned.groupBy(*groups, "bin").agg(
        mean("confidence").alias("confidence"), mean("hit").alias("hit_rate"), F.sum("w").alias("cells")
    )


def argmax(probabilities: Sequence[str] = PROBABILITIES) -> Column:
    """Class of the largest probability, the lowest class on ties."""
    p = F.array(*probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def full_report(rows: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """One row per group: macro report, precision and recall of each class, the matrix, Brier score and AUCs.

    ``m<real><predicted>`` are the nine cells of the matrix. The rows are read once. Brier
    score and AUCs are NULL for models without probabilities.
    """
    keys = list(groups)
    counted = materialise(tally(rows, keys), "outcomes")
    whole = None if keys else F.lit(0).alias("_all")
    if whole is not None:
        counted, keys = counted.select("*", whole), ["_all"]
    per_class = _per_class()
    sides = [(i, name) for i, name in ((1, "precision"), (2, "recall"))]
    figures = [per_class[k][i].alias(f"{name}_{NAMES[k]}") for i, name in sides for k in CLASSES[:2]]
    matrix = [f"m{i}{j}" for i in CLASSES for j in CLASSES]
    macro = _cells(counted, keys).select(*keys, *_macro_columns(), *figures, *matrix)
    auc = auc_ovr(counted, keys).groupBy(*keys).agg(
        *[F.max(F.when(F.col("class") == k, F.col("auc"))).alias(f"auc_{name}") for k, name in enumerate(NAMES)]
    )
    return macro.join(brier(counted, keys), keys).join(auc, keys).drop("_all")
