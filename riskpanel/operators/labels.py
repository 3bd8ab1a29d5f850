"""Risk labels from count thresholds, chosen on a ladder of four rules.

All rules are fitted on the histogram of training counts of eligible rows, so the panel
is read once for the whole ladder. Percentiles and forced cuts are ranks in running totals
over ranges of that histogram; no task holds all of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import exact_quantiles, running_total

# The rules in the order they are tried, and what they are based on.
RUNGS = ("global", "positivos", "por_dia", "discreto")
RUNG_BASES = ("todos", "positivos", "por dia", "todos (cortes enteros forzados)")

NOT_FORMULABLE = (
    "no threshold rule yields three non-empty classes: use more months, coarser units or two classes"
)


def training_histogram(split_panel: DataFrame) -> DataFrame:
    """Cells per (weekday, count) over eligible training rows."""
    rows = split_panel.filter((F.col("split") == "train") & F.col("eligible"))
    return rows.groupBy("dow", "n").agg(F.count("*").alias("cells"))


def _rung(name: str, low: Column, high: Column, days: tuple[Column, Column] | None = None) -> Column:
    per_day = days or (F.lit(None), F.lit(None))
    return F.struct(
        F.lit(name).alias("rung"),
        low.cast("double").alias("low"),
        high.cast("double").alias("high"),
        per_day[0].cast("array<double>").alias("low_by_day"),
        per_day[1].cast("array<double>").alias("high_by_day"),
    )


def _percentile_rungs(histogram: DataFrame, p_low: float, p_high: float) -> DataFrame:
    """Percentile pairs over all counts, over positive counts, and per weekday."""
    every = histogram.select(F.lit(-2).alias("which"), "n", "cells")
    positive = histogram.filter(F.col("n") > 0).select(F.lit(-1).alias("which"), "n", "cells")
    days = histogram.select(F.col("dow").alias("which"), "n", "cells")
    counts = every.unionByName(positive).unionByName(days).groupBy("which", "n").agg(F.sum("cells").alias("cells"))
    fitted = exact_quantiles(counts, "n", "cells", [p_low / 100.0, p_high / 100.0], ["which"])  # at most nine rows
    one_day = F.struct(F.col("which").alias("dow"), F.col("quantiles")[0].alias("low"), F.col("quantiles")[1].alias("high"))
    of_day = F.col("which") >= 0
    row = fitted.agg(
        F.max(F.when(F.col("which") == -2, F.col("quantiles"))).alias("every"),
        F.max(F.when(F.col("which") == -1, F.col("quantiles"))).alias("above_zero"),
        F.collect_list(F.when(of_day, one_day)).alias("days"),
        F.max(F.when(of_day, F.col("which"))).alias("max_dow"),
    ).withColumn("cut", F.map_from_entries(F.transform("days", lambda d: F.struct(d["dow"], d))))
    week = F.sequence(F.lit(0), F.lit(6))

    def per_day(side: str) -> Column:
        return F.transform(week, lambda d: F.coalesce(F.col("cut")[d][side], F.lit(0.0)))

    rules = F.array(
        _rung("global", F.col("every")[0], F.col("every")[1]),
        _rung("positivos", F.col("above_zero")[0], F.col("above_zero")[1]),
        _rung("por_dia", F.lit(None), F.lit(None), (per_day("low"), per_day("high"))),
    )
    return (
        row.filter(F.col("every").isNotNull())
        .select(F.explode(rules).alias("r"), "max_dow")
        .select("r.*", "max_dow")
        .filter((F.col("rung") == "por_dia") | F.col("low").isNotNull())
    )


def _discrete_rung(histogram: DataFrame, p_low: float, p_high: float) -> DataFrame:
    """Forced distinct integer cuts on the empirical distribution."""
    steps = running_total(histogram.groupBy("n").agg(F.sum("cells").alias("cells")), "n", ["cells"])
    before, total = F.col("cells_before"), F.col("cells_total")
    upto = before + F.col("cells")
    cuts = steps.agg(
        F.min(F.when(upto / total >= p_low / 100.0, F.col("n"))).alias("low"),
        # the count after that one is the first that has so much below it
        F.min(F.when(before / total >= p_low / 100.0, F.col("n"))).alias("after_low"),
        F.min(F.when(upto / total >= p_high / 100.0, F.col("n"))).alias("high"),
        F.max(F.when(upto < total, F.col("n"))).alias("last_but_one"),
        F.max("n").alias("last"),
        F.count("*").alias("distinct_counts"),
    )
    low = F.least("low", "last_but_one")
    high = F.greatest("high", F.coalesce("after_low", "last"))
    return (
        cuts.filter(F.col("distinct_counts") >= 3)
        .select(_rung("discreto", low, high).alias("r"))
        .select("r.*", F.lit(None).cast("int").alias("max_dow"))
    )


def _label_of(count: Column, low: Column, high: Column) -> Column:
    return (count > low).cast("int") + (count > high).cast("int")


def _per_weekday(cuts: DataFrame) -> DataFrame:
    """Seven rows per rule: the pair that holds on each weekday."""
    return (
        cuts.withColumn("dow", F.explode(F.sequence(F.lit(0), F.lit(6))))
        .withColumn("day_low", F.coalesce(F.col("low_by_day")[F.col("dow")], "low"))
        .withColumn("day_high", F.coalesce(F.col("high_by_day")[F.col("dow")], "high"))
    )


def threshold_ladder(
    histogram: DataFrame,
    p_low: float = 60,
    p_high: float = 90,
    *,
    rungs: Sequence[str] = RUNGS,
    min_class_share: float = 0.001,
    max_collapsed_days: int = 0,
) -> DataFrame:
    """One row per applicable rule with its cuts, class shares and verdict.

    A rule is viable when every class holds ``min_class_share`` of the rows and,
    for the weekday rule, no more than ``max_collapsed_days`` days lose their
    middle class. A high class larger than the medium one is legitimate.
    """
    unknown = set(rungs) - set(RUNGS)
    if unknown:
        raise ValueError(f"unknown threshold rules: {sorted(unknown)}")
    cuts = _percentile_rungs(histogram, p_low, p_high).unionByName(
        _discrete_rung(histogram, p_low, p_high)
    )
    cuts = cuts.filter(F.col("rung").isin(*rungs))
    # at most 4 rules x 7 weekdays, so the broadcast side is 28 rows
    scored = histogram.join(F.broadcast(_per_weekday(cuts)), "dow").withColumn(
        "label", _label_of(F.col("n"), F.col("day_low"), F.col("day_high"))
    )
    cells = F.sum("cells")

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("cells")).otherwise(0)) / cells

    summary = scored.groupBy("rung", "low", "high", "low_by_day", "high_by_day", "max_dow").agg(
        *[share(F.col("label") == k).alias(f"share_{name}") for k, name in enumerate(("low", "medium", "high"))],
        (share(F.col("n") <= F.col("low")) * 100).alias("mass_low"),
        (share(F.col("n") <= F.col("high")) * 100).alias("mass_high"),
    )
    by_day = F.col("rung") == "por_dia"
    collapsed = F.size(
        F.filter(
            F.arrays_zip("low_by_day", "high_by_day"),
            lambda day, i: (i <= F.col("max_dow")) & (day["low_by_day"] == day["high_by_day"]),
        )
    )
    enough = F.least("share_low", "share_medium", "share_high") >= min_class_share
    names = F.array(*[F.lit(r) for r in RUNGS])
    bases = F.array(*[F.lit(b) for b in RUNG_BASES])
    position = F.array_position(names, F.col("rung")).cast("int")
    return (
        summary.withColumn("collapsed_days", F.when(by_day, collapsed))
        .withColumn("rung_order", position - 1)
        .withColumn("base", F.element_at(bases, position))
        .withColumn("viable", enough & F.coalesce(F.col("collapsed_days") <= max_collapsed_days, F.lit(True)))
        .withColumn("matches_percentiles", F.col("rung") != "discreto")
        .withColumn("high_exceeds_medium", F.col("share_high") > F.col("share_medium"))
        .withColumn("mass_low_pct", F.when(~by_day, F.col("mass_low")))
        .withColumn("mass_high_pct", F.when(~by_day, F.col("mass_high")))
        .drop("max_dow", "mass_low", "mass_high")
    )


def chosen_thresholds(ladder: DataFrame) -> DataFrame:
    """Seven rows ``(dow, rung, low, high)`` of the first viable rule, else an error."""
    picked = ladder.agg(
        F.min_by(
            F.struct("rung", "low", "high", "low_by_day", "high_by_day"),
            F.when(F.col("viable"), F.col("rung_order")),
        ).alias("pick")
    )
    cuts = picked.select(F.coalesce("pick", F.raise_error(F.lit(NOT_FORMULABLE))).alias("pick")).select("pick.*")
    return _per_weekday(cuts).select(
        "dow", "rung", F.col("day_low").alias("low"), F.col("day_high").alias("high")
    )


def fit_thresholds(split_panel: DataFrame, p_low: float = 60, p_high: float = 90, **options) -> DataFrame:
    """Thresholds per weekday, fitted on eligible training rows only."""
    return chosen_thresholds(threshold_ladder(training_histogram(split_panel), p_low, p_high, **options))


def with_label(panel: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Add ``label``: 0 up to low, 1 up to high, 2 above; NULL for the future week."""
    pairs = F.broadcast(thresholds.select("dow", "low", "high"))  # seven rows
    labelled = panel.join(pairs, "dow").withColumn("label", _label_of(F.col("n"), F.col("low"), F.col("high")))
    return labelled.select(*panel.columns, "label")


def class_distribution(labelled: DataFrame, *groups: str) -> DataFrame:
    """Rows and share of each label within the groups (the split, usually)."""
    keys = groups or ("split",)
    counts = labelled.filter(F.col("label").isNotNull()).groupBy(*keys, "label").agg(F.count("*").alias("cells"))
    whole = Window.partitionBy(*keys)  # three rows per group
    return counts.withColumn("share", F.col("cells") / F.sum("cells").over(whole))
