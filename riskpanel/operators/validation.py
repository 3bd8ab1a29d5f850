"""Checks a new batch passes before it may join the history.

Batch and history are daily counts ``(unit_id, event_date, n)``.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_key
from .panel import months

# Fixed value: fewer distinct days than this hint at an incomplete month.
FULL_MONTH_DAYS = 25


def unknown_units(batch: DataFrame, units: DataFrame) -> DataFrame:
    """Units of the batch that the frozen catalogue does not hold."""
    return batch.select("unit_id").distinct().join(units.select("unit_id"), "unit_id", "left_anti")


def month_overlap(batch: DataFrame, loaded_months: DataFrame) -> DataFrame:
    """Months of the batch and whether the history already holds them."""
    loaded = loaded_months.select("month").distinct().withColumn("loaded", F.lit(True))
    return months(batch).join(loaded, "month", "left").withColumn("loaded", F.coalesce("loaded", F.lit(False)))


def batch_facts(batches: DataFrame, units: DataFrame, loaded_months: DataFrame, settings: DataFrame) -> DataFrame:
    """One row per batch with every figure the verdict looks at; each table is read once.

    ``batches`` are daily counts with a ``batch``; ``settings`` (batch, today, strict) names
    all batches to judge, those without a row too. Units, months and days are reduced by one
    grouping-sets aggregate, so that what is gathered per batch is its distinct values:
    ``unit_ids`` unknown to the catalogue, ``month_names`` and ``loaded_names``, all sorted.
    """
    dated = batches.join(settings.select("batch", "today"), "batch")
    late = F.col("event_date") > F.col("today")
    dated = dated.select("batch", "unit_id", month_key(F.col("event_date")).alias("month"), "event_date", "n", F.when(late, F.col("n")).alias("late"))
    sets = [["batch"], ["batch", "unit_id"], ["batch", "month"], ["batch", "event_date"]]
    keys = ["batch", "unit_id", "month", "event_date"]
    shares = [F.grouping(k).alias(f"no_{k}") for k in keys[1:]]
    facts = dated.groupingSets(sets, *keys).agg(F.sum("n").alias("n"), F.sum("late").alias("late"), *shares)
    known = units.select("unit_id").distinct().withColumn("known", F.lit(True))
    loaded = loaded_months.select("month").distinct().withColumn("loaded", F.lit(True))
    facts = facts.join(known, "unit_id", "left").join(loaded, "month", "left")
    of = lambda k: F.col(f"no_{k}") == 0
    whole = ~of("unit_id") & ~of("month") & ~of("event_date")
    names = lambda c, where: F.array_sort(F.collect_list(F.when(where, F.col(c))))
    counted = facts.groupBy("batch").agg(
        F.sum(F.when(whole, F.col("n"))).alias("records"),
        F.sum(F.when(whole, F.col("late"))).alias("future_records"),
        F.count_if(of("event_date")).alias("days"),
        names("unit_id", of("unit_id") & F.col("known").isNull()).alias("unit_ids"),
        names("month", of("month")).alias("month_names"),
        names("month", of("month") & F.col("loaded")).alias("loaded_names"),
    )
    none = F.array().cast("array<string>")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    lists = [F.coalesce(c, none).alias(c) for c in ("unit_ids", "month_names", "loaded_names")]
    rows = settings.join(counted, "batch", "left").select("batch", "today", "strict", *map(zero, ("records", "future_records", "days")), *lists)
    size = lambda c: F.size(c).cast("bigint")
    return rows.withColumns({"unknown_units": size("unit_ids"), "months": size("month_names"), "months_loaded": size("loaded_names")})


def _verdict(facts: DataFrame) -> DataFrame:
    """The first reason against a batch, and what its sender must mend."""
    # by default one new month is enough to accept the batch
    loaded = (F.col("months_loaded") > 0) & (F.col("strict") | (F.col("months_loaded") == F.col("months")))
    number = lambda c: F.col(c).cast("string")
    reasons = [
        (F.col("records") == 0, "empty", F.lit("no record is left in scope")),
        (F.col("future_records") > 0, "future dates", F.concat(number("future_records"), F.lit(" record(s) after "), number("today"))),
        (F.col("unknown_units") > 0, "unknown units", F.concat_ws(", ", "unit_ids")),
        (loaded, "months already loaded", F.concat_ws(", ", "loaded_names")),
    ]
    reason = detail = F.lit(None).cast("string")
    for condition, name, text in reversed(reasons):
        reason, detail = F.when(condition, name).otherwise(reason), F.when(condition, text).otherwise(detail)
    judged = facts.withColumns({"reason": reason, "detail": detail})
    accepted = F.col("reason").isNull()
    return judged.withColumns({"accepted": accepted, "partial_month": accepted & (F.col("days") < FULL_MONTH_DAYS)})


def judge_batches(batches: DataFrame, units: DataFrame, loaded_months: DataFrame, settings: DataFrame) -> DataFrame:
    """``batch_facts`` plus ``accepted``, the first ``reason`` against it, its ``detail`` and ``partial_month``."""
    return _verdict(batch_facts(batches, units, loaded_months, settings))


def batch_verdict(
    batch: DataFrame,
    units: DataFrame,
    loaded_months: DataFrame,
    today: Date | str,
    *,
    strict: bool = False,
) -> DataFrame:
    """The verdict on one batch of daily counts.

    ``strict`` also rejects a batch that only overlaps the loaded months.
    """
    spark = batch.sparkSession
    settings = spark.range(1).select(F.lit("").alias("batch"), F.lit(today).cast("date").alias("today"), F.lit(strict).alias("strict"))
    rows = batch.select(F.lit("").alias("batch"), "unit_id", "event_date", "n")
    return judge_batches(rows, units, loaded_months, settings).drop("batch", "today", "strict")


def drop_unknown_units(daily: DataFrame, units: DataFrame) -> DataFrame:
    return daily.join(units.select("unit_id"), "unit_id", "left_semi")
