"""The risk matrix of the coming week and the reports read from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import DAY_NAMES, day_name
from .metrics import PROBABILITIES, argmax
from .ordering import with_ordinal

# Level names by class, the name for cells that were not scored,
# and the severity order used in reports.
LEVELS = ("Bajo", "Medio", "Alto")
NOT_SCORED = "Sin datos suficientes"
SEVERITY = ("Alto", "Medio", "Bajo", NOT_SCORED)


def level_name(code: Column) -> Column:
    named = F.when(code >= 0, F.element_at(F.array(*[F.lit(v) for v in LEVELS]), code + 1))
    return F.coalesce(named, F.lit(NOT_SCORED))


def severity(level: Column) -> Column:
    """0 for the worst level upwards."""
    return F.array_position(F.array(*[F.lit(v) for v in SEVERITY]), level) - 1


def mask_unscored(scored: DataFrame) -> DataFrame:
    """Probabilities of cells that did not pass through the model are NULL, not 0."""
    return scored.withColumns({p: F.when(F.col("eligible"), F.col(p)) for p in PROBABILITIES})


def risk_matrix(scored: DataFrame, units: DataFrame, target_week: Date | str) -> DataFrame:
    """One row per unit and weekday in the published 13-column schema.

    ``scored`` holds ``unit_id, dow, eligible`` and the class probabilities of the
    target week; ``units`` the catalogue ``unit_id, name, area``.
    """
    catalogue = with_ordinal(units.select("unit_id", "name", "area"), "unit_id", "unit_idx")
    cells = mask_unscored(scored).join(catalogue, "unit_id")
    code = F.when(F.col("eligible"), argmax()).otherwise(F.lit(-1))
    return cells.select(
        F.col("unit_id").alias("unidad_id"),
        F.col("name").alias("unidad"),
        F.col("area").alias("canton"),
        F.col("unit_idx").alias("unidad_idx"),
        F.col("dow").alias("dia_idx"),
        day_name(F.col("dow")).alias("dia_semana"),
        code.alias("nivel_cod"),
        level_name(code).alias("nivel"),
        F.greatest(*PROBABILITIES).alias("prob_clase_predicha"),
        F.col("p_low").alias("p_bajo"),
        F.col("p_medium").alias("p_medio"),
        F.col("p_high").alias("p_alto"),
        F.date_format(F.lit(target_week).cast("date"), "yyyy-MM-dd").alias("semana_objetivo"),
    )


def level_summary(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("nivel").agg(F.count("*").alias("cells"))


def risk_pivot(matrix: DataFrame) -> DataFrame:
    """Units by weekday: level and probability, worst units first."""
    wide = (
        matrix.groupBy("unidad_id", "unidad")
        .pivot("dia_idx", list(range(7)))
        .agg(F.first("nivel").alias("nivel"), F.first("prob_clase_predicha").alias("prob"))
    )
    worst = F.least(*[severity(F.col(f"{d}_nivel")) for d in range(7)])
    renamed = wide.select(
        "unidad_id",
        "unidad",
        worst.cast("int").alias("worst"),
        *[F.col(f"{d}_{v}").alias(f"{DAY_NAMES[d]}_{v}") for d in range(7) for v in ("nivel", "prob")],
    )
    return renamed.orderBy("worst", "unidad_id")


def top_risk(matrix: DataFrame, limit: int = 6) -> DataFrame:
    """The riskiest scored cells: level first, then probability."""
    return (
        matrix.filter(F.col("nivel") != NOT_SCORED)
        .orderBy(severity(F.col("nivel")), F.desc("prob_clase_predicha"), "unidad_id", "dia_idx")
        .limit(limit)
        .select("unidad_id", "unidad", "dia_semana", "nivel", "prob_clase_predicha")
    )


def most_confident(matrix: DataFrame, limit: int = 10) -> DataFrame:
    return matrix.orderBy(F.desc_nulls_last("prob_clase_predicha"), "unidad_id", "dia_idx").limit(limit)


def detail(matrix: DataFrame) -> DataFrame:
    """All cells by level name, then by falling probability."""
    columns = ("unidad_id", "unidad", "canton", "dia_semana", "nivel", "prob_clase_predicha", "p_bajo", "p_medio", "p_alto")
    ordered = matrix.orderBy("nivel", F.desc_nulls_last("prob_clase_predicha"), "unidad_id", "dia_idx")
    return ordered.select(*columns)


def dashboard_filter(
    matrix: DataFrame,
    units: Sequence[str] | None = None,
    days: Sequence[str] | None = None,
    levels: Sequence[str] | None = None,
    min_probability: float = 0.0,
) -> DataFrame:
    """Chosen units, days and levels; cells without a score pass the probability floor."""
    rows = matrix
    for column, wanted in (("unidad", units), ("dia_semana", days), ("nivel", levels)):
        if wanted is not None:
            rows = rows.filter(F.col(column).isin(list(wanted)))
    likely = F.coalesce("prob_clase_predicha", F.lit(0.0)) >= min_probability
    return rows.filter(likely | (F.col("nivel") == NOT_SCORED))


def kpis(matrix: DataFrame) -> DataFrame:
    """Target week, units, cells, high-risk cells and mean confidence of scored cells."""
    scored = F.col("nivel") != NOT_SCORED
    return matrix.agg(
        F.max("semana_objetivo").alias("semana_objetivo"),
        F.count_distinct("unidad").alias("units"),
        F.count_distinct(F.when(scored, F.col("unidad"))).alias("units_scored"),
        F.count("*").alias("cells"),
        F.count_if(F.col("nivel") == "Alto").alias("high_risk"),
        F.avg(F.when(scored, F.col("prob_clase_predicha"))).alias("mean_confidence"),
    )


def unit_catalogue(units: DataFrame) -> DataFrame:
    """The catalogue as published: id, name and area of each unit."""
    return units.select(F.col("unit_id").alias("id"), F.col("name").alias("nombre"), F.col("area").alias("canton"))
