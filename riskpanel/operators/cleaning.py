"""Scope filters, date and unit checks, and the audit of what they drop."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, is_foldable, name_unit_id, normalise, numeric_unit_id

# How many characters of the category must occur, the date patterns
# (day first, or ISO), and the column each unit level is taken from.
CATEGORY_ROOT = 7
DATE_FORMATS = ("d/M/yyyy", "d-M-yyyy", "yyyy-M-d")
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"
UNIT_COLUMNS = {"parroquia": "cod_parroquia", "canton": "canton"}


@dataclass(frozen=True)
class Scope:
    """What belongs to the study: a category, an optional area, the unit level."""

    category: str = "TRANSITO"
    area_level: str | None = "canton"
    area: str | None = "GUAYAQUIL"
    unit_level: str = "parroquia"
    date_formats: tuple[str, ...] = DATE_FORMATS

    def __post_init__(self):
        if self.unit_level not in UNIT_COLUMNS:
            raise ValueError(f"unit_level must be one of {sorted(UNIT_COLUMNS)}")
        if self.area_level not in (None, "canton", "provincia"):
            raise ValueError("area_level must be 'canton', 'provincia' or None")

    @property
    def unit_column(self) -> str:
        return UNIT_COLUMNS[self.unit_level]

    @property
    def required_columns(self) -> set[str]:
        needed = {"fecha", "canton", "servicio", self.unit_column}
        return needed | {"provincia"} if self.area_level == "provincia" else needed


def in_category(text: Column, category: str) -> Column:
    """The normalised text contains the first letters of the category.

    Plain upper case decides most rows; only other texts are folded.
    """
    root = fold(category)[:CATEGORY_ROOT]
    if " " in root:
        return F.contains(normalise(text), F.lit(root))
    plain = F.contains(F.upper(text), F.lit(root))
    return F.coalesce(plain, F.lit(False)) | (is_foldable(text) & F.contains(normalise(text), F.lit(root)))


def in_area(text: Column, area: str) -> Column:
    """The normalised text equals the area; folded only where that could matter."""
    wanted = fold(area)
    plain = F.coalesce(F.upper(text) == wanted, F.lit(wanted == ""))
    return plain | (is_foldable(text) & (normalise(text) == wanted))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Day-first or ISO date without its time of day, two-digit years read as 20xx; NULL when no format fits."""
    plain = F.regexp_replace(F.trim(text), _TIME, "")
    short = F.rlike(plain, F.lit(r"^\d{1,2}/\d{1,2}/\d{2}$"))
    parsed = F.coalesce(*[F.try_to_date(plain, pattern) for pattern in formats])
    return F.when(short, F.try_to_date(plain, "d/M/yy")).otherwise(parsed)


def unit_id_of(scope: Scope) -> Column:
    column = F.col(scope.unit_column)
    return numeric_unit_id(column) if scope.unit_level == "parroquia" else name_unit_id(column)


def judged(raw: DataFrame, scope: Scope) -> DataFrame:
    """Add the date, the unit and one flag per check, each including the previous ones."""
    category = in_category(F.col("servicio"), scope.category)
    area = F.lit(True) if scope.area_level is None else in_area(F.col(scope.area_level), scope.area)
    return (
        raw.withColumn("event_date", parse_date(F.col("fecha"), scope.date_formats))
        .withColumn("unit_id", unit_id_of(scope))
        .withColumn("in_category", category)
        .withColumn("in_area", F.col("in_category") & area)
        .withColumn("has_date", F.col("in_area") & F.col("event_date").isNotNull())
        .withColumn("has_unit", F.col("has_date") & F.col("unit_id").isNotNull())
    )


def clean_events(raw: DataFrame, scope: Scope) -> DataFrame:
    """Rows in scope with a date and a unit. Identical rows stay: they are events."""
    flags = ("in_category", "in_area", "has_date", "has_unit")
    return judged(raw, scope).filter("has_unit").drop(*flags)


def funnel(raw: DataFrame, scope: Scope, skipped: DataFrame | None = None) -> DataFrame:
    """One row: how many rows each check kept and dropped, in a single pass.

    The rows of ``skipped`` files count as raw, and as dropped before any category is seen.
    """
    stages = judged(raw, scope).agg(
        F.count("*").alias("raw"),
        F.count_if("in_category").alias("after_category"),
        F.count_if("in_area").alias("after_area"),
        F.count_if("has_date").alias("after_date"),
        F.count_if("has_unit").alias("valid"),
        F.count_distinct(F.when(F.col("in_area"), F.col("archivo"))).alias("valid_files"),
    )
    if skipped is not None:
        unseen = skipped.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).scalar()
        stages = stages.withColumn("raw", F.col("raw") + unseen)
    return stages.select(
        "*",
        (F.col("raw") - F.col("after_category")).alias("dropped_category"),
        (F.col("after_category") - F.col("after_area")).alias("dropped_area"),
        (F.col("after_area") - F.col("after_date")).alias("dropped_date"),
        (F.col("after_date") - F.col("valid")).alias("dropped_unit"),
    )


def require_rows(events: DataFrame) -> None:
    if events.isEmpty():
        raise ValueError("no rows are left in scope: check the category, the area and the column names")
