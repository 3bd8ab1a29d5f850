"""Artefacts on shared storage: the frozen package, matrices, reports."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date as Date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.boosting import BoostedModel
from ..operators.networks import NetworkModel
from ..operators.passes import ProbabilityModel


@dataclass(frozen=True)
class Package:
    """A frozen model with everything scoring needs; scoring never refits any of it."""

    model: PipelineModel | ProbabilityModel
    model_name: str
    config: dict
    features: tuple[str, ...]
    level: str
    origin: Date
    n_weeks: int
    train_end: Date
    thresholds: DataFrame
    edges: DataFrame
    mask: DataFrame
    units: DataFrame


_TABLES = ("thresholds", "edges", "mask", "units")


_KINDS = {"boosting": BoostedModel, "network": NetworkModel}


def save_model(spark: SparkSession, model: PipelineModel | ProbabilityModel, path: str) -> None:
    """A pipeline in its own format; other models as one row of plain values."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return
    kind = next(k for k, c in _KINDS.items() if isinstance(model, c))
    rows = [(kind, json.dumps(model.settings()))]
    spark.createDataFrame(rows, "kind string, settings string").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str, kind: str) -> PipelineModel | ProbabilityModel:
    if kind == "pipeline":
        return PipelineModel.load(path)
    row = spark.read.parquet(path).first()
    return _KINDS[row["kind"]].from_settings(json.loads(row["settings"]))


def save_package(package: Package, path: str) -> None:
    save_model(package.units.sparkSession, package.model, f"{path}/model")
    for name in _TABLES:
        getattr(package, name).write.mode("overwrite").parquet(f"{path}/{name}")
    settings = {
        "model_name": package.model_name,
        "model_kind": "pipeline" if isinstance(package.model, PipelineModel) else "own",
        "config": json.dumps(package.config),
        "features": list(package.features),
        "level": package.level,
        "origin": package.origin,
        "n_weeks": package.n_weeks,
        "train_end": package.train_end,
    }
    spark = package.units.sparkSession
    schema = (
        "model_name string, model_kind string, config string, features array<string>, level string, "
        "origin date, n_weeks int, train_end date"
    )
    spark.createDataFrame([settings], schema).write.mode("overwrite").parquet(f"{path}/settings")


def load_package(spark: SparkSession, path: str) -> Package:
    settings = spark.read.parquet(f"{path}/settings").first().asDict()
    settings["config"] = json.loads(settings["config"])
    settings["features"] = tuple(settings["features"])
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in _TABLES}
    model = load_model(spark, f"{path}/model", settings.pop("model_kind", "pipeline"))
    return Package(model=model, **settings, **tables)


def save_matrix(matrix: DataFrame, path: str) -> None:
    matrix.write.mode("overwrite").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """A filtered view as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def without_nan(rows: DataFrame) -> DataFrame:
    """NaN becomes NULL, so that JSON output stays standard."""
    fractional = [f.name for f in rows.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return rows.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fractional}) if fractional else rows


def save_json(rows: DataFrame, path: str) -> None:
    """JSON lines; NULL fields are written, not left out."""
    without_nan(rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_comparison(validation: DataFrame, test: DataFrame, path: str, family_order: Sequence[str] = ()) -> None:
    """Comparison tables as CSV and one JSON record; the model itself is not touched."""
    export_csv(validation, f"{path}/comparacion_modelos_validacion")
    export_csv(test, f"{path}/comparacion_modelos_test")
    best = F.max_by("model", F.struct("f1_macro_val", -F.col("family_order")))
    payload = validation.agg(
        F.lit("F1 macro en validacion temporal").alias("criterio_seleccion"),
        best.alias("modelo_mejor_validacion"),
        F.collect_list(F.struct(*validation.columns)).alias("validacion"),  # one row per family
    ).withColumn("test", without_nan(test).agg(F.collect_list(F.struct(*test.columns))).scalar())
    payload.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/comparacion_modelos")


def read_artefact(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, else CSV, else JSON, judged by the file names in the folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    suffixes = {r["path"].rsplit(".", 1)[-1] for r in files.distinct().collect()}
    if "parquet" in suffixes:
        return spark.read.parquet(path)
    if "csv" in suffixes:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.option("multiLine", False).json(path)
