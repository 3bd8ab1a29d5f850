"""From daily counts to a frozen package: panel, labels, features, bins, models."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import binning, features, labels, models, panel, split
from ..operators.cleaning import Scope, clean_events
from ..session import materialise
from ..sources.artefacts import Package
from ..sources.csv_files import read_incidents

KEYS = ("unit_id", "dow", "week_idx")


@dataclass(frozen=True)
class Prepared:
    """Everything that is decided before a model is fitted."""

    meta: panel.PanelMeta
    level: str
    train_end: Date
    panel: DataFrame  # split, eligibility, label; the coming week included
    thresholds: DataFrame
    edges: DataFrame
    matrix: DataFrame  # panel columns plus binned features

    @property
    def features(self) -> tuple[str, ...]:
        return features.feature_names(self.level)

    def rows(self, name: str) -> DataFrame:
        return split.model_rows(self.matrix, name)


def panel_from_csv(spark, paths: str, scope: Scope) -> tuple[panel.PanelMeta, DataFrame]:
    """CSV files to dense panel. Raw rows are read once and leave as daily counts."""
    events = clean_events(read_incidents(spark, paths, scope), scope)
    daily = materialise(panel.daily_counts(events, "unit_id", "event_date"), "daily")
    meta = panel.read_meta(daily)
    return meta, panel.dense_panel(daily, meta)


def prepare(
    daily: DataFrame,
    train_end: Date,
    val_end: Date,
    *,
    level: str = "parroquia",
    eligibility: str = "unit",
    check_gaps: bool = True,
    **ladder_options,
) -> Prepared:
    """Panel, thresholds, labels, features and bins; each fit reads training weeks only.

    The panel and the feature matrix are written once, since several fits read them.
    """
    meta = panel.read_meta(daily)
    cells = split.temporal_split(panel.dense_panel(daily, meta, future_weeks=1), train_end, val_end)
    cells = materialise(split.with_eligibility(cells, eligibility), "panel")
    if check_gaps:
        panel.require_contiguous(cells.filter(F.col("n").isNotNull()))
    thresholds = materialise(labels.fit_thresholds(cells, **ladder_options), "thresholds")
    labelled = labels.with_label(cells, thresholds)
    names = features.feature_names(level)
    wide = materialise(features.build_features(labelled, level), "features")
    edges = materialise(binning.fit_bin_edges(split.model_rows(wide, "train"), names), "edges")
    matrix = materialise(binning.apply_bins(wide, edges, names), "matrix")
    return Prepared(meta, level, train_end, labelled, thresholds, edges, matrix)


def freeze(prepared: Prepared, fitted: models.Fitted, units: DataFrame) -> Package:
    """The package scoring runs from; ``units`` is the catalogue ``unit_id, name, area``."""
    features.check_feature_contract(prepared.features, models.input_features(fitted.model))
    mask = prepared.matrix.select("unit_id", "dow", "eligible").distinct()
    return Package(
        model=fitted.model,
        model_name=fitted.name,
        config=fitted.config,
        features=prepared.features,
        level=prepared.level,
        origin=prepared.meta.origin,
        n_weeks=prepared.meta.n_weeks,
        train_end=prepared.train_end,
        thresholds=prepared.thresholds,
        edges=prepared.edges,
        mask=mask,
        units=units,
    )
