"""Score the coming week from a new batch with a frozen package.

Order matters: validate, advance the panel state, score, and only then write the batch
and the state to the history. A rejected batch changes nothing on disk. What is read is the
batch, the ledger and the state; the daily counts of all batches are read only where no
state was written for them, or where the batch replaces another one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import binning, features, models, panel, risk, split, validation
from ..operators import state as panel_state
from ..operators.cleaning import Scope, clean_events
from ..session import materialise
from ..sources import history as store
from ..sources.artefacts import Package
from ..sources.csv_files import read_incidents


@dataclass(frozen=True)
class ScoringResult:
    accepted: bool
    reason: str | None
    partial_month: bool
    new_records: int
    history_records: int
    target_week: Date | None = None
    matrix: DataFrame | None = None
    summary: dict[str, int] | None = None
    detail: str | None = None  # what the sender of a rejected batch must mend


def state_of(daily: DataFrame, package: Package) -> panel_state.PanelState:
    """The panel state after daily counts, against the frozen origin and catalogue."""
    return panel_state.advanced(panel_state.empty_state(package.units, package.origin), daily)


def score_state(state: panel_state.PanelState, package: Package) -> tuple[Date, DataFrame]:
    """The risk matrix of the first week after the state, nothing refitted."""
    wide = split.apply_mask(panel_state.next_week_features(state, package.level), package.mask)
    keys = ("unit_id", "dow", "week_idx", "week_start", "eligible")
    features.check_feature_contract([c for c in wide.columns if c not in keys], package.features)
    features.check_feature_contract(package.features, models.input_features(package.model))
    target = materialise(binning.apply_bins(wide, package.edges, package.features), "target-week")
    # only eligible cells pass through the model; the others keep NULL probabilities
    scored = models.score(package.model, target.filter("eligible"))
    scored = scored.unionByName(target.filter(~F.col("eligible")), allowMissingColumns=True)
    return state.next_week, risk.risk_matrix(scored, package.units, state.next_week)


def score_next_week(daily: DataFrame, package: Package) -> tuple[Date, DataFrame]:
    """The risk matrix of the first week after the daily counts, nothing refitted."""
    return score_state(state_of(daily, package), package)


def _carried(spark: SparkSession, path: str, others: store.Snapshot, valid: store.Snapshot, package: Package) -> panel_state.PanelState:
    """The state after all other batches: the written one if it is just that, else made from their daily counts."""
    state = store.read_state(spark, path, valid) if others == valid else None
    if state is not None and state.origin == package.origin:
        units = state.cells.select("unit_id").distinct()
        frozen = package.units.select("unit_id").distinct()
        both = units.withColumn("a", F.lit(1)).join(frozen.withColumn("b", F.lit(1)), "unit_id", "full")
        if both.filter("a IS NULL OR b IS NULL").isEmpty():
            return state
    return state_of(panel.daily_counts(store.read_daily(spark, path, others), "unit_id", "event_date", "n"), package)


def score_batch(
    events: DataFrame,
    package: Package,
    history_path: str,
    batch: str,
    today: Date,
    *,
    strict: bool = False,
    save: bool = True,
    replay: bool = False,
) -> ScoringResult:
    """Validate clean events, score the next week, then append them to the history.

    ``batch`` names the batch: sent again under the same name, its events replace
    the earlier ones, in the counts as in the history. Months that only the batch
    itself has loaded reject it like any other, except in a ``replay``.
    """
    spark = events.sparkSession
    events = materialise(store.history_columns(events), "batch")
    new_daily = materialise(panel.daily_counts(events, "unit_id", "event_date"), "batch-daily")
    valid = store.snapshot(spark, history_path)
    others = valid.without(batch)
    months = store.months_table(spark, (others if replay else valid).months)
    verdict = validation.batch_verdict(new_daily, package.units, months, today, strict=strict).first()
    if not verdict["accepted"]:
        return ScoringResult(False, verdict["reason"], False, 0, valid.records, detail=verdict["detail"])

    state = panel_state.advanced(_carried(spark, history_path, others, valid, package), new_daily)
    state = panel_state.written(state)
    target_week, matrix = score_state(state, package)
    matrix = materialise(matrix, "matrix")
    summary = {r["nivel"]: r["cells"] for r in risk.level_summary(matrix).collect()}
    if save:
        store.write_batch(events, history_path, batch, state=state)
    return ScoringResult(
        True,
        None,
        verdict["partial_month"],
        verdict["records"],
        others.records + verdict["records"],
        target_week,
        matrix,
        summary,
    )


def score_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    package: Package,
    history_path: str,
    batch: str,
    today: Date,
    scope: Scope,
    **options,
) -> ScoringResult:
    """``score_batch`` from CSV files; unreadable or out-of-scope files are a rejection."""
    try:
        raw = read_incidents(spark, paths, scope)
    except (FileNotFoundError, ValueError) as unusable:
        kept = store.snapshot(spark, history_path).records
        return ScoringResult(False, f"unusable: {unusable}", False, 0, kept, detail=str(unusable))
    return score_batch(clean_events(raw, scope), package, history_path, batch, today, **options)
