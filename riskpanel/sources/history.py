"""The accumulated history: clean events in Parquet, by batch, version and month, and a ledger.

Nothing that was written is ever changed. A batch that is written, again or for the first
time, gets new folders of its own; the last step adds one file to the ledger, which names
the valid version of every batch. Readers take the newest complete ledger file, so they see
either all of a batch or what was there before, also while it is written, or when a
job stops halfway. Folders that no ledger file names any more are removed by ``vacuum``.

Next to the events lie their daily counts, one row per unit and day, and the panel state
after the batch (``operators.state``): scoring and validation read the ledger, the state and
the new batch, so a month's run does not scan the history again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_key
from ..operators.cleaning import Scope, clean_events, require_rows
from ..operators.panel import daily_counts
from ..operators.state import PanelState, load_state, save_state
from ..session import create_small, delete_path, materialise, names_in, read_small
from .csv_files import read_incidents

HISTORY_SCHEMA = "event_date date, unit_id string, parroquia string, canton string, archivo string"
DAILY_SCHEMA = "unit_id string, event_date date, n bigint"
_PLAIN = "-_. "  # besides letters and digits, what a folder name holds as it is


class BatchConflict(RuntimeError):
    """The batch was written by someone else in the meantime."""


@dataclass(frozen=True)
class Entry:
    """The valid version of a batch, with the facts that checks ask for."""

    version: str
    months: tuple[str, ...]
    records: int


@dataclass(frozen=True)
class Snapshot:
    """What one ledger file says: a few numbers per batch."""

    number: int = 0
    batches: dict[str, Entry] = field(default_factory=dict)
    state: str | None = None

    def without(self, batch: str) -> Snapshot:
        return replace(self, batches={b: e for b, e in self.batches.items() if b != batch})

    @property
    def months(self) -> list[str]:
        return sorted({m for e in self.batches.values() for m in e.months})

    @property
    def records(self) -> int:
        return sum(e.records for e in self.batches.values())


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The newest complete ledger file; an empty snapshot when nothing has been written yet."""
    for name in sorted(_ledger(spark, path), reverse=True):
        text = read_small(spark, f"{path}/ledger/{name}")
        if text.endswith("\n"):  # else its writer stopped before the end
            content = json.loads(text)
            batches = {b: Entry(e["version"], tuple(e["months"]), e["records"]) for b, e in content["batches"].items()}
            return Snapshot(int(name), batches, content["state"])
    return Snapshot()


def _ledger(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names_in(spark, f"{path}/ledger") if n.isdigit()]


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{HISTORY_SCHEMA}, month string, batch string")


def history_columns(events: DataFrame) -> DataFrame:
    return events.select("event_date", "unit_id", "parroquia", "canton", "archivo")


def _folder(batch: str, version: str) -> str:
    name = "".join(c if c.isalnum() or c in _PLAIN or ord(c) > 127 else f"%{ord(c):02X}" for c in batch)
    return f"batch={name}/version={version}"


def _read(spark: SparkSession, path: str, schema: str, valid: Snapshot) -> DataFrame:
    partitions = "batch string, version string, month string"
    if not valid.batches:
        return spark.createDataFrame([], f"{schema}, {partitions}").drop("version").select(*_names(schema), "month", "batch")
    folders = [f"{path}/{_folder(b, e.version)}" for b, e in valid.batches.items()]
    rows = spark.read.schema(f"{schema}, {partitions}").option("basePath", path).parquet(*folders)
    return rows.select(*_names(schema), "month", "batch")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def read_history(spark: SparkSession, path: str, valid: Snapshot | None = None) -> DataFrame | None:
    """All events of a snapshot, or None when nothing has been written yet."""
    valid = snapshot(spark, path) if valid is None else valid
    return _read(spark, f"{path}/events", HISTORY_SCHEMA, valid) if valid.number else None


def read_daily(spark: SparkSession, path: str, valid: Snapshot | None = None) -> DataFrame:
    """Daily counts of all batches of a snapshot, one row per unit, day and batch."""
    valid = snapshot(spark, path) if valid is None else valid
    return _read(spark, f"{path}/daily", DAILY_SCHEMA, valid)


def read_state(spark: SparkSession, path: str, valid: Snapshot) -> PanelState | None:
    """The panel state after the snapshot's batches, if one was written with them."""
    return load_state(spark, f"{path}/state/version={valid.state}") if valid.state else None


def _write(rows: DataFrame, path: str, batch: str, version: str) -> str:
    # one writer per month for small batches; adaptive execution splits a large month
    folder = f"{path}/{_folder(batch, version)}"
    by_month = rows.withColumn("month", month_key(F.col("event_date"))).hint("rebalance", "month")
    by_month.write.partitionBy("month").parquet(folder)
    return folder


def write_batch(events: DataFrame, path: str, batch: str, *, state: PanelState | None = None) -> Snapshot:
    """Add a batch, or put it in the place of all that the same batch held before.

    ``state`` is the panel state after it. Until the ledger names them, the new folders do
    not count, and a rerun writes new ones. Raises ``BatchConflict`` if the ledger got
    another version of the batch meanwhile; other batches may come and go.
    """
    if not batch:
        raise ValueError("a batch needs a name")
    spark = events.sparkSession
    before, version = snapshot(spark, path), uuid.uuid4().hex
    _write(history_columns(events), f"{path}/events", batch, version)
    folder = _write(daily_counts(events, "unit_id", "event_date"), f"{path}/daily", batch, version)
    written = spark.read.schema(f"{DAILY_SCHEMA}, month string").parquet(folder)
    facts = written.groupBy("month").agg(F.sum("n").alias("n")).collect()  # one row per month of the batch
    if state is not None:
        save_state(state, f"{path}/state/version={version}")
    entry = Entry(version, tuple(sorted(r["month"] for r in facts)), sum(r["n"] for r in facts))
    return _commit(spark, path, batch, entry, before, version if state is not None else None)


def _commit(spark: SparkSession, path: str, batch: str, entry: Entry, before: Snapshot, state: str | None) -> Snapshot:
    """Swap the ledger to the new version, unless the batch itself changed since ``before``."""
    while True:
        now = snapshot(spark, path)
        if now.batches.get(batch) != before.batches.get(batch):
            raise BatchConflict(f"batch {batch!r} was written by another job")
        # a state is that of all batches, so it is valid only if none of the others changed
        kept = state if now.batches == before.batches else None
        number = max([now.number, *map(int, _ledger(spark, path))]) + 1
        following = Snapshot(number, {**now.batches, batch: entry}, kept)
        content = {"batches": {b: asdict(e) for b, e in following.batches.items()}, "state": kept}
        if create_small(spark, f"{path}/ledger/{number:020d}", json.dumps(content) + "\n"):
            return following


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the versions that the newest ledger file does not name, and older ledger files.

    Not to be run while a batch is written, nor while older snapshots are read.
    """
    valid, gone = snapshot(spark, path), []
    versions = {e.version for e in valid.batches.values()}
    for kind in ("events", "daily"):
        for batch in names_in(spark, f"{path}/{kind}"):
            gone += [f"{path}/{kind}/{batch}/{v}" for v in names_in(spark, f"{path}/{kind}/{batch}") if v.removeprefix("version=") not in versions]
    gone += [f"{path}/state/{v}" for v in names_in(spark, f"{path}/state") if v.removeprefix("version=") != valid.state]
    gone += [f"{path}/ledger/{n}" for n in _ledger(spark, path) if int(n) != valid.number]
    for place in gone:
        delete_path(spark, place)
    return gone


def loaded_months(daily: DataFrame) -> DataFrame:
    """Distinct months that are loaded."""
    return daily.select("month").distinct()


def months_table(spark: SparkSession, months: Sequence[str]) -> DataFrame:
    """The months of a snapshot as ``(month)``."""
    return spark.createDataFrame([(m,) for m in months], "month string")


def load_or_build_history(
    spark: SparkSession, path: str, seed_paths: str | None, scope: Scope, *, build: bool = True
) -> DataFrame:
    """Read the history; build it once from the seed CSVs when it is missing."""
    history = read_history(spark, path)
    if history is not None:
        return history
    if not build or seed_paths is None:
        return empty_history(spark)
    events = materialise(history_columns(clean_events(read_incidents(spark, seed_paths, scope), scope)), "seed")
    require_rows(events)
    write_batch(events, path, "seed")
    return read_history(spark, path)


def append(history: DataFrame, batch: DataFrame) -> DataFrame:
    """UNION ALL: identical rows may be different incidents and all stay."""
    return history_columns(history).unionByName(history_columns(batch))
