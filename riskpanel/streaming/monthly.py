"""Monthly files as a stream: each new file is one batch to validate and score."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import Scope
from ..plans.incremental import ScoringResult, score_csv
from ..sources.artefacts import Package


def new_files(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the file paths that arrive in a folder (one row per line read)."""
    lines = (
        spark.readStream.option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    )
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"))


def score_arrivals(
    spark: SparkSession,
    folder: str,
    package: Package,
    history_path: str,
    checkpoint: str,
    scope: Scope,
    today: Callable[[], Date],
    on_result: Callable[[str, ScoringResult], None],
    **options,
) -> StreamingQuery:
    """Score every file not yet seen, oldest name first, and stop.

    The file name is the batch name in the history. A micro-batch that is run
    again after a failure is a replay: it replaces what it wrote, so that the events
    count once, and gives the same result again.
    """

    def handle(arrived: DataFrame, _epoch: int) -> None:
        for row in arrived.distinct().orderBy("name").collect():  # one row per file
            result = score_csv(
                spark, row["path"], package, history_path, row["name"], today(), scope, replay=True, **options
            )
            on_result(row["name"], result)

    return (
        new_files(spark, folder)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
