"""One pass over training rows that returns a sum of vectors: what iterative fits are made of.

A learner that fits many settings at once asks for the statistics of all of them in one
pass, so the number of Spark jobs depends on the iterations and not on the settings. Each
partition adds up its rows in numpy; the partial sums meet in a tree, so the driver gets few
of them however many partitions there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Partial sums that come to the driver at once; more are first added up in tasks.
PARTS_AT_ONCE = 32


def training_rows(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(x array<double>, label int, weight double) of rows with these feature columns."""
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    return rows.select(x.alias("x"), F.col("label").cast("int").alias("label"), F.col("weight").cast("double").alias("weight"))


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """The rows of a list or binary column as a matrix of ``width`` columns."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def _block(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class Pass:
    """A table that is read once per call of ``total``.

    The rows are kept as Arrow blocks of an RDD: a fit calls hundreds of passes over the same
    rows, and planning a query anew for each would take longer than most passes do. Lost
    blocks are made again from the table, which is best a written one.
    """

    def __init__(self, rows: DataFrame):
        ship(rows.sparkSession)

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([_block(batch)], pa.binary())], ["block"])

        self.blocks = rows.mapInArrow(blocks, "block binary").rdd.map(lambda row: bytes(row[0]))
        self.blocks.persist(StorageLevel.MEMORY_AND_DISK)

    def total(self, of: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
        """The sum of ``of`` over all batches of rows, a vector of ``size`` numbers."""

        def run(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
            total = np.zeros(size)
            for block in blocks:
                total += of(pa.ipc.open_stream(block).read_next_batch())
            yield total

        sums = self.blocks.mapPartitions(run)
        if self.blocks.getNumPartitions() > PARTS_AT_ONCE:
            return sums.treeReduce(np.add, 2)
        return sum(sums.collect(), np.zeros(size))

    def release(self) -> None:
        self.blocks.unpersist()


def softmax(margins: np.ndarray) -> np.ndarray:
    """Class probabilities along the last axis."""
    e = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class ProbabilityModel:
    """A fitted model whose probabilities numpy computes in batches; subclasses give ``predict``."""

    features: Sequence[str]

    def settings(self) -> dict:
        """All that makes the model, as plain values; ``from_settings`` turns them back."""
        raise NotImplementedError

    def predict(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probability array<double>``; every other column passes through as it is."""
        ship(rows.sparkSession)
        model = rows.sparkSession.sparkContext.broadcast(self)
        names, width = rows.columns, len(self.features)
        x = F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])
        packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), x.alias("x"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = model.value.predict(matrix(batch.column("x"), width))
                lists = pa.ListArray.from_arrays(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32), p.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "probability"])

        kind = packed.schema["row"].dataType.simpleString()
        return packed.mapInArrow(run, f"row {kind}, probability array<double>").select("row.*", "probability")
