"""Multiclass gradient boosting with shared histograms.

Trees are fitted on softmax gradients, one tree per class and round. All settings of a grid
grow their trees together: one pass per level adds up the gradients and curvatures of every
setting, class, node, feature and bin, so the passes are as many as the deepest tree has
levels, times the rounds, whatever the number of settings. Settings that differ only in
their number of rounds are one run, read at several lengths. What comes to the driver is a
table of histograms whose size the grid decides, not the data.

Margins are a column of the training table, written anew every few rounds; the trees since
then are sent along with each pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, temporary_tables
from .binning import fit_bin_edges
from .passes import Pass, ProbabilityModel, matrix, softmax, training_rows

CLASSES = 3
BINS = 32
_L2 = 1.0
_LEAST_CURVATURE = 1e-3
_ROUNDS_AT_ONCE = 20


@dataclass
class Trees:
    """Complete trees of one depth: split feature and bin of each inner node, value of each leaf."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    @classmethod
    def none(cls, depth: int) -> Trees:
        inner = 2**depth - 1
        return cls(np.zeros((0, inner), np.int16), np.zeros((0, inner), np.int16), np.zeros((0, inner + 1)))

    def plus(self, other: Trees) -> Trees:
        return Trees(*[np.concatenate([getattr(self, n), getattr(other, n)]) for n in ("feature", "cut", "value")])

    def __getitem__(self, which: slice) -> Trees:
        return Trees(self.feature[which], self.cut[which], self.value[which])

    def margins(self, codes: np.ndarray) -> np.ndarray:
        """Rows x classes: the sums of the trees, whose classes take turns."""
        out = np.zeros((len(codes), CLASSES))
        for k in range(CLASSES):
            part = self[k::CLASSES]
            leaf = walk(part.feature, part.cut, codes) - part.feature.shape[1]
            out[:, k] = part.value[np.arange(len(part.value)), leaf].sum(axis=1)
        return out


def walk(feature: np.ndarray, cut: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Rows x trees: the node each row reaches in trees of the given inner nodes."""
    rows, trees = np.arange(len(codes))[:, None], np.arange(len(feature))
    node = np.zeros((len(codes), len(feature)), np.int64)
    for _ in range((feature.shape[1] + 1).bit_length() - 1):
        node = 2 * node + 1 + (codes[rows, feature[trees, node]] > cut[trees, node])
    return node


def codes_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of raw values: the number of edges strictly below each."""
    return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


@dataclass
class BoostedModel(ProbabilityModel):
    """Boosted trees of one setting."""

    features: tuple[str, ...]
    edges: list[np.ndarray]
    start: np.ndarray
    trees: Trees

    def predict(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.start + self.trees.margins(codes_of(x, self.edges)))

    def settings(self) -> dict:
        trees = {n: getattr(self.trees, n).tolist() for n in ("feature", "cut", "value")}
        return {"features": list(self.features), "edges": [e.tolist() for e in self.edges], "start": self.start.tolist(), **trees}

    @classmethod
    def from_settings(cls, s: dict) -> BoostedModel:
        trees = Trees(np.array(s["feature"], np.int16), np.array(s["cut"], np.int16), np.array(s["value"], float))
        return cls(tuple(s["features"]), [np.array(e, float) for e in s["edges"]], np.array(s["start"]), trees)


def _coded(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray], width: int) -> DataFrame:
    """(codes, label, weight, margins) with the bins as bytes and margins of zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = codes_of(matrix(batch.column("x"), len(edges)), edges)
            margins = pa.array([bytes(8 * width)] * batch.num_rows, pa.binary())
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, batch.column("label"), batch.column("weight"), margins], ["codes", "label", "weight", "margins"])

    return training_rows(rows, features).mapInArrow(run, "codes binary, label int, weight double, margins binary")


def _advanced(rows: DataFrame, pending: list[Trees], width: int, features: int) -> DataFrame:
    """The rows with the pending trees added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = matrix(batch.column("codes"), features, np.uint8)
            margins = matrix(batch.column("margins"), width) + np.concatenate([t.margins(codes) for t in pending], axis=1)
            packed = pa.array([m.tobytes() for m in margins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("codes", "label", "weight")), packed], ["codes", "label", "weight", "margins"])

    return rows.mapInArrow(run, rows.schema)


def _histograms(pending: list[Trees], grown: list[Trees], level: int, start: np.ndarray, features: int):
    """Per batch: gradient and curvature by run, class, node of the level, feature and bin."""
    runs, nodes = len(pending), 2**level

    def of(batch: pa.RecordBatch) -> np.ndarray:
        codes = matrix(batch.column("codes"), features, np.uint8)
        label, weight = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
        margins = matrix(batch.column("margins"), runs * CLASSES).reshape(-1, runs, CLASSES)
        bins = codes.astype(np.int64) + np.arange(features) * BINS
        out = np.zeros((runs, CLASSES, 2, nodes, features * BINS))
        for r in range(runs):
            if grown[r].feature.shape[1] < nodes:
                continue  # this run's trees end above the level
            p = softmax(start + margins[:, r] + pending[r].margins(codes))
            gradient = (p - (label[:, None] == np.arange(CLASSES))) * weight[:, None]
            curvature = p * (1 - p) * weight[:, None]
            at = walk(grown[r].feature[:, : nodes - 1], grown[r].cut[:, : nodes - 1], codes) - (nodes - 1)
            for k in range(CLASSES):
                place = (bins + (at[:, k] * features * BINS)[:, None]).ravel()
                for i, values in enumerate((gradient, curvature)):
                    sums = np.bincount(place, np.repeat(values[:, k], features), nodes * features * BINS)
                    out[r, k, i] = sums.reshape(nodes, -1)
        return out.ravel()

    return of


def _best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the feature and bin to split behind, and the values of both sides, from class x 2 x node x feature x bin sums."""
    left = np.cumsum(sums, axis=-1)
    total = left[..., :1, -1:]  # every feature adds up to the node
    right = total - left
    score = lambda s: s[:, 0] ** 2 / (s[:, 1] + _L2)
    gain = score(left) + score(right) - score(np.broadcast_to(total, left.shape))
    gain = np.where((left[:, 1] > _LEAST_CURVATURE) & (right[:, 1] > _LEAST_CURVATURE), gain, 0.0)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(axis=-1)
    useful = np.take_along_axis(flat, best[..., None], -1)[..., 0] > 1e-12
    feature, cut = best // sums.shape[-1], best % sums.shape[-1]
    cut = np.where(useful, cut, BINS)  # all rows go left
    feature = np.where(useful, feature, 0)
    value = lambda s: -s[:, 0] / (s[:, 1] + _L2)
    take = lambda v: np.take_along_axis(v.reshape(*v.shape[:2], -1), best[..., None], -1)[..., 0]
    whole = value(np.broadcast_to(total, left.shape))
    sides = [np.where(useful, take(value(side)), take(whole)) for side in (left, right)]
    return feature, cut, np.stack(sides, axis=-1)


def fit_boosting(rows: DataFrame, features: Sequence[str], grid: Sequence[dict]) -> list[BoostedModel]:
    """One model per setting (``iterations``, ``rate``, ``depth``) of the grid, fitted on weighted rows.

    ``rows`` has the features, ``label`` 0 to 2 and ``weight``, and is best cached.
    Features are cut at their bin edges; the gain of a split and the value of a leaf follow
    from the sums of gradients and curvatures, with an L2 penalty of 1 on the values.
    """
    spark = rows.sparkSession
    runs = sorted({(c["rate"], c["depth"]) for c in grid})
    if not runs:
        return []
    rounds = {run: max(c["iterations"] for c in grid if (c["rate"], c["depth"]) == run) for run in runs}
    deepest, width, d = max(depth for _, depth in runs), len(runs) * CLASSES, len(features)
    found = {r["feature"]: r["edges"] for r in fit_bin_edges(rows, features, BINS).collect()}  # a few short lists
    edges = [np.array(found.get(f) or [], float) for f in features]
    shares = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    start = np.log([max(shares.get(k, 0.0), 1e-9) for k in range(CLASSES)])
    start -= start.mean()
    done = [Trees.none(depth) for _, depth in runs]
    pending = [Trees.none(depth) for _, depth in runs]
    with temporary_tables(spark):
        table = materialise(_coded(rows, features, edges, width), "boosting-rows")
        passes = Pass(table)
        for number in range(max(rounds.values())):
            grown = [Trees(*[np.zeros((CLASSES, 2**depth - 1), np.int16) for _ in "fc"], np.zeros((CLASSES, 2**depth))) for _, depth in runs]
            for level in range(deepest):
                sent = spark.sparkContext.broadcast((pending, grown))
                nodes, of = 2**level, _histograms
                size = len(runs) * CLASSES * 2 * nodes * d * BINS
                # the trees travel as a broadcast, not within each task
                sums = passes.total(lambda batch, s=sent, n=level: of(*s.value, n, start, d)(batch), size)
                sent.unpersist()
                sums = sums.reshape(len(runs), CLASSES, 2, nodes, d, BINS)
                for r, (rate, depth) in enumerate(runs):
                    if level >= depth:
                        continue
                    feature, cut, value = _best_splits(sums[r])
                    grown[r].feature[:, nodes - 1 : 2 * nodes - 1] = feature
                    grown[r].cut[:, nodes - 1 : 2 * nodes - 1] = cut
                    if level == depth - 1:
                        grown[r].value[:] = rate * value.reshape(CLASSES, -1)
            pending = [p.plus(g) for p, g in zip(pending, grown, strict=True)]
            if (number + 1) % _ROUNDS_AT_ONCE == 0 or number + 1 == max(rounds.values()):
                done = [a.plus(b) for a, b in zip(done, pending, strict=True)]
                if number + 1 < max(rounds.values()):
                    table = materialise(_advanced(table, pending, width, d), "boosting-rows")
                    passes.release()
                    passes = Pass(table)
                pending = [Trees.none(depth) for _, depth in runs]
        passes.release()
    of_run = {run: done[i] for i, run in enumerate(runs)}
    return [
        BoostedModel(tuple(features), edges, start, of_run[c["rate"], c["depth"]][: CLASSES * c["iterations"]]) for c in grid
    ]
