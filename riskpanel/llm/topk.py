"""Exact top-k search by distributed histogram selection.

Queries and candidates are cut into blocks of bounded size, and each pair of blocks is
scored in one task. A pass counts, per query, how many scores fall into each bin of the
score range in question; summed over all blocks, the counts tell which bin holds the k-th
best score, and the next pass looks into that bin only. A block reports its bins from the
top until it has counted k scores: the k-th best of all is never below a block's own. When
bins are one score wide the k-th value is exact, and a last pass returns the scores above
it and, of those equal to it, the smallest ids. All passes score every pair again, so the
scores themselves are never stored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import ship
from riskpanel.session import materialise

_SUB_BLOCK = 128  # queries scored at once
_EXACT = 1 << 53
_LARGEST = 1 << 61  # sums and differences of bin edges stay within 64 bits


def _pack(vectors: DataFrame) -> DataFrame:
    """(row, id, v array<bigint>) with v as packed 64-bit integers."""

    def run(batches):
        for batch in batches:
            packed = [np.asarray(v, np.int64).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(packed, pa.binary())], ["row", "id", "v"])

    return vectors.mapInArrow(run, "row long, id long, v binary")


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), np.int64)  # absent trailing components count as zero
    for i, v in enumerate(packed):
        row = np.frombuffer(v, np.int64)
        out[i, : len(row)] = row
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those too large for the bins of the search raise."""
    most = lambda x: int(np.abs(x.astype(object)).max()) if x.size else 0
    if a.shape[1] * most(a) * most(b) < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(abs(exact.min()), abs(exact.max())) > _LARGEST:
        raise OverflowError(f"an inner product is beyond {_LARGEST}; use a smaller scale")
    return exact.astype(np.int64)


def _blocks(left: pa.Table, right: pa.Table, width: int):
    """Per query of the left block: its place in it, the candidates' ids and scores."""
    candidates = _matrix(right.column("v").to_pylist(), width)
    ids, rows = right.column("id").to_numpy(), right.column("row").to_numpy()
    queries = left.column("row").to_numpy()
    vectors = left.column("v").to_pylist()
    for start in range(0, len(queries), _SUB_BLOCK):
        scores = _scores(_matrix(vectors[start : start + _SUB_BLOCK], width), candidates)
        for i, row in enumerate(scores, start):
            other = rows != queries[i]
            yield i, ids[other], row[other]


def _histogram(width: int, k: int):
    """Counts per bin, from the best bin down to where a block alone has enough."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if left.num_rows and right.num_rows:
            lo, step, wanted = (left.column(c).to_numpy() for c in ("lo", "step", "wanted"))
            hi = left.column("hi").to_numpy()
            query = left.column("row").to_numpy()
            for i, _, scores in _blocks(left, right, width):
                bins = (scores[(scores >= lo[i]) & (scores <= hi[i])] - lo[i]) // step[i]
                if len(bins) > wanted[i]:
                    floor = np.partition(bins, len(bins) - wanted[i])[len(bins) - wanted[i]]
                    bins = bins[bins >= floor]
                found, n = np.unique(bins, return_counts=True)
                if len(found):
                    out.append(np.stack([np.full(len(found), query[i]), found, n]))
        rows = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return pa.table({"row": rows[0], "bin": rows[1], "n": rows[2]})

    return run


def _winners(width: int):
    """Scores above the k-th value, and of the equal ones the smallest ids still wanted."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = []
        if left.num_rows and right.num_rows:
            lo, wanted = left.column("lo").to_numpy(), left.column("wanted").to_numpy()
            query, query_id = left.column("row").to_numpy(), left.column("id").to_numpy()
            for i, ids, scores in _blocks(left, right, width):
                above, equal = scores > lo[i], np.sort(ids[scores == lo[i]])[: wanted[i]]
                n = int(above.sum())
                row = np.empty((4, n + len(equal)), np.int64)
                row[0], row[1] = query[i], query_id[i]
                row[2, :n], row[2, n:] = ids[above], equal
                row[3, :n], row[3, n:] = scores[above], lo[i]
                out.append(row)
        rows = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
        return pa.table({"row": rows[0], "query_id": rows[1], "vec_id": rows[2], "score": rows[3]})

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: float = 1024.0,
    chunk_rows: int = 4096,
    block_rows: int = 4096,
    bins: int = 1 << 14,
) -> DataFrame:
    """Each query's ``k`` highest inner products: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on vec_id. Components
    become floor(scale * x). Equal scores go to the smaller vec_id; a row is no candidate
    of its own; with fewer than ``k`` candidates all are returned. Vectors that are null or
    hold a null or non-finite component, and rows without vec_id, take no part. Rows that
    repeat a vec_id are queries and candidates each, and meet each other. Vectors of
    unequal length are read as if zeros followed, other columns are not read, and an empty
    table gives an empty result. An inner product beyond 2**61 raises.
    """
    ship(vectors.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    kept = kept.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("id"), whole.alias("v"))
    kept = materialise(kept, "vectors")  # from here on a row's number is fixed
    largest = F.array_max(F.transform("v", F.abs))
    facts = kept.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"),
        F.coalesce(F.max(largest), F.lit(0)).alias("most"),
        F.count(F.when(is_query_on(is_query), 1)).alias("queries"),
    ).first()
    width = max(1, facts["width"])
    bound = min(_LARGEST, width * facts["most"] ** 2)  # no score is further from zero
    groups = max(1, math.ceil(facts["n"] / chunk_rows))
    parts = max(1, math.ceil(facts["queries"] / block_rows))
    packed = materialise(_pack(kept), "packed-vectors")
    spread = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    right = packed.select("row", "id", "v", spread(groups).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("b"))
    state = packed.filter(is_query_on(is_query)).select(
        "row", "id", "v", F.lit(-bound).alias("lo"), F.lit(bound).alias("hi"), F.lit(k).cast("bigint").alias("wanted")
    )
    span = 2 * bound + 1
    while True:
        step = max(1, -(-span // bins))
        left = state.withColumn("step", F.lit(step).cast("bigint")).select(
            "*", spread(parts).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
        )
        pairs = left.groupBy("g", "b").cogroup(right.groupBy("g", "b"))
        counts = pairs.applyInArrow(_histogram(width, k), "row long, bin long, n long")
        counts = counts.groupBy("row", "bin").agg(F.sum("n").alias("n"))
        best_first = Window.partitionBy("row").orderBy(F.col("bin").desc())
        ahead = F.coalesce(F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # the bin in which the wanted-th score lies; with too few scores, the lowest bin
        held = counts.withColumn("ahead", ahead).join(state.select("row", "wanted"), "row").filter(F.col("ahead") < F.col("wanted"))
        chosen = held.groupBy("row").agg(F.min("bin").alias("bin"), F.max("ahead").alias("ahead"))
        low = F.col("lo") + F.col("bin") * F.lit(step)
        state = materialise(
            state.join(chosen, "row").select(
                "row", "id", "v", low.alias("lo"), (low + F.lit(step - 1)).alias("hi"), (F.col("wanted") - F.col("ahead")).alias("wanted")
            ),
            "top-k-state",
        )
        span = step
        if step == 1:
            break
    left = state.select("row", "id", "v", "lo", "wanted", spread(parts).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    won = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(
        _winners(width), "row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = won.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def is_query_on(condition: Column) -> Column:
    """The caller's condition, null read as false."""
    return F.coalesce(condition, F.lit(False))
