"""Where two tables with the same keys differ.

Rows are dealt into buckets by their keys, and each bucket is first reduced to a digest. Only
the buckets whose digests differ are joined row by row, so comparing two nearly equal tables
costs two scans and a join of little more than their differences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW = "(row)"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).alias("_bucket")


def _digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per bucket the number of rows and two sums over their hashes."""
    each = [F.col(f"`{c}`") for c in columns]
    # xxhash64 passes over NULLs, so which columns are NULL is hashed too
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in each])
    h = F.xxhash64(nulls, *each)
    return rows.groupBy("_bucket").agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s")
    )


def differing_buckets(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_bucket) of the buckets that do not hold the same rows."""
    a, b = _digests(left, columns), _digests(right, columns)
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.x") == F.col("b.x")) & (F.col("a.s") == F.col("b.s"))
    both = a.alias("a").join(b.alias("b"), F.col("a._bucket") == F.col("b._bucket"), "full")
    return both.filter(~F.coalesce(same, F.lit(False))).select(F.coalesce("a._bucket", "b._bucket").alias("_bucket"))


def matrix_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str], *, tolerance: float = 1e-9, buckets: int = 1024
) -> DataFrame:
    """One row per differing cell: the keys, ``column``, ``left_value`` and ``right_value`` as text.

    Two values are equal if both are NULL or NaN, or if they are equal, or for fractions no
    more than ``tolerance`` apart. A row that only one side has gives one row with column
    ``(row)``, and ``present`` on its side. Rows that share their keys are paired in the order of
    their values. Only columns that both sides have are compared, by name.
    """
    kinds = {f.name: f.dataType for f in left.schema.fields}
    columns = [c for c in left.columns if c in right.columns and c not in keys]
    both = [*keys, *columns]
    sides = [rows.select(*[F.col(f"`{c}`") for c in both], _bucket(keys, buckets)) for rows in (left, right)]
    open_buckets = differing_buckets(*sides, both)
    order = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(f"`{c}`") for c in columns or keys])
    numbered = []
    for name, rows in zip("lr", sides, strict=True):
        rows = rows.join(open_buckets, "_bucket", "left_semi").withColumn("_nth", F.row_number().over(order))
        values = F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(True).alias(_ROW)).alias(name)
        numbered.append(rows.select(*[F.col(f"`{k}`").alias(f"_{name}{i}") for i, k in enumerate(keys)], F.col("_nth").alias(f"_{name}n"), values))
    on = F.col("_ln") == F.col("_rn")
    for i in range(len(keys)):
        on = on & F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}"))
    paired = numbered[0].join(numbered[1], on, "full")
    gone = F.col("l").isNull() | F.col("r").isNull()

    def differs(c: str) -> Column:
        a, b = F.col(f"l.`{c}`"), F.col(f"r.`{c}`")
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            near = F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
            return ~(a.eqNullSafe(b) | near)
        return ~a.eqNullSafe(b)

    def entry(name: str, where: Column, a: Column, b: Column) -> Column:
        return F.when(where, F.struct(F.lit(name).alias("column"), a.cast("string").alias("left_value"), b.cast("string").alias("right_value")))

    present = lambda side: F.when(F.col(side).isNotNull(), "present")
    entries = [entry(_ROW, gone, present("l"), present("r"))]
    entries += [entry(c, ~gone & differs(c), F.col(f"l.`{c}`"), F.col(f"r.`{c}`")) for c in columns]
    found = F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")
    names = [F.coalesce(f"_l{i}", f"_r{i}").alias(k) for i, k in enumerate(keys)]
    return paired.select(*names, found).select(*[F.col(f"`{k}`") for k in keys], "e.*")
