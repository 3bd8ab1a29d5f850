"""Run a registered query and its SQL side by side and compare whole results."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


_FAMILY = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences found; empty when row count, columns, types and values agree."""
    df = query(spark, sf_dir)
    spark_types = dict(df.dtypes)
    names = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    cur = con.execute(sql)
    described = {d[0]: str(d[1]) for d in cur.description}
    rows = cur.fetchall()
    cols = list(described)
    problems = []
    if sorted(cols) != names:
        return [f"columns {names} != {sorted(cols)}"]
    for c in names:
        want = described[c]
        want = _FAMILY.get(want, want.lower())
        want = "array<" + _FAMILY.get(want[:-2].upper(), want[:-2]) + ">" if want.endswith("[]") else want
        if want != spark_types[c]:
            problems.append(f"type of {c}: spark {spark_types[c]} sql {want}")
    idx = [cols.index(c) for c in names]
    want_rows = sorted(tuple(plain(r[i]) for i in idx) for r in rows)
    if len(got) != len(want_rows):
        problems.append(f"{len(got)} rows != {len(want_rows)}")
    diff = [(a, b) for a, b in zip(got, want_rows) if a != b]
    if diff:
        problems.append(f"{len(diff)} of {len(got)} rows differ, first: {names} {diff[0]}")
    return problems
