"""Table comparison and tallies against plain Python; a folder's profile over several dialects."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskpanel.operators import comparison, metrics
from riskpanel.sources import csv_files

SCHEMA = "unit string, day int, v double, level string, l int"


def by_hand(left, right, tolerance):
    out = set()
    for side, mine, other in (("l", left, right), ("r", right, left)):
        for key in mine.keys() - other.keys():
            out.add((*key, "(row)", "present" if side == "l" else None, "present" if side == "r" else None))
    for key in left.keys() & right.keys():
        for name, a, b in zip(("v", "level", "l"), left[key], right[key], strict=True):
            if a == b or (isinstance(a, float) and isinstance(b, float) and (math.isnan(a) and math.isnan(b) or abs(a - b) <= tolerance)):
                continue
            text = lambda x: None if x is None else "NaN" if isinstance(x, float) and math.isnan(x) else str(x)
            out.add((*key, name, text(a), text(b)))
    return out


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_differences_by_hand(spark, buckets):
    rng = np.random.default_rng(5)
    left = {(f"u{i}", d): (float(rng.integers(0, 4)), "Alto", d) for i in range(30) for d in range(7)}
    left[(None, 0)] = (None, None, None)
    right = dict(left)
    for i in range(0, 30, 7):
        right[(f"u{i}", 2)] = (left[(f"u{i}", 2)][0] + (1e-12 if i % 2 else 0.5), "Bajo", None)
    left[("u1", 1)], right[("u1", 1)] = (math.nan, "a", 1), (math.nan, "a", 1)
    left[("u2", 1)], right[("u2", 1)] = (math.nan, "a", 1), (None, "a", 1)
    del right[("u3", 3)], left[("u4", 4)]
    a, b = (spark.createDataFrame([(*k, *v) for k, v in t.items()], SCHEMA) for t in (left, right))
    got = comparison.matrix_diff(a, b, ["unit", "day"], buckets=buckets).collect()
    assert {tuple(r) for r in got} == by_hand(left, right, 1e-9)
    assert comparison.matrix_diff(a, a, ["unit", "day"], buckets=buckets).count() == 0
    assert comparison.matrix_diff(a.limit(0), b.limit(0), ["unit", "day"]).count() == 0


def test_repeated_rows_are_paired(spark):
    a = spark.createDataFrame([("u", 1, 1.0, "x", 1)] * 3, SCHEMA)
    b = spark.createDataFrame([("u", 1, 1.0, "x", 1)] * 2 + [("u", 1, 2.0, "x", 1)], SCHEMA)
    assert [tuple(r) for r in comparison.matrix_diff(a, b, ["unit", "day"]).collect()] == [("u", 1, "v", "1.0", "2.0")]
    assert comparison.matrix_diff(a, b.limit(2), ["unit", "day"]).count() == 1


def test_equal_buckets_are_not_joined(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("unit"), F.lit(1).alias("day"), F.rand(1).alias("v"))
    other = rows.withColumn("v", F.when(F.col("unit") == "7", 9.0).otherwise(F.col("v")))
    each = [F.pmod(F.xxhash64("unit", "day"), F.lit(64)).alias("_bucket")]
    open_buckets = comparison.differing_buckets(rows.select("*", *each), other.select("*", *each), ["unit", "day", "v"])
    assert open_buckets.count() == 1


def test_a_tally_reads_like_its_rows(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.dirichlet([1, 1, 1], 400), 1)
    rows = [("a" if i % 3 else "b", int(rng.integers(0, 3)), int(q.argmax()), *map(float, q)) for i, q in enumerate(p)]
    rows += [("none", int(rng.integers(0, 3)), 1, None, None, None) for _ in range(9)]
    df = spark.createDataFrame(rows, "model string, label int, pred int, p_low double, p_medium double, p_high double")
    parts = metrics.tally(df.filter("label = 0"), ["model"]).unionByName(metrics.tally(df.filter("label > 0"), ["model"]))
    merged = metrics.tally(parts, ["model"])
    for figure in (metrics.macro_report, metrics.confusion_matrix, metrics.class_metrics, metrics.brier, metrics.auc_ovr, metrics.full_report):
        want = sorted(map(str, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in figure(df, ["model"]).collect())))
        got = sorted(map(str, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in figure(merged, ["model"]).collect())))
        assert got == want
    report = {r["model"]: r for r in metrics.full_report(df, ["model"]).collect()}
    assert report["none"]["brier"] is None and report["none"]["auc_low"] is None and report["a"]["auc_low"] is not None
    assert sum(report["b"][f"m{i}{j}"] for i in range(3) for j in range(3)) == report["b"]["n"]
    assert metrics.full_report(df).first()["n"] == 409


def test_profile_of_a_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Tipo;Canton;Latitud;Otro;Fecha\nTránsito;Guayaquil;-2.5;;1/1/2024\ntransito ;;0;x;NA\nRobo;Quito;abc;x;\n")
    (tmp_path / "b.csv").write_bytes("Categoría,Ciudad,coord_x,n\nñ,\"Quito, norte\",1,2\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("nothing to split\n1\n")
    got = {(r.source, r.column): r for r in csv_files.profile_folder(spark, str(tmp_path)).collect()}
    assert len(got) == 9 and {r.encoding for r in got.values()} == {"UTF-8", "ISO-8859-1"}
    lat = got["a.csv", "Latitud"]
    assert (lat.rows, lat.min, lat.max, lat.null_pct, lat.distinct_values) == (3, -2.5, 0.0, 0.0, 3)
    assert lat.zero_pct == pytest.approx(100 / 3) and lat.top is None
    kind = got["a.csv", "Tipo"]
    assert [tuple(t) for t in kind.top] == [("TRANSITO", 2), ("ROBO", 1)] and kind.min is None
    assert got["a.csv", "Otro"].null_pct == pytest.approx(100 / 3) and got["a.csv", "Fecha"].sample == ["1/1/2024"]
    assert got["b.csv", "Ciudad"].sample == ["Quito, norte"] and got["b.csv", "coord_x"].max == 1.0
    assert [tuple(t) for t in got["a.csv", "Canton"].top] == [("GUAYAQUIL", 1), ("NAN", 1), ("QUITO", 1)]
    again = {(r.source, r.column): r for r in csv_files.profile_folder(spark, str(tmp_path)).collect()}
    assert again == got
    with pytest.raises(ValueError, match="can be read"):
        csv_files.profile_folder(spark, str(tmp_path / "c.csv"))
