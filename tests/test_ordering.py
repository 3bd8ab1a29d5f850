"""Distributed running totals and quantiles against brute force."""

import numpy as np
from pyspark.sql import functions as F

from riskpanel.operators.ordering import exact_quantiles, running_total, with_ordinal


def test_quantiles_equal_numpy_with_one_value_holding_a_third(spark):
    rng = np.random.default_rng(5)
    data = {}
    for group, size in (("a", 4000), ("b", 37), ("c", 1)):
        values = rng.normal(size=size)
        values[: size // 3] = 0.25  # a hot value
        data[group] = values
    rows = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    histogram = rows.groupBy("g", "v").agg(F.count("*").alias("c"))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.6, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(histogram, "v", "c", probabilities, ["g"]).collect()}
    for group, values in data.items():
        np.testing.assert_allclose(got[group], np.quantile(values, probabilities), atol=1e-12)


def test_running_total_per_group(spark):
    rows = [(g, i, (i * 7) % 5) for g in ("x", "y") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, n int").repartition(6)
    got = {(r["g"], r["k"]): (r["n_before"], r["n_total"]) for r in running_total(df, "k", ["n"], ["g"]).collect()}
    for g in ("x", "y"):
        before = 0
        for i in range(500):
            assert got[(g, i)][0] == before
            before += (i * 7) % 5
        assert {v[1] for key, v in got.items() if key[0] == g} == {before}


def test_ordinals_follow_the_sort_order(spark):
    keys = [f"unit-{i}" for i in range(300)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k string").repartition(7)
    got = {r["k"]: r["i"] for r in with_ordinal(df, "k", "i").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
