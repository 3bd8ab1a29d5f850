"""Features, labels, bins, weights and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskpanel.operators import binning, comparison, features, impurity, labels, split, weights

from riskpanel.session import materialise

from .fixtures import (
    FEATURE_SQL,
    FEATURES,
    LEVEL,
    featured_panel,
    label_sql,
    labelled_panel,
    nation_panel,
    r6,
    split_panel,
    split_sql,
    THRESHOLD_SQL,
)

KEYS = ("unit_id", "dow", "week_idx")
KEY_SQL = "unit_id, dow, week_idx"


def lags(spark, sf_dir):
    rows = features.with_lags(nation_panel(spark, sf_dir, 1))
    return rows.select(*KEYS, *[F.col(f"rezago_{k}") for k in features.LAGS])


def moving_means(spark, sf_dir):
    rows = features.with_moving_means(nation_panel(spark, sf_dir, 1))
    return rows.select(*KEYS, *[r6(F.col(f"media_movil_{w}")).alias(f"media_movil_{w}") for w in features.WINDOWS])


def historical_density(spark, sf_dir):
    rows = features.with_density(nation_panel(spark, sf_dir, 1), "density")
    return rows.select(*KEYS, r6(F.col("density")).alias("density"))


def _rounded(columns):
    return [r6(F.col(c)).alias(c) for c in columns]


def feature_matrix(spark, sf_dir):
    return featured_panel(spark, sf_dir).select(*KEYS, "split", *_rounded(FEATURES))


def future_week_rows(spark, sf_dir):
    rows = features.next_week_rows(featured_panel(spark, sf_dir))
    return rows.select(*KEYS, "week_start", *_rounded(FEATURES))


def matrix_diff(spark, sf_dir):
    """What changed in the features of a unit and weekday from the last observed week to the coming one."""
    rows = materialise(featured_panel(spark, sf_dir).select(*KEYS, *_rounded(FEATURES)), "features")
    coming = rows.agg(F.max("week_idx")).scalar()
    left, right = (rows.filter(F.col("week_idx") == coming - k).drop("week_idx") for k in (1, 0))
    return comparison.matrix_diff(left, right, ["unit_id", "dow"]).withColumns(
        {c: r6(F.col(c).cast("double")) for c in ("left_value", "right_value")}
    )


def _ladder(spark, sf_dir):
    return labels.threshold_ladder(labels.training_histogram(split_panel(spark, sf_dir)))


def threshold_ladder(spark, sf_dir):
    shares = ("low", "high", "share_low", "share_medium", "share_high", "mass_low_pct", "mass_high_pct")
    return _ladder(spark, sf_dir).select(
        "rung_order", "rung", *_rounded(shares), "collapsed_days", "viable", "matches_percentiles", "high_exceeds_medium"
    )


def _rung(name):
    def query(spark, sf_dir):
        rows = _ladder(spark, sf_dir).filter(F.col("rung") == name)
        return rows.select("rung", *_rounded(("low", "high", "share_low", "share_medium", "share_high")))

    return query


def thresholds_by_dow(spark, sf_dir):
    histogram = labels.training_histogram(split_panel(spark, sf_dir))
    ladder = labels.threshold_ladder(histogram, rungs=["por_dia"], max_collapsed_days=7)
    return ladder.select(
        F.posexplode(F.arrays_zip("low_by_day", "high_by_day")).alias("dow", "cut")
    ).select("dow", r6(F.col("cut.low_by_day")).alias("low"), r6(F.col("cut.high_by_day")).alias("high"))


def label_rows(spark, sf_dir):
    return labelled_panel(spark, sf_dir).select(*KEYS, "n", "label")


def class_distribution(spark, sf_dir):
    dist = labels.class_distribution(labelled_panel(spark, sf_dir))
    return dist.withColumn("share", r6(F.col("share")))


def labels_by_dow(spark, sf_dir):
    cells = split_panel(spark, sf_dir)
    cuts = labels.fit_thresholds(cells, rungs=["por_dia"], max_collapsed_days=7)
    return labels.with_label(cells, cuts).groupBy("dow", "label").agg(F.count("*").alias("cells"))


def _train_rows(featured):
    return split.model_rows(featured, "train")


def bin_edges(spark, sf_dir):
    edges = binning.fit_bin_edges(_train_rows(featured_panel(spark, sf_dir)), FEATURES)
    return edges.select("feature", F.posexplode("edges").alias("edge_idx", "edge")).select(
        "feature", "edge_idx", r6(F.col("edge")).alias("edge")
    )


def _binned(spark, sf_dir):
    featured = materialise(featured_panel(spark, sf_dir), "features")
    edges = binning.fit_bin_edges(_train_rows(featured), FEATURES)
    return binning.apply_bins(featured, edges, FEATURES)


def binned_features(spark, sf_dir):
    return _binned(spark, sf_dir).select(*KEYS, *FEATURES)


def class_weights(spark, sf_dir):
    rows = _train_rows(labelled_panel(spark, sf_dir))
    full = weights.class_weights(rows).withColumn("power", F.lit(1.0))
    half = weights.class_weights(rows, power=0.5).withColumn("power", F.lit(0.5))
    return full.unionByName(half).withColumn("weight", r6(F.col("weight")))


def _weighted_train(spark, sf_dir):
    rows = _train_rows(labelled_panel(spark, sf_dir))
    return weights.with_row_weights(rows, weights.class_weights(rows))


def row_weights(spark, sf_dir):
    return _weighted_train(spark, sf_dir).select(*KEYS, "label", r6(F.col("weight")).alias("weight"))


def gini_by_unit(spark, sf_dir):
    by_unit = impurity.gini_by_group(_weighted_train(spark, sf_dir), ["unit_id"])
    return by_unit.withColumn("impurity", r6(F.col("impurity")))


def _split_rows(spark, sf_dir):
    cells = labelled_panel(spark, sf_dir, 1)
    binned = materialise(features.build_features(cells, LEVEL), "features")
    edges = binning.fit_bin_edges(_train_rows(binned), FEATURES)
    rows = _train_rows(binning.apply_bins(binned, edges, FEATURES))
    return weights.with_row_weights(rows, weights.class_weights(rows))


def best_split(spark, sf_dir):
    found = impurity.best_split(_split_rows(spark, sf_dir), FEATURES)
    return found.withColumn("gain", F.round("gain", 4))


def best_split_by_unit(spark, sf_dir):
    found = impurity.best_split(_split_rows(spark, sf_dir), FEATURES, ["unit_id"])
    return found.withColumn("gain", F.round("gain", 4))


QUERIES = {
    "lags": lags,
    "moving_means": moving_means,
    "historical_density": historical_density,
    "feature_matrix": feature_matrix,
    "future_week_rows": future_week_rows,
    "matrix_diff": matrix_diff,
    "threshold_ladder": threshold_ladder,
    "thresholds_global": _rung("global"),
    "thresholds_positive": _rung("positivos"),
    "thresholds_by_dow": thresholds_by_dow,
    "thresholds_discrete": _rung("discreto"),
    "labels": label_rows,
    "labels_by_dow": labels_by_dow,
    "class_distribution": class_distribution,
    "bin_edges": bin_edges,
    "binned_features": binned_features,
    "class_weights": class_weights,
    "row_weights": row_weights,
    "gini_by_unit": gini_by_unit,
    "best_split": best_split,
    "best_split_by_unit": best_split_by_unit,
}


def _round_sql(columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _rung_sql(name):
    return f"""WITH {split_sql()}, {THRESHOLD_SQL}
        SELECT rung, round(low, 6) AS low, round(high, 6) AS high,
               {_round_sql(("share_low", "share_medium", "share_high"))} FROM ladder WHERE rung = '{name}'"""


FEATURED = f"{split_sql(1)}, {FEATURE_SQL}"

EDGE_SQL = """
longv AS (UNPIVOT (SELECT {cols} FROM ft WHERE split = 'train' AND eligible) ON {cols}
          INTO NAME feature VALUE value),
sizes AS (SELECT feature, count(DISTINCT value) AS k FROM longv GROUP BY 1),
few AS (SELECT DISTINCT feature, value AS edge FROM longv JOIN sizes USING (feature) WHERE k BETWEEN 2 AND 32
        QUALIFY value < max(value) OVER (PARTITION BY feature)
        UNION ALL SELECT DISTINCT feature, value - 1 FROM longv JOIN sizes USING (feature) WHERE k = 1),
many AS (SELECT DISTINCT feature, edge FROM (
           SELECT feature, unnest(quantile_cont(value, [{probs}])) AS edge
           FROM longv JOIN sizes USING (feature) WHERE k > 32 GROUP BY feature)),
edges AS (SELECT * FROM few UNION ALL SELECT * FROM many)""".format(
    cols=", ".join(FEATURES), probs=", ".join(str(k / 32) for k in range(1, 32))
)

BIN_EXPRS = ", ".join(
    f"CAST((SELECT count(*) FROM edges WHERE feature = '{f}' AND edge < {src}) AS INTEGER) AS {f}"
    for f, src in ((f, f"ft.{f}") for f in FEATURES)
)

WEIGHT_SQL = """
trl AS (SELECT * FROM lab WHERE split = 'train' AND eligible),
cls AS (SELECT CAST(k AS INTEGER) AS label, (SELECT count(*) FROM trl WHERE label = k) AS cells
        FROM (SELECT unnest(range(3)) AS k)),
cw AS (SELECT label, cells, CASE WHEN cells > 0 THEN (SELECT sum(cells) FROM cls) / (3 * cells) ELSE 0 END
              AS weight FROM cls)"""

# histogram per (node, feature, bin), then prefix sums and the best valid cut
SPLIT_SQL = """
binned AS (SELECT unit_id, dow, week_idx, {bins} FROM ft WHERE split = 'train' AND eligible),
rowsw AS (SELECT {node} AS node, b.* EXCLUDE (unit_id, dow, week_idx), trl.label, cw.weight
          FROM binned b JOIN trl USING (unit_id, dow, week_idx) JOIN cw ON cw.label = trl.label),
lng AS (UNPIVOT rowsw ON {cols} INTO NAME feature VALUE bin),
hist AS (SELECT node, feature, bin, count(*) AS c,
                sum(weight) FILTER (label = 0) AS a0, sum(weight) FILTER (label = 1) AS a1,
                sum(weight) FILTER (label = 2) AS a2 FROM lng GROUP BY 1, 2, 3),
pre AS (SELECT node, feature, bin, sum(c) OVER u AS nl, sum(c) OVER g AS nt,
               coalesce(sum(a0) OVER u, 0) AS l0, coalesce(sum(a1) OVER u, 0) AS l1, coalesce(sum(a2) OVER u, 0) AS l2,
               coalesce(sum(a0) OVER g, 0) AS t0, coalesce(sum(a1) OVER g, 0) AS t1, coalesce(sum(a2) OVER g, 0) AS t2
        FROM hist WINDOW u AS (PARTITION BY node, feature ORDER BY bin), g AS (PARTITION BY node, feature)),
crit AS (SELECT node, feature, bin, t0 + t1 + t2 AS w,
                1 - (t0 * t0 + t1 * t1 + t2 * t2) / ((t0 + t1 + t2) * (t0 + t1 + t2)) AS parent,
                ((l0 + l1 + l2) - (l0 * l0 + l1 * l1 + l2 * l2) / (l0 + l1 + l2)
                 + (t0 - l0 + t1 - l1 + t2 - l2)
                 - ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1) + (t2 - l2) * (t2 - l2))
                   / (t0 - l0 + t1 - l1 + t2 - l2)) / (t0 + t1 + t2) AS crit
         FROM pre WHERE nl >= 5 AND nt - nl >= 5 AND bin < 31),
ranked AS (SELECT *, row_number() OVER (PARTITION BY node
                  ORDER BY round(crit, 12), list_position([{names}], feature), bin) AS rk
           FROM crit WHERE crit < parent - 1e-12)"""


def _split_sql(node):
    return SPLIT_SQL.format(
        bins=BIN_EXPRS, node=node, cols=", ".join(FEATURES), names=", ".join(f"'{f}'" for f in FEATURES)
    )


# label_sql() defines the same sp as split_sql(), so features and labels share it
LABELLED_FEATURES = f"{label_sql(1)}, {FEATURE_SQL}, {EDGE_SQL}, {WEIGHT_SQL}"

ORACLES = {
    "lags": f"""WITH {FEATURED} SELECT {KEY_SQL}, rezago_1, rezago_2, rezago_3, rezago_4 FROM ft""",
    "moving_means": f"WITH {FEATURED} SELECT {KEY_SQL}, {_round_sql(('media_movil_4', 'media_movil_12'))} FROM ft",
    "historical_density": f"""WITH {FEATURED}
        SELECT {KEY_SQL}, round(densidad_historica_nacion, 6) AS density FROM ft""",
    "feature_matrix": f"WITH {FEATURED} SELECT {KEY_SQL}, split, {_round_sql(FEATURES)} FROM ft",
    "future_week_rows": f"""WITH {FEATURED}
        SELECT {KEY_SQL}, week_start, {_round_sql(FEATURES)} FROM ft WHERE split = 'future'""",
    "matrix_diff": f"""WITH {split_sql(1)}, {FEATURE_SQL},
        long AS (UNPIVOT (SELECT unit_id, dow, week_idx, {", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)} FROM ft)
                 ON {", ".join(FEATURES)} INTO NAME "column" VALUE v),
        w AS (SELECT max(week_idx) AS coming FROM ft)
        SELECT a.unit_id, a.dow, a."column", a.v AS left_value, b.v AS right_value
        FROM long a JOIN long b USING (unit_id, dow, "column") CROSS JOIN w
        WHERE a.week_idx = coming - 1 AND b.week_idx = coming AND abs(a.v - b.v) > 1e-9""",
    "threshold_ladder": f"""WITH {split_sql()}, {THRESHOLD_SQL}
        SELECT rung_order, rung, CASE WHEN rung <> 'por_dia' THEN round(low, 6) END AS low,
               CASE WHEN rung <> 'por_dia' THEN round(high, 6) END AS high,
               {_round_sql(("share_low", "share_medium", "share_high"))},
               CASE WHEN rung <> 'por_dia' THEN round(mass_low_pct, 6) END AS mass_low_pct,
               CASE WHEN rung <> 'por_dia' THEN round(mass_high_pct, 6) END AS mass_high_pct,
               CASE WHEN rung = 'por_dia' THEN CAST(collapsed AS INTEGER) END AS collapsed_days, viable,
               rung <> 'discreto' AS matches_percentiles, share_high > share_medium AS high_exceeds_medium
        FROM ladder""",
    "thresholds_global": _rung_sql("global"),
    "thresholds_positive": _rung_sql("positivos"),
    "thresholds_by_dow": f"""WITH {split_sql()}, {THRESHOLD_SQL}
        SELECT CAST(dow AS INTEGER) AS dow, round(low, 6) AS low, round(high, 6) AS high FROM cuts_d""",
    "thresholds_discrete": _rung_sql("discreto"),
    "labels": f"WITH {label_sql()} SELECT {KEY_SQL}, n, label FROM lab",
    "labels_by_dow": f"""WITH {split_sql()}, {THRESHOLD_SQL}
        SELECT dow, CAST(n > low AS INTEGER) + CAST(n > high AS INTEGER) AS label, count(*) AS cells
        FROM sp JOIN cuts_d USING (dow) GROUP BY 1, 2""",
    "class_distribution": f"""WITH {label_sql()}
        SELECT split, label, count(*) AS cells,
               round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
        FROM lab GROUP BY 1, 2""",
    "bin_edges": f"""WITH {FEATURED}, {EDGE_SQL}
        SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS INTEGER) AS edge_idx,
               round(edge, 6) AS edge FROM edges""",
    "binned_features": f"WITH {FEATURED}, {EDGE_SQL} SELECT {KEY_SQL}, {BIN_EXPRS} FROM ft",
    "class_weights": f"""WITH {label_sql()}, {WEIGHT_SQL}
        SELECT label, cells, round(pow(weight, p), 6) AS weight, CAST(p AS DOUBLE) AS power
        FROM cw, (VALUES (1.0), (0.5)) AS v(p)""",
    "row_weights": f"""WITH {label_sql()}, {WEIGHT_SQL}
        SELECT {KEY_SQL}, trl.label, round(weight, 6) AS weight FROM trl JOIN cw ON cw.label = trl.label""",
    "gini_by_unit": f"""WITH {label_sql()}, {WEIGHT_SQL},
        s AS (SELECT unit_id, trl.label, count(*) AS c, sum(weight) AS w FROM trl JOIN cw ON cw.label = trl.label
              GROUP BY 1, 2)
        SELECT unit_id, CAST(sum(c) AS BIGINT) AS cells,
               round(1 - sum(w * w) / (sum(w) * sum(w)), 6) AS impurity FROM s GROUP BY 1""",
    "best_split": f"""WITH {LABELLED_FEATURES}, {_split_sql("0")}
        SELECT feature, bin, round((parent - crit) * w, 4) AS gain FROM ranked WHERE rk = 1""",
    "best_split_by_unit": f"""WITH {LABELLED_FEATURES}, {_split_sql("unit_id")}
        SELECT node AS unit_id, feature, bin, round((parent - crit) * w, 4) AS gain FROM ranked WHERE rk = 1""",
}
