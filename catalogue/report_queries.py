"""Metrics over the baselines and class shares, the risk matrix and its reports.

Probabilities come from the class shares of each unit and weekday in training:
deterministic, so every report has an exact SQL equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.operators import baselines, labels, metrics, panel, risk, split
from riskpanel.session import materialise

from .fixtures import LATE_EVENTS_SQL, TRAIN_END, VAL_END, label_sql, labelled_panel, late_daily, r6, table

KEYS = ("unit_id", "dow", "week_idx")
MODELS = ("persistence", "mode", "majority")
SCORES = ("accuracy", "f1_macro", "f1_low", "f1_medium", "f1_high", "recall_high", "precision_high")
PROBABILITY_SCORES = ("brier", "auc_low", "auc_medium", "auc_high")
CLASS_SCORES = ("precision_low", "precision_medium", "recall_low", "recall_medium")
MATRIX = tuple(f"m{i}{j}" for i in range(3) for j in range(3))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(F.col(c)) for c in columns})


def _test(df: DataFrame) -> DataFrame:
    return df.filter((F.col("split") == "test") & F.col("eligible"))


def _baselines(labelled: DataFrame) -> DataFrame:
    for name, baseline in zip(MODELS, (baselines.persistence, baselines.historical_mode, baselines.majority)):
        labelled = baseline(labelled).withColumnRenamed("pred", name)
    return _test(labelled).unpivot([*KEYS, "label"], list(MODELS), "model", "pred")


def baseline_rows(spark, sf_dir) -> DataFrame:
    """Test rows under each baseline: ``(unit_id, dow, week_idx, model, label, pred)``."""
    return _baselines(materialise(labelled_panel(spark, sf_dir), "labelled"))


def _baseline(name):
    def query(spark, sf_dir):
        rows = labelled_panel(spark, sf_dir)
        if name == "majority":
            rows = materialise(rows, "labelled")
        model = {"persistence": baselines.persistence, "mode": baselines.historical_mode, "majority": baselines.majority}
        return _test(model[name](rows)).select(*KEYS, "label", "pred")

    return query


def with_shares(labelled: DataFrame) -> DataFrame:
    group = Window.partitionBy("unit_id", "dow")
    train = F.col("split") == "train"
    shares = {
        p: F.coalesce(F.avg(F.when(train, (F.col("label") == k).cast("double"))).over(group), F.lit(0.0))
        for k, p in enumerate(metrics.PROBABILITIES)
    }
    return labelled.withColumns(shares)


def _shares(labelled: DataFrame) -> DataFrame:
    return _test(with_shares(labelled)).withColumn("pred", metrics.argmax())


def scored_rows(spark, sf_dir) -> DataFrame:
    return _shares(labelled_panel(spark, sf_dir))


def model_comparison(spark, sf_dir):
    """The baselines and the class shares side by side; Brier and AUC only where there are probabilities."""
    labelled = materialise(labelled_panel(spark, sf_dir), "labelled")
    columns = ["model", "label", "pred", *metrics.PROBABILITIES]
    shares = _shares(labelled).withColumn("model", F.lit("shares")).select(*columns)
    both = _baselines(labelled).unionByName(shares, allowMissingColumns=True).select(*columns)
    report = metrics.full_report(both, ["model"]).select("model", "n", *SCORES, *PROBABILITY_SCORES)
    return _rounded(report, *SCORES, *PROBABILITY_SCORES).orderBy(F.desc("f1_macro"), "model")


def nation_catalogue(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.select(
        F.col("n_nationkey").cast("string").alias("unit_id"), F.col("n_name").alias("name"), F.col("r_name").alias("area")
    )


def risk_matrix(spark, sf_dir):
    daily = late_daily(spark, sf_dir)
    meta = panel.read_meta(daily)
    cells = split.temporal_split(panel.dense_panel(daily, meta, future_weeks=1), TRAIN_END, VAL_END)
    cells = materialise(split.with_eligibility(cells), "panel")
    scored = with_shares(labels.with_label(cells, labels.fit_thresholds(cells)))
    target = scored.filter(F.col("split") == "future")
    units = nation_catalogue(spark, sf_dir).join(daily.select("unit_id").distinct(), "unit_id", "left_semi")
    return risk.risk_matrix(target, units, meta.next_week)


PROBS = ("prob_clase_predicha", "p_bajo", "p_medio", "p_alto")


def risk_pivot(spark, sf_dir):
    wide = risk.risk_pivot(risk_matrix(spark, sf_dir))
    return _rounded(wide, *[c for c in wide.columns if c.endswith("_prob")])


def dashboard_filter(spark, sf_dir):
    rows = risk.dashboard_filter(
        risk_matrix(spark, sf_dir),
        days=["Lunes", "Martes", "Viernes"],
        levels=["Bajo", "Medio", risk.NOT_SCORED],
        min_probability=0.6,
    )
    return _rounded(rows, *PROBS)


def unit_catalogue(spark, sf_dir):
    return risk.unit_catalogue(nation_catalogue(spark, sf_dir))


QUERIES = {
    "baseline_persistence": _baseline("persistence"),
    "baseline_mode": _baseline("mode"),
    "baseline_majority": _baseline("majority"),
    "confusion_matrix": lambda spark, sf: metrics.confusion_matrix(baseline_rows(spark, sf), ["model"]),
    "class_metrics": lambda spark, sf: _rounded(
        metrics.class_metrics(baseline_rows(spark, sf), ["model"]), "precision", "recall", "f1"
    ),
    "macro_report": lambda spark, sf: _rounded(
        metrics.macro_report(scored_rows(spark, sf)),
        "accuracy", "f1_macro", "f1_low", "f1_medium", "f1_high", "recall_high", "precision_high",
    ),
    "model_comparison": model_comparison,
    "metrics_by_unit": lambda spark, sf: _rounded(
        metrics.metrics_by_unit(scored_rows(spark, sf)), "accuracy", "f1_macro", "recall_high", "precision_high"
    ),
    "brier": lambda spark, sf: _rounded(metrics.brier(scored_rows(spark, sf)), "brier"),
    "auc_ovr": lambda spark, sf: _rounded(metrics.auc_ovr(scored_rows(spark, sf)), "auc"),
    "auc_by_unit": lambda spark, sf: _rounded(metrics.auc_ovr(scored_rows(spark, sf), ["unit_id"]), "auc"),
    "calibration": lambda spark, sf: _rounded(
        metrics.calibration(scored_rows(spark, sf)), "confidence", "hit_rate"
    ),
    "full_report": lambda spark, sf: _rounded(
        metrics.full_report(scored_rows(spark, sf)), *SCORES, *CLASS_SCORES, *PROBABILITY_SCORES
    ),
    "risk_matrix": lambda spark, sf: _rounded(risk_matrix(spark, sf), *PROBS),
    "risk_pivot": risk_pivot,
    "top_risk": lambda spark, sf: _rounded(risk.top_risk(risk_matrix(spark, sf)), "prob_clase_predicha"),
    "most_confident": lambda spark, sf: _rounded(risk.most_confident(risk_matrix(spark, sf)), *PROBS),
    "risk_detail": lambda spark, sf: _rounded(risk.detail(risk_matrix(spark, sf)), *PROBS),
    "level_summary": lambda spark, sf: risk.level_summary(risk_matrix(spark, sf)),
    "dashboard_filter": dashboard_filter,
    "kpis": lambda spark, sf: _rounded(risk.kpis(risk_matrix(spark, sf)), "mean_confidence"),
    "unit_catalogue": unit_catalogue,
}

KEY_SQL = "unit_id, dow, week_idx"

BASELINE_SQL = f"""{label_sql()},
pr AS (SELECT *, coalesce(lag(label) OVER (PARTITION BY unit_id, dow ORDER BY week_idx), 0) AS p1,
              count(*) FILTER (split = 'train' AND label = 0) OVER g AS k0,
              count(*) FILTER (split = 'train' AND label = 1) OVER g AS k1,
              count(*) FILTER (split = 'train' AND label = 2) OVER g AS k2
       FROM lab WINDOW g AS (PARTITION BY unit_id, dow)),
maj AS (SELECT label AS p3 FROM lab WHERE split = 'train' AND eligible
        GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
bl AS (SELECT {KEY_SQL}, label, p1, CAST(CASE WHEN k0 >= k1 AND k0 >= k2 THEN 0 WHEN k1 >= k2 THEN 1 ELSE 2 END
              AS INTEGER) AS p2, p3 FROM pr CROSS JOIN maj WHERE split = 'test' AND eligible),
sc AS (SELECT {KEY_SQL}, 'persistence' AS model, label, p1 AS pred FROM bl
       UNION ALL SELECT {KEY_SQL}, 'mode', label, p2 FROM bl
       UNION ALL SELECT {KEY_SQL}, 'majority', label, p3 FROM bl)"""

SHARES_SQL = """
shr AS (SELECT *, coalesce(avg(CAST(label = 0 AS DOUBLE)) FILTER (split = 'train') OVER g, 0) AS p_low,
               coalesce(avg(CAST(label = 1 AS DOUBLE)) FILTER (split = 'train') OVER g, 0) AS p_medium,
               coalesce(avg(CAST(label = 2 AS DOUBLE)) FILTER (split = 'train') OVER g, 0) AS p_high
        FROM lab WINDOW g AS (PARTITION BY unit_id, dow)),
shp AS (SELECT *, CAST(CASE WHEN p_low >= p_medium AND p_low >= p_high THEN 0 WHEN p_medium >= p_high THEN 1 ELSE 2 END
                       AS INTEGER) AS pred FROM shr)"""

SCORED_SQL = f"""{label_sql()}, {SHARES_SQL},
scored AS (SELECT * FROM shp WHERE split = 'test' AND eligible)"""


def _class_sql(source: str, group: str) -> str:
    """Per-class figures grouped by one column."""
    return f"""cls AS (SELECT {group}, k AS label, count(*) FILTER (label = k) AS support,
                   count(*) FILTER (label = k AND pred = k) AS tp, count(*) FILTER (pred = k) AS pp
            FROM {source}, (SELECT CAST(unnest(range(3)) AS INTEGER) AS k) GROUP BY {group}, k),
        pr2 AS (SELECT {group}, label, support, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END AS precision,
                       CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM cls),
        prf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                               ELSE 0 END AS f1 FROM pr2),
        rep AS (SELECT {group}, CAST(sum(support) AS BIGINT) AS n, sum(recall * support) / sum(support) AS accuracy,
                       avg(f1) AS f1_macro, max(f1) FILTER (label = 0) AS f1_low,
                       max(f1) FILTER (label = 1) AS f1_medium, max(f1) FILTER (label = 2) AS f1_high,
                       max(recall) FILTER (label = 2) AS recall_high,
                       max(precision) FILTER (label = 2) AS precision_high,
                       CAST(count(*) FILTER (support > 0) AS INTEGER) AS classes_present,
                       string_agg(CAST(support AS VARCHAR), '/' ORDER BY label) AS dist_low_medium_high
                FROM prf GROUP BY {group})"""


def _round_sql(*columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


AUC_SQL = """
one AS (SELECT *, 'all' AS every FROM scored),
lngp AS (SELECT {group} AS grp, CAST(k AS INTEGER) AS class, CAST(label = k AS INTEGER) AS hit,
                CASE k WHEN 0 THEN p_low WHEN 1 THEN p_medium ELSE p_high END AS score
         FROM one, (SELECT unnest(range(3)) AS k)),
rk AS (SELECT *, rank() OVER (PARTITION BY grp, class ORDER BY score)
              + (count(*) OVER (PARTITION BY grp, class, score) - 1) / 2 AS mid FROM lngp),
ag AS (SELECT grp, class, sum(hit) AS np, count(*) - sum(hit) AS nn, sum(mid * hit) AS rs FROM rk GROUP BY 1, 2),
auc AS (SELECT grp, class, CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / 2) / (np * nn) END AS auc FROM ag)"""

BRIER_SQL = """avg((p_low - CAST(label = 0 AS INTEGER)) ** 2 + (p_medium - CAST(label = 1 AS INTEGER)) ** 2
                   + (p_high - CAST(label = 2 AS INTEGER)) ** 2)"""

MATRIX_SQL = f"""{label_sql(1, LATE_EVENTS_SQL)}, {SHARES_SQL},
cat AS (SELECT CAST(n_nationkey AS VARCHAR) AS unit_id, n_name AS name, r_name AS area,
               CAST(row_number() OVER (ORDER BY CAST(n_nationkey AS VARCHAR)) - 1 AS INTEGER) AS idx
        FROM nation JOIN region ON n_regionkey = r_regionkey
        WHERE CAST(n_nationkey AS VARCHAR) IN (SELECT unit_id FROM ev)),
mx AS (SELECT unit_id AS unidad_id, name AS unidad, area AS canton, idx AS unidad_idx, dow AS dia_idx,
              ['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'][dow + 1] AS dia_semana,
              CAST(CASE WHEN eligible THEN pred ELSE -1 END AS INTEGER) AS nivel_cod,
              CASE WHEN NOT eligible THEN 'Sin datos suficientes' WHEN pred = 0 THEN 'Bajo'
                   WHEN pred = 1 THEN 'Medio' ELSE 'Alto' END AS nivel,
              CASE WHEN eligible THEN round(greatest(p_low, p_medium, p_high), 6) END AS prob_clase_predicha,
              CASE WHEN eligible THEN round(p_low, 6) END AS p_bajo,
              CASE WHEN eligible THEN round(p_medium, 6) END AS p_medio,
              CASE WHEN eligible THEN round(p_high, 6) END AS p_alto,
              strftime(week_start, '%Y-%m-%d') AS semana_objetivo,
              CASE WHEN NOT eligible THEN 3 ELSE 2 - pred END AS sev
       FROM shp JOIN cat USING (unit_id) WHERE split = 'future')"""

DAYS = ("Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo")

ORACLES = {
    **{
        f"baseline_{m}": f"WITH {BASELINE_SQL} SELECT {KEY_SQL}, label, pred FROM sc WHERE model = '{m}'"
        for m in MODELS
    },
    "confusion_matrix": f"""WITH {BASELINE_SQL}
        SELECT model, CAST(i AS INTEGER) AS label, CAST(j AS INTEGER) AS pred,
               count(*) FILTER (label = i AND pred = j) AS cells
        FROM sc, (SELECT unnest(range(3)) AS i), (SELECT unnest(range(3)) AS j) GROUP BY 1, 2, 3""",
    "class_metrics": f"""WITH {BASELINE_SQL}, {_class_sql("sc", "model")}
        SELECT model, label, support, {_round_sql("precision", "recall", "f1")} FROM prf""",
    "macro_report": f"""WITH {SCORED_SQL}, one AS (SELECT *, 1 AS g FROM scored), {_class_sql("one", "g")}
        SELECT n, {_round_sql(*SCORES)} FROM rep""",
    "model_comparison": f"""WITH {BASELINE_SQL}, {SHARES_SQL},
        scored AS (SELECT * FROM shp WHERE split = 'test' AND eligible), {AUC_SQL.format(group='every')},
        every AS (SELECT model, label, pred FROM sc UNION ALL SELECT 'shares', label, pred FROM scored),
        {_class_sql("every", "model")},
        prob AS (SELECT 'shares' AS model, (SELECT round({BRIER_SQL}, 6) FROM scored) AS brier,
                        {", ".join(f"max(round(auc, 6)) FILTER (class = {k}) AS auc_{n}" for k, n in enumerate(("low", "medium", "high")))}
                 FROM auc)
        SELECT model, n, {_round_sql(*SCORES)}, brier, auc_low, auc_medium, auc_high FROM rep LEFT JOIN prob USING (model)""",
    "metrics_by_unit": f"""WITH {SCORED_SQL}, {_class_sql("scored", "unit_id")}
        SELECT unit_id, n, {_round_sql("accuracy", "f1_macro", "recall_high", "precision_high")},
               classes_present, dist_low_medium_high FROM rep""",
    "brier": f"WITH {SCORED_SQL} SELECT round({BRIER_SQL}, 6) AS brier FROM scored",
    "auc_ovr": f"WITH {SCORED_SQL}, {AUC_SQL.format(group='every')} SELECT class, round(auc, 6) AS auc FROM auc",
    "auc_by_unit": f"""WITH {SCORED_SQL}, {AUC_SQL.format(group='unit_id')}
        SELECT grp AS unit_id, class, round(auc, 6) AS auc FROM auc""",
    "calibration": f"""WITH {SCORED_SQL},
        cf AS (SELECT greatest(p_low, p_medium, p_high) AS c, CAST(pred = label AS DOUBLE) AS h FROM scored),
        bn AS (SELECT *, CAST(len(list_filter([0.1::DOUBLE, 0.2::DOUBLE, 0.30000000000000004::DOUBLE, 0.4::DOUBLE,
                      0.5::DOUBLE, 0.6000000000000001::DOUBLE, 0.7000000000000001::DOUBLE, 0.8::DOUBLE, 0.9::DOUBLE],
                      lambda e: c >= e)) AS INTEGER) AS bin FROM cf)
        SELECT bin, round(avg(c), 6) AS confidence, round(avg(h), 6) AS hit_rate, count(*) AS cells
        FROM bn GROUP BY bin""",
    "full_report": f"""WITH {SCORED_SQL}, {AUC_SQL.format(group='every')}, {_class_sql("one", "every")}
        SELECT n, {_round_sql(*SCORES)}, (SELECT round({BRIER_SQL}, 6) FROM scored) AS brier,
               {", ".join(f"(SELECT round({f}, 6) FROM prf WHERE label = {k}) AS {f}_{n}" for f in ("precision", "recall") for k, n in ((0, "low"), (1, "medium")))},
               {", ".join(f"(SELECT count(*) FILTER (label = {i} AND pred = {j}) FROM scored) AS m{i}{j}" for i in range(3) for j in range(3))},
               (SELECT round(auc, 6) FROM auc WHERE class = 0) AS auc_low,
               (SELECT round(auc, 6) FROM auc WHERE class = 1) AS auc_medium,
               (SELECT round(auc, 6) FROM auc WHERE class = 2) AS auc_high FROM rep""",
    "risk_matrix": f"WITH {MATRIX_SQL} SELECT * EXCLUDE (sev) FROM mx",
    "risk_pivot": f"""WITH {MATRIX_SQL} SELECT unidad_id, unidad, CAST(min(sev) AS INTEGER) AS worst, """
    + ", ".join(
        f"max(nivel) FILTER (dia_idx = {i}) AS {d}_nivel, max(prob_clase_predicha) FILTER (dia_idx = {i}) AS {d}_prob"
        for i, d in enumerate(DAYS)
    )
    + " FROM mx GROUP BY 1, 2",
    "top_risk": f"""WITH {MATRIX_SQL} SELECT unidad_id, unidad, dia_semana, nivel, prob_clase_predicha
        FROM mx WHERE sev < 3 ORDER BY sev, prob_clase_predicha DESC, unidad_id, dia_idx LIMIT 6""",
    "most_confident": f"""WITH {MATRIX_SQL} SELECT * EXCLUDE (sev) FROM mx
        ORDER BY prob_clase_predicha DESC NULLS LAST, unidad_id, dia_idx LIMIT 10""",
    "risk_detail": f"""WITH {MATRIX_SQL} SELECT unidad_id, unidad, canton, dia_semana, nivel, prob_clase_predicha,
        p_bajo, p_medio, p_alto FROM mx""",
    "level_summary": f"WITH {MATRIX_SQL} SELECT nivel, count(*) AS cells FROM mx GROUP BY 1",
    "dashboard_filter": f"""WITH {MATRIX_SQL} SELECT * EXCLUDE (sev) FROM mx
        WHERE dia_semana IN ('Lunes', 'Martes', 'Viernes') AND nivel IN ('Bajo', 'Medio', 'Sin datos suficientes')
          AND (coalesce(prob_clase_predicha, 0) >= 0.6 OR nivel = 'Sin datos suficientes')""",
    "kpis": f"""WITH {MATRIX_SQL}
        SELECT max(semana_objetivo) AS semana_objetivo, count(DISTINCT unidad) AS units,
               count(DISTINCT unidad) FILTER (sev < 3) AS units_scored, count(*) AS cells,
               count(*) FILTER (nivel = 'Alto') AS high_risk, round(avg(pp), 6) AS mean_confidence
        FROM (SELECT mx.*, CASE WHEN shp.eligible THEN greatest(shp.p_low, shp.p_medium, shp.p_high) END AS pp
              FROM mx JOIN shp ON shp.unit_id = unidad_id AND shp.dow = dia_idx AND shp.split = 'future')""",
    "unit_catalogue": """SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS nombre, r_name AS canton
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
}
