"""Event tables standing in for incidents, and the SQL the oracles share.

Main panel: one event per order, its unit the customer's nation, its date the
order date. Cuts leave 250 / 39 / 43 train / val / test weeks after the burn-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.operators import labels, panel, split
from riskpanel.operators.features import build_features
from riskpanel.session import materialise

TRAIN_END, VAL_END = "1999-12-31", "2000-09-30"
LEVEL = "nacion"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column) -> Column:
    return F.round(value, 6)


def nation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation and day, written once.

    Orders are reduced per customer and day first, so a customer with a third of
    the orders does not skew the join.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_customer = panel.daily_counts(orders, "o_custkey", "o_orderdate")
    joined = per_customer.join(customers, F.col("unit_id").cast("bigint") == F.col("c_custkey"))
    return materialise(panel.daily_counts(joined, "c_nationkey", "event_date", "n"), "daily")


def region_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    daily = nation_daily(spark, sf_dir)
    joined = daily.join(nations, F.col("unit_id").cast("int") == F.col("n_nationkey"))
    return panel.daily_counts(joined, "n_regionkey", "event_date", "n")


def late_daily(spark, sf_dir):
    """Shipments per supplier nation; those of nation 3 are nation 4's until training ended."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    per_supplier = panel.daily_counts(items, "l_suppkey", "l_shipdate")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = per_supplier.join(suppliers, F.col("unit_id").cast("bigint") == F.col("s_suppkey"))
    early = (F.col("s_nationkey") == 3) & (F.col("event_date") < F.lit("2000-06-01").cast("date"))
    unit = F.when(early, 4).otherwise(F.col("s_nationkey"))
    return materialise(panel.daily_counts(joined, unit, "event_date", "n"), "daily")


def nation_panel(spark: SparkSession, sf_dir: str, future_weeks: int = 0) -> DataFrame:
    return panel.dense_panel(nation_daily(spark, sf_dir), future_weeks=future_weeks)


def split_panel(spark: SparkSession, sf_dir: str, future_weeks: int = 0, level: str = "unit") -> DataFrame:
    cells = nation_panel(spark, sf_dir, future_weeks)
    return split.with_eligibility(split.temporal_split(cells, TRAIN_END, VAL_END), level)


def labelled_panel(spark: SparkSession, sf_dir: str, future_weeks: int = 0) -> DataFrame:
    """Fitting and applying the thresholds both read the panel, so it is written once."""
    cells = materialise(split_panel(spark, sf_dir, future_weeks), "panel")
    return labels.with_label(cells, labels.fit_thresholds(cells))


def featured_panel(spark: SparkSession, sf_dir: str, future_weeks: int = 1) -> DataFrame:
    return build_features(split_panel(spark, sf_dir, future_weeks), LEVEL)


# --- SQL shared by the oracles -------------------------------------------------

EVENTS_SQL = """
ev AS (SELECT CAST(c_nationkey AS VARCHAR) AS unit_id, CAST(o_orderdate AS DATE) AS d
       FROM orders JOIN customer ON o_custkey = c_custkey)"""

LATE_EVENTS_SQL = """
ev AS (SELECT CAST(CASE WHEN s_nationkey = 3 AND l_shipdate < TIMESTAMP '2000-06-01' THEN 4 ELSE s_nationkey END AS VARCHAR) AS unit_id,
              CAST(l_shipdate AS DATE) AS d
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def panel_sql(events: str = EVENTS_SQL, future: int = 0) -> str:
    """CTEs ``m`` (bounds) and ``panel`` on top of an ``ev(unit_id, d)`` CTE."""
    return f"""{events},
m AS (SELECT origin, last_date,
             CAST(floor((date_diff('day', origin, last_date) - 6) / 7.0) AS INTEGER) + 1 AS n_weeks
      FROM (SELECT CAST(date_trunc('week', min(d)) AS DATE) AS origin, max(d) AS last_date FROM ev)),
counts AS (SELECT unit_id, d, count(*) AS n FROM ev GROUP BY 1, 2),
grid AS (SELECT unit_id, CAST(dow AS INTEGER) AS dow, CAST(w AS INTEGER) AS week_idx
         FROM (SELECT DISTINCT unit_id FROM ev)
         CROSS JOIN (SELECT unnest(range(7)) AS dow)
         CROSS JOIN (SELECT unnest(range(n_weeks + {future})) AS w FROM m)),
panel AS (SELECT g.unit_id, g.dow, g.week_idx, origin + 7 * g.week_idx AS week_start,
                 CASE WHEN g.week_idx < n_weeks THEN coalesce(c.n, 0) END AS n
          FROM grid g CROSS JOIN m
          LEFT JOIN counts c ON c.unit_id = g.unit_id AND c.d = origin + (7 * g.week_idx + g.dow))"""


def split_sql(future: int = 0, level: str = "unit", events: str = EVENTS_SQL) -> str:
    """Adds ``sp``: the panel with split and eligibility."""
    keys = "unit_id" if level == "unit" else "unit_id, dow"
    return f"""{panel_sql(events, future)},
sp0 AS (SELECT *, CASE WHEN n IS NULL THEN 'future' WHEN week_idx < 12 THEN 'burn_in'
                       WHEN week_start <= DATE '{TRAIN_END}' THEN 'train'
                       WHEN week_start <= DATE '{VAL_END}' THEN 'val' ELSE 'test' END AS split FROM panel),
sp AS (SELECT *, coalesce(sum(CASE WHEN split = 'train' THEN n END) OVER (PARTITION BY {keys}) > 0, false)
              AS eligible FROM sp0)"""


# per-rule cuts from the training rows, then the first rule with three classes
THRESHOLD_SQL = """
tr AS (SELECT dow, n FROM sp WHERE split = 'train' AND eligible),
cuts_g AS (SELECT quantile_cont(n, 0.6) AS low, quantile_cont(n, 0.9) AS high FROM tr),
cuts_p AS (SELECT quantile_cont(n, 0.6) AS low, quantile_cont(n, 0.9) AS high FROM tr WHERE n > 0),
cuts_d AS (SELECT dow, quantile_cont(n, 0.6) AS low, quantile_cont(n, 0.9) AS high FROM tr GROUP BY dow),
dist AS (SELECT n, sum(cells) OVER (ORDER BY n) / sum(cells) OVER () AS f,
                row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS m
         FROM (SELECT n, CAST(count(*) AS DOUBLE) AS cells FROM tr GROUP BY n)),
pos0 AS (SELECT least(min(CASE WHEN f >= 0.6 THEN i END), max(m) - 2) AS i0,
                min(CASE WHEN f >= 0.9 THEN i END) AS j, max(m) AS m FROM dist),
pos AS (SELECT i0, least(greatest(j, i0 + 1), m - 1) AS i1 FROM pos0 WHERE m >= 3),
cuts_x AS (SELECT CAST(a.n AS DOUBLE) AS low, CAST(b.n AS DOUBLE) AS high
           FROM pos JOIN dist a ON a.i = i0 JOIN dist b ON b.i = i1),
cuts AS (SELECT 0 AS rung_order, 'global' AS rung, dow, low, high FROM cuts_g, (SELECT unnest(range(7)) AS dow)
         UNION ALL
         SELECT 1, 'positivos', dow, low, high FROM cuts_p, (SELECT unnest(range(7)) AS dow) WHERE low IS NOT NULL
         UNION ALL
         SELECT 2, 'por_dia', dow, low, high FROM cuts_d
         UNION ALL
         SELECT 3, 'discreto', dow, low, high FROM cuts_x, (SELECT unnest(range(7)) AS dow)),
shares AS (SELECT rung_order, rung, avg(CAST(n <= low AS INTEGER)) AS share_low,
                  avg(CAST(n > low AND n <= high AS INTEGER)) AS share_medium,
                  avg(CAST(n > low AND n > high AS INTEGER)) AS share_high,
                  100 * avg(CAST(n <= low AS INTEGER)) AS mass_low_pct, 100 * avg(CAST(n <= high AS INTEGER)) AS mass_high_pct
           FROM tr JOIN cuts USING (dow) GROUP BY 1, 2),
ladder AS (SELECT s.*, c.low, c.high, c.collapsed,
                  least(share_low, share_medium, share_high) >= 0.001
                  AND (rung <> 'por_dia' OR c.collapsed = 0) AS viable
           FROM shares s JOIN (SELECT rung_order, min(low) AS low, min(high) AS high,
                                      count(*) FILTER (low = high) AS collapsed FROM cuts GROUP BY 1) c
           USING (rung_order)),
th AS (SELECT CAST(dow AS INTEGER) AS dow, rung, low, high FROM cuts
       WHERE rung_order = (SELECT min(rung_order) FROM ladder WHERE viable))"""


def label_sql(future: int = 0, events: str = EVENTS_SQL) -> str:
    """Adds ``lab``: split, eligibility and label of every cell."""
    return f"""{split_sql(future, events=events)},{THRESHOLD_SQL},
lab AS (SELECT sp.*, CAST(n > low AS INTEGER) + CAST(n > high AS INTEGER) AS label
        FROM sp JOIN th USING (dow))"""


# Gauss's Easter rule; holidays as (date, name) for every year between the bounds
HOLIDAY_SQL = """
gauss AS (SELECT y, y % 19 AS a, y % 4 AS b, y % 7 AS c,
                 (15 - (13 + 8 * (y // 100)) // 25 + y // 100 - y // 400) % 30 AS mm,
                 (4 + y // 100 - y // 400) % 7 AS nn FROM years),
moon AS (SELECT *, (19 * a + mm) % 30 AS dd FROM gauss),
paschal AS (SELECT *, (2 * b + 4 * c + 6 * dd + nn) % 7 AS ee FROM moon),
easters AS (SELECT CAST(y AS INTEGER) AS y,
                   make_date(y, 3, 22) + CAST(dd + ee - CASE WHEN (dd = 29 AND ee = 6)
                        OR (dd = 28 AND ee = 6 AND a > 10) THEN 7 ELSE 0 END AS INTEGER) AS easter
            FROM paschal),
hol AS (SELECT y, make_date(y, mo, da) AS holiday_date, holiday FROM easters,
             (VALUES (1, 1, 'Anio Nuevo'), (5, 1, 'Dia del Trabajo'), (5, 24, 'Batalla del Pichincha'),
                     (8, 10, 'Primer Grito de Independencia'), (10, 9, 'Independencia de Guayaquil'),
                     (11, 2, 'Dia de los Difuntos'), (11, 3, 'Independencia de Cuenca'), (12, 25, 'Navidad'))
             AS f(mo, da, holiday)
        UNION ALL
        SELECT y, easter + off, holiday FROM easters,
             (VALUES (-48, 'Carnaval (lunes)'), (-47, 'Carnaval (martes)'), (-2, 'Viernes Santo'))
             AS v(off, holiday))"""

FEATURE_SQL = """
years AS (SELECT unnest(range(year(origin), year(last_date) + 2)) AS y FROM m),""" + HOLIDAY_SQL + """,
wk AS (SELECT unit_id, week_idx, sum(n) AS wn FROM sp GROUP BY 1, 2),
dens AS (SELECT unit_id, week_idx,
                coalesce(sum(wn) OVER (PARTITION BY unit_id ORDER BY week_idx
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / greatest(week_idx, 1) AS density
         FROM wk),
ft AS (SELECT sp.*, CAST(sp.dow AS DOUBLE) AS dia_semana, CAST(sp.dow >= 5 AS DOUBLE) AS es_fin_de_semana,
              CAST(month(week_start + sp.dow) AS DOUBLE) AS mes,
              CAST(week_start + sp.dow IN (SELECT holiday_date FROM hol) AS DOUBLE) AS es_feriado,
              CAST(coalesce(lag(n, 1) OVER w, 0) AS DOUBLE) AS rezago_1,
              CAST(coalesce(lag(n, 2) OVER w, 0) AS DOUBLE) AS rezago_2,
              CAST(coalesce(lag(n, 3) OVER w, 0) AS DOUBLE) AS rezago_3,
              CAST(coalesce(lag(n, 4) OVER w, 0) AS DOUBLE) AS rezago_4,
              coalesce(avg(n) OVER (w ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0) AS media_movil_4,
              coalesce(avg(n) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 0) AS media_movil_12,
              density AS densidad_historica_nacion
       FROM sp JOIN dens USING (unit_id, week_idx)
       WINDOW w AS (PARTITION BY sp.unit_id, sp.dow ORDER BY sp.week_idx))"""

FEATURES = (
    "dia_semana", "es_fin_de_semana", "mes", "es_feriado", "rezago_1", "rezago_2", "rezago_3", "rezago_4",
    "media_movil_4", "media_movil_12", "densidad_historica_nacion",
)
