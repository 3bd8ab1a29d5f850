"""Panel counts, calendar, split and eligibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskpanel.functions import calendar
from riskpanel.operators import panel, split

from riskpanel.session import materialise

from .fixtures import (
    EVENTS_SQL,
    HOLIDAY_SQL,
    LATE_EVENTS_SQL,
    TRAIN_END,
    VAL_END,
    late_daily,
    nation_daily,
    nation_panel,
    panel_sql,
    r6,
    region_daily,
    split_panel,
    split_sql,
    table,
)

REGION_EVENTS_SQL = """
ev AS (SELECT CAST(n_regionkey AS VARCHAR) AS unit_id, CAST(o_orderdate AS DATE) AS d
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
LINEITEM_EVENTS_SQL = """
ev AS (SELECT l_returnflag || l_linestatus AS unit_id, CAST(l_shipdate AS DATE) AS d FROM lineitem)"""
EVENT_TYPE_EVENTS_SQL = """
ev AS (SELECT event_type AS unit_id, CAST(ts AS DATE) AS d FROM events)"""
PANEL_COLUMNS = "unit_id, dow, week_idx, week_start, n"


def lineitem_panel(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    daily = panel.daily_counts(items, F.concat("l_returnflag", "l_linestatus"), "l_shipdate")
    return panel.dense_panel(materialise(daily, "daily"))


def event_type_daily(spark, sf_dir):
    return materialise(panel.daily_counts(table(spark, sf_dir, "events"), "event_type", "ts"), "daily")


def panel_meta(spark, sf_dir):
    return panel.panel_meta(nation_daily(spark, sf_dir))


def panel_untrimmed(spark, sf_dir):
    daily = event_type_daily(spark, sf_dir)
    return panel.dense_panel(daily, panel.read_meta(daily, trim=False))


def panel_totals(spark, sf_dir):
    totals = panel.panel_totals(nation_panel(spark, sf_dir))
    return totals.withColumns({c: r6(F.col(c)) for c in ("mean_per_cell", "zero_pct")})


def empty_weeks(spark, sf_dir):
    """All orders of a quarter counted in its first month, so that weeks without events exist."""
    day = F.to_date("o_orderdate")
    first = F.make_date(F.year(day), F.quarter(day) * 3 - 2, F.least(F.dayofmonth(day), F.lit(28)))
    daily = panel.daily_counts(table(spark, sf_dir, "orders"), "o_orderpriority", first)
    return panel.empty_weeks(panel.dense_panel(materialise(daily, "daily")))


def unit_share(spark, sf_dir):
    shares = panel.unit_share(nation_panel(spark, sf_dir))
    return shares.withColumn("share", r6(F.col("share")))


def dominance(spark, sf_dir):
    return panel.dominance(lineitem_panel(spark, sf_dir)).withColumn("dominant_share", r6(F.col("dominant_share")))


def count_cdf(spark, sf_dir):
    return panel.count_cdf(nation_panel(spark, sf_dir)).withColumn("cumulative", r6(F.col("cumulative")))


def unit_attributes(spark, sf_dir):
    """Customer names by nation: the first one per unit, and its region as area."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    first = panel.unit_attributes(named, "c_nationkey", "c_name", "r_name", ("c_custkey",))
    # every unit of the panel, also one without attributes
    units = nation_daily(spark, sf_dir).select("unit_id").distinct()
    return units.join(first, "unit_id", "left").select(
        "unit_id", F.coalesce("name", "unit_id").alias("name"), F.coalesce("area", F.lit("")).alias("area")
    )


def calendar_features(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    d = F.col("day")
    return days.select(
        "day",
        calendar.day_of_week(d).alias("dow"),
        calendar.day_name(calendar.day_of_week(d)).alias("day_name"),
        calendar.week_start(d).alias("week_start"),
        calendar.month_key(d).alias("month_key"),
        F.month(d).alias("month"),
        (calendar.day_of_week(d) >= 5).alias("weekend"),
        calendar.is_holiday(d).alias("holiday"),
    )


def holidays(spark, sf_dir):
    """Orders placed on each holiday of the years the orders span."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.count("*").alias("orders"))
    )
    span = daily.agg(F.year(F.min("day")).alias("first"), F.year(F.max("day")).alias("last"))
    years = span.select(F.explode(F.sequence("first", "last")).alias("year"))
    dates = calendar.holidays(years)
    return dates.join(daily, dates["holiday_date"] == daily["day"], "left").select(
        "year", "holiday_date", "holiday", F.coalesce("orders", F.lit(0)).alias("orders")
    )


def easter(spark, sf_dir):
    """Easter Sunday of every year with orders, and the orders of that year."""
    years = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("orders"))
    )
    return years.select("year", calendar.easter(F.col("year")).alias("easter"), "orders")


def temporal_split(spark, sf_dir):
    cells = split_panel(spark, sf_dir, future_weeks=1)
    return cells.groupBy("week_idx", "week_start", "split").agg(F.count("*").alias("cells"))


def frozen_train_weeks(spark, sf_dir):
    """Weeks of the first 300 that stay training weeks, whatever is added later."""
    cells = split.frozen_train_weeks(nation_panel(spark, sf_dir, 1), 300, TRAIN_END)
    return cells.groupBy("week_idx", "split").agg(F.count("*").alias("cells"))


def training_rows(spark, sf_dir):
    """Eligible cells of the training and validation weeks, summed per unit."""
    rows = split.model_rows(split.with_eligibility(_late_cells(spark, sf_dir)), "train", "val")
    return rows.groupBy("unit_id", "split").agg(F.count("*").alias("cells"), F.sum("n").alias("events"))


def eligible_units(spark, sf_dir):
    """Nations with shipments in the training weeks; nation 3 appears only later."""
    return _late_pairs(spark, sf_dir, "unit").groupBy("unit_id").agg(F.max("eligible").alias("eligible"))


def eligible_unit_days(spark, sf_dir):
    return _late_pairs(spark, sf_dir, "unit_day")


def _late_pairs(spark, sf_dir, level):
    return split.eligible_pairs(_late_cells(spark, sf_dir), level)


def _late_cells(spark, sf_dir):
    return split.temporal_split(panel.dense_panel(late_daily(spark, sf_dir)), TRAIN_END, VAL_END)


QUERIES = {
    "panel_dense_counts": nation_panel,
    "panel_region_counts": lambda spark, sf: panel.dense_panel(region_daily(spark, sf)),
    "panel_lineitem_counts": lineitem_panel,
    "panel_untrimmed": panel_untrimmed,
    "panel_meta": panel_meta,
    "panel_totals": panel_totals,
    "empty_weeks": empty_weeks,
    "unit_share": unit_share,
    "dominance": dominance,
    "count_cdf": count_cdf,
    "events_by_dow": lambda spark, sf: panel.events_by_dow(nation_panel(spark, sf)),
    "top_units": lambda spark, sf: panel.top_units(nation_panel(spark, sf)),
    "weekly_series": lambda spark, sf: panel.weekly_series(nation_panel(spark, sf)),
    "distinct_months": lambda spark, sf: panel.months(nation_daily(spark, sf)),
    "unit_attributes": unit_attributes,
    "calendar_features": calendar_features,
    "holidays": holidays,
    "easter": easter,
    "temporal_split": temporal_split,
    "frozen_train_weeks": frozen_train_weeks,
    "training_rows": training_rows,
    "eligible_units": eligible_units,
    "eligible_unit_days": eligible_unit_days,
}

ORACLES = {
    "panel_dense_counts": f"WITH {panel_sql()} SELECT {PANEL_COLUMNS} FROM panel",
    "panel_region_counts": f"WITH {panel_sql(REGION_EVENTS_SQL)} SELECT {PANEL_COLUMNS} FROM panel",
    "panel_lineitem_counts": f"WITH {panel_sql(LINEITEM_EVENTS_SQL)} SELECT {PANEL_COLUMNS} FROM panel",
    "panel_untrimmed": f"""WITH {panel_sql(EVENT_TYPE_EVENTS_SQL, 5)},
        allw AS (SELECT unit_id, dow, week_idx, week_start, origin, last_date FROM panel CROSS JOIN m
                 WHERE week_idx <= date_diff('day', origin, last_date) // 7)
        SELECT a.unit_id, a.dow, a.week_idx, a.week_start, coalesce(c.n, 0) AS n
        FROM allw a LEFT JOIN counts c ON c.unit_id = a.unit_id AND c.d = a.week_start + a.dow""",
    "panel_meta": f"""WITH {panel_sql()}
        SELECT origin, last_date, (SELECT count(*) FROM ev) AS events, n_weeks,
               CAST(date_diff('day', origin, last_date) // 7 + 1 AS INTEGER) - n_weeks AS weeks_dropped FROM m""",
    "panel_totals": f"""WITH {panel_sql()}
        SELECT CAST(sum(n) AS BIGINT) AS events, count(*) AS cells, round(avg(n), 6) AS mean_per_cell,
               round(100 * avg(CAST(n = 0 AS INTEGER)), 6) AS zero_pct FROM panel""",
    "empty_weeks": """WITH ev AS (SELECT make_date(year(o_orderdate), 3 * quarter(o_orderdate) - 2,
                                                 least(day(o_orderdate), 28)) AS d FROM orders),
        b AS (SELECT CAST(date_trunc('week', min(d)) AS DATE) AS origin, max(d) AS last_date FROM ev),
        w AS (SELECT origin, CAST(unnest(range((date_diff('day', origin, last_date) + 1) // 7)) AS INTEGER)
                     AS week_idx FROM b)
        SELECT week_idx, origin + 7 * week_idx AS week_start FROM w
        WHERE NOT EXISTS (SELECT 1 FROM ev WHERE d >= origin + 7 * week_idx AND d < origin + 7 * week_idx + 7)""",
    "unit_share": f"""WITH {panel_sql()}, t AS (SELECT unit_id, CAST(sum(n) AS BIGINT) AS events
                                               FROM panel GROUP BY 1)
        SELECT unit_id, events, round(events / (SELECT sum(events) FROM t), 6) AS share,
               events / (SELECT sum(events) FROM t) >= 0.01 AS at_least_one_pct FROM t""",
    "dominance": f"""WITH {panel_sql(LINEITEM_EVENTS_SQL)}, t AS (SELECT unit_id, sum(n) AS e FROM panel GROUP BY 1),
        s AS (SELECT e / (SELECT sum(e) FROM t) AS share FROM t)
        SELECT round(max(share), 6) AS dominant_share, count(*) FILTER (share >= 0.01) AS units_at_least_one_pct,
               max(share) > 0.9 AS one_unit_dominates FROM s""",
    "count_cdf": f"""WITH {panel_sql()}, h AS (SELECT n, count(*) AS cells FROM panel GROUP BY 1)
        SELECT n, cells, round(sum(cells) OVER (ORDER BY n) / CAST(sum(cells) OVER () AS DOUBLE), 6) AS cumulative
        FROM h ORDER BY n LIMIT 8""",
    "events_by_dow": f"WITH {panel_sql()} SELECT dow, CAST(sum(n) AS BIGINT) AS events FROM panel GROUP BY 1",
    "top_units": f"""WITH {panel_sql()} SELECT unit_id, CAST(sum(n) AS BIGINT) AS events FROM panel
        GROUP BY 1 ORDER BY events DESC, unit_id LIMIT 8""",
    "weekly_series": f"""WITH {panel_sql()} SELECT week_idx, week_start, CAST(sum(n) AS BIGINT) AS events
        FROM panel GROUP BY 1, 2""",
    "distinct_months": f"WITH {EVENTS_SQL} SELECT DISTINCT strftime(d, '%Y-%m') AS month FROM ev",
    "unit_attributes": f"""WITH {EVENTS_SQL}
        SELECT u.unit_id, coalesce(arg_min(c_name, c_custkey), u.unit_id) AS name,
               coalesce(upper(min(r_name)), '') AS area
        FROM (SELECT DISTINCT unit_id FROM ev) u
        LEFT JOIN customer ON CAST(c_nationkey AS VARCHAR) = u.unit_id
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        GROUP BY u.unit_id""",
    "calendar_features": f"""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
        years AS (SELECT DISTINCT year(day) AS y FROM days), {HOLIDAY_SQL}
        SELECT day, CAST(isodow(day) - 1 AS INTEGER) AS dow,
               CASE isodow(day) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes' WHEN 3 THEN 'Miercoles'
                    WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sabado' ELSE 'Domingo' END AS day_name,
               CAST(date_trunc('week', day) AS DATE) AS week_start, strftime(day, '%Y-%m') AS month_key,
               CAST(month(day) AS INTEGER) AS month, isodow(day) >= 6 AS weekend,
               day IN (SELECT holiday_date FROM hol) AS holiday FROM days""",
    "holidays": f"""WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
        years AS (SELECT unnest(range(min(year(day)), max(year(day)) + 1)) AS y FROM daily), {HOLIDAY_SQL}
        SELECT y AS year, holiday_date, holiday, coalesce(orders, 0) AS orders
        FROM hol LEFT JOIN daily ON holiday_date = day""",
    "easter": f"""WITH c AS (SELECT year(o_orderdate) AS y, count(*) AS orders FROM orders GROUP BY 1),
        years AS (SELECT y FROM c), {HOLIDAY_SQL}
        SELECT easters.y AS year, easter, orders FROM easters JOIN c USING (y)""",
    "temporal_split": f"""WITH {split_sql(1)}
        SELECT week_idx, week_start, split, count(*) AS cells FROM sp GROUP BY 1, 2, 3""",
    "frozen_train_weeks": f"""WITH {panel_sql(future=1)}
        SELECT week_idx, CASE WHEN n IS NULL THEN 'future'
                              WHEN week_idx BETWEEN 12 AND 299 AND week_start <= DATE '{TRAIN_END}' THEN 'train'
                              ELSE 'later' END AS split, count(*) AS cells FROM panel GROUP BY 1, 2""",
    "training_rows": f"""WITH {split_sql(0, 'unit', LATE_EVENTS_SQL)}
        SELECT unit_id, split, count(*) AS cells, CAST(sum(n) AS BIGINT) AS events FROM sp
        WHERE eligible AND split IN ('train', 'val') GROUP BY 1, 2""",
    "eligible_units": f"WITH {split_sql(0, 'unit', LATE_EVENTS_SQL)} SELECT DISTINCT unit_id, eligible FROM sp",
    "eligible_unit_days": f"""WITH {split_sql(0, 'unit_day', LATE_EVENTS_SQL)}
        SELECT DISTINCT unit_id, dow, eligible FROM sp""",
}
