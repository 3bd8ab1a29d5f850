"""Cleaning, CSV ingestion, profiling, batch validation and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskpanel.functions.calendar import month_key
from riskpanel.functions.text import normalise
from riskpanel.operators import cleaning, panel, profile, state, validation
from riskpanel.operators.cleaning import Scope
from riskpanel.session import fresh_path, materialise
from riskpanel.sources import csv_files, history

from .fixtures import EVENTS_SQL, FEATURE_SQL, FEATURES, LEVEL, nation_daily, panel_sql, r6, split_sql, table

EVENT_SCOPE = Scope(category="Click-through", area_level="canton", area="EVEN", unit_level="parroquia")


def event_incidents(spark, sf_dir):
    """The events table as raw incident rows: its type is the category, the parity of
    the user the area; every seventh value is a bad date, every eleventh a missing unit."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    text_date = F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day))
    return e.select(
        F.when(F.col("event_id") % 7 == 0, "31/02/2024").otherwise(text_date).alias("fecha"),
        F.lit(None).cast("string").alias("provincia"),
        F.when(F.col("user_id") % 2 == 0, "  Évèn ").otherwise("odd").alias("canton"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(
            F.concat(F.col("user_id").cast("string"), F.lit(".0"))
        ).alias("cod_parroquia"),
        F.lit(None).cast("string").alias("parroquia"),
        F.concat(F.lit("x "), F.col("event_type"), F.lit("-thru")).alias("servicio"),
        F.lit(None).cast("string").alias("subtipo"),
        F.col("event_type").alias("archivo"),
    )


def funnel_audit(spark, sf_dir):
    return cleaning.funnel(event_incidents(spark, sf_dir), EVENT_SCOPE)


def clean_events(spark, sf_dir):
    events = cleaning.clean_events(event_incidents(spark, sf_dir), EVENT_SCOPE)
    return events.groupBy("unit_id", "event_date").agg(F.count("*").alias("n"))


EVENT_CTE = """inc AS (SELECT *, CAST(ts AS DATE) AS d, 'x ' || event_type || '-thru' AS servicio FROM events),
fl AS (SELECT *, contains(upper(servicio), 'CLICK-T') AS c1, contains(upper(servicio), 'CLICK-T') AND user_id % 2 = 0
              AS c2 FROM inc),
f2 AS (SELECT *, c2 AND event_id % 7 <> 0 AS c3, c2 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AS c4 FROM fl)"""


def normalise_text(spark, sf_dir):
    """Whole document texts, normalised, as lengths and digests."""
    text = normalise(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(text).alias("chars"), F.md5(text.cast("binary")).alias("digest")
    )


# --- incidents written as messy CSV files and read back -------------------------


def incident_rows(spark, sf_dir):
    """Orders as incidents of their customer's nation; urgent and high ones are traffic."""
    o = table(spark, sf_dir, "orders")
    nations = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = o.join(nations, F.col("o_custkey") == F.col("c_custkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    day = F.to_date("o_orderdate")
    service = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Tránsito y Movilidad")
        .when(F.col("o_orderpriority") == "2-HIGH", " TRANSITO  y movilidad")
        .otherwise("Gestión Sanitaria")
    )
    return joined.select(
        F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)).alias("fecha"),
        F.initcap("r_name").alias("provincia"),
        F.col("n_name").alias("canton"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("cod"),
        F.concat(F.lit("Parroquia, n° "), F.col("c_nationkey").cast("string")).alias("parroquia"),
        service.alias("servicio"),
        F.col("o_orderpriority").alias("subtipo"),
        F.col("o_orderstatus"),
        F.col("o_orderkey"),
    )


def write_incident_files(spark, sf_dir, root):
    """Three dialects by order status: ';' UTF-8, ',' Latin-1 and '|' UTF-8 under other
    headers. The first also repeats its lines with a surplus field; those are dropped."""
    rows = incident_rows(spark, sf_dir)
    columns = ("fecha", "provincia", "canton", "cod", "parroquia", "servicio", "subtipo")
    plain = ("Fecha", "provincia", "Canton", "Cod_Parroquia", "Parroquia", "Servicio", "Subtipo")
    other = ("FECHA INCIDENTE", "DPA PROVINCIA", "Cantón", "COD PARR", "Nombre Parroquia", "Tipo", "Detalle")
    dialects = (("O", ";", "UTF-8", plain), ("F", ",", "ISO-8859-1", plain), ("P", "|", "UTF-8", other))
    for status, separator, encoding, header in dialects:
        part = rows.filter(F.col("o_orderstatus") == status)
        if separator == ";":
            # unquoted, so that a separator inside the last field makes the line too long
            part = part.unionByName(part.withColumn("subtipo", F.concat("subtipo", F.lit(";surplus"))))
        named = part.select(*[F.col(c).alias(h) for c, h in zip(columns, header)])
        writer = named.write.option("header", True).option("sep", separator).option("encoding", encoding)
        writer.option("escape", '"').option("quote", "" if separator == ";" else '"').csv(f"{root}/{status}")


CSV_SCOPE = Scope(category="TRANSITO", area_level="provincia", area="ASIA")


def _ingested(spark, sf_dir):
    root = fresh_path(spark, "csv")
    write_incident_files(spark, sf_dir, root)
    return csv_files.read_incidents(spark, root, CSV_SCOPE)


def csv_ingest(spark, sf_dir):
    events = cleaning.clean_events(_ingested(spark, sf_dir), CSV_SCOPE)
    month = month_key(F.col("event_date")).alias("month")
    return events.groupBy("unit_id", "parroquia", "canton", month).agg(F.count("*").alias("n"))


def csv_funnel(spark, sf_dir):
    return cleaning.funnel(_ingested(spark, sf_dir), CSV_SCOPE).drop("valid_files")


def csv_panel(spark, sf_dir):
    """CSV files to dense panel in one go."""
    events = cleaning.clean_events(_ingested(spark, sf_dir), CSV_SCOPE)
    return panel.dense_panel(materialise(panel.daily_counts(events, "unit_id", "event_date"), "daily"))


def csv_skipped_files(spark, sf_dir):
    """Delivered and open orders under headers that cannot be used; pending ones are read."""
    root = fresh_path(spark, "csv")
    rows = incident_rows(spark, sf_dir)
    columns = ("fecha", "provincia", "canton", "cod", "parroquia", "servicio", "subtipo")
    headers = (
        ("P", ";", ("Fecha", "provincia", "Canton", "Cod_Parroquia", "Parroquia", "Servicio", "Subtipo")),
        ("F", ",", ("Fecha", "provincia", "Canton", "Zona", "Parroquia", "Servicio", "Subtipo")),
        ("O", "~", ("Fecha", "provincia", "Canton", "Cod_Parroquia", "Parroquia", "Servicio", "Subtipo")),
    )
    for status, separator, header in headers:
        named = rows.filter(F.col("o_orderstatus") == status).select(*[F.col(c).alias(h) for c, h in zip(columns, header)])
        named.write.option("header", True).option("sep", separator).option("escape", '"').csv(f"{root}/{status}")
    skipped = csv_files.skipped_files(spark, root, CSV_SCOPE)
    return skipped.groupBy("reason").agg(F.sum("rows").alias("n"))


CSV_SKIPPED_SQL = """SELECT 'missing columns: cod_parroquia' AS reason, count(*)::BIGINT AS n FROM orders
        WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'no separator gives 5 columns', CAST(NULL AS BIGINT)"""


# --- profiles ---------------------------------------------------------------------


def profile_columns(spark, sf_dir):
    shares = profile.null_shares(event_incidents(spark, sf_dir))
    return shares.withColumn("null_pct", r6(F.col("null_pct")))


def profile_top_values(spark, sf_dir):
    return profile.top_values(event_incidents(spark, sf_dir), "servicio", "CLICK")


def profile_top_areas(spark, sf_dir):
    return profile.top_values(incident_rows(spark, sf_dir), "canton", "NATION_1", 10)


def profile_numbers(spark, sf_dir):
    rows = event_incidents(spark, sf_dir).withColumn("value_text", F.col("fecha"))
    found = profile.numeric_profile(rows, ["cod_parroquia", "canton", "value_text"])
    return found.withColumns({c: r6(F.col(c)) for c in ("null_pct", "zero_pct")})


def profile_folder(spark, sf_dir):
    """Every column of a folder of three dialects, by the folder a file lies in."""
    root = fresh_path(spark, "csv")
    write_incident_files(spark, sf_dir, root)
    status = F.regexp_extract("path", "/([^/]*)/[^/]*$", 1)
    found = csv_files.profile_folder(spark, root, status)
    top = F.transform("top", lambda t: F.concat_ws(":", t["value"], t["rows"].cast("string")))
    return found.withColumns({"null_pct": r6(F.col("null_pct")), "sample": F.concat_ws(";", "sample"), "top": F.array_join(top, ";")})


def _profile_sql():
    plain = ("Fecha", "provincia", "Canton", "Cod_Parroquia", "Parroquia", "Servicio", "Subtipo")
    other = ("FECHA INCIDENTE", "DPA PROVINCIA", "Cantón", "COD PARR", "Nombre Parroquia", "Tipo", "Detalle")
    values = ("day(d) || '/' || month(d) || '/' || year(d)", "replace(upper(r_name[1]) || lower(r_name[2:]), ' east', ' East')", "n_name", "c_nationkey || '.0'",
              "'Parroquia, n° ' || c_nationkey", "service", "o_orderpriority")
    cells = " UNION ALL ".join(
        f"SELECT o_orderstatus AS source, CASE o_orderstatus WHEN 'P' THEN '{b}' ELSE '{a}' END AS col, {v} AS v FROM inc"
        for a, b, v in zip(plain, other, values)
    )
    ranked = "col IN ('Canton', 'Cantón', 'Servicio', 'Subtipo', 'Tipo', 'FECHA INCIDENTE')"
    return f"""WITH inc AS (SELECT *, CAST(o_orderdate AS DATE) AS d,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'Tránsito y Movilidad' WHEN '2-HIGH' THEN 'TRANSITO  y movilidad'
                 ELSE 'Gestión Sanitaria' END AS service
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        counts AS (SELECT source, col, v, count(*) AS n FROM ({cells}) GROUP BY 1, 2, 3),
        smp AS (SELECT *, row_number() OVER (PARTITION BY source, col ORDER BY md5(v), v) AS nth FROM counts),
        nrm AS (SELECT source, col, trim(regexp_replace(upper(strip_accents(v)), '\\s+', ' ', 'g')) AS v, sum(n) AS n
                FROM counts WHERE {ranked} GROUP BY 1, 2, 3),
        top AS (SELECT source, col, string_agg(v || ':' || n, ';' ORDER BY n DESC, v) AS top FROM (
                SELECT *, row_number() OVER (PARTITION BY source, col ORDER BY n DESC, v) AS nth FROM nrm) WHERE nth <= 12 GROUP BY 1, 2)
        SELECT source, CASE source WHEN 'O' THEN ';' WHEN 'F' THEN ',' ELSE '|' END AS separator,
               CASE source WHEN 'F' THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding, col AS "column",
               CAST(sum(n) AS BIGINT) AS "rows", CAST(0 AS DOUBLE) AS null_pct, count(*) AS distinct_values,
               string_agg(v, ';' ORDER BY nth) FILTER (nth <= 3) AS sample,
               CAST(NULL AS DOUBLE) AS "min", CAST(NULL AS DOUBLE) AS "max", CAST(NULL AS DOUBLE) AS zero_pct, max(top) AS top
        FROM smp LEFT JOIN top USING (source, col) GROUP BY source, col"""


# --- batches against the history --------------------------------------------------

HISTORY_END = "2000-06-30"


def _between(daily, first, last):
    return daily.filter(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


# name, first day, last day, today, unit whose code the catalogue does not know, strict
SCENARIOS = (
    ("new month", "2000-07-01", "2000-07-31", "2001-01-01", None, False),
    ("loaded month", "2000-06-01", "2000-06-30", "2001-01-01", None, False),
    ("overlap", "2000-06-01", "2000-07-31", "2001-01-01", None, False),
    ("overlap, strict", "2000-06-01", "2000-07-31", "2001-01-01", None, True),
    ("future", "2000-07-01", "2000-07-31", "2000-07-15", None, False),
    ("unknown unit", "2000-07-01", "2000-07-31", "2001-01-01", "3", False),
    ("partial", "2000-08-01", "2000-08-10", "2001-01-01", None, False),
    ("empty", "2050-01-01", "2050-01-31", "2001-01-01", None, False),
)


def _catalogue(spark, sf_dir, without=None):
    units = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("unit_id"))
    return units if without is None else units.filter(F.col("unit_id") != without)


def batch_verdict(spark, sf_dir):
    """All scenarios judged at once; what each one's sender has to mend."""
    daily = nation_daily(spark, sf_dir)
    loaded = panel.months(_between(daily, "1900-01-01", HISTORY_END))
    columns = ("batch", "first", "last", "today", "without", "strict")
    rows = spark.createDataFrame(SCENARIOS, ", ".join(f"{c} {'boolean' if c == 'strict' else 'string'}" for c in columns))
    dates = {c: F.col(c).cast("date") for c in ("first", "last", "today")}
    scenarios = rows.withColumns(dates)
    # every day belongs to the few scenarios that span it
    batches = daily.join(F.broadcast(scenarios), F.col("event_date").between(F.col("first"), F.col("last")))
    renamed = F.when(F.col("unit_id") == F.col("without"), F.concat(F.lit("new "), "unit_id")).otherwise(F.col("unit_id"))
    batches = batches.select("batch", renamed.alias("unit_id"), "event_date", "n")
    judged = validation.judge_batches(batches, _catalogue(spark, sf_dir), loaded, scenarios.select("batch", "today", "strict"))
    lists = {c: F.concat_ws(",", c) for c in ("unit_ids", "month_names", "loaded_names")}
    return judged.withColumns(lists).drop("today", "strict")


def month_overlap(spark, sf_dir):
    daily = nation_daily(spark, sf_dir)
    loaded = panel.months(_between(daily, "1900-01-01", HISTORY_END))
    return validation.month_overlap(_between(daily, "2000-03-15", "2000-10-15"), loaded)


def unknown_units(spark, sf_dir):
    """Nations with orders whose suppliers' balances are below average on the whole."""
    balance = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("mean"))
    units = balance.filter(F.col("mean") > 4500).select(F.col("s_nationkey").cast("string").alias("unit_id"))
    return validation.unknown_units(nation_daily(spark, sf_dir), units)


def _order_events(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.to_date("o_orderdate").alias("event_date"),
        F.col("c_nationkey").cast("string").alias("unit_id"),
        F.lit(None).cast("string").alias("parroquia"),
        F.col("o_orderstatus").alias("canton"),
        F.col("o_orderpriority").alias("archivo"),
    )


def history_append(spark, sf_dir):
    """Seed history, then a batch written twice under one name: it counts once."""
    path = fresh_path(spark, "history")
    events = _order_events(spark, sf_dir)
    history.write_batch(_between(events, "1900-01-01", HISTORY_END), path, "seed")
    later = events.filter(F.col("event_date") > F.lit(HISTORY_END).cast("date"))
    history.write_batch(later, path, "later")
    history.write_batch(later, path, "later")
    return history.read_history(spark, path).groupBy("month", "batch").agg(F.count("*").alias("n"))


def batch_resent(spark, sf_dir):
    """A batch sent again with other months takes the place of all it held; a third sending that
    stops before the ledger names it changes nothing. Events and daily counts per month and batch."""
    path = fresh_path(spark, "history")
    events = _order_events(spark, sf_dir)
    later = events.filter(F.col("event_date") > F.lit(HISTORY_END).cast("date"))
    history.write_batch(_between(events, "1900-01-01", HISTORY_END), path, "seed")
    history.write_batch(later, path, "later")
    history.write_batch(later.filter(F.month("event_date") % 2 == 0), path, "later")
    # folders of a version that no ledger file names
    history._write(history.history_columns(later), f"{path}/events", "later", "stopped")
    counted = history.read_history(spark, path).groupBy("month", "batch").agg(F.count("*").alias("events"))
    daily = history.read_daily(spark, path).groupBy("month", "batch").agg(F.sum("n").alias("daily"))
    return counted.join(daily, ["month", "batch"], "full")


STATE_CUTS = ("1994-06-17", "1997-01-31", "1999-12-31", "2000-07-15")


def scoring_state(spark, sf_dir):
    """The features of the coming week from a state that five batches advanced one after the other."""
    daily = nation_daily(spark, sf_dir)
    bounds = ("1900-01-01", *STATE_CUTS, "2100-01-01")
    carried = state.empty_state(daily, panel.read_meta(daily).origin)
    for first, last in zip(bounds[:-1], bounds[1:]):
        part = daily.filter((F.col("event_date") > F.lit(first).cast("date")) & (F.col("event_date") <= F.lit(last).cast("date")))
        carried = state.written(state.advanced(carried, part))
    rows = state.next_week_features(carried, LEVEL)
    return rows.withColumns({c: r6(F.col(c)) for c in FEATURES if c.startswith(("media", "densidad"))})


def history_daily(spark, sf_dir):
    """The daily counts kept next to the events, with the months they cover."""
    path = fresh_path(spark, "history")
    history.write_batch(_order_events(spark, sf_dir), path, "all")
    return history.read_daily(spark, path).select("unit_id", "event_date", "n", "month")


def history_union(spark, sf_dir):
    """History plus batch without de-duplication."""
    events = _order_events(spark, sf_dir)
    both = history.append(events, _between(events, "2000-07-01", "2000-07-31"))
    return both.groupBy("unit_id", "canton").agg(F.count("*").alias("n"))


def frozen_panel(spark, sf_dir):
    """Rebuilt against a frozen origin and catalogue: later weeks only extend it."""
    daily = nation_daily(spark, sf_dir)
    units = _catalogue(spark, sf_dir, "3")
    known = validation.drop_unknown_units(daily, units)
    return panel.dense_panel(known, panel.read_meta(known, origin="1994-12-05"), units=units)


def before_origin(spark, sf_dir):
    return panel.before_origin(nation_daily(spark, sf_dir), "1996-01-01")


QUERIES = {
    "normalise_text": normalise_text,
    "funnel_audit": funnel_audit,
    "clean_events": clean_events,
    "csv_ingest": csv_ingest,
    "csv_funnel": csv_funnel,
    "csv_panel": csv_panel,
    "csv_skipped_files": csv_skipped_files,
    "profile_columns": profile_columns,
    "profile_top_values": profile_top_values,
    "profile_top_areas": profile_top_areas,
    "profile_numbers": profile_numbers,
    "profile_folder": profile_folder,
    "batch_verdict": batch_verdict,
    "month_overlap": month_overlap,
    "unknown_units": unknown_units,
    "history_append": history_append,
    "batch_resent": batch_resent,
    "scoring_state": scoring_state,
    "history_daily": history_daily,
    "history_union": history_union,
    "frozen_panel": frozen_panel,
    "before_origin": before_origin,
}

ORDER_CTE = """oe AS (SELECT CAST(c_nationkey AS VARCHAR) AS unit_id, CAST(o_orderdate AS DATE) AS d, orders.*
       FROM orders JOIN customer ON o_custkey = c_custkey)"""

ASIA_CTE = """ai AS (SELECT CAST(c_nationkey AS VARCHAR) AS unit_id, n_name, CAST(o_orderdate AS DATE) AS d
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND r_name = 'ASIA')"""


def _verdict_sql(name, first, last, today, without, strict):
    loaded = "months_loaded > 0" if strict else "months_loaded > 0 AND months_loaded = months"
    month = "strftime(d, '%Y-%m')"
    names = lambda c, where="": f"coalesce(string_agg(DISTINCT {c}, ',' ORDER BY {c}){where}, '')"
    return f"""SELECT *, reason IS NULL AS accepted, reason IS NULL AND days < 25 AS partial_month,
        CASE reason WHEN 'empty' THEN 'no record is left in scope'
            WHEN 'future dates' THEN future_records || ' record(s) after {today}' WHEN 'unknown units' THEN replace(unit_ids, ',', ', ')
            WHEN 'months already loaded' THEN replace(loaded_names, ',', ', ') END AS detail FROM (
        SELECT *, CASE WHEN records = 0 THEN 'empty' WHEN future_records > 0 THEN 'future dates'
                       WHEN unknown_units > 0 THEN 'unknown units'
                       WHEN {loaded} THEN 'months already loaded' END AS reason FROM (
        SELECT '{name}' AS batch, count(*) AS records,
               count(*) FILTER (d > DATE '{today}') AS future_records, count(DISTINCT d) AS days,
               count(DISTINCT u) FILTER (u LIKE 'new %') AS unknown_units, count(DISTINCT {month}) AS months,
               count(DISTINCT {month}) FILTER (old) AS months_loaded,
               {names("u", " FILTER (u LIKE 'new %')")} AS unit_ids, {names(month)} AS month_names,
               {names(month, " FILTER (old)")} AS loaded_names
        FROM (SELECT d, CASE WHEN unit_id = '{without or ""}' THEN 'new ' || unit_id ELSE unit_id END AS u,
                     strftime(d, '%Y-%m') IN (SELECT strftime(d, '%Y-%m') FROM oe WHERE d <= DATE '{HISTORY_END}') AS old
              FROM oe WHERE d BETWEEN DATE '{first}' AND DATE '{last}')))"""


ORACLES = {
    "normalise_text": r"""WITH t AS (SELECT doc_id,
            trim(regexp_replace(upper(replace(strip_accents(text), 'ß', 'ss')), '\s+', ' ', 'g')) AS v FROM documents)
        SELECT doc_id, CAST(length(v) AS INTEGER) AS chars, md5(v) AS digest FROM t""",
    "funnel_audit": f"""WITH {EVENT_CTE}, s AS (SELECT count(*) AS raw, count(*) FILTER (c1) AS after_category,
               count(*) FILTER (c2) AS after_area, count(*) FILTER (c3) AS after_date, count(*) FILTER (c4) AS valid,
               count(DISTINCT event_type) FILTER (c2) AS valid_files FROM f2)
        SELECT *, raw - after_category AS dropped_category, after_category - after_area AS dropped_area,
               after_area - after_date AS dropped_date, after_date - valid AS dropped_unit FROM s""",
    "clean_events": f"""WITH {EVENT_CTE} SELECT CAST(user_id AS VARCHAR) AS unit_id, d AS event_date, count(*) AS n
        FROM f2 WHERE c4 GROUP BY 1, 2""",
    "csv_ingest": f"""WITH {ASIA_CTE}
        SELECT unit_id, 'Parroquia, n° ' || unit_id AS parroquia, n_name AS canton, strftime(d, '%Y-%m') AS month,
               count(*) AS n FROM ai GROUP BY 1, 2, 3, 4""",
    "csv_funnel": f"""WITH {ASIA_CTE}, s AS (SELECT (SELECT count(*) FROM orders) AS raw,
            (SELECT count(*) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS after_category,
            (SELECT count(*) FROM ai) AS after_area, (SELECT count(*) FROM ai) AS after_date,
            (SELECT count(*) FROM ai) AS valid)
        SELECT *, raw - after_category AS dropped_category, after_category - after_area AS dropped_area,
               after_area - after_date AS dropped_date, after_date - valid AS dropped_unit FROM s""",
    "csv_skipped_files": CSV_SKIPPED_SQL,
    "csv_panel": "WITH "
    + panel_sql(ASIA_CTE + ",\nev AS (SELECT unit_id, d FROM ai)")
    + " SELECT unit_id, dow, week_idx, week_start, n FROM panel",
    "profile_columns": """SELECT col AS "column", CAST(p AS DOUBLE) AS null_pct FROM (VALUES
            ('fecha', 0), ('canton', 0), ('servicio', 0), ('archivo', 0),
            ('provincia', 100), ('parroquia', 100), ('subtipo', 100)) AS v(col, p)
        UNION ALL SELECT 'cod_parroquia', round(100 * avg(CAST(event_id % 11 = 0 AS INTEGER)), 6) FROM events""",
    "profile_top_values": """SELECT upper('x ' || event_type || '-thru') AS "value", count(*) AS "rows",
            contains(event_type, 'click') AS flagged FROM events GROUP BY event_type
        ORDER BY 2 DESC, 1 LIMIT 12""",
    "profile_top_areas": """SELECT upper(n_name) AS "value", count(*) AS "rows", contains(n_name, 'NATION_1') AS flagged
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name ORDER BY 2 DESC, 1 LIMIT 10""",
    "profile_numbers": """SELECT 'cod_parroquia' AS "column",
            CAST(min(user_id) FILTER (event_id % 11 <> 0) AS DOUBLE) AS "min",
            CAST(max(user_id) FILTER (event_id % 11 <> 0) AS DOUBLE) AS "max",
            round(100 * avg(CAST(event_id % 11 = 0 AS INTEGER)), 6) AS null_pct,
            round(100 * avg(CAST(event_id % 11 <> 0 AND user_id = 0 AS INTEGER)), 6) AS zero_pct FROM events""",
    "profile_folder": _profile_sql(),
    "batch_verdict": f"WITH {ORDER_CTE} " + " UNION ALL ".join(f"({_verdict_sql(*s)})" for s in SCENARIOS),
    "month_overlap": f"""WITH {ORDER_CTE} SELECT strftime(d, '%Y-%m') AS month,
            strftime(d, '%Y-%m') IN (SELECT strftime(d, '%Y-%m') FROM oe WHERE d <= DATE '{HISTORY_END}') AS loaded
        FROM oe WHERE d BETWEEN DATE '2000-03-15' AND DATE '2000-10-15' GROUP BY 1""",
    "unknown_units": f"""WITH {EVENTS_SQL} SELECT DISTINCT unit_id FROM ev
        WHERE unit_id NOT IN (SELECT CAST(s_nationkey AS VARCHAR) FROM supplier GROUP BY s_nationkey HAVING avg(s_acctbal) > 4500)""",
    "history_append": f"""WITH {ORDER_CTE} SELECT strftime(d, '%Y-%m') AS month,
            CASE WHEN d <= DATE '{HISTORY_END}' THEN 'seed' ELSE 'later' END AS batch, count(*) AS n
        FROM oe GROUP BY 1, 2""",
    "batch_resent": f"""WITH {ORDER_CTE} SELECT strftime(d, '%Y-%m') AS month,
            CASE WHEN d <= DATE '{HISTORY_END}' THEN 'seed' ELSE 'later' END AS batch, count(*) AS events, count(*) AS daily
        FROM oe WHERE d <= DATE '{HISTORY_END}' OR month(d) % 2 = 0 GROUP BY 1, 2""",
    "scoring_state": f"""WITH {split_sql(1)}, {FEATURE_SQL}
        SELECT unit_id, dow, week_idx, week_start, """
    + ", ".join(f"round({c}, 6) AS {c}" if c.startswith(("media", "densidad")) else c for c in FEATURES)
    + " FROM ft WHERE n IS NULL",
    "history_daily": f"""WITH {ORDER_CTE}
        SELECT unit_id, d AS event_date, count(*) AS n, strftime(d, '%Y-%m') AS month FROM oe GROUP BY 1, 2""",
    "history_union": f"""WITH {ORDER_CTE} SELECT unit_id, o_orderstatus AS canton,
            count(*) + count(*) FILTER (d BETWEEN DATE '2000-07-01' AND DATE '2000-07-31') AS n
        FROM oe GROUP BY 1, 2""",
    "frozen_panel": f"""WITH {EVENTS_SQL}, k AS (SELECT * FROM ev WHERE unit_id <> '3'),
        b AS (SELECT DATE '1994-12-05' AS origin, max(d) AS last_date FROM k),
        g AS (SELECT CAST(n_nationkey AS VARCHAR) AS unit_id, CAST(dow AS INTEGER) AS dow,
                     CAST(unnest(range((date_diff('day', origin, last_date) + 1) // 7)) AS INTEGER) AS week_idx, origin
              FROM nation, (SELECT unnest(range(7)) AS dow), b WHERE n_nationkey <> 3),
        c AS (SELECT unit_id, d, count(*) AS n FROM k GROUP BY 1, 2)
        SELECT g.unit_id, dow, week_idx, origin + 7 * week_idx AS week_start, coalesce(n, 0) AS n
        FROM g LEFT JOIN c ON c.unit_id = g.unit_id AND c.d = origin + (7 * week_idx + dow)""",
    "before_origin": f"""WITH {EVENTS_SQL}
        SELECT count(*) FILTER (d < DATE '1996-01-01') AS events_before_origin FROM ev""",
}
