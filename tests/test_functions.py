import datetime
import unicodedata

from pyspark.sql import functions as F

from riskpanel.functions import calendar, text


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_normalise_matches_the_driver_rule(spark):
    values = [
        "Tránsito y  Movilidad", "  DURÁN\t", "ñandú", "Ünïcödé straße", "ﬁn ½ Ǆungla", "café", "ＦＵＬＬ　width",
        "a b c", "", "ª º µ", "plain",
    ]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    got = {r["v"]: r["n"] for r in rows.select("v", text.normalise(F.col("v")).alias("n")).collect()}
    for v in values:
        folded = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))
        assert got[v] == " ".join(folded.upper().split()) == text.fold(v)
    assert got[None] == ""


def test_numeric_unit_id(spark):
    rows = spark.createDataFrame([("90150.0",), (" 90150 ",), ("x1",), (None,)], "v string")
    got = [r["u"] for r in rows.select(text.numeric_unit_id(F.col("v")).alias("u")).collect()]
    assert got == ["90150", "90150", None, None]


def test_easter_known_dates_and_gauss_rule(spark):
    def gauss(y):
        a, b, c, k = y % 19, y % 4, y % 7, y // 100
        m = (15 - (13 + 8 * k) // 25 + k - k // 4) % 30
        n = (4 + k - k // 4) % 7
        d = (19 * a + m) % 30
        e = (2 * b + 4 * c + 6 * d + n) % 7
        late = (d == 29 and e == 6) or (d == 28 and e == 6 and a > 10)
        return datetime.date(y, 3, 22) + datetime.timedelta(d + e - (7 if late else 0))

    years = spark.range(1900, 2200).select(F.col("id").cast("int").alias("year"))
    got = {r["year"]: r["d"] for r in years.select("year", calendar.easter(F.col("year")).alias("d")).collect()}
    assert got == {y: gauss(y) for y in range(1900, 2200)}
    assert [got[y].isoformat() for y in range(2021, 2026)] == [
        "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20",
    ]


def test_holidays_of_a_year(spark):
    years = spark.createDataFrame([(2025,), (2025,)], "year int")
    dates = {r["holiday_date"].isoformat() for r in calendar.holidays(years).collect()}
    assert len(dates) == 11 and {"2025-03-03", "2025-03-04", "2025-04-18"} <= dates
    days = spark.sql("SELECT explode(sequence(DATE '2025-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS d")
    flagged = {r["d"].isoformat() for r in days.filter(calendar.is_holiday(F.col("d"))).collect()}
    assert flagged == dates


def test_week_arithmetic(spark):
    day = F.lit("2026-01-11").cast("date")  # a Sunday
    origin = F.lit("2026-01-05").cast("date")
    assert _one(spark, calendar.day_of_week(day)) == 6
    assert _one(spark, calendar.week_start(day)).isoformat() == "2026-01-05"
    assert _one(spark, calendar.week_index(day, origin)) == 0
    assert _one(spark, calendar.week_index(F.date_add(day, 1), origin)) == 1
    assert _one(spark, calendar.week_index(F.date_sub(origin, 1), origin)) == -1
    assert _one(spark, calendar.month_key(day)) == "2026-01"
    assert _one(spark, calendar.day_name(F.lit(6))) == "Domingo"


def test_numeric_unit_id_of_dirty_codes(spark):
    codes = ["1e30", "Infinity", "12d", "90150.7", "123456789012345678.0", "+7", " 5. ", "99999999999999999999"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, v string")
    got = {r["i"]: r["u"] for r in rows.select("i", text.numeric_unit_id(F.col("v")).alias("u")).collect()}
    assert [got[i] for i in range(len(codes))] == [None, None, None, None, "123456789012345678", "7", "5", None]


def test_two_digit_years(spark):
    from riskpanel.operators.cleaning import parse_date

    rows = spark.createDataFrame([(0, "5/1/26"), (1, "05/01/2026"), (2, "31/2/26"), (3, None)], "i int, v string")
    got = {r["i"]: str(r["d"]) for r in rows.select("i", parse_date(F.col("v")).alias("d")).collect()}
    assert got == {0: "2026-01-05", 1: "2026-01-05", 2: "None", 3: "None"}


def test_date_forms(spark):
    from riskpanel.operators.cleaning import parse_date

    forms = ["2026-01-05", "5-1-2026", "05/01/2026 13:45", "2026-01-05T13:45:10.5", "5/1/126", "1/5", "2026-13-05"]
    rows = spark.createDataFrame(list(enumerate(forms)), "i int, v string")
    got = {r["i"]: str(r["d"]) for r in rows.select("i", parse_date(F.col("v")).alias("d")).collect()}
    assert [got[i] for i in range(len(forms))] == ["2026-01-05"] * 4 + ["None"] * 3
