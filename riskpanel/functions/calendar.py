"""Week, month and public-holiday arithmetic on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names, Monday first.
DAY_NAMES = ("Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo")

# National holidays on a fixed month and day.
FIXED_HOLIDAYS = (
    (1, 1, "Anio Nuevo"),
    (5, 1, "Dia del Trabajo"),
    (5, 24, "Batalla del Pichincha"),
    (8, 10, "Primer Grito de Independencia"),
    (10, 9, "Independencia de Guayaquil"),
    (11, 2, "Dia de los Difuntos"),
    (11, 3, "Independencia de Cuenca"),
    (12, 25, "Navidad"),
)

# Holidays at a distance in days from Easter Sunday.
MOVABLE_HOLIDAYS = (
    (-48, "Carnaval (lunes)"),
    (-47, "Carnaval (martes)"),
    (-2, "Viernes Santo"),
)


def day_of_week(date: Column) -> Column:
    """Monday 0 .. Sunday 6."""
    return F.weekday(date)


def week_start(date: Column) -> Column:
    """The Monday on or before ``date``."""
    return F.date_sub(date, F.weekday(date))


def week_index(date: Column, origin: Column) -> Column:
    """Whole weeks from ``origin`` (a Monday); negative before it."""
    return F.floor(F.datediff(date, origin) / 7).cast("int")


def month_key(date: Column) -> Column:
    """Calendar month as ``yyyy-MM``."""
    return F.date_format(date, "yyyy-MM")


def day_name(dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), dow + 1)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (Oudin's 1940 integer formula)."""
    century = _div(year, 100)
    golden = F.pmod(year, F.lit(19))
    epact = F.pmod(
        century - _div(century, 4) - _div(century - _div(century - 17, 25), 3) + golden * 19 + 15,
        F.lit(30),
    )
    # the two late corrections of the paschal full moon
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    moon = epact - late.cast("int")
    weekday = F.pmod(year + _div(year, 4) + moon + 2 - century + _div(century, 4), F.lit(7))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), moon - weekday)


def is_holiday(date: Column) -> Column:
    """True on the exact date of a national holiday; no lookup table needed."""
    month_day = F.month(date) * 100 + F.dayofmonth(date)
    fixed = month_day.isin([m * 100 + d for m, d, _ in FIXED_HOLIDAYS])
    to_easter = F.datediff(date, easter(F.year(date)))
    return fixed | to_easter.isin([offset for offset, _ in MOVABLE_HOLIDAYS])


def holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """Eleven rows ``(year, holiday_date, holiday)`` for each distinct year."""
    y = F.col(year)
    entries = [
        F.struct(F.make_date(y, F.lit(m), F.lit(d)).alias("holiday_date"), F.lit(name).alias("holiday"))
        for m, d, name in FIXED_HOLIDAYS
    ] + [
        F.struct(F.date_add(easter(y), offset).alias("holiday_date"), F.lit(name).alias("holiday"))
        for offset, name in MOVABLE_HOLIDAYS
    ]
    return (
        years.select(y.cast("int").alias("year"))
        .distinct()
        .select("year", F.explode(F.array(*entries)).alias("entry"))
        .select("year", "entry.holiday_date", "entry.holiday")
    )
