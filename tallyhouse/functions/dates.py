"""Calendar helpers; every job gets its reference date as a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "America/Sao_Paulo"

# Month names and their short forms.
MONTH_NAMES = [
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]
MONTH_SHORT = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]


def day(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def month_of(ts: Column, zone: str = "UTC") -> Column:
    """First day of the month, in the given zone."""
    return F.trunc(ts if zone == "UTC" else to_local(ts, zone), "MM")


def month_start(d: dt.date, back: int = 0) -> Column:
    """First day of the month `back` months before the one of `d`."""
    return F.add_months(F.trunc(day(d), "MM"), -back)


def month_key(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def month_label(month: Column) -> Column:
    """'jan/26'."""
    short = F.element_at(F.array(*[F.lit(m) for m in MONTH_SHORT]), F.month(month))
    return F.concat(short, F.lit("/"), F.date_format(month, "yy"))


def month_from_name(name: Column, year: Column) -> Column:
    """First day of a month given by its Portuguese name and a year."""
    from .text import light_normalise

    number = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), light_normalise(name))
    return F.when(number > 0, F.make_date(year, number.cast("int"), F.lit(1)))


def week_start(ts: Column) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", ts).cast("date")


def iso_week_key(ts: Column) -> Column:
    """'2025-W01' with the ISO year, so 2024-12-30 falls in 2025-W01."""
    year = F.extract(F.lit("YEAROFWEEK"), ts).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def next_business_day(d: Column) -> Column:
    """The day itself, or the Monday after a weekend day."""
    return F.date_add(d, F.when(F.dayofweek(d) == 7, 2).when(F.dayofweek(d) == 1, 1).otherwise(0))


def half_month_start(d: Column) -> Column:
    return F.when(F.day(d) <= 15, F.trunc(d, "MM")).otherwise(F.date_add(F.trunc(d, "MM"), 15))


def half_month_end(d: Column) -> Column:
    return F.when(F.day(d) <= 15, F.date_add(F.trunc(d, "MM"), 14)).otherwise(F.last_day(d))


def parse_day(c: Column) -> Column:
    """Date from ISO, dd/mm/yyyy, dd/mm/yy, a sheet serial or epoch milliseconds."""
    text = F.trim(c)
    number = text.try_cast("double")
    serial = F.when(number.between(1, 100_000), F.date_add(F.lit("1899-12-30").cast("date"), number.cast("int")))
    epoch = F.when(number > 100_000_000_000, F.timestamp_millis(number.cast("long")).cast("date"))

    def fmt(pattern: str, mask: str) -> Column:
        return F.when(text.rlike(pattern), F.try_to_timestamp(text, F.lit(mask)).cast("date"))

    return F.coalesce(
        fmt("^\\d{4}-\\d{2}-\\d{2}$", "yyyy-MM-dd"),
        F.when(text.rlike("^\\d{4}-\\d{2}-\\d{2}[T ]"), F.substring(text, 1, 10).try_cast("date")),
        fmt("^\\d{1,2}/\\d{1,2}/\\d{4}$", "d/M/yyyy"),
        fmt("^\\d{1,2}/\\d{1,2}/\\d{2}$", "d/M/yy"),
        serial,
        epoch,
    )


def sheet_month(name: Column) -> Column:
    """Month in a sheet name written MM-YYYY, MMYYYY or MMYY."""
    long_month = F.regexp_extract(name, "(\\d{2})-?(\\d{4})", 1)
    long_year = F.regexp_extract(name, "(\\d{2})-?(\\d{4})", 2)
    month = F.coalesce(F.nullif(long_month, F.lit("")), F.regexp_extract(name, "(\\d{2})(\\d{2})", 1))
    year = F.coalesce(
        F.nullif(long_year, F.lit("")),
        F.concat(F.lit("20"), F.nullif(F.regexp_extract(name, "(\\d{2})(\\d{2})", 2), F.lit(""))),
    )
    return F.concat(year, F.lit("-"), month, F.lit("-01")).try_cast("date")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) / 1_000_000.0 - F.unix_micros(start) / 1_000_000.0


def in_months(ts: str, start: dt.date | None, end: dt.date | None) -> Column:
    """Half-open date window on a raw column, so it reaches the scan."""
    keep = F.lit(True)
    if start:
        keep = keep & (F.col(ts) >= F.lit(dt.datetime.combine(start, dt.time())))
    if end:
        keep = keep & (F.col(ts) < F.lit(dt.datetime.combine(end, dt.time())))
    return keep
