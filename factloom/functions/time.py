"""Partial dates as intervals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: First month and number of months of a part of the year, and hours of a part of the day.
SEASONS = {"SP": (3, 3), "SU": (6, 3), "FA": (9, 3)}
DAY_PARTS = {"TMO": (6, 12), "TAF": (12, 18), "TEV": (18, 21), "TNI": (21, 24)}


def _stamp(year: Column, month: Column, day: Column) -> Column:
    return F.make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))


def _plus(t: Column, **parts: int) -> Column:
    return t + F.make_interval(**{k: F.lit(v) for k, v in parts.items()})


def normalise(value: Column) -> Column:
    """STRUCT<start, end> (both TIMESTAMP_NTZ, end inclusive to the second) of a partial date; null if it can't be read.

    Forms: YYYY, YYYY-MM, YYYY-MM-DD, YYYY-Wnn (ISO week), YYYY-Qn, YYYY-Hn, YYYY-SP/SU/FA/WI, and a day with TMO, TAF, TEV or
    TNI. The year must be 1000 to 2100. Winter is December to the 28th of February. References like PAST_REF have no interval.
    """
    year = F.try_to_number(F.nullif(F.regexp_extract(value, "^([0-9]{4})", 1), F.lit("")), F.lit("9999")).cast("int")
    ok = year.between(1000, 2100)

    def span(pattern: str, start: Column, end: Column) -> tuple[Column, Column]:
        return ok & value.rlike(pattern), F.struct(start.alias("start"), (end - F.expr("INTERVAL 1 SECOND")).alias("end"))

    def part(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, group), F.lit("")).cast("int")

    one = F.lit(1)
    jan = _stamp(year, one, one)
    month = part("^[0-9]{4}-([0-9]{2})")
    first = F.when(month.between(1, 12), _stamp(year, month, one))
    day_no = part("^[0-9]{4}-[0-9]{2}-([0-9]{2})")
    day = F.when((day_no >= 1) & (day_no <= F.dayofmonth(F.last_day(first))), _stamp(year, month, day_no))
    quarter, half, week = part("-Q([1-4])$"), part("-H([12])$"), part("-W([0-9]{1,2})$")
    q_start, h_start = _stamp(year, quarter * 3 - 2, one), _stamp(year, half * 6 - 5, one)
    fourth = _stamp(year, one, F.lit(4))
    monday = fourth - F.make_interval(days=F.weekday(fourth))
    w_start = F.when(week.between(1, 53), monday + F.make_interval(days=(week - 1) * 7))
    cases = [
        span("^[0-9]{4}$", jan, _plus(jan, years=1)),
        span("^[0-9]{4}-[0-9]{2}$", first, _plus(first, months=1)),
        span("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", day, _plus(day, days=1)),
        span("^[0-9]{4}-Q[1-4]$", q_start, _plus(q_start, months=3)),
        span("^[0-9]{4}-H[12]$", h_start, _plus(h_start, months=6)),
        span("^[0-9]{4}-W[0-9]{1,2}$", w_start, _plus(w_start, days=7)),
        span("^[0-9]{4}-WI$", _stamp(year, F.lit(12), one), _plus(_stamp(year + 1, F.lit(2), F.lit(28)), days=1)),
    ]
    for code, (m, n) in SEASONS.items():
        start = _stamp(year, F.lit(m), one)
        cases.append(span(f"^[0-9]{{4}}-{code}$", start, _plus(start, months=n)))
    for code, (a, b) in DAY_PARTS.items():
        cases.append(span(f"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{code}$", _plus(day, hours=a), _plus(day, hours=b)))
    out = None
    for cond, value_ in cases:
        value_ = F.when(value_["start"].isNotNull(), value_)
        out = F.when(cond, value_) if out is None else out.when(cond, value_)
    return out


def month_of(value: Column) -> Column:
    """YYYY-MM of a date string that starts with it."""
    return F.nullif(F.regexp_extract(value, "^([0-9]{4}-[0-9]{2})", 1), F.lit(""))


def spans_over(start: Column, end: Column, days: int) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp")) > days * 86_400_000_000
