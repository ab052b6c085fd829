"""Calendar arithmetic as Column expressions: durations that keep ends of months, Allen's relations, month grids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DURATION = re.compile(r"(-)?P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?")
#: The same for columns.
DURATION = r"^(-)?P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"

RELATIONS = ["before", "after", "meets", "met_by", "overlaps", "overlapped_by", "starts", "started_by", "during", "contains", "finishes", "finished_by", "equals"]


def parts(duration: str | Column) -> tuple[Column, Column]:
    """(months, microseconds) of an ISO 8601 duration."""
    if isinstance(duration, str):
        m = _DURATION.fullmatch(duration)
        if not m or duration.strip("-") in ("P", "PT"):
            raise ValueError(f"no duration: {duration}")
        sign = -1 if m[1] else 1
        y, mo, d, h, mi = (int(x or 0) for x in m.groups()[1:6])
        micros = round(float(m[7] or 0) * 1e6) + 1_000_000 * (86400 * d + 3600 * h + 60 * mi)
        return F.lit(sign * (12 * y + mo)), F.lit(sign * micros).cast("long")
    got = lambda k: F.coalesce(F.expr("try_cast(null as double)") if k is None else F.nullif(F.regexp_extract(duration, DURATION, k), F.lit("")).cast("double"), F.lit(0.0))
    sign = F.when(duration.startswith("-"), -1).otherwise(1)
    months = (sign * (got(2) * 12 + got(3))).cast("int")
    micros = (sign * (got(4) * 86400 + got(5) * 3600 + got(6) * 60 + got(7)) * 1e6).cast("long")
    good = duration.rlike(DURATION)
    return F.when(good, months), F.when(good, micros)


def add_months(day: Column, n: Column) -> Column:
    """The end of a month goes to the end of a month."""
    moved = F.add_months(day, n)
    return F.when(n == 0, day).when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def shift(when: Column, duration: str | Column, sign: int = 1, has_time: bool = False) -> Column:
    """when plus (or minus) a duration; a date stays a date unless the column is a date-time."""
    months, micros = parts(duration)
    day = add_months(when.cast("date"), months * sign)
    if not has_time:
        return F.date_add(day, (F.floor(micros * sign / 86_400_000_000)).cast("int"))
    base = F.unix_micros(when.cast("timestamp")) - F.unix_micros(when.cast("date").cast("timestamp"))
    return F.timestamp_micros(F.unix_micros(day.cast("timestamp")) + base + micros * sign).cast("timestamp_ntz")


def between(start: Column, end: Column, has_time: bool = False) -> Column:
    """The duration from one to the other in days (and seconds)."""
    days = F.datediff(end, start)
    text = lambda d: F.concat(F.when(d < 0, F.lit("-P")).otherwise(F.lit("P")), F.abs(d).cast("string"), F.lit("D"))
    if not has_time:
        return text(days)
    s = F.floor((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1_000_000).cast("long")
    a = F.abs(s)
    return F.concat(
        F.when(s < 0, F.lit("-P")).otherwise(F.lit("P")), F.expr("''"),
        F.when((a >= 86400) | (a == 0), F.concat(F.floor(a / 86400).cast("string"), F.lit("D"))).otherwise(F.lit("")),
        F.when(a % 86400 > 0, F.concat(F.lit("T"), (a % 86400).cast("string"), F.lit("S"))).otherwise(F.lit("")),
    )


def allen(a: Column, b: Column, c: Column, d: Column) -> Column:
    """The relation of [a, b) to [c, d)."""
    return (
        F.when((a == c) & (b == d), "equals").when(b < c, "before").when(a > d, "after").when(b == c, "meets").when(a == d, "met_by")
        .when((a == c) & (b < d), "starts").when(a == c, "started_by").when((b == d) & (a > c), "finishes").when(b == d, "finished_by")
        .when((a > c) & (b < d), "during").when((a < c) & (b > d), "contains").when(a < c, "overlaps").otherwise("overlapped_by")
    )


def holds(relation: str, a: Column, b: Column, c: Column, d: Column) -> Column:
    """One relation as a plain predicate, so that joins see comparisons."""
    tests = {
        "before": b < c, "after": a > d, "meets": b == c, "met_by": a == d, "overlaps": (a < c) & (b > c) & (b < d), "overlapped_by": (c < a) & (d > a) & (d < b),
        "starts": (a == c) & (b < d), "started_by": (a == c) & (b > d), "during": (a > c) & (b < d), "contains": (a < c) & (b > d),
        "finishes": (b == d) & (a > c), "finished_by": (b == d) & (a < c), "equals": (a == c) & (b == d),
    }
    if relation not in tests:
        raise ValueError(f"no relation {relation}; there are {', '.join(RELATIONS)}")
    return tests[relation]


def month_start(ym: Column) -> Column:
    return F.to_date(F.concat(ym.cast("string"), F.lit("-01")))


def month_starts(start: Column, end: Column) -> Column:
    """An array of first days in [start, end)."""
    first = F.trunc(start, "MM")
    return F.when(start < end, F.filter(F.sequence(first, end, F.expr("interval 1 month")), lambda x: (x >= start) & (x < end))).otherwise(F.array().cast("array<date>"))


def month_ends(start: Column, end: Column) -> Column:
    first = F.trunc(start, "MM")
    return F.when(start < end, F.filter(F.transform(F.sequence(first, end, F.expr("interval 1 month")), lambda x: F.last_day(x)), lambda x: (x >= start) & (x < end))).otherwise(F.array().cast("array<date>"))


def year_months(start: str, end: str) -> list[str]:
    """Year-months from start to before end."""
    (a, b), (c, d) = (map(int, x.split("-")) for x in (start, end))
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(12 * a + b - 1, 12 * c + d - 1)]
