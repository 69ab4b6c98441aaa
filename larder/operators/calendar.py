"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: national holidays on fixed dates --------------------------------------------
# month | day | name
HOLIDAYS_TEXT = """
1  | 1  | New Year
1  | 26 | Australia Day
4  | 25 | Anzac Day
12 | 25 | Christmas Day
12 | 26 | Boxing Day
"""


def holidays() -> list[tuple[int, int, str]]:
    rows = (line.split("|") for line in HOLIDAYS_TEXT.strip().splitlines())
    return [(int(m), int(d), name.strip()) for m, d, name in rows]


def calendar_dim(span: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day of a one-row span (two date columns), both ends included."""
    names = " ".join(
        f"when month(day) = {m} and day(day) = {d} then '{name}'" for m, d, name in holidays()
    )
    days = span.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    return days.selectExpr(
        "day",
        "date_format(day, 'yyyyMMdd') as date_key",
        "year(day) as year",
        "quarter(day) as quarter",
        "month(day) as month",
        "weekofyear(day) as iso_week",
        "weekday(day) + 1 as iso_weekday",
        "weekday(day) >= 5 as is_weekend",
        f"case {names} end as holiday",
    )
