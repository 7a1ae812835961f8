"""Batch scope: a list of ``YYYY-MM`` months and what it implies.

These are argument checks and predicate builders; nothing here touches data.
The month list is small (one entry per month processed), so it stays on the
driver and becomes a partition predicate or a pair of date literals.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted month format, four-digit year and month 01 to 12.
MONTH_PATTERN = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def validate_months(months) -> list[str]:
    """The distinct months of a batch in the order given.

    ``ValueError`` lists what is not a ``YYYY-MM`` month.
    """
    seen: dict[str, None] = {}
    refused = []
    for item in months:
        if isinstance(item, str) and MONTH_PATTERN.fullmatch(item):
            seen.setdefault(item)
        else:
            refused.append(repr(item))
    if refused:
        raise ValueError(f"not a month written YYYY-MM: {', '.join(refused)}")
    return list(seen)


def parse_months(text: str) -> list[str]:
    """Split a comma-separated argument, trim items, validate."""
    return validate_months([p.strip() for p in text.split(",") if p.strip()])


def month_tuple(month: str) -> tuple[int, int]:
    year, mon = month.split("-")
    return int(year), int(mon)


def first_day_after(year: int, month: int) -> dt.date:
    """First day of the month after (year, month); December rolls the year."""
    return dt.date(year + 1, 1, 1) if month == 12 else dt.date(year, month + 1, 1)


def month_bounds(months) -> tuple[dt.date, dt.date]:
    """Half-open ``[first day of min month, first day after max month)``.

    Gaps inside the list are not excluded: ``[2023-01, 2023-05]`` covers
    January to May. Use ``month_set_predicate`` for the exact month set.
    """
    items = validate_months(months)
    if not items:
        raise ValueError("at least one month is required")
    lo_y, lo_m = month_tuple(min(items))
    hi_y, hi_m = month_tuple(max(items))
    return dt.date(lo_y, lo_m, 1), first_day_after(hi_y, hi_m)


def month_bounds_text(months) -> tuple[str, str]:
    lo, hi = month_bounds(months)
    return lo.isoformat(), hi.isoformat()


def default_months(today: dt.date | None = None, lag: int = 2) -> list[str]:
    """Default scope when none is given: the month ``lag`` months back."""
    today = today or dt.date.today()
    index = today.year * 12 + (today.month - 1) - lag
    return [f"{index // 12:04d}-{index % 12 + 1:02d}"]


def month_set_predicate(months, year_col: str = "year", month_col: str = "month") -> Column:
    """OR of ``(year = y AND month = m)`` pairs.

    On a table partitioned by (year, month) this lands in ``PartitionFilters``
    so only the requested partitions are listed and read.
    """
    items = validate_months(months)
    if not items:
        raise ValueError("at least one month is required")
    pairs = [(F.col(year_col) == y) & (F.col(month_col) == m)
             for y, m in (month_tuple(s) for s in items)]
    return reduce(or_, pairs)
