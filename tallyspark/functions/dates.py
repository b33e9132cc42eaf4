"""Date helpers: sargable ranges and month arithmetic with an explicit as-of date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed as-of date for tenure so results are reproducible (never current_date()).
DEFAULT_AS_OF = "2026-06-28"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def year_range(c, year: int) -> Column:
    """``year(c) = year`` written as a half-open range, so it pushes down to the scan."""
    lo = F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")
    hi = F.lit(dt.datetime(year + 1, 1, 1)).cast("timestamp_ntz")
    return (_c(c) >= lo) & (_c(c) < hi)


def ts_literal(value: str) -> Column:
    return F.lit(dt.datetime.fromisoformat(value)).cast("timestamp_ntz")


def tenure_months(join_date, as_of: str = DEFAULT_AS_OF) -> Column:
    """Whole months between ``join_date`` and ``as_of`` (months_between rounded half-up)."""
    return F.round(F.months_between(F.lit(as_of).cast("date"), _c(join_date)), 0).cast("int")
