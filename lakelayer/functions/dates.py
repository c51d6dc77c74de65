"""Day arithmetic for half-open date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_sequence(start, end) -> Column:
    """Array of the days in ``[start, end)``; empty when start >= end."""
    s = F.to_date(start if not isinstance(start, str) else F.lit(start))
    e = F.to_date(end if not isinstance(end, str) else F.lit(end))
    return F.when(s < e, F.sequence(s, F.date_sub(e, 1))).otherwise(F.array().cast("array<date>"))
