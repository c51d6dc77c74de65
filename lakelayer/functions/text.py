"""String cleansing and classification columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for equal results):
#   email shape: local part [a-zA-Z0-9._%+-]+, "@", domain [a-zA-Z0-9.-]+, ".", TLD [a-zA-Z]{2,}
#   duration buckets: below 150 -> "low", below 300 -> "medium", otherwise "high"
EMAIL_BODY = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
DURATION_LOW = 150
DURATION_HIGH = 300


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_name(c) -> Column:
    return F.upper(_col(c))


def hyphen_to_space(c) -> Column:
    """Every '-' becomes a space (not only the first)."""
    return F.regexp_replace(_col(c), "-", " ")


def duration_flag(c, low: int = DURATION_LOW, high: int = DURATION_HIGH) -> Column:
    """low / medium / high bucket. A NULL duration is not < anything, so it lands in "high"."""
    c = _col(c)
    return F.when(c < low, "low").when(c < high, "medium").otherwise("high")


def email_valid(c) -> Column:
    """Boolean email shape check; NULL input gives false.

    The anchor mirrors a Python ``re.match(...$)``: the end may be followed by one
    trailing ``\\n`` but nothing else (``\\z`` is the absolute end in Java regex).
    """
    return F.coalesce(_col(c).rlike(EMAIL_BODY + r"\n?\z"), F.lit(False))
