"""Lenient numbers: unreadable input takes a default instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import as_col, strip


def safe_int(c: Column | str, default: int | Column) -> Column:
    """Whole numbers only, as text or number; anything else takes the default."""
    t = strip(as_col(c).cast("string"))
    whole = F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("int"))
    return F.coalesce(whole, default if isinstance(default, Column) else F.lit(default))


def safe_num(c: Column | str, default: float = 0.0) -> Column:
    return F.coalesce(strip(as_col(c).cast("string")).try_cast("double"), F.lit(float(default)))


def clamp(c: Column, low: float | int, high: float | int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def ratio(part: Column, whole: Column, places: int | None = 3) -> Column:
    """``part / whole`` with zero for an empty whole."""
    value = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    return value if places is None else F.round(value, places)


def safe_bool(c: Column | str, default: bool) -> Column:
    t = F.lower(strip(as_col(c).cast("string")))
    return (
        F.when(t.isin("true", "1", "yes", "on"), F.lit(True))
        .when(t.isin("false", "0", "no", "off"), F.lit(False))
        .otherwise(F.lit(default))
    )
