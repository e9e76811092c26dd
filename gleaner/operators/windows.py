"""Which articles fall in the run's time window. Pure row predicates: they push into the scan and never shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D


def since(published_utc: Column, as_of: Column, lookback_hours: int = K.LOOKBACK_HOURS) -> Column:
    """At or after the look-back start; no upper bound."""
    return published_utc >= as_of - F.expr(f"INTERVAL '{lookback_hours}' HOUR")


def rolling_half_open(published_utc: Column, as_of: Column, lookback_hours: Column) -> Column:
    return (published_utc >= as_of - D.hours(lookback_hours)) & (published_utc < as_of)


def rolling_closed(published_utc: Column, as_of: Column, lookback_hours: Column) -> Column:
    return (published_utc >= as_of - D.hours(lookback_hours)) & (published_utc <= as_of)


def _today_or_yesterday(article_date: Column, run_date: Column) -> Column:
    return article_date.between(F.date_sub(run_date, 1), run_date)


def calendar_home(article_date: Column, as_of: Column) -> Column:
    """The article's date is the run's date in the home zone, or the day before."""
    return _today_or_yesterday(article_date, D.to_zone(as_of, K.HOME_TZ).cast("date"))


def calendar_zone(published_utc: Column, as_of: Column, tz: Column) -> Column:
    """Both dates in the site's own zone."""
    return _today_or_yesterday(D.to_zone(published_utc, tz).cast("date"), D.to_zone(as_of, tz).cast("date"))


def decide(
    df: DataFrame,
    as_of: Column,
    published_utc: str = "published_utc",
    parsed_date: str = "parsed_date",
    mode: str = "target_date_mode",
    lookback_hours: str = "lookback_hours",
    tz: str = "date_timezone",
) -> DataFrame:
    """Add ``decision``: accepted, out_of_window, target_date_mismatch or extraction_failed."""
    ts = F.col(published_utc)
    article_date = F.coalesce(F.col(parsed_date).try_cast("date"), D.to_zone(ts, F.col(tz)).cast("date"))
    decision = (
        F.when(ts.isNull(), F.lit("extraction_failed"))
        .when(
            F.col(mode) == "calendar_day",
            F.when(calendar_home(article_date, as_of), F.lit("accepted")).otherwise(F.lit("target_date_mismatch")),
        )
        .when(rolling_half_open(ts, as_of, F.col(lookback_hours)), F.lit("accepted"))
        .otherwise(F.lit("out_of_window"))
    )
    return df.withColumn("decision", decision)


def in_site_window(published_utc: Column, as_of: Column, mode: Column, lookback_hours: Column, tz: Column) -> Column:
    return F.when(mode == "calendar_day", calendar_zone(published_utc, as_of, tz)).otherwise(
        rolling_closed(published_utc, as_of, lookback_hours)
    )
