"""Window rules over every event as a feed entry."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import AS_OF, MODES, ZONE_HOURS, ZONES, entries, pick, query, sql_pick
from gleaner.functions import dates as D
from gleaner.operators import windows as W

AT = f"TIMESTAMP '{AS_OF}'"

def now():
    return D.ntz(AS_OF)


def lookback():
    return F.col("k") + 1


def zone():
    return pick(F.col("user_id"), ZONES)


OFF = f"to_hours(list_extract({ZONE_HOURS}, CAST(user_id % 3 AS INTEGER) + 1))"


@query("window_main", f"WITH {{entries}} SELECT ord, published_utc FROM entries WHERE published_utc >= {AT} - INTERVAL 24 HOUR")
def window_main(spark, sf_dir):
    return entries(spark, sf_dir).where(W.since(F.col("published_utc"), now())).select("ord", "published_utc")


@query(
    "window_rolling_halfopen",
    f"WITH {{entries}} SELECT ord FROM entries WHERE published_utc >= {AT} - to_hours(k + 1) AND published_utc < {AT}",
)
def window_rolling_halfopen(spark, sf_dir):
    return entries(spark, sf_dir).where(W.rolling_half_open(F.col("published_utc"), now(), lookback())).select("ord")


# The run time is the time of one of the entries, so the closed end matters.
@query(
    "window_rolling_closed",
    """WITH {entries}, r AS (SELECT max(published_utc) AS t FROM entries)
    SELECT ord FROM entries, r WHERE published_utc >= t - to_hours(k + 1) AND published_utc <= t""",
)
def window_rolling_closed(spark, sf_dir):
    e = entries(spark, sf_dir)
    latest = e.agg(F.max("published_utc").alias("t")).scalar()
    return e.where(W.rolling_closed(F.col("published_utc"), latest, lookback())).select("ord")


@query(
    "window_calendar_jst",
    f"""WITH {{entries}}, v AS (SELECT ord, CASE WHEN k % 4 = 0 THEN CAST(published_utc AS DATE)
      ELSE CAST(published_utc + {OFF} AS DATE) END AS day FROM entries)
    SELECT ord, day FROM v WHERE day IN (CAST({AT} + INTERVAL 9 HOUR AS DATE), CAST({AT} + INTERVAL 9 HOUR AS DATE) - 1)""",
)
def window_calendar_jst(spark, sf_dir):
    stated = F.when(F.col("k") % 4 == 0, F.col("published_utc").cast("date"))
    day = F.coalesce(stated, D.to_zone("published_utc", zone()).cast("date"))
    return entries(spark, sf_dir).select("ord", day.alias("day")).where(W.calendar_home(F.col("day"), now()))


@query(
    "window_calendar_site",
    f"""WITH {{entries}} SELECT ord FROM entries WHERE CAST(published_utc + {OFF} AS DATE)
      IN (CAST({AT} + {OFF} AS DATE), CAST({AT} + {OFF} AS DATE) - 1)""",
)
def window_calendar_site(spark, sf_dir):
    return entries(spark, sf_dir).where(W.calendar_zone(F.col("published_utc"), now(), zone())).select("ord")


DECISION = f"""decided AS (SELECT ord, site, CASE WHEN k % 10 = 3 THEN 'extraction_failed'
      WHEN {sql_pick('user_id', MODES)} = 'calendar_day' THEN
        CASE WHEN CAST(published_utc + {OFF} AS DATE) IN (CAST({AT} + INTERVAL 9 HOUR AS DATE), CAST({AT} + INTERVAL 9 HOUR AS DATE) - 1)
          THEN 'accepted' ELSE 'target_date_mismatch' END
      WHEN published_utc >= {AT} - to_hours(k + 1) AND published_utc < {AT} THEN 'accepted' ELSE 'out_of_window' END AS decision FROM entries)"""


def decided(spark, sf_dir):
    e = entries(spark, sf_dir).select(
        "ord",
        "site",
        F.when(F.col("k") % 10 != 3, F.col("published_utc")).alias("published_utc"),
        F.lit(None).cast("string").alias("parsed_date"),
        pick(F.col("user_id"), MODES).alias("target_date_mode"),
        lookback().alias("lookback_hours"),
        zone().alias("date_timezone"),
    )
    return W.decide(e, now())


@query("window_decision", f"WITH {{entries}}, {DECISION} SELECT ord, site, decision FROM decided")
def window_decision(spark, sf_dir):
    return decided(spark, sf_dir).select("ord", "site", "decision")
