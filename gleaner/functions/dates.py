"""Publication times.

Times are carried as ``TIMESTAMP_NTZ`` so results never depend on the session zone:
``*_utc`` columns hold UTC wall-clock time, ``*_local`` columns the wall clock of the rule's zone.
"""

from __future__ import annotations

import zoneinfo
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.text import as_col, let, strip, text

# Month names and mail zone names with their offsets in minutes.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
MAIL_ZONES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}


def ntz(value: str | datetime) -> Column:
    """A literal wall-clock time."""
    return F.lit(str(value)).cast("timestamp_ntz")


def known_zone(tz: Column | str, default: str = K.HOME_TZ) -> Column:
    """Unknown zone names read as the default zone."""
    name = strip(text(tz))
    return F.when(name.isin(sorted(zoneinfo.available_timezones())), name).otherwise(F.lit(default))


def to_zone(utc: Column | str, tz: Column | str) -> Column:
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(F.lit("UTC"), zone, as_col(utc))


def from_zone(local: Column | str, tz: Column | str) -> Column:
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.convert_timezone(zone, F.lit("UTC"), as_col(local))


def minutes(n: Column) -> Column:
    return n * F.expr("INTERVAL '1' MINUTE")


def hours(n: Column) -> Column:
    return n * F.expr("INTERVAL '1' HOUR")


def minute_text(local: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm``; read from the value itself, so the session zone plays no part."""
    return F.left(as_col(local).cast("string"), F.lit(16))


def day_text(local: Column | str) -> Column:
    return F.left(as_col(local).cast("string"), F.lit(10))


def midnight(local: Column) -> Column:
    return local.cast("date").cast("timestamp_ntz")


def label(local: Column | str, granularity: Column | None = None) -> Column:
    """``yyyy-MM-dd HH:mm``, or the date alone for date granularity."""
    if granularity is None:
        return minute_text(local)
    return F.when(granularity == "date", day_text(local)).otherwise(minute_text(local))


def _wall_clock(t: Column) -> Column:
    """``y-M-d[ h:m[:s]]`` as a wall-clock time; impossible dates and other text are null."""
    return t.try_cast("timestamp_ntz")


def _month_number(name: Column) -> Column:
    """Month of an English name, short or full, as text; null for other words."""
    names = {m[:3]: i for i, m in enumerate(MONTHS, 1)} | {m: i for i, m in enumerate(MONTHS, 1)}
    table = F.create_map(*[F.lit(x) for m, i in names.items() for x in (m, str(i))])
    return F.try_element_at(table, F.lower(name))


def _utc(local: Column, offset_minutes: Column, tz: Column) -> Column:
    """Shift by a stated offset, or from the zone when none is stated."""
    return let(
        offset_minutes,
        lambda o: from_zone(local - minutes(F.coalesce(o, F.lit(0))), F.when(o.isNull(), tz).otherwise(F.lit("UTC"))),
    )


ISO_TIME = r"(?:[T ]\d{2}(?::?\d{2}(?::?\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?"
ISO = rf"^\d{{4}}(?:-\d{{2}}-\d{{2}}|\d{{4}}){ISO_TIME}$"
ISO_OFFSET = r"(?<=[T ].{2,20})(Z|[+-]\d{2}:?\d{2})$"
#: Blanks of any script: a full-width blank parts a date from its time like any other.
B = K.WS
MAIL = (
    rf"^(?:[A-Za-z]{{3,9}},?{B}+)?(\d{{1,2}})[ -]([A-Za-z]{{3,9}})[ -](\d{{4}}|\d{{2}}){B}+(\d{{1,2}}:\d{{2}}(?::\d{{2}})?)"
    rf"{B}*([+-]\d{{4}}|[A-Za-z]{{1,5}})?$"
)
PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"


def _offset(zone: Column) -> Column:
    """Minutes east of UTC for ``+09:00`` or ``-0500``; null for other text."""
    def size(digits: Column) -> Column:
        return (F.floor(digits / 100) * 60 + digits % 100).cast("int")

    signed = F.replace(zone, F.lit(":"), F.lit("")).try_cast("int")
    return let(signed, lambda n: F.when(n < 0, -size(-n)).otherwise(size(n)))


# Texts are bound once with ``let`` and matches read as empty text when absent: each pattern runs once for a row.


def parse_iso_utc(c: Column | str, tz: Column) -> Column:
    """ISO 8601, extended or compact; text without an offset is in ``tz``."""

    def parse(t: Column) -> Column:
        zone = F.replace(F.regexp_extract(t, ISO_OFFSET, 0), F.lit("Z"), F.lit("+00:00"))
        body = F.regexp_replace(t, ISO_OFFSET, "")
        body = F.regexp_replace(body, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
        body = F.regexp_replace(body, r"[T ](\d{2}):?(\d{2}):?", " $1:$2:")
        return _utc(_wall_clock(F.rtrim(F.replace(body, F.lit(","), F.lit(".")), F.lit(":"))), _offset(zone), tz)

    return let(F.regexp_extract(strip(text(c)), ISO, 0), lambda t: F.when(t != "", parse(t)))


def parse_mail_utc(c: Column | str, tz: Column) -> Column:
    """Mail-style dates; an unknown or missing zone, and ``-0000``, read as ``tz``."""
    named = F.create_map(*[F.lit(x) for kv in MAIL_ZONES.items() for x in kv])

    def parse(t: Column) -> Column:
        local = F.concat(
            let(
                F.regexp_extract(t, MAIL, 3),
                lambda y: F.when(F.length(y) == 4, F.lit("")).when(y < "69", F.lit("20")).otherwise(F.lit("19")),
            ),
            F.replace(F.regexp_replace(t, MAIL, "$3-@-$1 $4"), F.lit("@"), _month_number(F.regexp_extract(t, MAIL, 2))),
        )
        offset = let(
            F.upper(F.regexp_extract(t, MAIL, 5)),
            lambda z: F.coalesce(F.try_element_at(named, z), F.when(z.rlike("^[+-]") & (z != "-0000"), _offset(z))),
        )
        return _utc(_wall_clock(local), offset, tz)

    return let(F.regexp_extract(strip(text(c)), MAIL, 0), lambda t: F.when(t != "", parse(t)))


def parse_flexible_utc(c: Column | str, tz: Column, granularity: Column) -> Column:
    """ISO, else three plain formats, else mail style. Date granularity cuts only the plain formats."""

    def plain(t: Column) -> Column:
        shaped = F.regexp_replace(F.translate(t, "年月/日", "---"), K.WS + "+", " ")
        return let(
            _wall_clock(F.regexp_extract(shaped, PLAIN, 0)),
            lambda v: from_zone(F.when(granularity == "date", midnight(v)).otherwise(v), tz),
        )

    return let(strip(text(c)), lambda t: F.coalesce(parse_iso_utc(t, tz), plain(t), parse_mail_utc(t, tz)))


def parse_date_text_local(c: Column | str, tz: Column, granularity: Column) -> Column:
    """First date found anywhere in the text, by six shapes in order, then ISO; null when none."""
    day_first = rf"(\d{{1,2}}){B}+([A-Za-z]+){B}+(\d{{4}})"
    month_first = rf"([A-Za-z]+){B}+(\d{{1,2}}),{B}*(\d{{4}})"

    def parse(t: Column) -> Column:
        def shape(pattern: str) -> Column:
            return F.regexp_extract(t, pattern, 0)

        def named(pattern: str, day: int, month: int, year: int) -> Column:
            return let(
                shape(pattern),
                lambda m: F.replace(
                    F.regexp_replace(m, pattern, f"${year}-@-${day}"), F.lit("@"), _month_number(F.regexp_extract(m, pattern, month))
                ),
            )

        numeric_time = F.translate(shape(rf"\d{{4}}[/-]\d{{1,2}}[/-]\d{{1,2}}{B}+\d{{1,2}}:\d{{2}}"), "/", "-")
        kanji_time = F.translate(shape(rf"\d{{4}}年\d{{1,2}}月\d{{1,2}}日{B}*\d{{1,2}}:(?:\d{{2}})?"), "年月日", "-- ")
        found = F.coalesce(
            _wall_clock(F.regexp_replace(numeric_time, f"{B}+", " ")),
            _wall_clock(F.regexp_replace(F.regexp_replace(kanji_time, f"{B}+", " "), ":$", ":00")),
            _wall_clock(F.translate(shape(r"\d{4}[/-]\d{1,2}[/-]\d{1,2}"), "/", "-")),
            _wall_clock(F.translate(shape(r"\d{4}年\d{1,2}月\d{1,2}日"), "年月日", "--")),
            _wall_clock(named(day_first, 1, 2, 3)),
            _wall_clock(named(month_first, 2, 1, 3)),
        )
        cut = let(found, lambda v: F.when(granularity == "date", midnight(v)).otherwise(v))
        return F.coalesce(cut, to_zone(parse_iso_utc(t, tz), tz))

    return let(strip(text(c)), parse)


def entry_datetime_utc(published_parsed: Column, updated_parsed: Column) -> Column:
    return F.coalesce(published_parsed, updated_parsed)


def ranked_entry_datetime(
    published_parsed: Column, updated_parsed: Column, published: Column, updated: Column
) -> tuple[Column, Column]:
    """(UTC time, name of the field used). The first non-empty field decides, even if unreadable."""
    has_pub, has_upd = F.nullif(published, F.lit("")).isNotNull(), F.nullif(updated, F.lit("")).isNotNull()
    utc_zone = F.lit("UTC")
    value = (
        F.when(published_parsed.isNotNull(), published_parsed)
        .when(updated_parsed.isNotNull(), updated_parsed)
        .when(has_pub, parse_mail_utc(published, utc_zone))
        .when(has_upd, parse_mail_utc(updated, utc_zone))
    )
    source = (
        F.when(published_parsed.isNotNull(), F.lit("published_parsed"))
        .when(updated_parsed.isNotNull(), F.lit("updated_parsed"))
        .when(has_pub, F.lit("published"))
        .when(has_upd, F.lit("updated"))
    )
    return value, source


def date_text_from_url(candidates: Column, pattern: Column | str, groups: int) -> Column:
    """Date text matched in URL candidates (one per line); three groups make ``Y-M-D``."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    whole = F.regexp_substr(candidates, p)
    if groups < 3:
        return whole
    parts = [F.regexp_extract(candidates, pattern, g) for g in (1, 2, 3)]
    return F.when(whole.isNotNull(), F.concat_ws("-", *parts))


def normalize_issue_date(c: Column | str) -> Column:
    """``YYYYMMDD`` or an ISO prefix as ``YYYY-MM-DD``; anything else is empty."""
    s = strip(text(c))
    return (
        F.when(s.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2)))
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(s, F.lit(10)))
        .otherwise(F.lit(""))
    )


def display_date(c: Column | str) -> Column:
    """``YYYYMMDD`` shown as a date, other text as it is."""
    s = text(c)
    return F.when(
        s.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    ).otherwise(s)


def target_date(setting: Column, as_of_utc: Column) -> Column:
    """``auto`` (or nothing) means the run's date in the home zone."""
    s = strip(text(setting))
    today = F.replace(day_text(to_zone(as_of_utc, K.HOME_TZ)), F.lit("-"), F.lit(""))
    return F.when((s != "") & (s != "auto"), s).otherwise(today)


def fallback_to_run_time(parsed: Column, mode: Column, source: Column, as_of: Column) -> tuple[Column, Column]:
    """(time, source label): unreadable times take the run time when the mode allows it."""
    use_run = parsed.isNull() & (mode == "use_fetched_at")
    return F.when(use_run, as_of).otherwise(parsed), F.when(use_run, F.lit("fetched_at")).otherwise(source)
