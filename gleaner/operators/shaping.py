"""Config rows, aliases, typed writes and other row shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.functions.numbers import safe_int
from gleaner.operators.filters import url_pattern

# Site settings as saved: trimmed text, lower-cased choices with defaults, counts with a floor, switches.
SITE_TEXTS = [
    "site_name", "subject_prefix", "list_date_pattern", "article_date_pattern", "list_container_selector",
    "article_link_selector", "list_date_selector", "article_date_selector", "next_page_selector",
    "include_title_pattern", "exclude_title_pattern", "search_query", "search_url_pattern",
]
SITE_CHOICES = {
    "date_granularity": "datetime", "target_date_mode": "rolling_24h", "fetch_mode": "direct",
    "date_fallback_mode": "require_date",
}
SITE_COUNTS = {"max_items_per_site": 20, "max_items_total": 50, "lookback_hours": 24, "max_pages": 1}
SITE_SWITCHES = ["enabled", "delivery_enabled", "fetch_article_body"]
SITE_COLUMNS = [
    *SITE_TEXTS, *SITE_CHOICES, *SITE_COUNTS, *SITE_SWITCHES, "display_order", "list_page_urls", "article_url_pattern",
    "date_timezone",
]


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_site_config(raw: DataFrame) -> DataFrame:
    """The 28 settings of each site; missing columns take their defaults."""
    def c(name: str) -> Column:
        return _column_or_null(raw, name)

    columns = [T.strip(T.text(c(n))).alias(n) for n in SITE_TEXTS]
    columns += [
        F.coalesce(F.nullif(F.lower(T.strip(T.text(c(n)))), F.lit("")), F.lit(default)).alias(n)
        for n, default in SITE_CHOICES.items()
    ]
    columns += [F.greatest(F.lit(1), safe_int(c(n), default)).alias(n) for n, default in SITE_COUNTS.items()]
    columns += [F.coalesce(c(n).try_cast("boolean"), F.lit(True)).alias(n) for n in SITE_SWITCHES]
    columns += [
        safe_int(c("display_order"), 9999).alias("display_order"),
        U.parse_url_list(c("list_page_urls")).alias("list_page_urls"),
        url_pattern(T.strip(T.text(c("article_url_pattern")))).alias("article_url_pattern"),
        D.known_zone(F.coalesce(F.nullif(T.strip(T.text(c("date_timezone"))), F.lit("")), F.lit(K.HOME_TZ))).alias(
            "date_timezone"
        ),
    ]
    return raw.select(*columns)


def normalize_date_rule(raw: DataFrame, medium: str = "medium") -> DataFrame:
    """Complete date rules: a non-null override beats the medium's preset, which beats the default."""
    rules = K.DATE_RULE_DEFAULTS

    def preset(field: str) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for name, values in K.DATE_RULE_PRESETS.items():
            if field in values:
                out = out.when(F.col(medium) == name, F.lit(str(values[field])))
        return out.otherwise(F.lit(str(rules[field])))

    chosen = raw.withColumns(
        {f: F.coalesce(T.strip(_column_or_null(raw, f).cast("string")), preset(f)) for f in rules}
    )

    def choice(field: str, allowed: list[str], default: Column | str) -> Column:
        value = F.lower(T.strip(field))
        return F.when(value.isin(allowed), value).otherwise(F.lit(default) if isinstance(default, str) else default)

    staged = chosen.withColumns(
        {
            "date_source_type": choice("date_source_type", K.DATE_SOURCE_TYPES, "rss"),
            "fallback_date_source_type": choice("fallback_date_source_type", K.DATE_SOURCE_TYPES, ""),
            "date_granularity": choice("date_granularity", K.DATE_GRANULARITIES, "datetime"),
        }
    )
    by_granularity = F.when(F.col("date_granularity") == "date", F.lit("calendar_day")).otherwise(F.lit("rolling_24h"))
    hours = safe_int("lookback_hours", K.LOOKBACK_HOURS)
    return staged.withColumns(
        {
            "target_date_mode": choice("target_date_mode", K.TARGET_DATE_MODES, by_granularity),
            "lookback_hours": F.when(hours > 0, hours).otherwise(F.lit(K.LOOKBACK_HOURS)),
            "date_timezone": D.known_zone("date_timezone"),
        }
    )


def build_media_rows(raw: DataFrame) -> DataFrame:
    """Usable media: named, enabled and with at least one valid feed."""
    out = raw.select(
        T.strip(T.text("media_name")).alias("media_name"),
        F.coalesce(F.col("enabled"), F.lit(False)).alias("enabled"),
        T.clean_list(F.coalesce("alert_ids", F.array().cast("array<string>"))).alias("alert_ids"),
        U.parse_feed_urls("alert_feeds").alias("alert_feeds"),
        safe_int("display_order", 999).alias("display_order"),
        safe_int("max_items", K.ITEMS_PER_MEDIUM).alias("max_items"),
        safe_int("max_items_total", K.ITEMS_TOTAL).alias("max_items_total"),
    )
    return out.where((F.col("media_name") != "") & F.col("enabled") & (F.size("alert_feeds") > 0)).drop("enabled")


# ---- schema-driven columns --------------------------------------------------------------------


def resolve_columns(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> tuple[DataFrame, list[str]]:
    """Rename the first present alias of each field; fields without one are reported."""
    aliases = aliases or K.STORE_COLUMN_ALIASES
    found = {field: next((n for n in names if n in df.columns), None) for field, names in aliases.items()}
    columns = [F.col(f"`{n}`").alias(field) for field, n in found.items() if n]
    return df.select(*columns), sorted(field for field, n in found.items() if n is None)


def project_known(df: DataFrame, known: list[str]) -> DataFrame:
    """Only the columns the target has."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in set(known)])


def require_columns(available: list[str], required: list[str] | None = None) -> None:
    missing = sorted(set(required or K.REQUIRED_REPORT_COLUMNS) - set(available))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def typed_write(value: Column, kind: str) -> Column | None:
    """A value in the destination's declared type, cut to its limits; ``None`` for an unknown type."""
    t = value.cast("string")
    if kind in ("title", "rich_text"):
        return F.left(t, F.lit(K.TEXT_CHARS))
    if kind == "select":
        return F.left(t, F.lit(K.TAG_CHARS))
    if kind == "number":
        return t.try_cast("double")
    if kind == "checkbox":
        return value.cast("boolean")
    if kind == "date":
        return F.coalesce(F.nullif(D.normalize_issue_date(t), F.lit("")), t)
    if kind == "url":
        return t
    return None


def typed_list_write(values: Column, kind: str) -> Column | None:
    """A list as tags, or as one text when the destination holds text."""
    items = F.filter(values, lambda v: T.strip(v) != "")
    if kind == "multi_select":
        return F.transform(items, lambda v: F.left(v, F.lit(K.TAG_CHARS)))
    if kind == "rich_text":
        return F.left(F.array_join(items, "、"), F.lit(K.LONG_TEXT_CHARS))
    return None


def write_typed(df: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Coerce columns to the destination's types; fields it cannot take are left out and reported."""
    columns, skipped = {}, []
    for name, kind in kinds.items():
        is_list = dict(df.dtypes)[name].startswith("array")
        made = typed_list_write(F.col(name), kind) if is_list else typed_write(F.col(name), kind)
        if made is None:
            skipped.append(name)
        else:
            columns[name] = made
    return df.select(*[c for c in df.columns if c not in kinds], *[v.alias(k) for k, v in columns.items()]), skipped


def enrichment_payload(df: DataFrame, model: str) -> DataFrame:
    """Columns written back after enrichment."""
    return df.select(
        "article_id", "summary", "reason_to_read", "business_implications",
        F.lit(True).alias("processed"), F.lit(model).alias("model"),
    )


def ensure_title(*candidates: Column | str, url: Column | str, id_param: str = "ng", prefix: str = "Untitled Article - ") -> Column:
    """First non-blank title, else one made from the article id."""
    aid = U.query_param(T.strip(T.text(url)), id_param)
    fallback = F.concat(F.lit(prefix), F.when(aid != "", aid).otherwise(F.lit("unknown")))
    return F.coalesce(*[T.presence(c) for c in candidates], fallback)
