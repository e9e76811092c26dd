"""JSON text columns: tagged property values, lookup responses, typed blocks, report checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.text import strip, text

_PARTS = "array<struct<plain_text:string>>"
_NAMES = "array<struct<name:string>>"


def json_field(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def _joined(c: Column, path: str) -> Column:
    parts = F.from_json(F.get_json_object(c, path), _PARTS)
    return F.array_join(F.transform(parts, lambda p: F.coalesce(p["plain_text"], F.lit(""))), "")


def property_value(c: Column) -> Column:
    """Text of a tagged property ``{type: T, T: value}``; names of a multi-select joined by commas."""
    kind = F.get_json_object(c, "$.type")
    names = F.from_json(F.get_json_object(c, "$.multi_select"), _NAMES)
    return (
        F.when(kind == "checkbox", F.get_json_object(c, "$.checkbox"))
        .when(kind == "number", F.get_json_object(c, "$.number"))
        .when(kind == "url", F.get_json_object(c, "$.url"))
        .when(kind == "select", F.get_json_object(c, "$.select.name"))
        .when(
            kind == "multi_select",
            F.array_join(F.filter(F.transform(names, lambda n: n["name"]), lambda n: n != ""), ","),
        )
        .when(kind == "rich_text", F.coalesce(_joined(c, "$.rich_text"), F.lit("")))
        .when(kind == "title", F.coalesce(_joined(c, "$.title"), F.lit("")))
        .when(kind == "date", F.get_json_object(c, "$.date.start"))
    )


def property_by_name(properties: Column, name: str) -> Column:
    """JSON text of one property from a ``map<string,string>``; outer blanks of keys are ignored."""
    exact = F.try_element_at(properties, F.lit(name))
    keys = F.filter(F.map_keys(properties), lambda k: strip(k) == name.strip())
    return F.coalesce(exact, F.try_element_at(properties, F.try_element_at(keys, F.lit(1))))


def translations(c: Column, expected: Column) -> Column:
    """Translations of a response in request order, or null unless there is one for each title.

    Accepts a list, ``{"translations": list}``, or an object keyed by digits (also nested).
    """
    body = F.when(c.rlike(r'(?s)^\s*\{.*"translations"\s*:'), F.get_json_object(c, "$.translations")).otherwise(c)
    listed = F.when(body.rlike(r"^\s*\["), F.from_json(body, "array<string>"))
    keyed = F.when(body.rlike(r"^\s*\{"), F.from_json(body, "map<string,string>"))
    all_digits = F.forall(F.map_keys(keyed), lambda k: k.rlike(r"^\d+$"))
    ordered = F.transform(
        F.array_sort(
            F.transform(
                F.map_entries(keyed), lambda e: F.struct(e["key"].try_cast("bigint").alias("k"), e["value"].alias("v"))
            )
        ),
        lambda e: e["v"],
    )
    found = F.coalesce(listed, F.when(all_digits, ordered))
    return F.when(F.size(found) == expected, found)


def block_heading(c: Column) -> Column:
    """Heading text of a typed block, empty for other blocks."""
    kind = F.get_json_object(c, "$.type")
    out = F.when(F.lit(False), F.lit(""))
    for h in ("heading_1", "heading_2", "heading_3"):
        out = out.when(kind == h, strip(F.coalesce(_joined(c, f"$.{h}.rich_text"), F.lit(""))))
    return out.otherwise(F.lit(""))


def report_errors(c: Column, expected_sections: Column) -> Column:
    """Error codes of a generated report, in a fixed order."""
    def present(key: str) -> Column:
        return F.array_contains(F.json_object_keys(c), key)

    codes = [
        F.when(F.coalesce(F.get_json_object(c, f"$.{k}"), F.lit("")).isin("", "false", "0", "[]", "{}"), F.lit(f"missing_{k}"))
        for k in K.REQUIRED_REPORT_TEXTS
    ]
    codes += [F.when(~present(k), F.lit(f"missing_{k}")) for k in K.REQUIRED_REPORT_KEYS]
    items = F.get_json_object(c, "$.priority_watch_items")
    codes.append(
        F.when(
            present("priority_watch_items") & ~F.coalesce(items, F.lit("")).startswith("["),
            F.lit("priority_watch_items_not_list"),
        )
    )
    sections = F.get_json_object(c, "$.article_sections")
    size = F.json_array_length(sections)
    codes.append(
        F.when(sections.isNull(), F.lit("missing_article_sections"))
        .when(~sections.startswith("["), F.lit("article_sections_not_list"))
        .when(
            size != expected_sections,
            F.concat(
                F.lit("article_sections_count_"), size.cast("string"), F.lit("_expected_"), expected_sections.cast("string")
            ),
        )
    )
    is_object = F.json_object_keys(c).isNotNull()
    return F.when(is_object, F.array_compact(F.array(*codes))).otherwise(F.array(F.lit("report_is_not_object")))


def long_enough(c: Column, minimums: dict[str, int]) -> Column:
    """All named texts present, non-blank and at least as long as asked."""
    ok = F.lit(True)
    for key, n in minimums.items():
        v = F.coalesce(F.get_json_object(c, f"$.{key}"), F.lit(""))
        ok = ok & (strip(v) != "") & (F.length(v) >= n)
    return ok


def clipped_json(value: Column, limit: int = K.TEXT_CHARS) -> Column:
    return F.left(F.to_json(value), F.lit(limit))


def is_valid_translation(source: Column, translated: Column) -> Column:
    t = strip(text(translated))
    return (t != "") & (t != strip(text(source)))
