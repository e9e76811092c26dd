"""Numbers, lists and JSON values read from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import art, entries, pick, query, s_strip, sql_pick, sql_text, table
from gleaner.functions import jsons as J
from gleaner.functions import numbers as N
from gleaner.functions import text as T

ODD_NUMBERS = [" 7 ", "", "abc", "-3", "2.5", "0", "１", "99999999999"]


RAW_NUMBERS = f"""v AS (SELECT o_orderkey, {sql_pick('o_orderkey', ODD_NUMBERS)} AS raw FROM orders)"""


@query(
    "safe_int",
    f"""WITH {RAW_NUMBERS} SELECT o_orderkey, coalesce(CASE WHEN regexp_matches({s_strip('raw')}, '^[+-]?[0-9]+$') THEN try_cast({s_strip('raw')} AS INTEGER) END, 20) AS n FROM v""",
)
def safe_int(spark, sf_dir):
    raw = pick(F.col("o_orderkey"), ODD_NUMBERS)
    return table(spark, sf_dir, "orders").select("o_orderkey", N.safe_int(raw, 20).alias("n"))


@query("safe_num", f"WITH {RAW_NUMBERS} SELECT o_orderkey, coalesce(try_cast({s_strip('raw')} AS DOUBLE), 0.0) AS x FROM v")
def safe_num(spark, sf_dir):
    raw = pick(F.col("o_orderkey"), ODD_NUMBERS)
    return table(spark, sf_dir, "orders").select("o_orderkey", N.safe_num(raw).alias("x"))


@query("clamp", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(greatest(1, least(40, l_quantity)) AS DOUBLE) AS clamped FROM lineitem")
def clamp(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", N.clamp(F.col("l_quantity").cast("double"), 1.0, 40.0).alias("clamped")
    )


@query(
    "ratio",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(round(l_discount / nullif(l_tax, 0), 3), 0.0) AS share FROM lineitem",
)
def ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", N.ratio(F.col("l_discount"), F.col("l_tax")).alias("share")
    )


@query(
    "ordered_distinct",
    """WITH w AS (SELECT conv_id, turn, string_split(lower(text), ' ') AS ws FROM conversations),
    u AS (SELECT conv_id, turn, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
    d AS (SELECT conv_id, turn, w, min(i) AS i FROM u GROUP BY ALL)
    SELECT conv_id, turn, string_agg(w, ' ' ORDER BY i) AS words FROM d GROUP BY ALL""",
)
def ordered_distinct(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(F.array_distinct(F.split(F.lower("text"), " ", -1)), " ").alias("words")
    )


@query(
    "clean_string_list",
    f"""SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(text, '.'), lambda x: {s_strip('x')}),
      lambda x: x <> ''), '|') AS items FROM conversations""",
)
def clean_string_list(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(T.clean_list(F.split("text", r"\.")), "|").alias("items")
    )


KEYWORDS = ["Steel", "ai", "鉄鋼", "M&A", "der", "que", "tion", "データセンター", "速報", "一覧"]


@query(
    "keyword_hits",
    "WITH {art}, s AS (SELECT article_id, lower(title || chr(10) || body) AS t FROM art) SELECT article_id, array_to_string(list_filter(["
    + ", ".join(sql_text(k) for k in KEYWORDS)
    + "], lambda k: contains(t, lower(k))), ',') AS hits FROM s",
)
def keyword_hits(spark, sf_dir):
    keywords = F.array(*[F.lit(k) for k in KEYWORDS])
    staged = art(spark, sf_dir).select("article_id", F.lower(F.concat_ws("\n", "title", "body")).alias("t"))
    return staged.select("article_id", F.array_join(T.keyword_hits("t", keywords), ",").alias("hits"))


_COUNT = " + ".join(f"(length(body) - length(replace(body, {sql_text(t)}, ''))) // {len(t)}" for t in K.BODY_NAV_TERMS)


@query("count_hits", f"WITH {{art}} SELECT article_id, CAST({_COUNT} AS INTEGER) AS hits FROM art")
def count_hits(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.count_occurrences("body", K.BODY_NAV_TERMS).alias("hits"))


# Tagged properties built from order columns: one of each kind.
PROPERTIES = [
    '{"type":"checkbox","checkbox":true}',
    '{"type":"number","number":@key}',
    '{"type":"url","url":"https://example.com/@key"}',
    '{"type":"select","select":{"name":"@status"}}',
    '{"type":"select","select":null}',
    '{"type":"multi_select","multi_select":[{"name":"@status"},{"name":""},{"name":"n@key"}]}',
    '{"type":"rich_text","rich_text":[{"plain_text":"a@key"},{"plain_text":" b"}]}',
    '{"type":"title","title":[{"plain_text":"@status"}]}',
    '{"type":"date","date":{"start":"2024-01-@day"}}',
    '{"type":"people","people":[]}',
]


def properties(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = pick(F.col("o_orderkey"), PROPERTIES)
    raw = F.replace(raw, F.lit("@key"), F.col("o_orderkey").cast("string"))
    raw = F.replace(raw, F.lit("@status"), F.col("o_orderstatus"))
    return o.select("o_orderkey", F.replace(raw, F.lit("@day"), F.date_format("o_orderdate", "dd")).alias("prop"))


@query(
    "property_value",
    """SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN 'true' WHEN 1 THEN CAST(o_orderkey AS VARCHAR)
      WHEN 2 THEN 'https://example.com/' || o_orderkey WHEN 3 THEN o_orderstatus WHEN 4 THEN NULL
      WHEN 5 THEN o_orderstatus || ',n' || o_orderkey WHEN 6 THEN 'a' || o_orderkey || ' b' WHEN 7 THEN o_orderstatus
      WHEN 8 THEN '2024-01-' || strftime(o_orderdate, '%d') END AS value FROM orders""",
)
def property_value(spark, sf_dir):
    return properties(spark, sf_dir).select("o_orderkey", J.property_value(F.col("prop")).alias("value"))


RESPONSES = [
    '["@a","@b"]',
    '{"translations":["@a","@b"]}',
    '{"0":"@a","10":"@c","2":"@b"}',
    '{"translations":{"1":"@b","0":"@a"}}',
    '{"first":"@a"}',
    '["@a"]',
]


@query(
    "translations_payload",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'A' || o_orderkey || '/B' || o_custkey
      WHEN 1 THEN 'A' || o_orderkey || '/B' || o_custkey WHEN 3 THEN 'A' || o_orderkey || '/B' || o_custkey
      WHEN 2 THEN CASE WHEN o_custkey % 2 = 0 THEN 'A' || o_orderkey || '/B' || o_custkey || '/C' END END AS translated
    FROM orders""",
)
def translations_payload(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = pick(F.col("o_orderkey"), RESPONSES)
    raw = F.replace(raw, F.lit("@a"), F.concat(F.lit("A"), F.col("o_orderkey").cast("string")))
    raw = F.replace(raw, F.lit("@b"), F.concat(F.lit("B"), F.col("o_custkey").cast("string")))
    raw = F.replace(raw, F.lit("@c"), F.lit("C"))
    expected = F.when((F.col("o_orderkey") % 6 == 2) & (F.col("o_custkey") % 2 == 0), F.lit(3)).otherwise(F.lit(2))
    return o.select("o_orderkey", F.array_join(J.translations(raw, expected), "/").alias("translated"))


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS missing FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        J.json_field(F.col("props"), "$.k").alias("k"),
        J.json_field(F.col("props"), "$.none").alias("missing"),
    )


@query(
    "breakdown_json",
    """SELECT o_orderkey, left('[' || string_agg('{"tag":"p' || l_partkey || '","weight":' || CAST(l_linenumber AS INTEGER) || '}', ',' ORDER BY l_linenumber, 'p' || l_partkey) || ']', 60) AS breakdown
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def breakdown_json(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("l_linenumber").cast("int").alias("weight"),
                    F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("tag"),
                )
            )
        ).alias("b")
    )
    shaped = F.transform("b", lambda s: F.struct(s["tag"].alias("tag"), s["weight"].alias("weight")))
    return rows.join(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select(
        "o_orderkey", J.clipped_json(shaped, 60).alias("breakdown")
    )


BLOCKS = [
    '{"type":"heading_2","heading_2":{"rich_text":[{"plain_text":" 本"},{"plain_text":"文 "}]}}',
    '{"type":"paragraph","paragraph":{"rich_text":[{"plain_text":"@t"}]}}',
    '{"type":"heading_1","heading_1":{"rich_text":[{"plain_text":"@t"}]}}',
    '{"type":"heading_3","heading_3":{"rich_text":[]}}',
]


@query(
    "block_heading",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '本文' WHEN 2 THEN c_mktsegment ELSE '' END AS heading,
      c_custkey % 4 = 0 AS starts_body FROM customer""",
)
def block_heading(spark, sf_dir):
    raw = F.replace(pick(F.col("c_custkey"), BLOCKS), F.lit("@t"), F.col("c_mktsegment"))
    staged = table(spark, sf_dir, "customer").select("c_custkey", J.block_heading(raw).alias("heading"))
    return staged.select("c_custkey", "heading", F.col("heading").isin(K.BODY_START_HEADINGS).alias("starts_body"))


@query(
    "valid_translation",
    f"""WITH {{art}}, v AS (SELECT article_id, title, CASE article_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN ' ' || title ELSE '訳 ' || title END AS tr FROM art)
    SELECT article_id, coalesce({s_strip('tr')}, '') <> '' AND coalesce({s_strip('tr')}, '') <> {s_strip('title')} AS valid FROM v""",
)
def valid_translation(spark, sf_dir):
    n = F.col("article_id") % 4
    tr = F.when(n == 1, F.lit(" ")).when(n == 2, F.concat(F.lit(" "), "title")).when(n == 3, F.concat(F.lit("訳 "), "title"))
    return art(spark, sf_dir).select("article_id", J.is_valid_translation(F.col("title"), tr).alias("valid"))
