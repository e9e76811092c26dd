"""Text functions over every article, page and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import (
    art, query, s_any, s_lines, s_squeeze, s_strip, s_title_key, sql_list, sql_text, table,
)
from gleaner.functions import text as T

JAVA_BOILERPLATE = "|".join(f"(?:{T.java_pattern(p)})" for p in K.BOILERPLATE_PATTERNS)


@query("strip_tags", "SELECT page_id, trim(regexp_replace(html, '<[^<]+?>', '', 'g')) AS plain FROM pages")
def strip_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_tags("html").alias("plain"))


@query("normalize_title", f"WITH {{art}} SELECT article_id, {s_title_key('title')} AS title_key FROM art")
def normalize_title(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.normalize_title("title").alias("title_key"))


@query(
    "title_space_key",
    f"""WITH {{art}}, t AS (SELECT article_id, '  ' || replace(title, ' ', chr(12288) || ' ') || chr(9) AS title FROM art)
    SELECT article_id, {s_squeeze(s_strip('lower(title)'))} AS site_key, {s_squeeze(s_strip('title'))} AS cache_key FROM t""",
)
def title_space_key(spark, sf_dir):
    raw = F.concat(F.lit("  "), F.replace("title", F.lit(" "), F.lit("　 ")), F.lit("\t"))
    return art(spark, sf_dir).select(
        "article_id", T.title_space_key(raw).alias("site_key"), T.cache_key(raw).alias("cache_key")
    )


CLEAN_LINES = f"""ls AS (SELECT article_id, {s_lines("replace(body, '<br>', chr(10))")} AS ls FROM art),
    kept AS (SELECT article_id, ls, list_filter(ls, lambda x: NOT list_contains({sql_list(K.BOILERPLATE_LINES)}, x)
      AND NOT regexp_matches(x, '{JAVA_BOILERPLATE}')) AS k FROM ls)"""


@query(
    "clean_body_lines",
    f"""WITH {{art}}, {CLEAN_LINES}
    SELECT article_id, array_to_string(k, chr(10)) AS body, CAST(length(ls) - length(k) AS INTEGER) AS removed FROM kept""",
)
def clean_body_lines(spark, sf_dir):
    staged = art(spark, sf_dir).select("article_id", T.content_lines("body").alias("ls"))
    kept = staged.select("article_id", "ls", T.drop_boilerplate(F.col("ls")).alias("k"))
    return kept.select(
        "article_id", F.array_join("k", "\n").alias("body"), (F.size("ls") - F.size("k")).alias("removed")
    )


def _replace_all(x: str, terms: list[str]) -> str:
    for t in terms:
        x = f"replace({x}, {sql_text(t)}, ' ')"
    return x


@query(
    "clean_report_text",
    f"""WITH {{art}}, s AS (SELECT article_id, regexp_replace({_replace_all('body', K.REPORT_NOISE)}, '[\\t\\r ]+', ' ', 'g') AS s FROM art)
    SELECT article_id, array_to_string(list_filter(list_transform(string_split(s, chr(10)), lambda x: {s_strip('x')}),
      lambda x: length(x) > 8), chr(10)) AS body FROM s""",
)
def clean_report_text(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.clean_report_text("body").alias("body"))


@query(
    "clean_article_text",
    f"""WITH {{art}}, s AS (SELECT article_id, regexp_replace(replace(body, chr(160), ' '), '\\r\\n?', chr(10), 'g') AS s FROM art)
    SELECT article_id, {s_strip("regexp_replace(s, '\\n{3,}', chr(10) || chr(10), 'g')")} AS body FROM s""",
)
def clean_article_text(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.clean_article_text("body").alias("body"))


def _remove_patterns(x: str) -> str:
    for p in K.SAMPLE_REMOVE_PATTERNS:
        x = f"regexp_replace({x}, '{T.java_pattern(p)}', '', 'g')"
    return x


_SAMPLE_SOURCE = "regexp_replace(regexp_replace(replace(body, chr(12288), ' '), '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g')"
_TRAIL = (
    "(x = t || 'を' OR x = t || 'へ' OR x = t || 'はこちら') AND t <> '' OR (length(x) <= 40 AND NOT regexp_matches(x, '[。、]') "
    "AND (ends_with(x, 'を') OR ends_with(x, 'へ') OR ends_with(x, 'はこちら')))"
)


@query(
    "trim_trailing_links",
    f"""WITH {{art}}, s AS (SELECT article_id, CASE WHEN article_id % 3 = 0 THEN '山田氏の記事' ELSE title END AS t,
        {_remove_patterns(_SAMPLE_SOURCE)} AS s FROM art),
    l AS (SELECT article_id, {s_strip('t')} AS t, list_filter(list_transform(string_split(s, chr(10)), lambda x: {s_strip('x')}), lambda x: x <> '') AS ls FROM s)
    SELECT article_id, array_to_string(ls[1:coalesce(list_max(list_transform(ls, lambda x, i: CASE WHEN {_TRAIL} THEN 0 ELSE i END)), 0)], chr(10) || chr(10)) AS body
    FROM l""",
)
def trim_trailing_links(spark, sf_dir):
    title = F.when(F.col("article_id") % 3 == 0, F.lit("山田氏の記事")).otherwise(F.col("title"))
    staged = art(spark, sf_dir).select("article_id", title.alias("t"), T.sample_lines("body").alias("ls"))
    return staged.select("article_id", F.array_join(T.drop_trailing_links(F.col("ls"), "t"), "\n\n").alias("body"))


CHUNK_SQL = f"""WITH {{art}}, l AS (SELECT article_id, {s_lines('body')} AS ls FROM art),
    folded AS (SELECT article_id, list_reduce(ls, lambda a, x: CASE WHEN a.o <> '' AND length(a.o) + length(x) + 1 > 1800
        THEN {{{{'d': list_append(a.d, a.o), 'o': x}}}} ELSE {{{{'d': a.d, 'o': CASE WHEN a.o = '' THEN x ELSE a.o || chr(10) || x END}}}} END,
        {{{{'d': CAST([] AS VARCHAR[]), 'o': ''}}}}) AS f FROM l),
    c AS (SELECT article_id, CASE WHEN f.o <> '' THEN list_append(f.d, f.o) ELSE f.d END AS chunks FROM folded)
    SELECT article_id, CAST(unnest(range(len(chunks))) AS INTEGER) AS pos, unnest(chunks) AS chunk FROM c"""


@query("chunk_text", CHUNK_SQL.replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}"))
def chunk_text(spark, sf_dir):
    staged = art(spark, sf_dir).select("article_id", T.lines("body").alias("ls"))
    return staged.select("article_id", F.posexplode(T.chunk(F.col("ls"))).alias("pos", "chunk"))


@query(
    "excerpt",
    f"""WITH {{art}}, s AS (SELECT article_id, body, {s_strip(s_squeeze('body'))} AS c FROM art)
    SELECT article_id, CASE WHEN body = '' THEN NULL WHEN length(c) <= 180 THEN c ELSE left(c, 179) || '…' END AS excerpt FROM s""",
)
def excerpt(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.excerpt("body").alias("excerpt"))


_SECTION_CASE = " ".join(
    f"WHEN {s_any('low', [t.lower() for t in terms])} THEN {sql_text(name)}" for name, terms in K.SECTION_KEYWORDS.items()
)


@query(
    "classify_section",
    f"WITH {{art}}, s AS (SELECT article_id, lower(body || title) AS low FROM art) SELECT article_id, CASE {_SECTION_CASE} END AS section FROM s",
)
def classify_section(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.classify_section(F.concat("body", "title")).alias("section"))


@query(
    "split_keywords",
    f"""SELECT item_id, array_to_string(list_filter(list_transform(regexp_split_to_array(
      regexp_replace(replace(text || ' OR 鉄鋼、政策;資源|物流　再エネ or FORD', 'a', ','), '(?i){K.WS}*OR{K.WS}*', chr(10), 'g'), '[\\n,、;|　]+'),
      lambda x: {s_strip('x')}), lambda x: x <> ''), '/') AS keywords FROM benchmark""",
)
def split_keywords(spark, sf_dir):
    raw = F.replace(F.concat("text", F.lit(" OR 鉄鋼、政策;資源|物流　再エネ or FORD")), F.lit("a"), F.lit(","))
    return table(spark, sf_dir, "benchmark").select(
        "item_id", F.array_join(T.split_keywords(raw), "/").alias("keywords")
    )


@query(
    "split_list",
    f"""SELECT conv_id, turn, array_to_string(list_filter(list_transform(regexp_split_to_array(text, '[,;\\n]'),
      lambda x: {s_strip('x')}), lambda x: x <> ''), '/') AS items FROM conversations""",
)
def split_list(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(T.split_list("text"), "/").alias("items")
    )


@query(
    "mask_address",
    """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_name
        ELSE replace(right(c_name, CAST(c_custkey % 9 + 1 AS INTEGER)), '#', '.') || '@mail.example.com' END AS address FROM customer)
    SELECT c_custkey, CASE WHEN NOT contains(address, '@') THEN '***' WHEN strpos(address, '@') - 1 <= 2 THEN left(address, 1) || '*@mail.example.com'
      ELSE left(address, 1) || repeat('*', strpos(address, '@') - 3) || substring(address, strpos(address, '@') - 1) END AS masked FROM a""",
)
def mask_address(spark, sf_dir):
    name = F.replace(F.right("c_name", (F.col("c_custkey") % 9 + 1).cast("int")), F.lit("#"), F.lit("."))
    address = F.when(F.col("c_custkey") % 10 == 0, F.col("c_name")).otherwise(F.concat(name, F.lit("@mail.example.com")))
    return table(spark, sf_dir, "customer").select("c_custkey", T.mask_address(address).alias("masked"))


def s_norm(x: str) -> str:
    x = f"regexp_replace({s_strip(x)}, '{K.WS}*-{K.WS}*{K.SITE_TITLE_SUFFIX}{K.WS}*$', '')"
    x = f"regexp_replace({x}, '{K.WS}+', '', 'g')"
    return f"translate({x}, '{K.TITLE_PUNCTUATION.replace(chr(39), chr(39) * 2)}', '')"


def s_tokens(norm: str) -> str:
    return (
        f"list_filter(regexp_extract_all({norm}, '[\\p{{L}}\\p{{N}}_\\x{{3040}}-\\x{{30ff}}\\x{{3400}}-\\x{{9fff}}]+'), "
        "lambda x: length(x) >= 2)"
    )


@query("title_match_norm", f"WITH {{art}} SELECT article_id, {s_norm('title')} AS norm FROM art")
def title_match_norm(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", T.title_match_norm("title").alias("norm"))


@query(
    "title_tokens",
    f"""WITH {{art}}, n AS (SELECT article_id, {s_norm("replace(title, ' ', '+')")} AS norm FROM art)
    SELECT article_id, array_to_string({s_tokens('norm')}, ' ') AS tokens FROM n""",
)
def title_tokens(spark, sf_dir):
    norm = T.title_match_norm(F.replace("title", F.lit(" "), F.lit("+")))
    staged = art(spark, sf_dir).select("article_id", norm.alias("norm"))
    return staged.select("article_id", F.array_join(T.title_tokens(F.col("norm")), " ").alias("tokens"))


@query(
    "valid_body",
    f"WITH {{art}} SELECT article_id, {s_strip('body')} <> '' AS has_body FROM art",
)
def valid_body(spark, sf_dir):
    return art(spark, sf_dir).select("article_id", (T.strip("body") != "").alias("has_body"))


@query(
    "is_japanese",
    "WITH {art} SELECT article_id, regexp_matches(title, '[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS title_ja, "
    "regexp_matches(body, '[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS body_ja FROM art",
)
def is_japanese(spark, sf_dir):
    return art(spark, sf_dir).select(
        "article_id", T.is_japanese("title").alias("title_ja"), T.is_japanese("body").alias("body_ja")
    )
