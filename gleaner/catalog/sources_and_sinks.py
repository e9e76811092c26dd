"""Sources and sinks: the tables are written as captured files, read back and compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import art, query, s_strip, sql_text, store, table
from gleaner.catalog.text_functions import CHUNK_SQL
from gleaner.functions import jsons as J
from gleaner.functions import sql as SQL
from gleaner.functions import text as T
from gleaner.operators import shaping
from gleaner.operators import store as S
from gleaner.session import shared_dir
from gleaner.sources import readers, writers

PER_FILE = 100


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/captures/{name}-{uuid.uuid4().hex}"


def _text_files(rows, folder: str):
    """One text file for each row of ``(part, value)``."""
    rows.write.partitionBy("part").text(folder)
    return f"{folder}/part=*"


@query(
    "read_feed_items",
    """SELECT page_id, CAST(i AS INTEGER) AS entry_ord, CASE i WHEN 0 THEN 'A & B ' || page_id ELSE NULL END AS title, CASE i WHEN 0 THEN split_part(url, '?', 1) ELSE 'https://x.example.com/' || page_id END AS link,
      CASE i WHEN 0 THEN 'Fri, 05 Jan 2024 10:20:30 GMT' END AS published FROM pages, (VALUES (0), (1)) t(i) WHERE page_id % 6 <> 5""",
)
def read_feed_items(spark, sf_dir):
    n = F.col("page_id")
    good = F.concat(
        F.lit("<?xml version='1.0'?><rss><channel><title>f</title><item><title>A &amp; B "), n.cast("string"), F.lit("</title><link>"),
        F.substring_index("url", "?", 1), F.lit("</link><pubDate>Fri, 05 Jan 2024 10:20:30 GMT</pubDate></item><item><link>https://x.example.com/"),
        n.cast("string"), F.lit("</link></item></channel></rss>"),
    )
    feeds = table(spark, sf_dir, "pages").select("page_id", F.when(n % 6 == 5, F.lit("<rss><channel><item><title>cut")).otherwise(good).alias("xml"))
    return readers.parse_feeds(feeds).select("page_id", "entry_ord", "title", "link", "published")


def _customer_files(spark, sf_dir, row, wrap):
    """Customers in files of a hundred, each file one JSON text."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").groupBy(F.floor(k / PER_FILE).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct(k.alias("k"), row.alias("r")))).alias("rows")
    )
    return rows.select("part", wrap(F.to_json(F.transform("rows", lambda r: r["r"]))).alias("value"))


@query("read_json_array", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_json_array(spark, sf_dir):
    row = F.struct("c_custkey", "c_name", "c_acctbal")
    path = _text_files(_customer_files(spark, sf_dir, row, lambda v: v), _folder(spark, "json"))
    schema = "c_custkey bigint, c_name string, c_acctbal double"
    missing = readers.read_json_array(spark, _folder(spark, "absent"), schema)
    return readers.read_json_array(spark, path, schema).unionByName(missing)


@query(
    "read_site_config",
    "SELECT c_name AS site_name, CAST(c_custkey % 9 + 1 AS INTEGER) AS max_pages, 20 AS max_items_per_site, CAST(c_custkey % 100 AS INTEGER) AS config_ord FROM customer",
)
def read_site_config(spark, sf_dir):
    row = F.struct(F.col("c_name").alias("SiteName"), (F.col("c_custkey") % 9 + 1).alias("MaxPages"), F.lit("").alias("MaxItemsPerSite"))
    nested = lambda v: F.when(F.col("part") % 2 == 0, F.concat(F.lit('{"sites":'), v, F.lit("}"))).otherwise(v)
    path = _text_files(_customer_files(spark, sf_dir, row, nested), _folder(spark, "sites"))
    names = {"SiteName": "site_name", "MaxPages": "max_pages", "MaxItemsPerSite": "max_items_per_site"}
    raw = readers.read_site_config(spark, path, names)
    clean = shaping.normalize_site_config(raw.withColumn("search_query", F.col("config_ord").cast("string")))
    return clean.select("site_name", "max_pages", "max_items_per_site", F.col("search_query").cast("int").alias("config_ord"))


@query(
    "read_property_pages",
    "SELECT 'p' || c_custkey AS page_id, c_name AS name, c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS rank, CAST(c_custkey % 100 AS INTEGER) AS pos FROM customer",
)
def read_property_pages(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.struct(F.lit("title").alias("type"), F.array(F.struct(F.col("c_name").alias("plain_text"))).alias("title"))
    segment = F.struct(F.lit("select").alias("type"), F.struct(F.col("c_mktsegment").alias("name")).alias("select"))
    rank = F.struct(F.lit("number").alias("type"), k.alias("number"))
    properties = F.struct(name.alias("Name"), segment.alias(" Segment "), rank.alias("Rank"))
    row = F.struct(F.concat(F.lit("p"), k.cast("string")).alias("id"), properties.alias("properties"))
    wrap = lambda v: F.concat(F.lit('{"results":'), v, F.lit(',"has_more":true,"next_cursor":"c"}'))
    path = _text_files(_customer_files(spark, sf_dir, row, wrap), _folder(spark, "properties"))
    rows = readers.read_property_pages(spark, path, {"Name": "name", "Segment": "segment", "Rank": "rank"})
    return rows.select("page_id", "name", "segment", "rank", F.col("_pos").alias("pos"))


@query("write_json_rows", "SELECT doc_id, text, lang, source FROM documents")
def write_json_rows(spark, sf_dir):
    folder = _folder(spark, "rows")
    writers.write_json_rows(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), folder, ["lang", "source"])
    return spark.read.schema("doc_id bigint, text string, lang string, source string").json(folder)


@query("write_jsonl", "SELECT event_id, CASE WHEN value > 5 THEN value END AS value, event_type FROM events")
def write_jsonl(spark, sf_dir):
    folder = _folder(spark, "lines")
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 5, F.col("value")).alias("value"), "event_type")
    writers.write_jsonl(rows, folder)
    return spark.read.schema("event_id bigint, value double, event_type string").json(folder)


# Each article's page holds a cover, an old body section that ends at a metadata heading on some pages, and a tail.
_OLD = [("paragraph", "", "cover"), ("heading_2", "本文", "本文"), ("paragraph", "", "old"), ("heading_2", "メタデータ", "メタデータ"), ("paragraph", "", "tail")]
CHUNKED = CHUNK_SQL.replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}")


@query(
    "replace_blocks",
    "WITH {art}, chunked AS (" + CHUNKED.replace("WITH {art}, l AS", "WITH l AS") + """),
    upd AS (SELECT DISTINCT article_id FROM chunked), old(pos, kind, content) AS (VALUES (0, 'paragraph', 'cover'), (1, 'heading_2', '本文'), (2, 'paragraph', 'old'), (3, 'heading_2', 'メタデータ'), (4, 'paragraph', 'tail')),
    blocks AS (SELECT article_id, pos, kind, content FROM art, old WHERE NOT (article_id % 3 = 0 AND pos = 3))
    SELECT article_id AS page_id, 0 AS part, pos, kind, content FROM blocks WHERE article_id NOT IN (SELECT article_id FROM upd) OR pos < 1 OR (pos >= 3 AND article_id % 3 <> 0)
    UNION ALL SELECT article_id, 1, 0, 'heading_2', 'タイトル' FROM upd
    UNION ALL SELECT article_id, 1, 1, 'heading_3', left(title, 1900) FROM upd JOIN art USING (article_id) WHERE title <> ''
    UNION ALL SELECT article_id, 1, 2, 'heading_2', '本文' FROM upd
    UNION ALL SELECT article_id, 2, c.pos, 'paragraph', left(chunk, 1900) FROM chunked c JOIN art USING (article_id) WHERE c.pos + CASE WHEN title <> '' THEN 3 ELSE 2 END < 100""",
)
def replace_blocks(spark, sf_dir):
    a = art(spark, sf_dir)
    old = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(k).alias("kind"), F.lit(h).alias("heading"), F.lit(c).alias("content")) for i, (k, h, c) in enumerate(_OLD)])
    blocks = a.select(F.col("article_id").alias("page_id"), F.explode(old).alias("b")).select("page_id", "b.*")
    blocks = blocks.where(~((F.col("page_id") % 3 == 0) & (F.col("pos") == 3)))
    staged = a.select(F.col("article_id").alias("page_id"), T.lines("body").alias("ls"))
    chunks = staged.select("page_id", F.posexplode(T.chunk(F.col("ls"))).alias("pos", "content"))
    return S.replace_blocks(blocks, chunks, a.select(F.col("article_id").alias("page_id"), "title"))


# ---- columns by alias ----


def _saved(spark, sf_dir):
    return store(spark, sf_dir).select(
        F.col("title").alias("記事名"), F.col("url").alias("Link"), F.col("url").alias("Source URL"), F.col("issue_date").alias("Published Date"),
        F.col("edition").alias("Edition"), F.col("text").alias("本文"), F.col("ord").alias("Rank"),
    )


@query("resolve_columns", "WITH {store} SELECT title, url, issue_date AS issue, edition, text AS body FROM store")
def resolve_columns(spark, sf_dir):
    out, missing = shaping.resolve_columns(_saved(spark, sf_dir))
    assert "source" in missing and "title" not in missing
    return out


@query("project_known", "WITH {store} SELECT url AS \"Link\", edition AS \"Edition\" FROM store")
def project_known(spark, sf_dir):
    return shaping.project_known(_saved(spark, sf_dir), ["Link", "Edition", "Unknown"])


@query("intersect_columns", "WITH {store} SELECT edition AS \"Edition\", text AS \"本文\" FROM store")
def intersect_columns(spark, sf_dir):
    wanted = store(spark, sf_dir).select(F.lit(1).alias("Edition"), F.lit(1).alias("本文"), F.lit(1).alias("other"))
    return shaping.project_known(_saved(spark, sf_dir), wanted.columns)


@query("require_columns", "WITH {store} SELECT title AS \"Title\", issue_date AS \"Date\" FROM store")
def require_columns(spark, sf_dir):
    out = store(spark, sf_dir).select(F.col("title").alias("Title"), F.col("issue_date").alias("Date"))
    shaping.require_columns(out.columns)
    return out


# ---- SQL surface ----


@query(
    "sql_functions",
    "WITH {art} SELECT article_id, "
    + "regexp_matches(title, '[\\x{3040}-\\x{30ff}\\x{4e00}-\\x{9fff}]') AS ja, "
    + f"{s_strip('body')} AS stripped FROM art",
)
def sql_functions(spark, sf_dir):
    SQL.register(spark)
    a = art(spark, sf_dir)
    return a.select("article_id", F.expr("is_japanese_text(title)").alias("ja"), F.expr("strip_text(body)").alias("stripped"))


@query("text_blocks", CHUNKED.replace(") AS pos, unnest(chunks) AS chunk", ") AS pos, unnest(chunks) AS block"))
def text_blocks(spark, sf_dir):
    SQL.register(spark)
    return spark.sql("SELECT a.article_id, b.pos, b.block FROM {art} a, LATERAL text_blocks(a.body, 1800) b", art=art(spark, sf_dir))
