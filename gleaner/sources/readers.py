"""Captured inputs as tables. Network fetches are somebody else's job: these read what was saved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from gleaner.functions import jsons as J
from gleaner.operators.shaping import SITE_COLUMNS

FEED_ITEM = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("title", "link", "description", "summary", "pubDate", "published", "updated")
    ]
)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON array files; a path without files is an empty table."""
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(shape).option("multiLine", True).json(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], shape)


def read_feed_items(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Items of captured RSS or Atom files with the file and the position in it; broken files give no rows."""
    items = (
        spark.read.format("xml").option("rowTag", row_tag).option("mode", "DROPMALFORMED").schema(FEED_ITEM).load(path)
    )
    return items.select(
        F.col("_metadata.file_path").alias("feed"),
        F.monotonically_increasing_id().alias("entry_ord"),
        "title",
        F.coalesce("summary", "description").alias("summary"),
        "link",
        F.coalesce("published", "pubDate").alias("published"),
        "updated",
    )


def parse_feeds(feeds: DataFrame, body: str = "xml") -> DataFrame:
    """Items of feeds held as text, numbered in feed order; text that is no feed gives no rows."""
    shape = "struct<channel:struct<item:array<struct<title:string,link:string,description:string,pubDate:string>>>>"
    whole = F.from_xml(F.col(body), shape, {"mode": "PERMISSIVE"})
    kept = [c for c in feeds.columns if c != body]
    rows = feeds.select(*kept, F.posexplode(whole["channel"]["item"]).alias("entry_ord", "_i"))
    return rows.select(
        *kept, "entry_ord", F.col("_i.title").alias("title"), F.col("_i.link").alias("link"),
        F.col("_i.description").alias("summary"), F.col("_i.pubDate").alias("published"),
    )


def read_site_config(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """Site settings from ``{"sites": [...]}`` or a bare array; ``names`` maps saved names to ours."""
    row = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.text(path, wholetext=True)
    nested = F.from_json(F.get_json_object("value", "$.sites"), T.ArrayType(row))
    bare = F.from_json("value", T.ArrayType(row))
    sites = raw.select(F.posexplode(F.coalesce(nested, bare)).alias("config_ord", "s"))
    return sites.select("config_ord", *[F.col(f"s.`{saved}`").alias(ours) for saved, ours in names.items() if ours in SITE_COLUMNS])


PAGE_FILE = "results array<struct<id:string,properties:map<string,string>>>, has_more boolean, next_cursor string"


def read_property_pages(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """Rows of saved result pages: one column for each named property, pages in file order."""
    pages = spark.read.schema(PAGE_FILE).option("multiLine", True).json(path)
    rows = pages.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("results").alias("_pos", "r"))
    return rows.select(
        "_file", "_pos", F.col("r.id").alias("page_id"), *[property_column(F.col("r.properties"), n).alias(ours) for n, ours in names.items()]
    )


def property_column(properties: Column, name: str) -> Column:
    return J.property_value(J.property_by_name(properties, name))


def decode_captures(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Captured pages as text: bytes decoded by their charset with replacement, final URL defaulting to the URL."""
    charset = F.lower(F.coalesce("charset", F.lit("utf-8")))
    html = (
        F.when(charset.isin("iso-8859-1", "latin-1", "latin1"), F.decode("content", "ISO-8859-1"))
        .when(charset.isin("utf-16", "utf16"), F.decode("content", "UTF-16"))
        .when(charset.isin("us-ascii", "ascii"), F.decode("content", "US-ASCII"))
        .otherwise(F.make_valid_utf8(F.col("content").cast("string")))
    )
    return raw.select(*(keep or []), "url", F.coalesce("final_url", "url").alias("final_url"), html.alias("html"))


def read_page_captures(spark: SparkSession, path: str) -> DataFrame:
    return decode_captures(spark.read.parquet(path))
