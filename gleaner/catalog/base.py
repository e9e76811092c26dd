"""Registry of named queries and the shared input views, built the same way for Spark and for the SQL check.

A query takes ``(spark, sf_dir)``. Its SQL twin may use the views below by name: ``{art}``, ``{entries}``,
``{links}`` and ``{store}`` expand to the matching common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import dates as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- fixture texts ----------------------------------------------------------------------------
# The driver's documents hold no Japanese text, so every article is given some: one of these titles and
# bodies by document number. All rows and whole texts are used.

TITLES = [
    "鉄鋼大手が電炉に投資（速報）",
    "新社長に 山田太郎氏",
    "プロ野球 阪神が首位",
    "三菱商事、データセンター建設を拡大",
    "決算説明会 参加者募集【公式】",
    "訃報 元会長が死去",
    "インドの関税と半導体",
    "朝刊・夕刊 3月12日付",
    "市況",
    "人事 異動のお知らせ",
    "将棋 名人戦",
    "日銀の金利と為替",
    "M&A: 資本提携。商社が買収",
    "米国 AI Data Center と ai steel",
    "12日",
    "物流コラム - 日本経済新聞",
]
BODIES = [
    "鉄鋼の需要が増えた。価格も上がった。\n電炉への投資が続く。各社は設備の更新を急いでいる。\n共有\n保存\n[有料会員限定]",
    "速報\nアクセスランキング\nトピック一覧\nメディア一覧\nhttps://example.com/a\n▶ 次へ",
    "人事記事をもっと見る\n役員の異動",
    "ログインしてください。会員登録はこちら\n日経IDでログイン、会員登録",
    "この記事は会員限定です。続きは会員限定\n購読のご案内",
    "メニュー\nサイトマップ\nプライバシー",
    "データセンター向けの電力需要が急増。半導体の投資も拡大する。商社は物流を強化。インドの関税も影響。\n"
    "印刷 翻訳\n1234文字\n詳しくはこちら\nデータセンター向けの電力需要が急増。半導体の投資も拡大する。\n<br>Steel and ai trade.",
    "Access Denied 403\nForbidden",
    "就任あいさつ。社長は山田氏。\n山田氏の記事はこちら",
    "物流の話題。海上運賃が下がる。港湾の混雑が続く。\n物流の話題。海上運賃が下がる。港湾の混雑が続く。\n関連記事を\n",
    "スポーツと芸能、俳優の話題。\n企業での記事共有や会議資料への転載・複製は不可",
    "為替と金利。日銀が会合。米国の経済。\r\n\r\n\r\n企業の決算。M&Aも。\u00a0以上。\n保存 共有 印刷 その他",
]


def pick(n: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values)).cast("int") + 1)


def sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_pick(n: str, values: list[str]) -> str:
    return f"list_extract({sql_list(values)}, CAST({n} % {len(values)} AS INTEGER) + 1)"


# ---- views ------------------------------------------------------------------------------------

ART_START = "2024-01-01 00:00:00"


def art(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: one row per document."""
    return articles_of(table(spark, sf_dir, "documents"))


def articles_of(d: DataFrame) -> DataFrame:
    n = F.col("doc_id")
    first_line = F.substring_index("text", "\n", 1)
    snippet, extra = pick(n, TITLES), pick(F.floor(n / 3), BODIES)
    return d.select(
        n.alias("article_id"),
        F.col("source").alias("medium"),
        "lang",
        F.when(n % 5 == 0, snippet).otherwise(F.concat(first_line, F.lit(" "), snippet)).alias("title"),
        F.when(n % 7 == 0, extra)
        .when(n % 7 == 1, F.lit(""))
        .otherwise(F.concat(F.col("text"), F.lit("\n"), extra))
        .alias("body"),
        n.alias("ord"),
        (D.ntz(ART_START) + D.minutes(n)).alias("published"),
        F.concat(F.lit("https://news.example.com/paper/article/?ng=N"), F.floor(n / 2).cast("string")).alias("url"),
    )


ART = f"""art AS (
  SELECT doc_id AS article_id, source AS medium, lang,
    CASE WHEN doc_id % 5 = 0 THEN {sql_pick('doc_id', TITLES)}
         ELSE split_part(text, chr(10), 1) || ' ' || {sql_pick('doc_id', TITLES)} END AS title,
    CASE WHEN doc_id % 7 = 0 THEN {sql_pick('(doc_id // 3)', BODIES)} WHEN doc_id % 7 = 1 THEN ''
         ELSE text || chr(10) || {sql_pick('(doc_id // 3)', BODIES)} END AS body,
    doc_id AS ord, TIMESTAMP '{ART_START}' + to_minutes(doc_id) AS published,
    'https://news.example.com/paper/article/?ng=N' || (doc_id // 2) AS url
  FROM documents)"""

AS_OF = "2024-01-30 12:00:00"
MODES = ["rolling_24h", "calendar_day"]
ZONES = ["Asia/Tokyo", "UTC", "America/New_York"]
ZONE_HOURS = [9, 0, -5]  # offsets in January 2024, for the SQL check


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed feed entries: one row per event; the type is the feed, the user the site."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("ord"),
        F.col("ts").alias("published_utc"),
        F.col("event_type").alias("feed"),
        F.concat(F.lit("site"), (F.col("user_id") % 12).cast("string")).alias("site"),
        F.col("user_id").alias("user_id"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.concat(F.lit("Report "), F.get_json_object("props", "$.k"), F.lit(" - "), F.col("event_type")).alias("title"),
    )


ENTRIES = """entries AS (
  SELECT event_id AS ord, ts AS published_utc, event_type AS feed, 'site' || (user_id % 12) AS site, user_id, value,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    'Report ' || json_extract_string(props, '$.k') || ' - ' || event_type AS title
  FROM events)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming links: every page under its own URL and three written variants of it."""
    p = table(spark, sf_dir, "pages")
    u = F.col("url")
    scheme_cut = F.regexp_replace(u, "^(https?)://([^/]+)", "$1://$2/")
    variants = F.array(
        u,
        F.concat(F.substring_index(u, "#", 1), F.when(F.contains(u, F.lit("?")), F.lit("&")).otherwise(F.lit("?")),
                 F.lit("utm_medium=mail")),
        F.concat(F.substring_index(scheme_cut, "#", 1), F.lit("#part")),
        F.concat(F.lit("https://news.google.com/rss?x=1&url="), F.replace(u, F.lit(":"), F.lit("%3A"))),
    )
    return p.select("page_id", "html", F.posexplode(variants).alias("variant", "link")).select(
        (F.col("page_id") * 4 + F.col("variant")).alias("ord"),
        "page_id",
        "variant",
        "link",
        F.concat(F.lit("Page "), F.floor(F.col("page_id") / 3).cast("string"), F.lit(" (v)")).alias("title"),
        F.regexp_extract("link", "(?:https?://|%3A//)([^/?#]+)", 1).alias("site"),
    )


LINKS = """links AS (
  SELECT page_id * 4 + variant AS ord, page_id, variant, link, 'Page ' || (page_id // 3) || ' (v)' AS title,
    regexp_extract(link, '(?:https?://|%3A//)([^/?#]+)', 1) AS site
  FROM (SELECT page_id, unnest([0, 1, 2, 3]) AS variant, unnest([
      url,
      split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'utm_medium=mail',
      split_part(regexp_replace(url, '^(https?)://([^/]+)', '\\1://\\2/'), '#', 1) || '#part',
      'https://news.google.com/rss?x=1&url=' || replace(url, ':', '%3A')]) AS link FROM pages))"""

STORE_SEEN = "2023-12-31"


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved rows: each page is stored as is, under an equivalent URL, under another path, or without text."""
    p = table(spark, sf_dir, "pages")
    n, u = F.col("page_id"), F.col("url")
    bare = F.substring_index(F.substring_index(u, "#", 1), "?", 1)
    url = (
        F.when(n % 4 == 1, F.concat(F.rtrim(bare, F.lit("/")), F.lit("/")))
        .when(n % 4 == 2, F.concat(bare, F.lit("/archive")))
        .otherwise(u)
    )
    return p.select(
        F.concat(F.lit("pg-"), n.cast("string")).alias("page_id"),
        url.alias("url"),
        F.concat(F.lit("Stored "), n.cast("string")).alias("title"),
        F.when(n % 6 == 0, F.lit(" ")).otherwise(F.concat(F.lit("Body of "), n.cast("string"))).alias("text"),
        F.date_format(F.date_add(F.lit(STORE_SEEN).cast("date"), (n % 30).cast("int") + 1), "yyyyMMdd").alias("issue_date"),
        F.when(n % 2 == 0, F.lit("morning")).otherwise(F.lit("evening")).alias("edition"),
        n.alias("ord"),
    )


STORE = f"""store AS (
  SELECT 'pg-' || page_id AS page_id,
    CASE WHEN page_id % 4 = 1 THEN rtrim(split_part(split_part(url, '#', 1), '?', 1), '/') || '/'
         WHEN page_id % 4 = 2 THEN split_part(split_part(url, '#', 1), '?', 1) || '/archive'
         ELSE url END AS url,
    'Stored ' || page_id AS title,
    CASE WHEN page_id % 6 = 0 THEN ' ' ELSE 'Body of ' || page_id END AS text,
    strftime(DATE '{STORE_SEEN}' + CAST(page_id % 30 + 1 AS INTEGER), '%Y%m%d') AS issue_date,
    CASE WHEN page_id % 2 = 0 THEN 'morning' ELSE 'evening' END AS edition, page_id AS ord
  FROM pages)"""


# ---- SQL fragments for the check --------------------------------------------------------------

_STRIP = K.WHITESPACE.replace("'", "''")


def s_strip(x: str) -> str:
    return f"trim({x}, '{_STRIP}')"


def s_squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{K.WS}+', ' ', 'g')"


def s_any(x: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {sql_text(t)})" for t in terms) + ")"


def s_count(x: str, terms: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({x}, {sql_text(t)}) AS INTEGER)" for t in terms) + ")"


def s_occurrences(x: str, terms: list[str]) -> str:
    return "(" + " + ".join(
        f"CAST((length({x}) - length(replace({x}, {sql_text(t)}, ''))) // {len(t)} AS INTEGER)" for t in terms
    ) + ")"


def s_part(u: str, group: int) -> str:
    return f"regexp_extract({u}, '{K.URL_PARTS}', {group})"


def s_collapse(p: str) -> str:
    inner = f"rtrim(regexp_replace(CASE WHEN {p} = '' THEN '/' ELSE {p} END, '/+', '/', 'g'), '/')"
    return f"CASE WHEN {inner} = '' THEN '/' ELSE {inner} END"


def s_normalize_link(u: str) -> str:
    inner = (
        f"CASE WHEN contains({u}, 'news.google.com') AND contains({u}, 'url=') "
        f"THEN url_decode(regexp_replace({u}, '.*url=', '')) ELSE {u} END"
    )
    return f"regexp_replace({inner}, '&utm_.*', '')"


def s_url_key(u: str) -> str:
    link = s_normalize_link(u)
    host = f"regexp_replace(split_part(regexp_replace(lower({s_part(link, 2)}), '^.*@', ''), ':', 1), '^www[.]', '')"
    return f"CASE WHEN {u} = '' THEN '' ELSE {host} || {s_collapse(s_part(link, 3))} END"


def s_normalize_url(u: str) -> str:
    pairs = (
        f"list_transform(list_sort(list_transform(list_filter(string_split({s_part(u, 4)}, '&'), lambda s: s <> ''), "
        "lambda s: {'k': url_decode(replace(split_part(s, '=', 1), '+', ' ')), "
        "'v': url_decode(replace(s[length(split_part(s, '=', 1)) + 2:], '+', ' '))})), "
        "lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+'))"
    )
    q = f"array_to_string({pairs}, '&')"
    base = f"(lower({s_part(u, 1)}) || '://' || lower({s_part(u, 2)}) || {s_collapse(s_part(u, 3))})"
    return f"CASE WHEN {q} = '' THEN {base} ELSE {base} || '?' || {q} END"


def s_title_key(t: str) -> str:
    x = f"regexp_replace(lower({t}), '（.*?）|\\(.*?\\)', '', 'g')"
    x = f"regexp_replace({x}, '-.*$', '')"
    x = f"regexp_replace({x}, 'reuters|bloomberg|yahoo|msn|dメニュー|ロイター', '', 'g')"
    return f"trim(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def s_lines(x: str) -> str:
    """Stripped non-blank lines."""
    return (
        f"list_filter(list_transform(regexp_split_to_array({x}, '{K.LINE_BREAK}'), lambda s: {s_strip('s')}), "
        "lambda s: s <> '')"
    )


def s_article_key(u: str, id_param: str = "ng") -> str:
    """Key of a URL whose parameters need no decoding."""
    aid = f"regexp_extract({s_part(u, 4)}, '(?:^|&){id_param}=([^&]+)', 1)"
    p = f"rtrim({s_part(u, 3)}, '/')"
    return (
        f"CASE WHEN {aid} <> '' THEN '{id_param}:' || {aid} "
        f"ELSE lower({s_part(u, 2)}) || CASE WHEN {p} = '' THEN '/' ELSE {p} END END"
    )


_VIEWS = {"{art}": ART, "{entries}": ENTRIES, "{links}": LINKS, "{store}": STORE}


def expand(sql: str) -> str:
    for name, body in _VIEWS.items():
        sql = sql.replace(name, body)
    return sql.strip()
