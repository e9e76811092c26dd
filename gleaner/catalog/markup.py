"""Markup functions and jobs over every captured page."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.catalog.base import AS_OF, art, links, pick, query, s_part, s_squeeze, s_strip, sql_list, sql_pick, sql_text, table
from gleaner.functions import dates as D
from gleaner.functions import html as H
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import bodies, elements, page_bodies, ranking, site_watch


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def s_inner(x: str) -> str:
    out = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for name, value in H.ENTITIES:
        out = f"replace({out}, {sql_text(name)}, {sql_text(value)})"
    return s_strip(s_squeeze(out))


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query(
    "read_page_captures",
    f"""SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN {s_part('url', 1)} || '://' || {s_part('url', 2)} || {s_part('url', 3)} ELSE url END AS final_url, length(html) AS chars FROM pages""",
)
def read_page_captures(spark, sf_dir):
    from gleaner.sources.readers import decode_captures

    plain = F.concat(U.scheme("url"), F.lit("://"), U.authority("url"), U.path("url"))
    raw = pages(spark, sf_dir).select(
        "page_id", "url", F.when(F.col("page_id") % 3 == 0, plain).alias("final_url"), F.encode("html", "UTF-8").alias("content"),
        F.lit("utf-8").alias("charset"),
    )
    return decode_captures(raw, keep=["page_id"]).select("page_id", "url", "final_url", F.length("html").cast("bigint").alias("chars"))


#: Put before every page: a bare target, references by name and number, in text and target.
LINKED = "<a href=/b?x=1&amp;y=&#50;>Caf&eacute; &#8212; &#x3042; &unknown; q</a>"


@query(
    "page_links",
    f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, {q(H.ANCHOR)}, 1)) AS head, unnest(regexp_extract_all(html, {q(H.ANCHOR)}, 2)) AS body,
      generate_subscripts(regexp_extract_all(html, {q(H.ANCHOR)}, 1), 1) AS pos FROM pages)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, {s_part('url', 1)} || '://' || {s_part('url', 2)} || trim(regexp_extract(head, {q(H.HREF)}, 1)) AS link, {s_inner('body')} AS title FROM a
    UNION ALL SELECT page_id, 0, {s_part('url', 1)} || '://' || {s_part('url', 2)} || '/b?x=1&y=2', 'Café — あ &unknown; q' FROM pages""",
)
def page_links(spark, sf_dir):
    linked = pages(spark, sf_dir).withColumn("html", F.concat(F.lit(LINKED), "html"))
    return site_watch.page_links(linked, ["page_id"]).select("page_id", "pos", "link", "title")


SELECTED = ["article h1", "nav ul li a", "div.ad", "time.pub", "p b", "div p"]
PIECES_SQL = r"""piece AS (SELECT *, regexp_matches(lower(t), '^<(script|style)\b') AS whole, lower(regexp_extract(t, '^</?([A-Za-z][A-Za-z0-9_:-]*)', 1)) AS tag FROM (
      SELECT page_id, unnest(range(len(x))) AS pos, unnest(x) AS t FROM (
        SELECT page_id, regexp_extract_all(html, '(?is)(<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]*>|[^<]+)', 1) AS x FROM pages))),
    kind AS (SELECT *, tag <> '' AND starts_with(t, '</') AS closes,
      tag <> '' AND NOT starts_with(t, '</') AND NOT whole AND NOT ends_with(t, '/>')
        AND tag NOT IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'track', 'wbr') AS opens FROM piece),
    deep AS (SELECT *, sum(CASE WHEN opens THEN 1 WHEN closes THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY pos) + CASE WHEN opens THEN 0 ELSE 1 END AS level FROM kind),
    el AS (SELECT page_id, pos, tag, t AS head, level, opens, coalesce(lead(pos) OVER (PARTITION BY page_id, level ORDER BY pos), 2147483647) AS stop FROM deep WHERE opens OR closes),
    node AS (SELECT page_id, pos, stop, tag, head, level FROM el WHERE opens
      UNION ALL SELECT page_id, pos, pos, tag, t, level FROM deep WHERE tag <> '' AND NOT opens AND NOT closes),
    txt AS (SELECT page_id, pos, t FROM deep WHERE tag = '' AND NOT starts_with(t, '<'))"""


def s_decoded(x: str) -> str:
    """References by name as text, ``&amp;`` last, so that nothing is decoded twice."""
    named = {f"&{n};": chr(c) for n, c in name2codepoint.items() if n not in ("amp", "nbsp")} | {"&nbsp;": " ", "&#39;": "'", "&apos;": "'"}
    for name, value in [*named.items(), ("&amp;", "&")]:
        x = f"replace({x}, {sql_text(name)}, {sql_text(value)})"
    return x


def s_entities(x: str) -> str:
    return s_strip(s_squeeze(s_decoded(x)))


def _class(name: str) -> str:
    return rf"""list_contains(regexp_split_to_array(regexp_extract(head, '(?is)[\s"'']class\s*=\s*["'']([^"'']*)["'']', 1), '\s+'), '{name}')"""


def _under(*parts: str) -> str:
    """Elements that fit the last part, in elements that fit the parts before it."""
    sql = f"SELECT n0.* FROM node n0 WHERE {parts[0]}"
    for i, part in enumerate(parts[1:], 1):
        sql = f"SELECT n{i}.* FROM node n{i} WHERE {part} AND EXISTS (SELECT 1 FROM ({sql}) o WHERE o.page_id = n{i}.page_id AND o.pos < n{i}.pos AND n{i}.stop <= o.stop)"
    return sql


CHOSEN = {
    "article h1": _under("tag = 'article'", "tag = 'h1'"), "nav ul li a": _under("tag = 'nav'", "tag = 'ul'", "tag = 'li'", "tag = 'a'"),
    "div.ad": _under(f"tag = 'div' AND {_class('ad')}"), "time.pub": _under(f"tag = 'time' AND {_class('pub')}"), "p b": _under("tag = 'p'", "tag = 'b'"),
    "div p": _under("tag = 'div'", "tag = 'p'"), "li": _under("tag = 'li'"), "#none": _under("false"),
}


def selected_sql(names: list[str], columns: str, asked: str) -> str:
    each = " UNION ALL ".join(f"SELECT {sql_text(n)} AS selector, * FROM ({CHOSEN[n]})" for n in names)
    return f"""WITH {PIECES_SQL}, hit AS ({each}), first AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY page_id, selector ORDER BY pos) = 1),
    said AS (SELECT f.page_id, selector, string_agg(txt.t, ' ' ORDER BY txt.pos) AS t FROM first f JOIN txt ON txt.page_id = f.page_id AND txt.pos > f.pos AND txt.pos < f.stop GROUP BY ALL),
    asked AS ({asked})
    SELECT {columns} FROM asked a LEFT JOIN first f ON f.page_id = a.page_id AND f.selector = a.selector LEFT JOIN said s ON s.page_id = a.page_id AND s.selector = a.selector"""


SHOWN = f"coalesce({s_entities('s.t')}, '') AS text"


@query(
    "select_one",
    selected_sql(
        SELECTED, f"a.page_id, a.selector, f.pos IS NOT NULL AS found, coalesce(f.tag, '') AS tag, '' AS datetime, {SHOWN}",
        f"SELECT page_id, unnest([{', '.join(map(sql_text, SELECTED))}]) AS selector FROM pages",
    ),
)
def select_one(spark, sf_dir):
    """The pages' times have no ``datetime``, so that column is empty here; the tests look at one that has."""
    return elements.select_first(pages(spark, sf_dir), "page_id", F.array(*map(F.lit, SELECTED)), longest=4)


ASKED = ["article h1", "li", "div.ad", "#none"]


@query("extract_selectors", selected_sql(ASKED, f"a.page_id, a.selector, {SHOWN}", f"SELECT page_id, {sql_pick('page_id', ASKED)} AS selector FROM pages"))
def extract_selectors(spark, sf_dir):
    """Every page against the selector its site asks for."""
    found = elements.select_first(pages(spark, sf_dir), "page_id", F.array(pick(F.col("page_id"), ASKED)), longest=2)
    return found.select("page_id", "selector", "text")


# Head tags with dates, structured data and application data are put in front of every page.
HEAD_DATES = [
    '<meta name="author" content="x 2020-01-01"><meta property="article:published_time" content=" @T00:00 "><meta name="updated" content="@">',
    '<script type="application/ld+json">{"@type":"NewsArticle","datePublished":"@","articleBody":" Body @ "}</script>',
    '<script type="application/ld+json">[{"@type":"WebPage","description":"About @"}]</script>',
    '<script id="__NEXT_DATA__">{"x":{"articleBody":"' + "long text " * 9 + '@"}}</script>',
    '<img src="/a.png" alt="A @"><img alt="none"><img src="/b.png">',
    '<a class="pager next" href="/p/@">go</a><a href="/other">Next</a>',
    '<a href="/x/@"> Older </a>',
    "",
]
DAY_SQL = "strftime(DATE '2023-12-31' + CAST(page_id % 300 + 1 AS INTEGER), '%Y-%m-%d')"


def headed(spark, sf_dir):
    n = F.col("page_id")
    day = F.date_add(F.lit("2023-12-31").cast("date"), (n % 300).cast("int") + 1).cast("string")
    head = F.replace(pick(n, HEAD_DATES), F.lit("@"), F.concat(day, F.when(n % 8 == 1, F.lit("")).otherwise(F.lit(""))))
    # '@type' keys lose their sign with the placeholder, so it is put back.
    head = F.replace(head, F.concat(F.lit('"'), day, F.lit('type"')), F.lit('"@type"'))
    return pages(spark, sf_dir).select("page_id", "url", F.concat(head, F.col("html")).alias("html"), day.alias("day"))


HEADED = f"""headed AS (SELECT page_id, url, {DAY_SQL} AS day, replace(replace({sql_pick('page_id', HEAD_DATES)}, '@', {DAY_SQL}), '"' || {DAY_SQL} || 'type"', '"@type"') || html AS html FROM pages)"""


@query(
    "meta_dates",
    f"""WITH {HEADED} SELECT page_id, CASE WHEN page_id % 8 = 0 THEN day || 'T00:00|' || day ELSE '' END AS dates, CASE WHEN page_id % 8 = 0 THEN day ELSE '' END AS updated FROM headed""",
)
def meta_dates(spark, sf_dir):
    return headed(spark, sf_dir).select(
        "page_id", F.array_join(H.meta_dates("html"), "|").alias("dates"), F.array_join(H.meta_dates("html", "UPDATED"), "|").alias("updated")
    )


@query(
    "jsonld_blocks",
    f"""WITH {HEADED} SELECT page_id, array_to_string(regexp_extract_all(html, {q(H.LD_JSON)}, 1), '|') AS blocks,
      array_to_string(list_filter(regexp_extract_all(html, {q(H.LD_JSON)}, 1), lambda b: contains(b, 'WebPage')), '|') AS picked FROM headed""",
)
def jsonld_blocks(spark, sf_dir):
    return headed(spark, sf_dir).select(
        "page_id", F.array_join(H.ld_json_blocks("html"), "|").alias("blocks"),
        F.array_join(H.ld_json_blocks("html", "WebPage"), "|").alias("picked"),
    )


@query(
    "jsonld_news_date",
    f"""WITH {HEADED} SELECT page_id, CASE WHEN page_id % 8 = 1 THEN day END AS published FROM headed""",
)
def jsonld_news_date(spark, sf_dir):
    return headed(spark, sf_dir).select("page_id", H.news_article_date("html").alias("published"))


@query(
    "embedded_body",
    f"""WITH {HEADED} SELECT page_id, CASE page_id % 8 WHEN 1 THEN 'Body ' || day WHEN 2 THEN 'About ' || day WHEN 3 THEN '{"long text " * 9}' || day ELSE '' END AS body,
      CASE page_id % 8 WHEN 1 THEN 'json_ld' WHEN 2 THEN 'json_ld' WHEN 3 THEN 'next_data' ELSE '' END AS source FROM headed""",
)
def embedded_body(spark, sf_dir):
    body, source = H.embedded_body("html")
    return headed(spark, sf_dir).select("page_id", body.alias("body"), source.alias("source"))


@query(
    "page_images",
    f"""WITH {HEADED} SELECT page_id, CAST(CASE WHEN page_id % 8 = 4 THEN 2 ELSE 0 END AS INTEGER) AS images,
      CASE WHEN page_id % 8 = 4 THEN 'A ' || day || '=/a.png,=/b.png' ELSE '' END AS listed FROM headed""",
)
def page_images(spark, sf_dir):
    rows = headed(spark, sf_dir).select("page_id", H.images("html").alias("i"))
    first = F.slice("i", 1, 20)
    return rows.select(
        "page_id", F.size("i").alias("images"),
        F.array_join(F.transform(first, lambda i: F.concat(i["alt"], F.lit("="), i["src"])), ",").alias("listed"),
    )


@query(
    "next_page",
    f"""WITH {HEADED} SELECT page_id, CASE page_id % 8 WHEN 5 THEN '/p/' || day WHEN 6 THEN '/x/' || day ELSE '' END AS href FROM headed""",
)
def next_page(spark, sf_dir):
    return headed(spark, sf_dir).select("page_id", H.next_page_href("html").alias("href"))


BLOCKS = f"""blocks AS (SELECT page_id, upper(unnest(regexp_extract_all(html, {q(H.BLOCK)}, 1))) AS tag, unnest(regexp_extract_all(html, {q(H.BLOCK)}, 3)) AS b,
      generate_subscripts(regexp_extract_all(html, {q(H.BLOCK)}, 1), 1) - 1 AS pos FROM pages),
    shown AS (SELECT page_id, tag, pos, {s_inner('b')} AS t FROM blocks),
    long AS (SELECT page_id, tag, t, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS place FROM shown WHERE length(t) >= 80)"""


def block_rows(spark, sf_dir):
    rows = pages(spark, sf_dir).select("page_id", F.posexplode(H.block_stats("html")).alias("place", "b"))
    return rows.select("page_id", "place", "b.tag", "b.text_length", "b.text_head")


@query(
    "block_stats",
    f"WITH {BLOCKS} SELECT page_id, CAST(place AS INTEGER) AS place, tag, CAST(length(t) AS INTEGER) AS text_length, left(t, 300) AS text_head FROM long",
)
def block_stats(spark, sf_dir):
    return block_rows(spark, sf_dir)


@query(
    "longest_blocks",
    f"WITH {BLOCKS} SELECT page_id, tag, CAST(length(t) AS INTEGER) AS text_length, left(t, 300) AS text_head FROM long QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(t) DESC, place) <= 80",
)
def longest_blocks(spark, sf_dir):
    return ranking.first_n(block_rows(spark, sf_dir), ["page_id"], [F.col("text_length").desc(), "place"], 80).drop("place")


NAV_HITS = " + ".join(f"CAST(contains(t, {sql_text(w)}) AS INTEGER)" for w in K.PARAGRAPH_NAV_TERMS)


@query(
    "paragraph_text",
    f"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, {q(H.PARAGRAPH)}, 1)) AS p, generate_subscripts(regexp_extract_all(html, {q(H.PARAGRAPH)}, 1), 1) AS pos FROM pages),
    m AS (SELECT page_id, pos, {s_inner('p')} AS t, coalesce(list_sum(list_transform(regexp_extract_all(p, '(?is)<a\\b[^>]*>(.*?)</a>', 1), lambda a: length({s_inner('a')}))), 0) AS link_chars FROM p),
    f AS (SELECT * FROM m WHERE length(t) >= 20 QUALIFY row_number() OVER (PARTITION BY page_id, t ORDER BY pos) = 1)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS place, t AS paragraph FROM f
    WHERE link_chars < length(t) * 0.6 AND NOT ({NAV_HITS} >= 2 AND length(t) < 120)""",
)
def paragraph_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.posexplode(H.paragraph_texts("html")).alias("place", "paragraph"))


def s_noise(x: str) -> str:
    from gleaner.catalog.quality_gates import NOISE_SQL

    return NOISE_SQL.replace("body", x)


# ---- body candidates: something that a body selector names is put in front of every page's body ----

LEADS = [
    '<div class="cmn-section x"><h2>Lead</h2>Some words &amp; <a href="/l">a link</a> in them, long enough.<br>Next line</div>',
    '<section class="cmn-section cmn-indent"><p>First paragraph of the lead text.</p><p>First paragraph of the lead text.</p><div class="share">x</div></section>',
    '<div itemprop="articleBody">One <b>bold</b>word<script>var a = "<p>no</p>";</script></div><div class="related"><article>other</article></div>',
    '<div data-track-article-body><p><a href="/all">All of this paragraph is one link</a></p></div>',
    '<div class="my-article-body"><ul><li>a</li><li>b</li></ul></div>',
    "",
]
TWICE = "First paragraph of the lead text.\nFirst paragraph of the lead text."
#: For each lead: the candidates that it alone fills, as (selectors, text, paragraphs, link ratio), and the lines it adds to the body.
LEAD_TEXTS = [
    ([".cmn-section"], "Lead\nSome words & a link in them, long enough.\nNext line", 1, 0.107),
    (["section.cmn-section.cmn-indent", ".cmn-section.cmn-indent", ".cmn-section"], TWICE, 2, 0.0),
    (['[itemprop="articleBody"]'], "One boldword", 0, 0.0),
    (["[data-track-article-body]"], "All of this paragraph is one link", 1, 1.0),
    (['[class*="article-body"]', '[class*="article"]'], "a\nb", 0, 0.0),
    ([], "", 0, 0.0),
]


def led(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.regexp_replace("html", F.lit("<body>"), F.concat(F.lit("<body>"), pick(F.col("page_id"), LEADS))).alias("html"))


def s_lines(x: str) -> str:
    """Blocks as lines, other tags gone, blanks squeezed."""
    block = "|".join(page_bodies.LINE_TAGS)
    x = f"regexp_replace(regexp_replace({x}, '\\s+', ' ', 'g'), '(?i)</?({block})\\b[^>]*>', chr(10), 'g')"
    x = s_decoded(f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')")
    return f"trim(regexp_replace(regexp_replace({x}, '[ \\t]+', ' ', 'g'), ' ?\\n\\s*', chr(10), 'g'), ' ' || chr(10))"


def s_shape(text: str, ratio: str = "0.0") -> str:
    long = f"len(list_filter(string_split({text}, chr(10)), lambda y: length(trim(y)) >= 20))"
    return f"{text} AS text, CAST(length({text}) AS INTEGER) AS text_length, CAST({long} AS INTEGER) AS paragraph_count, CAST({ratio} AS DOUBLE) AS link_text_ratio"


BLOCKS_BUT_BR = "|".join(t for t in page_bodies.LINE_TAGS if t != "br")
LEAD_ROWS = ", ".join(f"({k}, {sql_text(n)}, {sql_text(t)}, {p}, CAST({r} AS DOUBLE))" for k, (names, t, p, r) in enumerate(LEAD_TEXTS) for n in names)
BODIES_SQL = f"""lead_own(k, selector, text, n, ratio) AS (VALUES {LEAD_ROWS}),
    lead(k, lines) AS (VALUES {", ".join(f"({k}, {sql_text(t)})" for k, (_, t, _, _) in enumerate(LEAD_TEXTS))}),
    names(selector) AS (VALUES {", ".join(f"({sql_text(n)})" for n in K.BODY_SELECTORS)}),
    tail AS (SELECT page_id, page_id % {len(LEADS)} AS k, regexp_replace(regexp_extract(html, '(?s)</nav>(.*)$', 1), '(?s)<script.*?</script>|<!--.*?-->|<footer>.*?</footer>', '', 'g') AS t FROM pages),
    shown AS (SELECT page_id, k, {s_lines("regexp_extract(t, '(?s)<article>(.*)$', 1)")} AS article, {s_lines("t")} AS body, t FROM tail),
    par AS (SELECT page_id, k, i, {s_lines(f"regexp_replace(x, '(?s)</?({BLOCKS_BUT_BR})\\b.*$', '')").replace("chr(10), 'g'), ' ' || chr(10))", "' ', 'g'), ' ' || chr(10))")} AS x FROM (
      SELECT page_id, k, unnest(z) AS x, generate_subscripts(z, 1) AS i FROM (SELECT page_id, k, string_split_regex(CASE WHEN k = 1 THEN '<p>First paragraph of the lead text.</p>' ELSE '' END || t, '<p>') AS z FROM shown)) WHERE i > 1),
    pars AS (SELECT page_id, k, string_agg(x, chr(10) || chr(10) ORDER BY i) AS text, count(*) AS n FROM (SELECT page_id, k, x, min(i) AS i FROM par WHERE length(x) >= 20 GROUP BY ALL) GROUP BY ALL),
    cand AS (
      SELECT page_id, s.k, names.selector, coalesce(o.text, '') AS text, CAST(length(coalesce(o.text, '')) AS INTEGER) AS text_length, CAST(coalesce(o.n, 0) AS INTEGER) AS paragraph_count, coalesce(o.ratio, 0.0) AS link_text_ratio
      FROM shown s CROSS JOIN names LEFT JOIN lead_own o ON o.k = s.k AND o.selector = names.selector WHERE names.selector <> 'article'
      UNION ALL SELECT page_id, k, 'article', {s_shape("article")} FROM shown
      UNION ALL SELECT page_id, k, 'paragraph_fallback', text, CAST(length(text) AS INTEGER), CAST(n AS INTEGER), CAST(0 AS DOUBLE) FROM pars
      UNION ALL SELECT page_id, k, 'body', {s_shape("b")} FROM (SELECT page_id, s.k, trim(lines || chr(10) || body, chr(10)) AS b FROM shown s JOIN lead USING (k)))"""


@query("body_candidates", f"""WITH {BODIES_SQL} SELECT page_id, selector, text, text_length, paragraph_count, link_text_ratio FROM cand""")
def body_candidates(spark, sf_dir):
    rows = page_bodies.body_candidates(led(spark, sf_dir), "page_id").select("page_id", F.explode("candidates").alias("c")).select("page_id", "c.*")
    named = F.when(F.col("selector") == page_bodies.BODY_FALLBACK, "body").otherwise(F.col("selector"))
    return rows.withColumn("selector", named)


@query(
    "extract_candidates",
    f"""WITH {BODIES_SQL}, usable AS (SELECT *, list_position({sql_list(K.SELECTOR_PREFERENCE)}, selector) AS place FROM cand WHERE text_length > 0 AND link_text_ratio <= 0.6)
    SELECT page_id, arg_min(selector, place) AS selector, CAST(arg_min(text_length, place) AS INTEGER) AS chars FROM usable WHERE place IS NOT NULL AND NOT {s_noise("text")} GROUP BY page_id""",
)
def extract_candidates(spark, sf_dir):
    """The best candidate of every page."""
    chosen = page_bodies.body_candidates(led(spark, sf_dir), "page_id").select("page_id", bodies.choose_candidate(F.col("candidates")).alias("b"))
    return chosen.where("b IS NOT NULL").select("page_id", "b.selector", F.col("b.text_length").alias("chars"))


# Candidates written from each article's own texts.
def candidate_rows(spark, sf_dir):
    o = F.col("ord")

    def one(selector: str, text, ratio):
        return F.struct(
            F.lit(selector).alias("selector"), text.alias("text"), F.length(text).alias("text_length"), ratio.cast("double").alias("link_text_ratio")
        )

    listed = F.array(
        one("article", F.col("body"), (o % 10) / 10), one("main", F.col("title"), F.lit(0)),
        one(".cmn-section", F.when(o % 3 == 0, F.concat("title", F.lit("。"), "body")).otherwise(F.lit("")), (o % 7) / 7),
    )
    return art(spark, sf_dir).select("article_id", "ord", "title", "body", listed.alias("candidates"))


@query(
    "choose_candidate",
    f"""WITH {{art}}, c AS (SELECT article_id, ord, body, title, CASE WHEN ord % 3 = 0 THEN title || '。' || body ELSE '' END AS cmn FROM art)
    SELECT article_id, CASE WHEN cmn <> '' AND (ord % 7) / 7 <= 0.6 AND NOT {s_noise('cmn')} THEN '.cmn-section'
      WHEN body <> '' AND (ord % 10) / 10 <= 0.6 AND NOT {s_noise('body')} THEN 'article'
      WHEN title <> '' AND NOT {s_noise('title')} THEN 'main' ELSE 'none' END AS selector FROM c""",
)
def choose_candidate(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir)
    best = bodies.choose_candidate(F.col("candidates"))
    return rows.select("article_id", F.coalesce(best["selector"], F.lit("none")).alias("selector"))


@query(
    "longest_candidate",
    """WITH {art}, c AS (SELECT article_id, CASE WHEN ord % 3 = 0 THEN title || '。' || body ELSE '' END AS cmn, body, title FROM art)
    SELECT article_id, CASE WHEN cmn <> '' AND length(cmn) >= length(body) AND length(cmn) >= length(title) THEN '.cmn-section' WHEN body <> '' AND length(body) >= length(title) THEN 'article'
      ELSE 'main' END AS selector, CAST(greatest(length(cmn), length(body), length(title)) AS INTEGER) AS chars FROM c""",
)
def longest_candidate(spark, sf_dir):
    rows = candidate_rows(spark, sf_dir)
    best = bodies.longest_candidate(F.col("candidates"))
    return rows.select("article_id", best["selector"].alias("selector"), best["text_length"].alias("chars"))


@query(
    "sample_limit",
    f"""SELECT page_id, array_to_string(regexp_extract_all(html, {q(H.HREF)}, 1)[1:5], ' ') AS first_links FROM pages""",
)
def sample_limit(spark, sf_dir):
    hrefs = F.regexp_extract_all("html", F.lit(H.HREF), F.lit(1))
    return pages(spark, sf_dir).select("page_id", F.array_join(F.slice(hrefs, 1, 5), " ").alias("first_links"))


@query(
    "jsonld_walk",
    f"SELECT page_id, CASE WHEN page_id % 3 <> 2 THEN {DAY_SQL} END AS published FROM pages",
)
def jsonld_walk(spark, sf_dir):
    """A news article four levels down, in lists and nested graphs."""
    n = F.col("page_id")
    day = F.date_add(F.lit("2023-12-31").cast("date"), (n % 300).cast("int") + 1).cast("string")
    deep = pick(
        n,
        [
            '[[{"@graph":{"@type":"WebPage","@graph":[{"@type":["Thing","NewsArticle"],"datePublished":" @D "}]}}]]',
            '{"@graph":[{"@graph":[{"@graph":[{"@type":"newsarticle","datePublished":"@D"}]}]}]}',
            '{"@graph":[{"@type":"Article","datePublished":"@D"}, {"@type":"NewsArticle","datePublished":7}]}',
        ],
    )
    block = F.concat(F.lit('<script type="application/ld+json">'), F.replace(deep, F.lit("@D"), day), F.lit("</script>"))
    return pages(spark, sf_dir).select("page_id", H.news_article_date(F.concat("html", block)).alias("published"))


@query(
    "list_date_text",
    f"""WITH {PIECES_SQL.replace('FROM pages', "FROM (SELECT page_id, '<li>2024/01/05 <a href=''/d''><b>x</b></a></li>' || html AS html FROM pages)")},
    a AS (SELECT page_id, pos, stop, level, trim(regexp_extract(head, '(?is)[\\s"'']href\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href FROM node WHERE tag = 'a'),
    c AS (SELECT a.*, n.pos AS up, n.stop AS until FROM a LEFT JOIN node n ON n.page_id = a.page_id AND n.level = a.level - 1 AND n.pos < a.pos AND a.stop <= n.stop WHERE href <> ''),
    t AS (SELECT c.page_id, c.pos, href, regexp_extract({s_entities("string_agg(txt.t, ' ' ORDER BY txt.pos)")}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') AS d
      FROM c LEFT JOIN txt ON txt.page_id = c.page_id AND txt.pos > c.up AND txt.pos < c.until GROUP BY ALL)
    SELECT page_id, href, coalesce(d, '') AS date_text, CASE WHEN d <> '' THEN 'list_regex' ELSE 'failed' END AS date_source FROM t""",
)
def list_date_text(spark, sf_dir):
    """The date text of every link, from the element around it."""
    dated = pages(spark, sf_dir).withColumn("html", F.concat(F.lit("<li>2024/01/05 <a href='/d'><b>x</b></a></li>"), "html"))
    text, source = elements.list_date(F.lit(r"[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"))
    return elements.links_in_context(dated, "page_id").select("page_id", "href", text.alias("date_text"), source.alias("date_source"))


@query(
    "read_search_results",
    f"""WITH p AS (SELECT page_id, url, page_id % 3 AS kind FROM pages)
    SELECT 'site' || (page_id % 7) AS site, 0 AS pos, 'T ' || page_id AS title, url, CASE WHEN kind = 0 THEN '2024-01-05' ELSE '' END AS date_text,
      CASE WHEN kind = 0 THEN 'search_date' ELSE 'fetched_at' END AS date_source, CASE WHEN kind = 1 THEN 'Src' ELSE 'site' || (page_id % 7) END AS site_name
    FROM p WHERE page_id % 5 <> 0 OR regexp_matches(url, '/en/')""",
)
def read_search_results(spark, sf_dir):
    n = F.col("page_id")
    one = F.struct(
        F.concat(F.lit(" T "), n.cast("string")).alias("title"), F.col("url").alias("link"),
        F.when(n % 3 == 0, F.lit("2024-01-05")).alias("date"), F.lit("s").alias("snippet"),
        F.when(n % 3 == 1, F.lit("Src ")).when(n % 3 == 2, F.lit(" ")).alias("source"),
    )
    blank = F.struct(F.lit(" ").alias("title"), F.lit("https://x.example.com").alias("link"), *[F.lit(None).cast("string").alias(c) for c in ("date", "snippet", "source")])
    payloads = pages(spark, sf_dir).select(
        F.concat(F.lit("site"), (n % 7).cast("string")).alias("site"),
        F.when(n % 5 == 0, F.lit(" /en/ ")).otherwise(F.lit("")).alias("search_url_pattern"),
        F.to_json(F.struct(F.array(one, blank).alias("organic_results"))).alias("payload"),
    )
    return site_watch.search_candidates(payloads, D.ntz(AS_OF)).select("site", "pos", "title", "url", "date_text", "date_source", "site_name")
