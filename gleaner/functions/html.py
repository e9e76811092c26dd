"""Markup columns by pattern. What needs the nesting of elements lives in ``gleaner.operators.elements``."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.text import as_col, let, squeeze, strip, text

ANCHOR = r"(?is)<a\b([^>]*\bhref\s*=\s*[\"'][^\"']*[\"'][^>]*)>(.*?)</a>"
HREF = r"(?i)\bhref\s*=\s*[\"']([^\"']*)[\"']"
TITLE_ATTR = r"(?i)\btitle\s*=\s*[\"']([^\"']*)[\"']"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"
BLOCK = r"(?is)<(p|li|h1|h2|h3|td|blockquote|pre)(\s[^>]*)?>(.*?)</(?:p|li|h1|h2|h3|td|blockquote|pre)>"
META_TAG = r"(?i)(<meta\b[^>]*>)"
LD_JSON = r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
APP_DATA = r"(?is)<script[^>]*id=[\"']__NEXT_DATA__[\"'][^>]*>(.*?)</script>"
IMAGE = r"(?is)(<img\b[^>]*>)"

# Entities with a meaning of their own here (a no-break blank is a blank).
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: A link with its target quoted or bare, and the target in one of three groups.
LINK = r"""(?is)<a\b([^>]*\bhref\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)[^>]*)>(.*?)</a>"""
TARGET = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def unescape(c: Column) -> Column:
    """Character references decoded once, by number, by the names of HTML 4 or as ``&apos;``; unknown ones stay."""
    names = {name: chr(code) for name, code in name2codepoint.items()} | {e[1:-1]: v for e, v in ENTITIES if "#" not in e} | {"apos": "'"}
    known = F.str_to_map(F.lit("\x01".join(f"{n}\x02{v}" for n, v in names.items())), F.lit("\x01"), F.lit("\x02"))

    def value(name: Column) -> Column:
        digits = F.regexp_extract(name, "([0-9a-fA-F]+)$", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).when(F.startswith(name, F.lit("#")), digits).cast("int")
        fits = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        character = F.when(fits, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        whole = F.concat(F.lit("&"), name, F.lit(";"))
        return F.when(F.startswith(name, F.lit("#")), F.coalesce(character, whole)).otherwise(F.coalesce(F.try_element_at(known, name), whole))

    def decoded(t: Column) -> Column:
        values = F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(1)), value)
        return F.array_join(F.zip_with(F.split(t, REFERENCE, -1), values, lambda part, v: F.concat(part, F.coalesce(v, F.lit("")))), "")

    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def inner_text(c: Column | str) -> Column:
    """Text of a fragment: tags become blanks, blanks squeezed."""
    return strip(squeeze(unescape(F.regexp_replace(as_col(c), "(?s)<[^>]*>", " "))))


def attr(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf"(?i)(?:^|[\s\"'])({name})\s*=\s*[\"']([^\"']*)[\"']", 2)


def anchors(html: Column | str) -> Column:
    """Links in page order: href as written and the visible text, else the title attribute."""
    page = text(html)
    heads = F.regexp_extract_all(page, F.lit(LINK), F.lit(1))
    bodies = F.regexp_extract_all(page, F.lit(LINK), F.lit(2))

    def link(head: Column, body: Column) -> Column:
        shown = inner_text(body)
        return F.struct(
            strip(unescape(F.concat(*[F.regexp_extract(head, TARGET, i) for i in (1, 2, 3)]))).alias("href"),
            F.when(shown != "", shown).otherwise(strip(F.regexp_extract(head, TITLE_ATTR, 1))).alias("title"),
            head.alias("head"),
        )

    return F.filter(F.zip_with(heads, bodies, link), lambda a: a["href"] != "")


def canonical_url(html: Column | str) -> Column:
    page = text(html)
    link = r"(?i)<link\b[^>]*rel=[\"']canonical[\"'][^>]*href=[\"']([^\"']+)[\"']"
    meta = r"(?i)<meta\b[^>]*(?:property|name)=[\"']og:url[\"'][^>]*content=[\"']([^\"']+)[\"']"
    found = F.coalesce(
        F.nullif(F.regexp_extract(page, link, 1), F.lit("")), F.nullif(F.regexp_extract(page, meta, 1), F.lit(""))
    )
    return F.coalesce(strip(found), F.lit(""))


def redirect_url(html: Column | str) -> Column:
    """Target named by a redirect wrapper, empty for an ordinary page."""
    page = text(html)
    script = r"(?i)redirectUrl\s*=\s*['\"]([^'\"]+)['\"]"
    single = r"(?is)google\.navigateTo\('(.*?)'\)"
    double = r'(?is)google\.navigateTo\("(.*?)"\)'
    refresh = r"(?i)<meta\b[^>]*http-equiv=[\"']refresh[\"'][^>]*content=[\"'][^\"']*url=([^\"';>]+)"
    return (
        F.when(page.rlike(script), strip(F.regexp_extract(page, script, 1)))
        .when(page.rlike(single), strip(F.regexp_extract(page, single, 1)))
        .when(page.rlike(double), strip(F.regexp_extract(page, double, 1)))
        .when(page.rlike(refresh), strip(F.regexp_extract(page, refresh, 1)))
        .otherwise(F.lit(""))
    )


def meta_dates(html: Column | str, selector: Column | str = "") -> Column:
    """Contents of meta tags that name and hold a date; an optional text narrows the tags."""
    sel = F.lower(strip(F.lit(selector) if isinstance(selector, str) else text(selector)))
    tags = F.regexp_extract_all(text(html), F.lit(META_TAG), F.lit(1))

    def content(tag: Column) -> Column:
        return strip(attr(tag, "content"))

    def is_date(tag: Column) -> Column:
        marker = F.concat_ws(" ", attr(tag, "property"), attr(tag, "name"), attr(tag, "itemprop"), attr(tag, "http-equiv"))
        return (
            ((sel == "") | F.contains(F.lower(tag), sel))
            & marker.rlike("(?i)date|time|published|publish|modified|updated|article")
            & content(tag).rlike(r"\d{4}[-/]\d{1,2}[-/]\d{1,2}")
        )

    return F.transform(F.filter(tags, is_date), content)


def ld_json_blocks(html: Column | str, selector: Column | str = "") -> Column:
    sel = F.lit(selector) if isinstance(selector, str) else text(selector)
    blocks = F.regexp_extract_all(text(html), F.lit(LD_JSON), F.lit(1))
    return F.filter(blocks, lambda b: (sel == "") | F.contains(b, sel))


#: How many lists and graphs deep a page's structured data is searched.
LD_DEPTH = 12


def news_article_date(html: Column | str) -> Column:
    """Publication date of the first news article in a page's structured data, in lists and nested graphs.

    Blocks without the word are not parsed. Each step puts the items of a list in its place and the graph of an object
    behind it, so that objects stay in page order.
    """
    blocks = F.filter(ld_json_blocks(html), lambda b: F.contains(F.lower(b), F.lit("newsarticle")))
    node = lambda v, done: F.struct(v.alias("v"), F.lit(done).alias("done"))

    def opened(n: Column) -> Column:
        kind, graph = F.schema_of_variant(n["v"]), F.try_variant_get(n["v"], '$["@graph"]', "variant")
        items = F.transform(F.try_variant_get(n["v"], "$", "array<variant>"), lambda v: node(v, False))
        inner = F.when(graph.isNotNull(), F.array(node(n["v"], True), node(graph, False))).otherwise(F.array(node(n["v"], True)))
        return F.when(n["done"], F.array(n)).when(kind.startswith("ARRAY"), items).when(kind.startswith("OBJECT"), inner)

    nodes = F.transform(F.filter(F.transform(blocks, lambda b: F.try_parse_json(strip(b))), lambda v: v.isNotNull()), lambda v: node(v, False))
    for _ in range(LD_DEPTH):
        nodes = F.flatten(F.filter(F.transform(nodes, opened), lambda x: x.isNotNull()))

    def dated(n: Column) -> Column:
        one, many = F.try_variant_get(n["v"], '$["@type"]', "string"), F.try_variant_get(n["v"], '$["@type"]', "array<string>")
        kinds = F.transform(F.coalesce(many, F.array(one)), lambda k: F.lower(strip(k)))
        raw = F.try_variant_get(n["v"], "$.datePublished", "variant")
        day = strip(F.when(F.schema_of_variant(raw) == "STRING", F.try_variant_get(raw, "$", "string")))
        return F.when(n["done"] & F.array_contains(kinds, "newsarticle") & (day != ""), day)

    return F.get(F.array_compact(F.transform(nodes, dated)), F.lit(0))


def embedded_body(html: Column | str) -> tuple[Column, Column]:
    """(body, source) from embedded JSON: structured data first, then application data."""
    blocks = ld_json_blocks(html)

    def body_of(b: Column) -> Column:
        fields = [F.get_json_object(b, f"$.{k}") for k in ("articleBody", "description", "text")]
        listed = [F.get_json_object(b, f"$[0].{k}") for k in ("articleBody", "description", "text")]
        chosen = F.coalesce(*[F.nullif(f, F.lit("")) for f in fields + listed], F.lit(""))
        return strip(chosen)

    structured = F.try_element_at(F.filter(F.transform(blocks, body_of), lambda x: x != ""), F.lit(1))
    data = F.regexp_extract(text(html), APP_DATA, 1)
    raw = F.regexp_extract(data, r'"articleBody":"([^"]{80,})"', 1)
    app = F.nullif(F.replace(F.replace(raw, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit(""))
    body = F.coalesce(structured, app, F.lit(""))
    source = F.when(structured.isNotNull(), F.lit("json_ld")).when(app.isNotNull(), F.lit("next_data")).otherwise(F.lit(""))
    return body, source


def paragraph_texts(html: Column | str) -> Column:
    """Distinct running-text paragraphs of a page, in order."""
    inner = F.regexp_extract_all(text(html), F.lit(PARAGRAPH), F.lit(1))

    def measure(p: Column) -> Column:
        links = F.regexp_extract_all(p, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), F.lit(1))
        shown = inner_text(p)
        link_chars = F.aggregate(links, F.lit(0), lambda acc, a: acc + F.length(inner_text(a)))
        return F.struct(shown.alias("text"), link_chars.alias("link_chars"))

    def keep(p: Column) -> Column:
        t = p["text"]
        nav_hits = sum((F.contains(t, F.lit(w)).cast("int") for w in K.PARAGRAPH_NAV_TERMS), F.lit(0))
        nav_like = (nav_hits >= 2) & (F.length(t) < 120)
        return (F.length(t) >= 20) & (p["link_chars"] < F.length(t) * 0.6) & ~nav_like

    # Only the first copy of a text counts, even when that copy is rejected for its link share.
    placed = F.transform(
        F.transform(inner, measure),
        lambda p, i: F.struct(p["text"].alias("text"), i.alias("pos"), p["link_chars"].alias("link_chars")),
    )
    ordered = F.array_sort(F.filter(placed, lambda p: F.length(p["text"]) >= 20))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform(ordered, lambda p: p["text"]))
    firsts = F.zip_with(ordered, before, lambda p, prev: F.when(prev.isNull() | (prev != p["text"]), p))
    kept = F.filter(firsts, lambda p: p.isNotNull() & keep(p))
    back = F.array_sort(F.transform(kept, lambda p: F.struct(p["pos"].alias("pos"), p["text"].alias("text"))))
    return F.transform(back, lambda p: p["text"])


def block_stats(html: Column | str, min_chars: int = 80, head_chars: int = 300) -> Column:
    """Text blocks of a page with tag, class, id, length and head."""
    page = text(html)
    tags = F.regexp_extract_all(page, F.lit(BLOCK), F.lit(1))
    heads = F.regexp_extract_all(page, F.lit(BLOCK), F.lit(2))
    bodies = F.regexp_extract_all(page, F.lit(BLOCK), F.lit(3))
    zipped = F.arrays_zip(tags.alias("tag"), heads.alias("head"), bodies.alias("body"))

    def row(z: Column) -> Column:
        shown = inner_text(z["body"])
        return F.struct(
            F.upper(z["tag"]).alias("tag"),
            attr(F.coalesce(z["head"], F.lit("")), "class").alias("class_name"),
            attr(F.coalesce(z["head"], F.lit("")), "id").alias("element_id"),
            F.length(shown).alias("text_length"),
            F.left(shown, F.lit(head_chars)).alias("text_head"),
        )

    return F.filter(F.transform(zipped, row), lambda r: r["text_length"] >= min_chars)


def images(html: Column | str) -> Column:
    tags = F.regexp_extract_all(text(html), F.lit(IMAGE), F.lit(1))
    shaped = F.transform(tags, lambda t: F.struct(attr(t, "alt").alias("alt"), attr(t, "src").alias("src")))
    return F.filter(shaped, lambda i: i["src"] != "")


def next_page_href(html: Column | str) -> Column:
    """href of the next page: a ``next`` relation or class, else a link labelled as next; empty if none."""
    marks = lambda a: a["head"].rlike(r"(?i)\brel\s*=\s*[\"']next[\"']") | a["head"].rlike(r"(?i)\bclass\s*=\s*[\"'](?:[^\"']*\s)?(?:next|pagination-next)(?:\s[^\"']*)?[\"']")
    labels = lambda a: F.lower(a["title"]).isin("next", "next >", ">", "older")
    first = lambda links, test: F.try_element_at(F.filter(links, test), F.lit(1))["href"]
    return let(anchors(html), lambda links: F.coalesce(first(links, marks), first(links, labels), F.lit("")))
