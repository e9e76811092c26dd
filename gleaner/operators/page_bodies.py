"""Body candidates of pages: texts under known selectors as differences of running columns, without any join of texts to elements."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.html import unescape
from gleaner.functions.text import let, squeeze, strip
from gleaner.operators.elements import pieces, up_to

#: Tags that begin a line of text of their own.
LINE_TAGS = [
    "address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul",
]
CANDIDATE = "struct<selector:string,text:string,text_length:int,paragraph_count:int,link_text_ratio:double>"
TEXTS = "array<struct<pos:int,line:bigint,text:string>>"
FOUND = "array<struct<pos:int,since:bigint,links:bigint,until:bigint,links_until:bigint,which:array<int>>>"
BODY_FALLBACK = "document.body.innerText fallback"
#: Shortest text of a paragraph, and the largest share of links in one.
SHORTEST, MOST_LINKS = 20, 0.6


def fits(part: str, tag: str = "tag", head: str = "piece") -> Column:
    """Whether a start tag fits a simple selector that is known beforehand: tag and classes, or one attribute."""
    have = lambda name: F.regexp_extract(head, rf"(?is)[\s\"']{name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    if given := re.fullmatch(r'\[([\w-]+)(?:(\*?=)"([^"]*)")?\]', part):
        name, sign, value = given.groups()
        if sign is None:
            return F.col(head).rlike(rf"(?i)[\s\"']{name}(?=[\s=>/\"'])")
        return F.contains(have(name), F.lit(value)) if sign == "*=" else have(name) == value
    wanted, *classes = part.split(".")
    own = F.split(have("class"), r"\s+")
    return reduce(Column.__and__, ([F.col(tag) == wanted.lower()] if wanted else []) + [F.array_contains(own, c) for c in classes])


def lines(text: Column) -> Column:
    """Blanks squeezed within lines, empty lines gone."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"[^\S\n]+", " "), r" ?\n\s*", "\n"))


def body_candidates(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, candidates)``: for each page the texts under the known body selectors, its paragraphs, and the whole body.

    A candidate is ``selector, text, text_length, paragraph_count, link_text_ratio``. Boilerplate elements are left out with all they
    hold; an element's text is what stands between its start and end, a line for each block, blanks squeezed; the texts of several
    elements are joined by lines. A page without such an element has an empty text there. Paragraphs are distinct texts of 20 characters
    and more, of which links are less than 60 %; there is no such candidate without any.

    Everything is running columns over the page: how many boilerplate elements are open, how many texts, lines and characters of links
    came before. An element is the difference of two of them; its texts are a stretch of the page's, cut out where the page is one row again.
    """
    cut = pieces(pages, key, html)
    boiler = reduce(Column.__or__, [fits(x) for x in [*K.REMOVED_SELECTORS, "head"]])
    tags = F.col("opens") | F.col("closes")
    so_far = up_to(key)

    def ended(flag: Column) -> Column:
        """Whether this tag ends an element of which the flag holds: the tag before it on its level."""
        before = Window.partitionBy(key, "level").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(tags & F.last(F.when(tags, flag), ignorenulls=True).over(before), F.lit(False)).cast("int")

    marked = cut.withColumn("_out", F.col("opens") & boiler).withColumn("_change", F.col("_out").cast("int") - ended(F.col("_out")))
    # the tag that ends boilerplate may be a start tag; it is kept with what follows
    kept = marked.withColumn("_left", F.sum("_change").over(so_far)).where("_left = 0")
    is_link = (F.col("tag") == "a") & F.col("opens")
    linked = kept.withColumn("_link", is_link.cast("int") - ended(is_link)).withColumn("_in_link", F.sum("_link").over(so_far) > 0)
    shown = linked.withColumn("text", F.when(F.col("shown"), unescape(F.regexp_replace("piece", r"\s+", " "))))
    chars = F.when(F.col("_in_link") & F.col("shown"), F.length(strip(F.col("text")))).otherwise(0)
    summed = shown.withColumns({
        "since": F.sum(F.col("shown").cast("long")).over(so_far), "line": F.sum(F.col("tag").isin(LINE_TAGS).cast("long")).over(so_far), "links": F.sum(chars.cast("long")).over(so_far),
    })
    names = [*K.BODY_SELECTORS, "p", "body"]
    which = F.array_compact(F.array(*[F.when(fits(n), F.lit(i)) for i, n in enumerate(names)]))
    end = F.lead(F.struct("since", "links")).over(Window.partitionBy(key, "level").orderBy("pos"))
    # a paragraph ends at the next tag of a block, closed or not
    backward = Window.partitionBy(key).orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    block = F.last(F.when(F.col("tag").isin([t for t in LINE_TAGS if t != "br"]), F.struct("since", "links")), ignorenulls=True).over(backward)
    elements = summed.where(tags).withColumn("_end", F.when(F.col("tag") == "p", block).otherwise(end)).where("opens").withColumn("which", which).where(F.size("which") > 0)
    listed = F.struct("pos", "since", "links", F.col("_end.since").alias("until"), F.col("_end.links").alias("links_until"), "which")
    found = elements.groupBy(key).agg(F.array_sort(F.collect_list(listed)).alias("found"))
    texts = summed.where("shown").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "line", "text"))).alias("texts"), F.max("links").alias("all_links"))
    rows = pages.select(key).join(texts, key, "left").join(found, key, "left")
    return rows.select(key, _candidates(names).cast(f"array<{CANDIDATE}>").alias("candidates"))


def _joined(part: Column) -> Column:
    """Texts side by side, on a new line where a block began or ended between them."""
    broken = lambda x, i: (i > 0) & (F.get(part, i - 1)["line"] != x["line"])
    return lines(F.array_join(F.transform(part, lambda x, i: F.when(broken(x, i), F.concat(F.lit("\n"), x["text"])).otherwise(x["text"])), ""))


def _measured(name: str, text: Column, links: Column) -> Column:
    size = F.length(text)
    long = F.size(F.filter(F.split(text, "\n"), lambda x: F.length(strip(x)) >= SHORTEST))
    ratio = F.when(size > 0, F.round(links / size, 3)).otherwise(F.lit(0.0))
    return F.struct(F.lit(name).alias("selector"), text.alias("text"), size.alias("text_length"), long.alias("paragraph_count"), ratio.alias("link_text_ratio"))


def _paragraphs(els: Column) -> Column:
    """Of equal paragraphs the first counts, even if it is turned away."""
    flat = F.transform(els, lambda e, i: F.struct(squeeze(e["text"]).alias("text"), i.alias("at"), e["links"].alias("links")))
    ordered = F.array_sort(F.filter(flat, lambda x: F.length(x["text"]) >= SHORTEST))
    firsts = let(ordered, lambda o: F.filter(o, lambda x, i: (i == 0) | (F.get(o, i - 1)["text"] != x["text"])))
    navigates = lambda t: sum((F.contains(t, F.lit(w)).cast("int") for w in K.PARAGRAPH_NAV_TERMS), F.lit(0)) >= 2
    good = F.filter(firsts, lambda x: (x["links"] / F.length(x["text"]) < MOST_LINKS) & ~(navigates(x["text"]) & (F.length(x["text"]) < 120)))
    return F.transform(F.array_sort(F.transform(good, lambda x: F.struct(x["at"].alias("at"), x["text"].alias("text")))), lambda x: x["text"])


def _fallback(paragraphs: Column) -> Column:
    text = F.array_join(paragraphs, "\n\n")
    one = F.struct(F.lit("paragraph_fallback").alias("selector"), text.alias("text"), F.length(text).alias("text_length"), F.size(paragraphs).alias("paragraph_count"), F.lit(0.0).alias("link_text_ratio"))
    return F.when(F.size(paragraphs) > 0, F.array(one)).otherwise(F.array().cast(f"array<{CANDIDATE}>"))


def _candidates(names: list[str]) -> Column:
    """The candidates of a page that is one row: its ``texts`` in order and the elements ``found`` that some selector names."""

    def element(e: Column, texts: Column) -> Column:
        until = F.coalesce(e["until"], F.size(texts).cast("long"))
        part = F.slice(texts, (e["since"] + 1).cast("int"), F.greatest(F.lit(0), until - e["since"]).cast("int"))
        links = F.coalesce(e["links_until"], F.col("all_links"), F.lit(0)) - e["links"]
        return F.struct(let(part, _joined).alias("text"), links.cast("int").alias("links"))

    def candidate(name: str, els: Column) -> Column:
        text = lines(F.array_join(F.transform(els, lambda e: e["text"]), "\n"))
        links = F.aggregate(els, F.lit(0), lambda a, e: a + e["links"])
        return let(F.struct(text.alias("text"), links.alias("links")), lambda c: _measured(name, c["text"], c["links"]))

    def named(name: str) -> Callable[[Column], Column]:
        return lambda els: candidate(name, els)

    def whole(els: Column, texts: Column) -> Column:
        text = F.when(F.size(els) > 0, F.get(els, F.lit(0))["text"]).otherwise(_joined(texts))
        return let(strip(F.regexp_replace(text, K.BODY_MENU, "")), lambda t: _measured(BODY_FALLBACK, t, F.lit(0)))

    def every(texts: Column, found: Column) -> Column:
        of = lambda i: F.transform(F.filter(found, lambda e: F.array_contains(e["which"], i)), lambda e: element(e, texts))
        known = F.array(*[let(of(i), named(n)) for i, n in enumerate(names[:-2])])
        return F.concat(known, let(let(of(len(names) - 2), _paragraphs), _fallback), F.array(let(of(len(names) - 1), lambda els: whole(els, texts))))

    texts, found = F.coalesce("texts", F.array().cast(TEXTS)), F.coalesce("found", F.array().cast(FOUND))
    return let(texts, lambda t: let(found, lambda f: every(t, f)))
