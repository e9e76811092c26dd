"""Elements of pages as rows: a place in the page, an end, a tag; selectors as predicates on them.

A page is cut into tags and texts; a running sum over the page gives each tag its level, and an element ends at the next
tag of its level. Every start tag opens a level and every end tag closes one, void tags excepted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gleaner.functions.html import TARGET, unescape
from gleaner.functions.text import let, squeeze, strip

#: Comments, scripts and styles are one piece each, so that what is in them opens nothing.
PIECE = r"(?is)(<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<[^>]*>|[^<]+)"
#: Tags that never hold anything.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]


def pieces(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, pos, piece, tag, closes, opens, shown, level)`` for each tag and text; a text has an empty tag and is ``shown``."""
    cut = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(PIECE), F.lit(1))).alias("pos", "piece"))
    whole = F.col("piece").rlike(r"(?is)^<(script|style)\b.*</(script|style)>$")
    tag = F.lower(F.regexp_extract("piece", r"^</?([A-Za-z][\w:-]*)", 1))
    named = cut.withColumn("tag", tag).withColumn("closes", (F.col("tag") != "") & F.startswith("piece", F.lit("</")))
    alone = whole | F.col("tag").isin(VOID) | F.endswith("piece", F.lit("/>"))
    marked = named.withColumn("opens", (F.col("tag") != "") & ~F.col("closes") & ~alone)
    change = F.when(F.col("opens"), 1).when(F.col("closes"), -1).otherwise(0)
    after = F.sum(change).over(Window.partitionBy(key).orderBy("pos"))
    shown = (F.col("tag") == "") & ~F.startswith("piece", F.lit("<"))
    return marked.withColumns({"shown": shown, "level": F.when(F.col("opens"), after).otherwise(after + 1)})


def elements(cut: DataFrame, key: str) -> DataFrame:
    """``(key, pos, stop, tag, head, parent)``: each element with the place of its end and of its parent's start."""
    ends = F.lead("pos").over(Window.partitionBy(key, "level").orderBy("pos"))
    last = F.lit((1 << 31) - 1)
    bound = cut.where(F.col("opens") | F.col("closes")).withColumn("stop", F.coalesce(ends, last))
    holding = bound.where("opens").select(key, "pos", "stop", "tag", F.col("piece").alias("head"), "level")
    single = cut.where("tag <> '' AND NOT opens AND NOT closes").select(key, "pos", F.col("pos").alias("stop"), "tag", F.col("piece").alias("head"), "level")
    return holding.unionByName(single)


def attribute(head: str, name: Column) -> Column:
    """The value of an attribute whose name is a column; empty if it is not there."""
    frame = {"head": F.col(head), "name": name}
    pattern = F.concat(F.lit(r"(?is)[\s\"']"), frame["name"], F.lit(r"\s*=\s*[\"']([^\"']*)[\"']"))
    return F.coalesce(F.call_function("regexp_extract", frame["head"], pattern, F.lit(1)), F.lit(""))


def matches(part: Column, head: str = "head") -> Column:
    """Whether an element (``tag`` and its start tag) fits one simple selector: tag, id and classes, or one attribute."""
    by_attribute = F.startswith(part, F.lit("["))
    name, value = F.regexp_extract(part, r"^\[([\w-]+)", 1), F.regexp_extract(part, r'="([^"]*)"', 1)
    have = attribute(head, name)
    fits = F.when(F.contains(part, F.lit("*=")), F.contains(have, value)).when(F.contains(part, F.lit("=")), have == value).otherwise(have != "")
    wanted = F.regexp_extract(part, r"^([A-Za-z][\w-]*)", 1)
    ident = F.regexp_extract(part, r"#([\w-]+)", 1)
    classes = F.regexp_extract_all(part, F.lit(r"\.([\w-]+)"), F.lit(1))
    own = F.split(attribute(head, F.lit("class")), r"\s+")
    simple = (
        ((wanted == "") | (F.lower(wanted) == F.col("tag")))
        & ((ident == "") | (attribute(head, F.lit("id")) == ident))
        & (F.size(F.array_except(classes, own)) == 0)
    )
    return F.when(by_attribute, fits).otherwise(simple)


def select_first(pages: DataFrame, key: str, selectors: Column, longest: int, html: str = "html") -> DataFrame:
    """``(key, selector, found, tag, datetime, text)``: the first element of each page for each of its selectors.

    ``selectors`` is an array for each page; a selector is a descendant chain of at most ``longest`` simple ones. An
    element counts if elements for the earlier parts, outermost first, enclose it; the chain is a series of semi-joins
    within the page. Text is the texts inside in page order, blanks squeezed.
    """
    cut = pieces(pages, key, html)
    asked = pages.select(key, F.explode(F.array_distinct(selectors)).alias("selector"))
    parts = asked.select(key, "selector", F.posexplode(F.split(F.trim("selector"), r"\s+")).alias("step", "part"), F.size(F.split(F.trim("selector"), r"\s+")).alias("steps"))
    fitting = elements(cut, key).join(parts, key).where(matches(F.col("part"))).select(key, "selector", "step", "steps", "pos", "stop", "tag", "head")
    held, done = fitting.where("step = 0"), []
    for step in range(longest):
        done.append(held.where(F.col("steps") == step + 1))
        outer = held.select(F.col(key).alias("_k"), F.col("selector").alias("_s"), F.col("pos").alias("_a"), F.col("stop").alias("_b"))
        inside = (F.col(key) == F.col("_k")) & (F.col("selector") == F.col("_s")) & (F.col("_a") < F.col("pos")) & (F.col("stop") <= F.col("_b"))
        held = fitting.where(F.col("step") == step + 1).join(outer, inside, "left_semi")
    first = reduce(DataFrame.unionByName, done).groupBy(key, "selector").agg(F.min(F.struct("pos", "stop", "tag", "head")).alias("e")).select(key, "selector", "e.*")
    texts = cut.where("tag = '' AND NOT startswith(piece, '<')").select(F.col(key).alias("_k"), F.col("pos").alias("_p"), "piece")
    within = first.join(texts, (F.col(key) == F.col("_k")) & (F.col("_p") > F.col("pos")) & (F.col("_p") < F.col("stop")))
    joined = within.groupBy(key, "selector").agg(F.array_sort(F.collect_list(F.struct("_p", "piece"))).alias("t"))
    text = strip(squeeze(unescape(F.array_join(F.transform("t", lambda x: x["piece"]), " "))))
    answers = first.join(joined, [key, "selector"], "left").select(key, "selector", "tag", F.trim(attribute("head", F.lit("datetime"))).alias("datetime"), text.alias("text"))
    found = F.col("tag").isNotNull()
    return asked.join(answers, [key, "selector"], "left").select(key, "selector", found.alias("found"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("tag", "datetime", "text")])


def up_to(key: str) -> WindowSpec:
    """The page so far, the piece itself included."""
    return Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)


def _spans(cut: DataFrame, key: str, closing: bool = False) -> DataFrame:
    """Tags that open or stand alone (and those that close), with ``stop`` and the texts inside as the range ``since`` to ``until`` of the page's."""
    counted = cut.withColumn("since", F.sum(F.col("shown").cast("long")).over(up_to(key)))
    end = lambda name: F.coalesce(F.lead(name).over(Window.partitionBy(key, "level").orderBy("pos")), F.lit((1 << 31) - 1))
    holding = counted.where("opens OR closes").withColumns({"stop": end("pos"), "until": end("since")})
    alone = counted.where("tag <> '' AND NOT opens AND NOT closes").withColumns({"stop": F.col("pos"), "until": F.col("since")})
    return (holding if closing else holding.where("opens")).unionByName(alone)


def _said(texts: Column, since: Column, until: Column) -> Column:
    part = F.slice(texts, (since + 1).cast("int"), F.greatest(F.lit(0), F.least(until, F.size(texts)) - since).cast("int"))
    return F.coalesce(strip(squeeze(F.array_join(part, " "))), F.lit(""))


def links_in_context(
    pages: DataFrame, key: str, html: str = "html", selector: Column | None = None, pattern: Column | None = None, link: Column | None = None, longest: int = 3
) -> DataFrame:
    """``(key, pos, href, title, selected, around)``: each link with its own text, else its ``title``, and that of the element around it.

    ``selected`` is the text of the first element inside the link that fits the page's simple ``selector``. With a ``pattern`` for
    each page ``around`` is only its first match there. With ``link``, a chain of at most ``longest`` simple selectors for each page,
    only links that fit are given; all are where it is empty.

    A link's parent is the last element that opened on the level above: one running column over links and elements by level, so rows
    are as many as tags and texts. Texts are cut out of the page's texts in order, the one around links once for each parent. Pages are
    dealt out by ``key`` before they are cut up, so that their markup moves and not the many rows made of it.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = pieces(pages.select(key, html).repartition(parts, key), key, html)
    spans = _spans(cut, key)
    target = strip(unescape(F.concat(*[F.regexp_extract("piece", TARGET, i) for i in (1, 2, 3)])))
    found = spans.where("tag = 'a'").withColumn("href", target).where("href <> ''")
    place, nothing = ["pos", "since", "until"], F.lit(None).cast("string")
    below = found.select(key, (F.col("level") - 1).alias("level"), *place, "href", F.trim(attribute("piece", F.lit("title"))).alias("named"))
    both = spans.where("opens").select(key, "level", *place, nothing.alias("href"), nothing.alias("named")).unionByName(below)
    earlier = (Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("href").isNull(), F.struct(*place)), ignorenulls=True).over(Window.partitionBy(key, "level").orderBy("pos").rowsBetween(*earlier))
    links = both.withColumn("up", F.coalesce(opened, F.struct(*place))).where("href IS NOT NULL").select(key, *place, "href", "named", "up")
    if link is not None:
        wanted = select_all(pages, key, link, longest, html).select(key, "pos", F.lit(True).alias("_fits"))
        free = pages.select(key, (F.coalesce(F.trim(link), F.lit("")) == "").alias("_free"))
        links = links.join(free, key).join(wanted, [key, "pos"], "left").where("_free OR _fits").drop("_free", "_fits")
    part = F.lit(None).cast("struct<since:bigint,until:bigint>")
    if selector is not None:
        asked = pages.select(key, F.coalesce(F.trim(selector), F.lit("")).alias("part")).where("part <> ''")
        # the link a tag is in: the last one that opened, if its end is still to come
        current = F.last(F.when(F.col("tag") == "a", F.struct("pos", "stop")), ignorenulls=True).over(Window.partitionBy(key).orderBy("pos").rowsBetween(*earlier))
        tags = spans.join(asked, key).withColumn("_a", current).where("stop < _a.stop").where(matches(F.col("part"), "piece"))
        inside = tags.groupBy(key, F.col("_a.pos").alias("pos")).agg(F.min(F.struct(*place)).alias("_in"))
        links, part = links.join(inside, [key, "pos"], "left"), F.when(F.col("_in").isNotNull(), F.struct("_in.since", "_in.until"))
    given = F.array_sort(F.collect_list(F.struct(*place, "href", "named", F.col("up.pos").alias("up"), part.alias("part"))))
    listed = links.groupBy(key).agg(given.alias("links"), F.array_distinct(F.collect_list("up")).alias("ups"))
    read = cut.where("shown").select(key, F.struct("pos", unescape(F.col("piece")).alias("text")).alias("x"))
    texts = read.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["text"]).alias("texts"))
    rows = listed.join(texts, key, "left")
    if pattern is not None:
        rows = rows.join(pages.select(key, F.nullif(pattern, F.lit("")).alias("_pattern")), key)

    def around(u: Column) -> Column:
        said = _said(F.col("texts"), u["since"], u["until"])
        return said if pattern is None else F.coalesce(F.trim(F.regexp_substr(said, F.col("_pattern"))), F.lit(""))

    def shown(x: Column, known: Column) -> Column:
        selected = F.when(x["part"].isNotNull(), _said(F.col("texts"), x["part"]["since"], x["part"]["until"])).otherwise(F.lit(""))
        title = F.coalesce(F.nullif(_said(F.col("texts"), x["since"], x["until"]), F.lit("")), x["named"])
        return F.struct(x["pos"].alias("pos"), x["href"].alias("href"), title.alias("title"), selected.alias("selected"), F.try_element_at(known, x["up"]).alias("around"))

    known = F.map_from_entries(F.transform("ups", lambda u: F.struct(u["pos"].alias("pos"), around(u).alias("text"))))
    return rows.select(key, F.explode(let(known, lambda k: F.transform("links", lambda x: shown(x, k)))).alias("x")).select(key, "x.*")


def select_all(pages: DataFrame, key: str, selector: Column, longest: int = 3, html: str = "html") -> DataFrame:
    """``(key, pos, stop, since, until, tag, piece)``: every element that fits the page's descendant chain of simple selectors.

    Running columns for each part of the chain: an element fits a part if it does so itself and stands inside one that fits the part
    before, which the number of such elements open at its place tells. A longer chain than ``longest`` fits nothing.
    """
    chain = F.split(F.trim(selector), r"\s+")
    asked = pages.where(F.coalesce(F.trim(selector), F.lit("")) != "")  # other pages are not cut up
    rows = _spans(pieces(asked, key, html), key, closing=True).join(asked.select(key, chain.alias("parts")), key)
    by_place, by_level = Window.partitionBy(key).orderBy("pos"), Window.partitionBy(key, "level").orderBy("pos")
    earlier = (Window.unboundedPreceding, -1)
    tag = F.col("opens") | F.col("closes")
    hit, inside = F.lit(False), F.lit(True)
    for step in range(longest):
        part = F.get("parts", F.lit(step))
        rows = rows.withColumn("_own", F.coalesce(inside & ~F.col("closes") & matches(part, "piece"), F.lit(False)))
        ended = F.last(F.when(tag, F.col("_own") & F.col("opens")), ignorenulls=True).over(by_level.rowsBetween(*earlier))
        rows = rows.withColumn("_change", (F.col("_own") & F.col("opens")).cast("int") - F.when(tag & ended, 1).otherwise(0))
        rows = rows.withColumn("_hit", hit | (F.col("_own") & (F.size("parts") == step + 1)))
        rows = rows.withColumn("_open", F.coalesce(F.sum("_change").over(by_place.rowsBetween(*earlier)), F.lit(0)))
        hit, inside = F.col("_hit"), F.col("_open") > 0
    return rows.where("_hit").select(key, "pos", "stop", "since", "until", "tag", "piece")


def list_date(pattern: Column) -> tuple[Column, Column]:
    """(date text, source) of a link in its context: the selected text inside it, else a match in the text around it."""
    matched = F.trim(F.regexp_substr("around", F.nullif(pattern, F.lit(""))))
    selected = F.nullif(F.col("selected"), F.lit(""))
    source = F.when(selected.isNotNull(), F.lit("list_selector")).when(matched.isNotNull(), F.lit("list_regex")).otherwise(F.lit("failed"))
    return F.coalesce(selected, matched, F.lit("")), source
