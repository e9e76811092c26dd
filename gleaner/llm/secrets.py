"""Secrets in texts: strong patterns, and weak parts of credentials that only count near a complementary part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import let
from gleaner.llm.common import as_text, staged, text_key


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: Strong kinds in their order: pattern, the group that is measured, and its least length.
ASSIGN = f"({_either_case('password|passwd|secret|token|api_?key')}){_VALUE}([A-Za-z0-9+/_.=-]+)"
#: A run of the class is one match, so the least length can stand in the pattern.
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
#: Weak kinds: a named secret of any length or an unnamed key, a login name, an address.
WEAK = f"({_either_case('pwd|pass|passphrase|credential|auth|private_key|secret_key|token|secret|password')}){_VALUE}([A-Za-z0-9+/_.=-]{{4,}})"
IDENTIFIER = f"({_either_case('client_id|access_key_id|account_id|username|user|login')}){_VALUE}([A-Za-z0-9@+_.-]{{3,}})"
ENDPOINT = r"[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20\x22\x27<>]+"
KINDS = ["assign", "access", "hex", "weak_secret", "identifier", "endpoint"]
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def before(values: Column, fold: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For each element of an array of numbers the fold of all earlier ones, 0 for the first.

    Elements are folded within blocks of the cube root of the array's size, and the blocks before each block in the same way with
    one level less, so that n elements take steps of the order n to the power 4/3 and no array grows step by step.
    """
    total = lambda a: F.aggregate(a, F.lit(0), fold)
    inner = lambda block, first: F.transform(block, lambda _, j: fold(first, total(F.slice(block, F.lit(1), j))))

    def joined(blocks: Column, totals: Column) -> Column:
        firsts = before(totals, fold, levels - 1) if levels > 1 else F.transform(totals, lambda _, b: total(F.slice(totals, F.lit(1), b)))
        return F.flatten(F.zip_with(blocks, firsts, inner))

    def whole(v: Column) -> Column:
        wide = F.greatest(F.lit(16), F.ceil(F.pow(F.size(v), F.lit(1 / (levels + 1)))).cast("int"))
        cut = lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / w).cast("int")), lambda b: F.slice(v, b * w + 1, w))
        return let(let(wide, cut), lambda blocks: let(F.transform(blocks, total), lambda totals: joined(blocks, totals)))

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(F.array().cast("array<int>")))


def located(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Spans ``(start, kind, stop)`` of a pattern's leftmost non-overlapping matches, in code points.

    The texts between the matches give the positions: match i starts after the first i + 1 gaps and i matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("hit"), measured.alias("part"))
    lengths = F.transform(zipped, lambda x: F.struct(*[F.length(x[n]).alias(n) for n in ("gap", "hit", "part")]))

    def span(x: Column, at: Column) -> Column:
        start = at + x["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + x["hit"]).alias("stop"), x["part"].alias("part"))

    def spans(sizes: Column) -> Column:
        starts = before(F.transform(sizes, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b)
        long = F.filter(F.zip_with(sizes, starts, span), lambda x: x["part"] >= least)
        return F.transform(long, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))

    return F.when(text.rlike(pattern), let(lengths, spans)).otherwise(F.array().cast(SPAN))


def _apart(found: DataFrame) -> DataFrame:
    """``(_row, start, kind, stop)`` of all strong spans and those parts that overlap none, of rows that have parts.

    A part overlaps a strong span if one that starts no later ends after its start, or one that starts later does so before its end.
    """
    strong = lambda name, flag: F.transform(name, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"), F.lit(flag).alias("strong")))
    each = found.where(F.size("_parts") > 0).select("_row", F.explode(F.concat(strong("base_spans", True), strong("_parts", False))).alias("s")).select("_row", "s.*")
    rows = Window.partitionBy("_row")
    # both run from one end to the other, so that each row is taken up once
    reached = F.max(F.when(F.col("strong"), F.col("stop"))).over(rows.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    coming = F.min(F.when(F.col("strong"), F.col("start"))).over(rows.orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, 0))
    clear = (F.coalesce(reached, F.lit(-1)) <= F.col("start")) & (F.coalesce(coming, F.lit((1 << 31) - 1)) >= F.col("stop"))
    return each.withColumn("_clear", clear).where("strong OR _clear").select("_row", "start", "kind", "stop")


def _linked(found: DataFrame, window: int) -> DataFrame:
    """Add ``all_spans``: the strong spans and the weak ones with a complement in reach."""
    number = {k: i for i, k in enumerate(KINDS)}
    spans = _apart(found)
    is_secret = F.col("kind").isin(number["assign"], number["hex"], number["weak_secret"])
    bins = lambda wide: F.explode(F.sequence(F.floor((F.col("start") - wide) / window), F.floor((F.col("stop") + wide) / window))).alias("bin")
    others = spans.select(F.col("_row").alias("r"), F.col("start").alias("a"), F.col("stop").alias("b"), is_secret.alias("secret"), bins(0))
    weak = spans.where(F.col("kind").isin(number["weak_secret"], number["identifier"])).select("_row", "start", "kind", "stop", (~is_secret).alias("wants"), bins(window))
    reach = (F.col("a") <= F.col("stop") + window) & (F.col("b") >= F.col("start") - window)
    near = weak.join(others, (F.col("_row") == F.col("r")) & (weak["bin"] == others["bin"]) & (F.col("wants") == F.col("secret")) & reach, "left_semi")
    kept = near.groupBy("_row").agg(F.collect_set(F.struct("start", "kind", "stop")).alias("_linked"))
    joined = found.join(kept, "_row", "left")
    return joined.withColumn("all_spans", F.array_sort(F.concat("base_spans", F.coalesce("_linked", F.array().cast(SPAN))))).drop("_linked", "_parts")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def secret_spans(docs: DataFrame, window: int = 200) -> DataFrame:
    """``(doc_id, text_key, base_spans, all_spans)`` for each document; spans ``(start, kind, stop)`` by start, then kind.

    Strong kinds always count. Access keys, weak secrets, login names and endpoints are parts: a weak secret counts
    only if an access key, login name or endpoint lies within ``window`` code points, a login name only if any secret
    does. Parts meet in an interval semi-join on document and scope bin, so no pairs come out. Endpoints never count by
    themselves. Texts are read once, into a slim table of spans.

    A null or empty text has no spans; a part that overlaps a strong span is that span. Rows are told apart by place,
    so repeated rows and null ids come out as often as they come in; other columns are ignored.
    """
    text = as_text("text")
    base = F.array_sort(F.concat(located(text, ASSIGN, "assign", 2, 8), located(text, ACCESS, "access"), located(text, HEX, "hex")))
    parts = F.concat(located(text, WEAK, "weak_secret"), located(text, IDENTIFIER, "identifier"), located(text, ENDPOINT, "endpoint"))
    slim = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), base.alias("base_spans"), parts.alias("_parts"), F.monotonically_increasing_id().alias("_row"))
    found = staged(slim, "secrets")
    return _linked(found, window).drop("_row")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with the mark in place of each span, given by start; spans that overlap or adjoin share one.

    What stays is cut out block by block: a substring is read from the start of its text, so those of many spans are taken from
    pieces of the text and not each from the whole.
    """
    stops = lambda all_: before(F.transform(all_, lambda s: s["stop"]), lambda a, b: F.greatest(a, b))
    gap = lambda s, at: F.struct(at.alias("from"), s["start"].alias("to"))

    def opening(all_: Column) -> Column:
        """The stretches before the spans that share no mark with an earlier one."""
        return F.filter(F.zip_with(all_, stops(all_), gap), lambda g, i: (i == 0) | (g["to"] > g["from"]))

    def kept(gaps: Column, w: Column) -> Column:
        def block(b: Column) -> Column:
            return let(F.slice(gaps, b * w + 1, w), lambda own: let(F.get(own, F.lit(0))["from"], lambda first: cut(own, first)))

        def cut(own: Column, first: Column) -> Column:
            piece = F.substring(text, first + 1, F.get(own, F.size(own) - 1)["to"] - first)
            return let(piece, lambda t: F.array_join(F.transform(own, lambda g: F.concat(F.substring(t, g["from"] - first + 1, g["to"] - g["from"]), F.lit(mark))), ""))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / w).cast("int")), block), "")

    def whole(gaps: Column) -> Column:
        wide = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(gaps))).cast("int"))
        return let(wide, lambda w: kept(gaps, w))

    last = F.array_max(F.transform(spans, lambda s: s["stop"]))
    marked = F.concat(let(spans, lambda all_: let(opening(all_), whole)), F.substring(text, last + 1, F.length(text)))
    return F.when(F.size(spans) > 0, marked).otherwise(text)
