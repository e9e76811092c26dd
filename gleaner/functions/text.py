"""Text columns: trimming, line handling, keys, cleaning, chunking."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once, so an expression that uses it many times stays small."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def fence(value: Column) -> Column:
    """Compute a costly column once where it stands.

    The optimizer copies a deterministic expression into every filter above it, down to the scan. A condition it
    cannot see through (always true) keeps the value, and the filters on it, in place.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def quote(term: str) -> str:
    """Escape a literal for a Java/RE2 pattern."""
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-/&#~" else ch for ch in term)


def any_of(terms: Iterable[str]) -> str:
    return "|".join(quote(t) for t in terms)


def java_pattern(pattern: str) -> str:
    """Spell out the Unicode reading of ``\\d``, ``\\s`` and ``.`` for Java's ASCII classes."""
    pattern = pattern.removeprefix(".*").removesuffix(".*")  # a search finds the same without them
    inside_class = r"\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}"
    out = pattern.replace(r"[^\s]", f"[^{inside_class}]").replace(r"\d", r"\p{Nd}").replace(r"\s", K.WS)
    # restore the class body that the previous replace expanded
    out = out.replace(K.WS + r"\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]", inside_class + "]")
    return out.replace(".*", r"[^\n]*")


def strip(c: Column | str) -> Column:
    return F.btrim(as_col(c), F.lit(K.WHITESPACE))


def text(c: Column | str) -> Column:
    """Null reads as empty text."""
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def presence(c: Column | str) -> Column:
    """The stripped text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def first_present(*cols: Column | str) -> Column:
    return F.coalesce(*[presence(c) for c in cols], F.lit(""))


def squeeze(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), K.WS + "+", " ")


def contains_any(c: Column | str, terms: Iterable[str]) -> Column:
    """Any of the literal terms. Byte searches are several times faster here than one alternation pattern."""
    wanted = list(terms)

    def search(col: Column) -> Column:
        return reduce(Column.__or__, [F.contains(col, F.lit(t)) for t in wanted])

    return search(F.col(c)) if isinstance(c, str) else let(c, search)


def has_word(low: Column, word: str) -> Column:
    """The word stands alone in the text. A plain search rules most texts out before the pattern runs."""
    return F.contains(low, F.lit(word)) & low.rlike(rf"{word}(?!{K.WORD})(?<!{K.WORD}{word})")


def hits_of(c: Column | str, terms: list[str]) -> Column:
    """Terms of a fixed list that occur in the text, in list order."""
    col = as_col(c)
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(col, t))


def count_terms(c: Column | str, terms: list[str]) -> Column:
    """How many of the terms occur at all."""
    col = as_col(c)
    return sum((F.contains(col, F.lit(t)).cast("int") for t in terms[1:]), F.contains(col, F.lit(terms[0])).cast("int"))


def count_occurrences(c: Column | str, terms: list[str]) -> Column:
    """Sum over terms of the non-overlapping occurrences of each."""
    col = as_col(c)

    def one(t: str) -> Column:
        shorter = F.length(col) - F.length(F.replace(col, F.lit(t), F.lit("")))
        return F.when(F.contains(col, F.lit(t)), (shorter / F.lit(len(t))).cast("int")).otherwise(F.lit(0))

    total = one(terms[0])
    for t in terms[1:]:
        total = total + one(t)
    return total


def lines(c: Column | str) -> Column:
    """Stripped, non-blank lines."""
    return F.filter(F.transform(F.split(as_col(c), K.LINE_BREAK), strip), lambda x: x != "")


def strip_tags(c: Column | str) -> Column:
    return strip(F.regexp_replace(as_col(c), "<[^<]+?>", ""))


# ---- keys -------------------------------------------------------------------------------------


def normalize_title(c: Column | str) -> Column:
    t = F.lower(as_col(c))
    t = F.regexp_replace(t, r"（[^\n]*?）|\([^\n]*?\)", "")
    t = F.regexp_replace(t, r"-[^\n]*$", "")
    t = F.regexp_replace(t, any_of(K.TITLE_SOURCE_NAMES), "")
    t = F.regexp_replace(t, K.NOT_WORD + "+", " ")
    return strip(t)


def title_space_key(c: Column | str) -> Column:
    return squeeze(F.lower(strip(c)))


def cache_key(c: Column | str) -> Column:
    return squeeze(strip(c))


def is_japanese(c: Column | str) -> Column:
    return as_col(c).rlike("[぀-ヿ一-鿿]")


# ---- body cleaning ----------------------------------------------------------------------------


def clean_article_text(c: Column | str) -> Column:
    t = F.replace(text(c), F.lit("\xa0"), F.lit(" "))
    t = F.regexp_replace(t, r"\r\n?", "\n")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def _is_boilerplate(line: Column) -> Column:
    pattern = "|".join(f"(?:{java_pattern(p)})" for p in K.BOILERPLATE_PATTERNS)
    return line.isin(K.BOILERPLATE_LINES) | line.rlike(pattern)


def content_lines(c: Column | str) -> Column:
    """Non-blank lines after turning ``<br>`` into a line break."""
    return lines(F.replace(text(c), F.lit("<br>"), F.lit("\n")))


def drop_boilerplate(line_array: Column) -> Column:
    return F.filter(line_array, lambda x: ~_is_boilerplate(x))


def clean_body(c: Column | str) -> Column:
    return F.array_join(drop_boilerplate(content_lines(c)), "\n")


def clean_report_text(c: Column | str) -> Column:
    t = text(c)
    for noise in K.REPORT_NOISE:
        t = F.replace(t, F.lit(noise), F.lit(" "))
    t = F.regexp_replace(t, r"[\t\r ]+", " ")
    parts = F.transform(F.split(t, "\n"), strip)
    return F.array_join(F.filter(parts, lambda x: F.length(x) > 8), "\n")


def sample_lines(c: Column | str) -> Column:
    """Lines left after removing reader-tool labels."""
    t = F.replace(text(c), F.lit("　"), F.lit(" "))
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    for p in K.SAMPLE_REMOVE_PATTERNS:
        t = F.regexp_replace(t, java_pattern(p), "")
    return F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != "")


def is_trailing_link(line: Column, title: Column | str) -> Column:
    t = strip(text(title))
    named = (t != "") & line.isin(F.concat(t, F.lit("を")), F.concat(t, F.lit("へ")), F.concat(t, F.lit("はこちら")))
    short = (F.length(line) <= 40) & ~line.rlike("[。、]") & line.rlike("(?:を|へ|はこちら)$")
    return named | short


def drop_trailing_links(line_array: Column, title: Column | str) -> Column:
    """Cut the link-like lines at the end; anything before the last real line stays."""
    marks = F.transform(line_array, lambda x, i: F.when(is_trailing_link(x, title), F.lit(0)).otherwise(i + 1))
    return F.slice(line_array, F.lit(1), F.coalesce(F.array_max(marks), F.lit(0)))


def excerpt(c: Column | str, limit: int = 180) -> Column:
    compact = strip(squeeze(c))
    return F.when(F.nullif(as_col(c), F.lit("")).isNull(), F.lit(None).cast("string")).when(
        F.length(compact) <= limit, compact
    ).otherwise(F.concat(F.left(compact, F.lit(limit - 1)), F.lit("…")))


def classify_section(c: Column | str) -> Column:
    low = F.lower(text(c))
    out = None
    for section, terms in K.SECTION_KEYWORDS.items():
        hit = contains_any(low, [t.lower() for t in terms])
        out = F.when(hit, F.lit(section)) if out is None else out.when(hit, F.lit(section))
    return out


def chunk(line_array: Column, limit: int = K.CHUNK_CHARS) -> Column:
    """Greedy packing of lines into chunks of at most ``limit`` characters.

    A line longer than the limit stays whole. The fold keeps finished chunks and the open one.
    """
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, line: Column) -> Column:
        full = (acc["open"] != "") & (F.length(acc["open"]) + F.length(line) + 1 > limit)
        joined = F.when(acc["open"] == "", line).otherwise(F.concat(acc["open"], F.lit("\n"), line))
        return F.struct(
            F.when(full, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]).alias("done"),
            F.when(full, line).otherwise(joined).alias("open"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"] != "", F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])

    return F.aggregate(line_array, start, step, finish)


# ---- lists ------------------------------------------------------------------------------------


def clean_list(arr: Column) -> Column:
    return F.filter(F.transform(arr, lambda x: strip(x.cast("string"))), lambda x: x != "")


def split_keywords(c: Column | str) -> Column:
    t = F.replace(text(c), F.lit("\r\n"), F.lit("\n"))
    t = F.regexp_replace(t, rf"(?i){K.WS}*OR{K.WS}*", "\n")
    return clean_list(F.split(t, "[\n,、;|　]+"))


def split_list(c: Column | str) -> Column:
    return clean_list(F.split(text(c), "[,;\n]"))


def mask_address(c: Column | str) -> Column:
    col = as_col(c)
    local = F.substring_index(col, "@", 1)
    domain = F.substr(col, F.length(local) + F.lit(2))
    first = F.left(local, F.lit(1))
    stars = F.when(F.length(local) <= 2, F.lit("*")).otherwise(
        F.concat(F.repeat(F.lit("*"), F.greatest(F.length(local) - 2, F.lit(0))), F.right(local, F.lit(1)))
    )
    return F.when(~F.contains(col, F.lit("@")), F.lit("***")).otherwise(F.concat(first, stars, F.lit("@"), domain))


def keyword_hits(target: Column | str, keywords: Column) -> Column:
    t = as_col(target)
    return F.filter(keywords, lambda k: F.contains(t, F.lower(k)))


# ---- title matching ---------------------------------------------------------------------------


def title_match_norm(c: Column | str) -> Column:
    t = strip(text(c))
    suffix = rf"{K.WS}*-{K.WS}*{K.SITE_TITLE_SUFFIX}{K.WS}*$"
    bare = F.when(F.contains(t, F.lit(K.SITE_TITLE_SUFFIX)), F.regexp_replace(t, suffix, "")).otherwise(t)
    return F.translate(bare, K.WHITESPACE + K.TITLE_PUNCTUATION, "")


def title_tokens(norm: Column) -> Column:
    """Word runs of two characters or more, in order, repeats kept."""
    runs = F.regexp_extract_all(norm, F.lit(r"([\p{L}\p{N}_\x{3040}-\x{30ff}\x{3400}-\x{9fff}]+)"), F.lit(1))
    return F.filter(runs, lambda x: F.length(x) >= 2)
