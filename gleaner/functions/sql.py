"""The main functions for use in ``spark.sql``: SQL-defined, so Catalyst inlines them.

    register(spark)
    spark.sql("SELECT title_key(title), url_key(link) FROM entries")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gleaner import constants as K
from gleaner.functions.text import any_of


def _lit(text: str) -> str:
    """A raw SQL string; raw strings keep backslashes, so patterns read as they are written."""
    return 'r"' + text.replace('"', r"\x22") + '"'


_WS = _lit(K.WS + "+")
_STRIP = "btrim({x}, '" + "".join(f"\\u{ord(c):04X}" for c in K.WHITESPACE) + "')"


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


def _part(u: str, group: int) -> str:
    return f"regexp_extract({u}, {_lit(K.URL_PARTS)}, {group})"


def _collapse(p: str) -> str:
    return f"coalesce(nullif(rtrim('/', regexp_replace(if({p} = '', '/', {p}), '/+', '/')), ''), '/')"


SCALARS = {
    "strip_text": ("x STRING", "STRING", _strip("x")),
    "squeeze_text": ("x STRING", "STRING", f"regexp_replace(x, {_WS}, ' ')"),
    "plain_text": ("x STRING", "STRING", _strip("regexp_replace(x, '<[^<]+?>', '')")),
    "title_key": (
        "x STRING", "STRING",
        _strip(
            "regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(x), "
            + _lit(r"（[^\n]*?）|\([^\n]*?\)") + ", ''), " + _lit(r"-[^\n]*$") + f", ''), {_lit(any_of(K.TITLE_SOURCE_NAMES))}, ''), {_lit(K.NOT_WORD + '+')}, ' ')"
        ),
    ),
    "is_japanese_text": ("x STRING", "BOOLEAN", "x rlike '[぀-ヿ一-鿿]'"),
    "clean_link": (
        "u STRING", "STRING",
        "regexp_replace(if(contains(u, 'news.google.com') and contains(u, 'url='), "
        "coalesce(try_url_decode(replace(regexp_replace(substring_index(u, 'url=', -1), '%(?![0-9A-Fa-f]{2})', '%25'), '+', '%2B')), u), u), "
        + _lit(r"&utm_[^\n]*") + ", '')",
    ),
    "url_host": (
        "u STRING", "STRING",
        f"regexp_replace(substring_index(substring_index(lower({_part('u', 2)}), '@', -1), ':', 1), '^www[.]', '')",
    ),
    "url_path": ("u STRING", "STRING", _collapse(_part("u", 3))),
    "url_key": ("u STRING", "STRING", "if(u = '', '', concat(url_host(clean_link(u)), url_path(clean_link(u))))"),
    "section_of": (
        "x STRING", "STRING",
        "case " + " ".join(
            f"when lower(x) rlike {_lit(any_of(t.lower() for t in terms))} then '{name}'" for name, terms in K.SECTION_KEYWORDS.items()
        ) + " end",
    ),
}

_FOLD = f"""aggregate(
  filter(transform(split(body, {_lit(K.LINE_BREAK)}), x -> {_strip('x')}), x -> x <> ''),
  named_struct('done', cast(array() as array<string>), 'open', ''),
  (a, x) -> if(a.open <> '' and length(a.open) + length(x) + 1 > size_limit,
    named_struct('done', array_append(a.done, a.open), 'open', x),
    named_struct('done', a.done, 'open', if(a.open = '', x, concat(a.open, '\\n', x)))),
  a -> if(a.open <> '', array_append(a.done, a.open), a.done))"""


def register(spark: SparkSession) -> None:
    """Create the functions for this session."""
    for name, (args, returns, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION text_blocks(body STRING, size_limit INT) "
        f"RETURNS TABLE (pos INT, block STRING) RETURN SELECT pos, col FROM posexplode({_FOLD})"
    )
