"""URL columns. Every function is total: odd input gives text, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions.text import as_col, normalize_title, strip, text


def _part(url: Column | str, group: int) -> Column:
    return F.regexp_extract(as_col(url), K.URL_PARTS, group)


def scheme(url: Column | str) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column | str) -> Column:
    return _part(url, 2)


def path(url: Column | str) -> Column:
    return _part(url, 3)


def query(url: Column | str) -> Column:
    return _part(url, 4)


def bare_host(url: Column | str) -> Column:
    """Lower-case host without user info, port or a leading ``www.``."""
    host = F.substring_index(F.substring_index(F.lower(authority(url)), "@", -1), ":", 1)
    return F.regexp_replace(host, r"^www\.", "")


def percent_decode(c: Column, plus_is_space: bool = False) -> Column:
    """Decode ``%XX``; stray percent signs stay as they are."""
    safe = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    if not plus_is_space:
        safe = F.replace(safe, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(safe), c)


def percent_encode(c: Column) -> Column:
    """Form encoding: blank is ``+``; only letters, digits and ``_.-~`` stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _collapse(p: Column) -> Column:
    """Single slashes, no trailing slash, ``/`` when empty."""
    tidy = F.rtrim(F.regexp_replace(F.when(p == "", F.lit("/")).otherwise(p), "/+", "/"), F.lit("/"))
    return F.when(tidy == "", F.lit("/")).otherwise(tidy)


def _rebuild(sch: Column, auth: Column, p: Column) -> Column:
    rooted = F.when((auth != "") & ~p.startswith("/"), F.concat(F.lit("/"), p)).otherwise(p)
    has_auth = (auth != "") | sch.isin("http", "https", "ftp", "file")
    return F.concat(
        F.when(sch != "", F.concat(sch, F.lit(":"))).otherwise(F.lit("")),
        F.when(has_auth, F.concat(F.lit("//"), auth)).otherwise(F.lit("")),
        rooted,
    )


def query_pairs(url: Column | str) -> Column:
    """Decoded ``(k, v)`` pairs in URL order; blanks kept, empty segments dropped."""
    segments = F.filter(F.split(query(url), "&"), lambda s: s != "")

    def pair(s: Column) -> Column:
        name = F.substring_index(s, "=", 1)
        value = F.substr(s, F.length(name) + F.lit(2))
        return F.struct(percent_decode(name, True).alias("k"), percent_decode(value, True).alias("v"))

    return F.transform(segments, pair)


def query_param(url: Column | str, name: str) -> Column:
    """First non-empty value of one parameter, else empty text."""
    values = F.filter(query_pairs(url), lambda p: (p["k"] == name) & (p["v"] != ""))
    return F.coalesce(F.try_element_at(values, F.lit(1))["v"], F.lit(""))


def normalize_link(url: Column | str) -> Column:
    """Unwrap an aggregator link, then cut campaign parameters after ``&utm_``."""
    u = text(url)
    wrapped = F.contains(u, F.lit(K.AGGREGATOR_HOST)) & F.contains(u, F.lit("url="))
    inner = F.when(wrapped, percent_decode(F.substring_index(u, "url=", -1))).otherwise(u)
    return F.regexp_replace(inner, r"&utm_[^\n]*", "")


def normalize_url(url: Column | str) -> Column:
    """Comparable form: lower host, tidy path, sorted query, no fragment."""
    u = text(url)
    pairs = F.array_sort(query_pairs(u))
    q = F.array_join(
        F.transform(pairs, lambda p: F.concat(percent_encode(p["k"]), F.lit("="), percent_encode(p["v"]))), "&"
    )
    base = _rebuild(scheme(u), F.lower(authority(u)), _collapse(path(u)))
    return F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q))


def dedupe_url_key(url: Column | str) -> Column:
    """Host and path only."""
    link = normalize_link(url)
    return F.when(text(url) == "", F.lit("")).otherwise(F.concat(bare_host(link), _collapse(path(link))))


def dedupe_key(title: Column | str, link: Column | str) -> Column:
    key = dedupe_url_key(link)
    return F.concat(F.when(key == "", F.lit("title_only")).otherwise(key), F.lit("|"), normalize_title(text(title)))


def store_dedupe_key(
    source: Column | str, article_id: Column | str, url: Column | str, title: Column | str, published: Column | str
) -> Column:
    s, a, u = text(source), text(article_id), text(url)
    bar = F.lit("|")
    return (
        F.when((s != "") & (a != ""), F.concat(s, F.lit("|id|"), a))
        .when((s != "") & (u != ""), F.concat(s, F.lit("|url|"), u))
        .otherwise(F.concat(s, F.lit("|tp|"), text(title), bar, text(published)))
    )


def strip_url(url: Column | str) -> Column:
    """Scheme (https when missing), lower host, tidy path; no query or fragment."""
    u = text(url)
    sch = F.when(scheme(u) == "", F.lit("https")).otherwise(scheme(u))
    return F.when(u == "", F.lit("")).otherwise(_rebuild(sch, F.lower(authority(u)), _collapse(path(u))))


def article_key(url: Column | str, id_param: str = "ng") -> Column:
    """``<param>:<id>`` when the query carries an id, else host and path."""
    u = strip(text(url))
    aid = query_param(u, id_param)
    p = F.rtrim(path(u), F.lit("/"))
    hostpath = F.concat(F.lower(authority(u)), F.when(p == "", F.lit("/")).otherwise(p))
    return F.when(u == "", F.lit("")).when(aid != "", F.concat(F.lit(f"{id_param}:"), aid)).otherwise(hostpath)


def article_id(url: Column | str, id_param: str = "ng") -> Column:
    u = text(url)
    aid = query_param(u, id_param)
    return F.when(aid != "", aid).otherwise(F.regexp_extract(path(u), r"/article/([A-Z0-9]+)/", 1))


def long_article_id(url: Column | str) -> Column:
    """Ids of eight characters or more, after ``/article/`` or as the last segment; null when absent."""
    u = text(url)
    return F.coalesce(
        F.nullif(F.regexp_extract(u, r"/article/([A-Z0-9]{8,})", 1), F.lit("")),
        F.nullif(F.regexp_extract(u, r"/([A-Z0-9]{8,})/?$", 1), F.lit("")),
    )


def is_http_url(url: Column | str) -> Column:
    u = text(url)
    return scheme(u).isin("http", "https") & (authority(u) != "")


def is_issue_article(url: Column | str, domain: str, article_path: str, id_param: str = "ng") -> Column:
    u = text(url)
    return F.contains(authority(u), F.lit(domain)) & (path(u) == article_path) & (query_param(u, id_param) != "")


def url_join(base: Column | str, ref: Column | str) -> Column:
    """Resolve a reference against the page it was found on."""
    b, r = text(base), text(ref)
    b_scheme, b_auth, b_path, b_query = scheme(b), authority(b), path(b), query(b)
    r_scheme, r_auth, r_path, r_query = scheme(r), authority(r), path(r), query(r)
    fragment = F.regexp_extract(r, "(#.*)$", 1)
    base_segments = F.split(b_path, "/")
    keep = F.when(F.try_element_at(base_segments, F.lit(-1)) == "", base_segments).otherwise(
        F.slice(base_segments, F.lit(1), F.greatest(F.size(base_segments) - 1, F.lit(0)))
    )
    segments = F.when(r_path.startswith("/"), F.split(r_path, "/")).otherwise(F.concat(keep, F.split(r_path, "/")))
    last = F.size(segments) - 1
    solid = F.filter(segments, lambda s, i: (i == 0) | (i == last) | (s != ""))
    resolved = F.aggregate(
        solid,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
        )
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    ends_in_dots = F.try_element_at(solid, F.lit(-1)).isin(".", "..")
    joined = F.array_join(F.when(ends_in_dots, F.array_append(resolved, F.lit(""))).otherwise(resolved), "/")
    merged = F.when(joined == "", F.lit("/")).otherwise(joined)

    def with_query(p: Column, q: Column) -> Column:
        return F.concat(p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")), fragment)

    foreign = (r_scheme != "") & ((r_scheme != b_scheme) | ~r_scheme.isin("http", "https", "ftp", "file"))
    same_page_query = F.when(r_query != "", r_query).otherwise(b_query)
    return (
        F.when(b == "", r)
        .when(r == "", b)
        .when(foreign, r)
        .when(r_auth != "", with_query(_rebuild(b_scheme, r_auth, r_path), r_query))
        .when(r_path == "", with_query(_rebuild(b_scheme, b_auth, b_path), same_page_query))
        .otherwise(with_query(_rebuild(b_scheme, b_auth, merged), r_query))
    )


def parse_url_list(c: Column | str) -> Column:
    """URLs in free text, also glued or in markdown; comparable form, first seen order.

    A blank goes before every URL first, so a markdown link is told apart only when it opens the text.
    """
    t = strip(text(c))
    spaced = F.regexp_replace(t, r"(?<!^)(https?://)", " $1")
    markdown = r"\[[^\]]*\]\((https?://[^)\s]+)\)"
    rest = F.regexp_replace(spaced, markdown, " $1 ")
    found = F.concat(
        F.regexp_extract_all(spaced, F.lit(markdown), F.lit(1)),
        F.regexp_extract_all(rest, F.lit(r"(https?://[^\s,;\]\[)(\"'<>]+)"), F.lit(1)),
    )
    return F.array_distinct(F.transform(found, normalize_url))


def parse_feed_urls(c: Column | str) -> Column:
    """One URL per line; invalid ones skipped, first seen order."""
    stripped = F.transform(F.split(text(c), K.LINE_BREAK), strip)
    return F.array_distinct(F.filter(stripped, is_http_url))


def page_link(explicit: Column | str, page_id: Column | str, base: str) -> Column:
    """An explicit page URL, else one built from the page id; empty without either."""
    given, pid = strip(text(explicit)), strip(text(page_id))
    return F.when(given != "", given).when(
        pid != "", F.concat(F.lit(base), F.replace(pid, F.lit("-"), F.lit("")))
    ).otherwise(F.lit(""))
