"""Keyword scoring: rules with weights, importance buckets and topic weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import constants as K
from gleaner.functions import text as T
from gleaner.operators.filters import exclude_topics
from gleaner.operators.quality import is_navigation_body

RULE_FIELDS = ["rule_ord", "tag_name", "rule_type", "match_field", "weight", "priority", "keywords", "negative_keywords"]
MATCHES = (
    "array<struct<rule_ord int, tag_name string, rule_type string, match_field string, weight double, priority int, "
    "positive_hits array<string>, negative_hits array<string>>>"
)


# ---- fixed keyword scores ---------------------------------------------------------------------


def bucket_score(c: Column) -> Column:
    """One point for each keyword found, at most three. Plain ASCII words must stand alone.

    Keywords are compared as written with lower-cased text, so those holding capitals never match.
    """
    words = [w for bucket in K.IMPORTANCE_BUCKETS.values() for w in bucket]

    def points(low: Column) -> Column:
        total = F.lit(0)
        for w in words:
            if w.isascii() and w.isalpha():
                hit = T.has_word(low, w)
            else:
                hit = F.contains(low, F.lit(w))
            total = total + hit.cast("int")
        return F.least(F.lit(3), total)

    return T.let(F.lower(c), points)


def with_bucket_score(df: DataFrame, c: Column, out: str = "score") -> DataFrame:
    return df.withColumn(out, T.fence(bucket_score(c)))


def with_topic_score(df: DataFrame, title: Column, section: Column, body: Column, out: str = "topic") -> DataFrame:
    return df.withColumn(out, T.fence(topic_score(title, section, body)))


def topic_score(title: Column, section: Column, body: Column) -> Column:
    """Struct of score (0 to 100), reason and the matched topics and companies."""
    weights = F.create_map(*[F.lit(x) for kv in K.TOPIC_WEIGHTS.items() for x in kv])

    def judge(v: Column) -> Column:
        topics = F.filter(F.map_keys(weights), lambda k: F.contains(v["low"], F.lower(k)))
        companies = T.hits_of(v["text"], K.TOPIC_COMPANIES)
        minus = T.count_terms(v["text"], K.TOPIC_NEGATIVES) * K.NEGATIVE_WEIGHT

        def result(f: Column) -> Column:
            plus = F.aggregate(f["topics"], F.lit(0), lambda acc, t: acc + F.element_at(weights, t))
            why = F.concat(
                F.transform(f["topics"], lambda t: F.concat(F.lit("topic:"), t)),
                F.transform(f["companies"], lambda t: F.concat(F.lit("company:"), t)),
            )
            raw = plus + F.size(f["companies"]) * K.COMPANY_WEIGHT - f["minus"]
            return F.struct(
                F.greatest(F.lit(0), F.least(F.lit(100), raw)).alias("score"),
                F.when(F.size(why) == 0, F.lit(K.NO_TOPIC_REASON)).otherwise(F.array_join(why, "; ")).alias("reason"),
                f["topics"].alias("topics"),
                f["companies"].alias("companies"),
            )

        return T.let(F.struct(topics.alias("topics"), companies.alias("companies"), minus.alias("minus")), result)

    text = F.concat_ws(" ", T.text(title), T.text(section), T.text(body))
    return T.let(F.struct(text.alias("text"), F.lower(text).alias("low")), judge)


# ---- rules as data ----------------------------------------------------------------------------


def scoring_texts(df: DataFrame, source_title: str, page_title: str, body: str) -> DataFrame:
    """Add the cleaned body, whether it is scored, and the three lower-cased texts rules look at."""
    staged = df.withColumn("clean_body", T.clean_body(body)).withColumn(
        "body_used_for_scoring", ~is_navigation_body("clean_body")
    )
    title = F.lower(F.concat_ws("\n", T.text(source_title), T.text(page_title)))
    scored = F.when(F.col("body_used_for_scoring"), F.lower("clean_body")).otherwise(F.lit(""))
    return staged.withColumns({"_title": title, "_body": scored}).withColumn("_both", F.concat_ws("\n", "_title", "_body"))


def _target(field: Column) -> Column:
    return F.when(field == "title", F.col("_title")).when(field == "body", F.col("_body")).otherwise(F.col("_both"))


def matches_inline(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``matches``: the rules that hit, in rule order. Map-only; the rules ride along as one value.

    Scoring uses this form unless told otherwise. A null keyword list is empty.
    """
    packed = rules.agg(F.array_sort(F.collect_list(F.struct(*RULE_FIELDS))).alias("rules")).scalar()
    none = F.array().cast("array<string>")

    def judge(r: Column) -> Column:
        target = _target(r["match_field"])
        return F.struct(
            *[r[f].alias(f) for f in RULE_FIELDS[:6]],
            T.keyword_hits(target, F.coalesce(r["keywords"], none)).alias("positive_hits"),
            T.keyword_hits(target, F.coalesce(r["negative_keywords"], none)).alias("negative_hits"),
        )

    judged = F.transform("_rules", judge)
    hit = F.filter(judged, lambda m: (F.size(m["positive_hits"]) > 0) | (F.size(m["negative_hits"]) > 0))
    return df.withColumn("_rules", packed).withColumn("matches", T.fence(F.coalesce(hit, F.array()))).drop("_rules")


def matches_automaton(df: DataFrame, rules: DataFrame) -> DataFrame:
    """The same ``matches`` by one walk over each text, for rule tables with many keywords.

    Every task builds one automaton over all keywords, and a text is read once whatever their number: what is
    found costs, not what is asked. A caller's choice, since with few keywords native searches are cheaper. Rules
    are configuration and travel with the plan, as in ``matches_inline``. Only the two texts go through Python.
    """
    none = F.array().cast("array<string>")
    sides = ("keywords", "negative_keywords")
    spelled = [
        F.transform(F.coalesce(c, none), lambda k: F.struct(k.alias("word"), F.lower(k).alias("low"))).alias(c) for c in sides
    ]
    listed = rules.select(*RULE_FIELDS[:6], *spelled).orderBy("rule_ord").collect()
    heads = [{f: r[f] for f in RULE_FIELDS[:6]} for r in listed]
    words = [[[k["word"] for k in r[c]] for c in sides] for r in listed]
    places: dict[str, list[tuple[int, int, int]]] = {}
    for at, r in enumerate(listed):
        for side, c in enumerate(sides):
            for pos, k in enumerate(r[c]):
                if k["low"] is not None:
                    places.setdefault(k["low"], []).append((at, side, pos))
    everywhere = places.pop("", [])  # every text holds the empty keyword

    def hits(title: str, body: str, automaton) -> list[dict]:
        split = len(title)
        met = {(low, 1 if end < split else 2 if end - len(low) >= split else 0) for end, low in automaton(f"{title}\n{body}")}
        found: dict[int, tuple[set[int], set[int]]] = {}
        for low, part in met:
            for at, side, pos in places[low]:
                if part == {"title": 1, "body": 2}.get(heads[at]["match_field"], part):
                    found.setdefault(at, (set(), set()))[side].add(pos)
        for at, side, pos in everywhere:
            found.setdefault(at, (set(), set()))[side].add(pos)
        return [
            heads[at] | {f"{kind}_hits": [words[at][side][p] for p in sorted(found[at][side])] for side, kind in enumerate(("positive", "negative"))}
            for at in sorted(found)
        ]

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for low in places:
            automaton.add_word(low, low)
        automaton.make_automaton()
        walk = automaton.iter if places else lambda text: ()
        strings, kind = pa.list_(pa.string()), pa.string()
        row = pa.struct([
            ("rule_ord", pa.int32()), ("tag_name", kind), ("rule_type", kind), ("match_field", kind), ("weight", pa.float64()),
            ("priority", pa.int32()), ("positive_hits", strings), ("negative_hits", strings),
        ])
        for titles, bodies in batches:
            pairs = zip(titles.to_pylist(), bodies.to_pylist(), strict=True)
            yield pa.array([hits(t or "", b or "", walk) for t, b in pairs], pa.list_(row))

    return df.withColumn("matches", F.arrow_udf(run, MATCHES)("_title", "_body"))


def score(df: DataFrame, min_report_score: float = 5.0, source_title: str = "source_title", page_title: str = "page_title") -> DataFrame:
    """Add score, priority, tags, negatives, breakdown and exclusion from ``matches``."""
    m = F.col("matches")
    positive = F.filter(m, lambda r: F.size(r["positive_hits"]) > 0)
    total = F.aggregate(
        m,
        F.lit(0.0),
        lambda acc, r: acc
        + F.when(F.size(r["positive_hits"]) > 0, r["weight"]).otherwise(F.lit(0.0))
        - F.when(F.size(r["negative_hits"]) > 0, F.abs(r["weight"])).otherwise(F.lit(0.0)),
    )

    def tags(rows: Column) -> Column:
        return F.array_distinct(F.filter(F.transform(rows, lambda r: r["tag_name"]), lambda t: t != ""))

    def entry(r: Column, kind: str) -> Column:
        sign = r["weight"] if kind == "positive" else -F.abs(r["weight"])
        return F.when(
            F.size(r[f"{kind}_hits"]) > 0,
            F.struct(
                r["tag_name"].alias("tag"), F.lit(kind).alias("type"), r[f"{kind}_hits"].alias("hits"), sign.alias("weight")
            ),
        )

    breakdown = F.flatten(F.transform(m, lambda r: F.array_compact(F.array(entry(r, "positive"), entry(r, "negative")))))
    negatives = F.flatten(
        F.transform(m, lambda r: F.transform(r["negative_hits"], lambda h: F.concat(r["tag_name"], F.lit(":"), h)))
    )
    def of_type(kind: str) -> Column:
        return tags(F.filter(positive, lambda r: r["rule_type"] == kind))

    by_type = {column: of_type(kind) for kind, column in K.RULE_TAG_COLUMNS.items()}
    top = F.coalesce(F.array_max(F.transform(positive, lambda r: r["priority"])), F.lit(0))
    off_topic = exclude_topics(F.concat_ws("\n", T.text(source_title), T.text(page_title), T.text("clean_body")))
    scored = df.withColumns(
        {
            "importance_score": total,
            "priority": F.greatest(F.lit(0), top),
            "tags": tags(positive),
            "matched_rules": tags(positive),
            "negative_matches": negatives,
            "score_breakdown": breakdown,
            "exclude_reason": T.fence(off_topic),
            **by_type,
        }
    )
    worth = (F.col("importance_score") >= min_report_score) & (F.size("tags") > 0)
    reason = (
        F.when(F.col("exclude_reason") != "", F.concat(F.lit(K.REASON_EXCLUDED_PREFIX), "exclude_reason"))
        .when(worth, F.concat(F.array_join("tags", "、"), F.lit(K.REASON_MATCHED_SUFFIX)))
        .otherwise(F.lit(""))
    )
    return scored.withColumns({"exclude_candidate": F.col("exclude_reason") != "", "reason_to_read": reason}).drop(
        "matches", "_title", "_body", "_both"
    )


def score_articles(
    articles: DataFrame, rules: DataFrame, key: str, source_title: str = "source_title", page_title: str = "page_title",
    body: str = "text", min_report_score: float = 5.0, match: Callable[[DataFrame, DataFrame], DataFrame] = matches_inline,
) -> DataFrame:
    staged = scoring_texts(articles, source_title, page_title, body)
    return score(match(staged, rules), min_report_score, source_title, page_title)
