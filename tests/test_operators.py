"""Literal cases and sequential models for dedupe, ranking, scoring, store and quality."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleaner.functions import jsons as J
from gleaner.functions import text as T
from gleaner.functions import urls as U
from gleaner.operators import dedupe, digest, filters, lookup, numbering, quality, ranking, rules, selection, shaping
from gleaner.operators import store as S


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


# ---- dedupe ----


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_dedupe_equals_the_sequential_model(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(60), rng.randrange(60)) for i in range(300)]
    seen_a, seen_b, expected = set(), set(), []
    for i, a, b in rows:
        if a in seen_a or b in seen_b:
            continue
        seen_a.add(a)
        seen_b.add(b)
        expected.append(i)
    shuffled = rng.sample(rows, len(rows))
    got = dedupe.greedy_by_either_key(spark.createDataFrame(shuffled, "ord int, a int, b int"), "a", "b", "ord")
    assert sorted(r["ord"] for r in got.collect()) == expected


def test_greedy_dedupe_follows_a_long_chain(spark):
    rows = [(i, (i + 1) // 2, i // 2) for i in range(14)]  # each row shares one key with the row before it
    got = dedupe.greedy_by_either_key(spark.createDataFrame(rows, "ord int, a int, b int"), "a", "b", "ord")
    assert sorted(r["ord"] for r in got.collect()) == list(range(0, 14, 2))


def test_untitled_first_link_hides_later_ones(spark):
    rows = [(0, "p", "https://x.example.com/a", ""), (1, "p", "https://x.example.com/a/", "A"), (2, "p", "https://x.example.com/b", "B")]
    df = spark.createDataFrame(rows, "ord int, page string, url string, title string")
    assert [r["ord"] for r in dedupe.candidates(df, ["page"], "url", "title", ["ord"]).collect()] == [2]


def test_rejected_rows_do_not_block(spark):
    rows = [(0, "s", "https://x.example.com/a?b=1&a=2", False), (1, "s", "https://X.example.com//a?a=2&b=1", True)]
    df = spark.createDataFrame(rows, "ord int, site string, url string, ok boolean")
    assert [r["ord"] for r in dedupe.accepted(df, "site", "url", F.col("ok"), ["ord"]).collect()] == [1]


def test_body_beats_order_for_one_article(spark):
    rows = [
        (0, "https://n.example.com/paper/article/?ng=X1", "", "new"), (1, "https://n.example.com/article/X1/", "saved text", "saved"),
        (2, "https://n.example.com/article/X1/", "new text", "new"), (3, "https://n.example.com/article/X1/", "later text", "new"),
    ]
    df = spark.createDataFrame(rows, "ord int, url string, text string, source string")
    got = dedupe.best_body(df, "url", "text", "source", "ord", existing="saved").collect()
    assert [(r["ord"], r["first_seen"]) for r in got] == [(2, 0)]


# ---- ranking ----


@pytest.mark.parametrize("seed", range(3))
def test_budget_equals_the_sequential_model(spark, seed):
    rng = random.Random(seed)
    rows = [(g, rng.randrange(5), i) for g in range(12) for i in range(rng.randrange(9))]
    order = {g: min(o for gg, o, _ in rows if gg == g) for g in {r[0] for r in rows}}
    rows = [(g, order[g], i) for g, _, i in rows]
    left, expected = 20, []
    for g in sorted(order, key=lambda g: (order[g], g)):
        take = [(g, i) for gg, _, i in rows if gg == g][:left]
        left -= len(take)
        expected += take
    df = spark.createDataFrame(rows, "g int, o int, i int")
    got = ranking.budget_across_groups(df, "g", ["o"], ["i"], 20)
    assert sorted((r["g"], r["i"]) for r in got.collect()) == sorted(expected)


def test_per_group_limit_is_exact_on_a_hot_group(spark):
    df = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1)).alias("g"), "id")
    df = df.withColumn("n", (F.col("g") % 7 + 1).cast("int"))
    got = {r["g"]: r["ids"] for r in ranking.first_n(df, ["g"], ["id"], "n").groupBy("g").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()}
    assert got[0] == [0] and got[2] == [1, 101, 151]
    assert all(len(ids) == g % 7 + 1 for g, ids in got.items())


def test_positions_are_total(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = numbering.with_position(df, ["k"], "p").collect()
    assert all(r["k"] == r["p"] for r in got)


@pytest.mark.parametrize(("ties", "n"), [(True, 7), (False, 5)])
def test_ties_at_the_cutoff(spark, ties, n):
    rows = [(i, float(s), 0, f"u{i}", "20240101", f"t{i}", False, "2024-01-01") for i, s in enumerate([10, 8, 6, 5, 4, 4, 4, 2])]
    df = spark.createDataFrame(
        rows, "ord int, importance_score double, priority int, url string, issue_date string, title string, exclude_candidate boolean, published_at string"
    )
    assert selection.select_report(df, include_ties=ties).count() == n
    assert selection.select_from_pool(df, include_ties=ties).count() == n


def test_pool_takes_zero_scores_only_when_short_of_positive_ones(spark):
    rows = [(i, float(s), 0, "20240101", f"t{i}", s == 9, "") for i, s in enumerate([9, 3, 0, 0, 2])]
    df = spark.createDataFrame(rows, "ord int, importance_score double, priority int, issue_date string, title string, exclude_candidate boolean, published_at string")
    assert sorted(r["ord"] for r in selection.select_from_pool(df, top_rank=2, include_ties=False).collect()) == [1, 4]
    assert sorted(r["ord"] for r in selection.select_from_pool(df, top_rank=3, include_ties=False).collect()) == [1, 2, 4]


def test_attempts_stop_at_either_limit(spark):
    df = spark.createDataFrame([("r", i, i % 2 == 0) for i in range(60)], "run string, ord int, ok boolean")
    assert ranking.attempt_budget(df, "run", ["ord"], "ok", max_successes=3).count() == 5
    assert ranking.attempt_budget(df, "run", ["ord"], "ok", max_successes=0, max_attempts=4).count() == 4
    assert ranking.attempt_budget(df, "run", ["ord"], "ok", max_successes=0).count() == 60


# ---- rules ----

RULES = [
    (0, "A", "country", "title", 3.0, 2, ["インド"], []),
    (1, "B", "sector", "both", 2.0, 5, ["鉄鋼", "Steel"], ["広告"]),
]
RULE_SCHEMA = "rule_ord int, tag_name string, rule_type string, match_field string, weight double, priority int, keywords array<string>, negative_keywords array<string>"


def score(spark, title, text, table=RULES):
    df = spark.createDataFrame([(1, title, title, text)], "id int, source_title string, page_title string, text string")
    return rules.score_articles(df, spark.createDataFrame(table, RULE_SCHEMA), "id").first()


def test_two_rules_add_up(spark):
    row = score(spark, "インドで増産", "鉄鋼の需要。STEELの話。")
    assert (row["importance_score"], row["priority"], row["tags"]) == (5.0, 5, ["A", "B"])
    assert [h for b in row["score_breakdown"] for h in b["hits"]] == ["インド", "鉄鋼", "Steel"]


def test_negatives_subtract_once(spark):
    row = score(spark, "鉄鋼", "広告。広告。")
    assert row["importance_score"] == 0.0 and row["negative_matches"] == ["B:広告"]


def test_navigation_body_is_not_scored(spark):
    row = score(spark, "題", "速報 アクセスランキング 鉄鋼")
    assert row["importance_score"] == 0.0 and row["body_used_for_scoring"] is False


def test_inline_and_automaton_matching_agree(spark):
    words = ["a", "ab", "abc", "日本", "日本語テ", "zz", "b c"]
    texts = ["xabcx", "日本語テスト", "", "zab", "no", "ab c"]
    table = [(i, f"t{i}", "x", "both", 1.0, 0, [w], [words[-i - 1]]) for i, w in enumerate(words)]
    df = spark.createDataFrame([(i, t, "", t) for i, t in enumerate(texts)], "id int, source_title string, page_title string, text string")
    staged = rules.scoring_texts(df, "source_title", "page_title", "text")
    table = spark.createDataFrame(table, RULE_SCHEMA)
    read = lambda d: {r["id"]: r["matches"] for r in d.select("id", "matches").collect()}
    assert read(rules.matches_inline(staged, table)) == read(rules.matches_automaton(staged, table))


def test_three_thousand_keywords_empty_and_missing_lists(spark):
    words = [f"kw{i}x" for i in range(3000)]
    table = [(i, f"t{i}", "x", "both", 1.0, 0, words[i * 100 : i * 100 + 100], None) for i in range(30)] + [(30, "e", "x", "both", 1.0, 0, [""], ["kw7x"]), (31, "n", "x", "title", 1.0, 0, None, ["kw8x"])]
    df = spark.createDataFrame([(i, t, "", t) for i, t in enumerate(["kw7x kw2999x", "none", "", "KW8X"])], "id int, source_title string, page_title string, text string")
    staged, table = rules.scoring_texts(df, "source_title", "page_title", "text"), spark.createDataFrame(table, RULE_SCHEMA)
    read = lambda d: {r["id"]: r["matches"] for r in d.select("id", "matches").collect()}
    inline = read(rules.matches_inline(staged, table))
    assert inline == read(rules.matches_automaton(staged, table))
    assert [[m["rule_ord"] for m in inline[i]] for i in range(4)] == [[0, 29, 30], [30], [30], [0, 30, 31]]


def test_automaton_keeps_fields_order_and_repeats(spark):
    import random

    pick = random.Random(5)
    bits = ["a", "b", "ab", "ba", "aab", "B", "本", "本a", "𠮷", "a\nb", "", "zz", None]
    some = lambda: pick.choice([None, [], [pick.choice(bits) for _ in range(pick.randrange(1, 5))]])
    table = [(i, f"t{i}", "x", pick.choice(["title", "body", "both", "", None]), float(i), i, some(), some()) for i in range(60)]
    text = lambda: "".join(pick.choice(["a", "b", "A", "本", "𠮷", " "]) for _ in range(pick.randrange(6)))
    df = spark.createDataFrame([(i, text(), text()) for i in range(60)], "id int, _title string, _body string")
    staged = df.selectExpr("id", "lower(_title) AS _title", "lower(_body) AS _body", "concat_ws('\n', lower(_title), lower(_body)) AS _both")
    read = lambda d: {r["id"]: r["matches"] for r in d.select("id", "matches").collect()}
    table = spark.createDataFrame(table, RULE_SCHEMA)
    got = read(rules.matches_automaton(staged, table))
    assert got == read(rules.matches_inline(staged, table))
    assert any(m["positive_hits"] for row in got.values() for m in row)
    assert read(rules.matches_automaton(staged, table.where("false"))) == {i: [] for i in range(60)}


def test_keywords_split_inside_words(spark):
    assert one(spark, T.split_keywords(F.lit("鉄鋼 OR インド,政策、商社;資源|物流　再エネ"))) == ["鉄鋼", "インド", "政策", "商社", "資源", "物流", "再エネ"]
    assert one(spark, T.split_keywords(F.lit("FORD"))) == ["F", "D"]


@pytest.mark.parametrize(("text", "points"), [("steel and ai", 2), ("paid aié said", 0), ("H Beam Bangladesh AD", 0), ("M&A 買収 商社 鉄鋼", 3)])
def test_bucket_words_stand_alone(spark, text, points):
    assert one(spark, rules.bucket_score(F.lit(text))) == points


def test_only_personnel_is_renamed(spark):
    assert one(spark, filters.exclude_topics(F.lit("人事の話"))) == "人事だけの記事"
    assert one(spark, filters.exclude_topics(F.lit("人事と競馬"))) == "人事のみ、競馬"


# ---- urls, text, json ----


@pytest.mark.parametrize(
    ("fn", "raw", "expected"),
    [
        (U.normalize_url, "HTTPS://Ex.com//a/?b=2&a=&a=1#f", "https://ex.com/a?a=&a=1&b=2"),
        (U.normalize_url, "https://ex.com", "https://ex.com/"),
        (U.normalize_url, "https://ex.com/?q=a%20b~*", "https://ex.com/?q=a+b~%2A"),
        (U.normalize_link, "https://news.google.com/x?url=https%3A%2F%2Fa.com%2Fp%2Bq&utm_x=1", "https://a.com/p+q"),
        (U.normalize_link, "https://a.com/?utm_x=1", "https://a.com/?utm_x=1"),
        (U.dedupe_url_key, "https://u:p@WWW.a.com:80//x//y/?q=1", "a.com/x/y"),
        (U.article_key, "https://a.com/paper/article/?ng=K1&x=2", "ng:K1"),
        (U.article_key, "https://A.com/x/", "a.com/x"),
        (U.article_id, "https://a.com/article/DG12/x", "DG12"),
        (U.strip_url, "//A.com//x/?q#f", "https://a.com/x"),
        (T.normalize_title, "Steel（速報） (x) News - Reuters", "steel news"),
        (T.strip_tags, " <b>x</b> < y ", "x < y"),
        (T.mask_address, "abcd@x.com", "a**d@x.com"),
        (T.mask_address, "ab@x.com", "a*@x.com"),
        (T.mask_address, "nobody", "***"),
        (T.title_match_norm, "「鉄鋼」 増産 - 日本経済新聞", "鉄鋼増産"),
    ],
)
def test_text_functions(spark, fn, raw, expected):
    assert one(spark, fn(F.lit(raw))) == expected


@pytest.mark.parametrize(
    ("ref", "expected"),
    [
        ("/n/1", "https://a.com/n/1"), ("x", "https://a.com/b/x"), ("../x", "https://a.com/x"), ("../../../x", "https://a.com/x"),
        ("?q=1", "https://a.com/b/c?q=1"), ("#f", "https://a.com/b/c?z=9#f"), ("//d.com/x", "https://d.com/x"),
        ("mailto:a@b.c", "mailto:a@b.c"), ("http://d.com", "http://d.com"), (".", "https://a.com/b/"), ("", "https://a.com/b/c?z=9"),
    ],
)
def test_url_join(spark, ref, expected):
    assert one(spark, U.url_join(F.lit("https://a.com/b/c?z=9"), F.lit(ref))) == expected


def test_url_list(spark):
    raw = "https://a.com/x\n[m](https://b.com/y/) https://a.com/x#f, https://c.com/1https://d.com/2"
    assert one(spark, U.parse_url_list(F.lit(raw))) == ["https://a.com/x", "https://b.com/y", "https://c.com/1", "https://d.com/2"]


@pytest.mark.parametrize(
    ("content", "n", "expected"),
    [
        ('["A","B"]', 2, ["A", "B"]), ('{"translations":["A"]}', 1, ["A"]), ('{"0":"A","2":"C","1":"B"}', 3, ["A", "B", "C"]),
        ('{"translations":{"10":"B","9":"A"}}', 2, ["A", "B"]), ('["A"]', 2, None), ('{"a":"A"}', 1, None),
    ],
)
def test_translations(spark, content, n, expected):
    assert one(spark, J.translations(F.lit(content), F.lit(n))) == expected


def test_chunks_keep_long_lines_whole(spark):
    assert one(spark, T.chunk(T.lines(F.lit("aa\n\nbb\n" + "c" * 9 + "\ndd")), 6)) == ["aa\nbb", "c" * 9, "dd"]


# ---- quality, store, crawl ----


def gate(spark, text, page="P", source="P", url="https://x.example.com/"):
    df = spark.createDataFrame([(text, page, source, url)], "text string, page_title string, source_title string, url string")
    return quality.validate_body(df, "text", "source_title", "page_title", "url").first()["rejection_reason"]


def test_body_gate(spark):
    nav = "\n".join(["速報", "アクセスランキング", "トピック一覧", "人事"] * 4)
    article = "\n".join(f"企業{i}は設備の更新を急いでいると説明した。市場の反応は様々である。" for i in range(11))
    assert gate(spark, " ") == "empty_text"
    assert gate(spark, nav) == "navigation_like_text"
    assert gate(spark, article) == ""
    assert gate(spark, "短い。本文。です。") == "navigation_like_text"
    assert gate(spark, nav, page="朝刊・夕刊 3月12日付") == "paper_index_page_title"


def test_metrics_count_repeated_lines(spark):
    df = spark.createDataFrame([("a\nb\na\na\nc\nwww.x.com",)], "text string")
    m = quality.with_body_metrics(df, "text").first()["metrics"]
    assert m["duplicate_line_ratio"] == 0.5 and m["link_text_ratio"] == round(1 / 6, 3)


def test_existing_rows_by_url_or_key(spark):
    store = spark.createDataFrame(
        [("https://n.example.com/?ng=1", "p1", "body", 0), ("https://n.example.com/?ng=2", "p2", " ", 1)], "url string, page_id string, text string, ord int"
    )
    incoming = spark.createDataFrame(
        [("https://n.example.com/?ng=1",), ("https://n.example.com/?ng=2",), ("https://m.example.com/?ng=1",), ("https://n.example.com/?ng=3",)], "url string"
    )
    got = {r["url"][-7:] + r["url"][8]: r["outcome"] for r in S.split_existing(incoming, store).collect()}
    assert sorted(got.values()) == ["backfill", "backfill", "new", "skipped"]  # known by key alone counts as without text
    kept = {r["outcome"] for r in S.split_existing(incoming, store, backfill=False).collect()}
    assert kept == {"new", "skipped"}


def test_crawl_stops_at_visited_pages(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "b"), ("e", "")], "url string, next_url string")
    starts = spark.createDataFrame([("s", 0, "a"), ("s", 1, "d"), ("s", 2, "e"), ("t", 0, "d")], "site string, start int, url string")
    got = {(r["site"], r["start"], r["url"]) for r in lookup.crawl_pages(starts.withColumn("max_pages", F.lit(5)), edges).collect()}
    assert got == {("s", 0, "a"), ("s", 0, "b"), ("s", 0, "c"), ("s", 1, "d"), ("s", 2, "e"), ("t", 0, "d"), ("t", 0, "b"), ("t", 0, "c"), ("t", 0, "a")}


def test_missing_required_columns_are_named():
    with pytest.raises(ValueError, match=re.escape("['Date']")):
        shaping.require_columns(["Title"])


def test_each_site_stops_at_its_own_limit(spark):
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), *((f"n{i}", f"n{i + 1}") for i in range(12))], "url string, next_url string")
    starts = spark.createDataFrame([("one", 0, "a", 1), ("one", 1, "b", 1), ("two", 0, "a", 2), ("two", 1, "b", 2), ("eight", 0, "n0", 8), ("none", 0, "a", 0)], "site string, start int, url string, max_pages int")
    got = {}
    for r in lookup.crawl_pages(starts, chain).collect():
        got.setdefault((r.site, r.start), []).append((r.depth, r.url))
    assert {k: [u for _, u in sorted(v)] for k, v in got.items()} == {
        ("one", 0): ["a"], ("one", 1): ["b"], ("two", 0): ["a", "b"], ("eight", 0): [f"n{i}" for i in range(8)],
    }


def test_scored_rows_are_evaluated_once(spark):
    from pyspark.sql import functions as F

    from gleaner.operators import ranking, selection

    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def judged(i):
        calls.add(1)
        return float(i // 3)

    rows = spark.range(30).select(F.col("id").alias("ord"), judged("id").alias("importance_score"), F.lit(False).alias("exclude_candidate"), F.lit(1).alias("priority"), (F.col("id") % 2).alias("g"))
    assert sorted(r.ord for r in ranking.with_ties(rows, "importance_score", 2).collect()) == [27, 28, 29]
    assert calls.value == 30
    assert ranking.with_ties(rows, "importance_score", 2, ["g"]).count() == 5
    assert calls.value == 60
    held = selection.score_table(rows.withColumn("article_id", F.col("ord")), "article_id")
    chosen = selection.select_from_pool(held, include_ties=True)
    assert (chosen.count(), selection.select_report(held).count(), held.count()) == (6, 6, 30)
    assert calls.value == 90


def test_rows_without_address_are_new_and_spread(spark):
    store = spark.createDataFrame([("p", "https://a.com/x", " ", 1), ("q", "", "text", 2)], "page_id string, url string, text string, ord int")
    incoming = spark.createDataFrame([(i, "" if i % 2 else None) for i in range(50)] + [(99, "https://a.com/x")], "ord int, url string")
    got = {r["ord"]: (r["outcome"], r["page_id"]) for r in S.split_existing(incoming, store).collect()}
    assert got == {i: ("new", None) for i in range(50)} | {99: ("backfill", "p")}


def test_fingerprint_by_tree(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"))
    mark = lambda df, fan_out=8, levels=3: digest.tree_fingerprint(df, ["id"], ["t"], F.lit("d"), fan_out, levels).first()[0]
    whole = mark(rows)
    assert whole == mark(rows.repartition(5).orderBy(F.rand(1)))
    changed = [rows.where("id <> 500"), rows.withColumn("t", F.when(F.col("id") == 999, "x").otherwise(F.col("t"))), rows.withColumn("id", 1000 - F.col("id"))]
    assert len({whole, mark(rows, 16), *map(mark, changed)}) == 5

    def plain(texts, fan_out=8, levels=3):
        level = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        for _ in range(levels):
            level = [hashlib.sha256("\x1e".join(level[i : i + fan_out]).encode()).hexdigest() for i in range(0, len(level), fan_out)]
        return hashlib.sha256("\x1e".join(["d", *level]).encode()).hexdigest()

    assert whole == plain([f"t{i}" for i in range(1000)]) and mark(rows.where("false")) == plain([])
