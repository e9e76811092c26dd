"""Secret scans, license scans, decontamination and URL filters on awkward rows, against plain versions."""

import re

import pytest

import cases
from gleaner.llm import decontaminate, licenses, secrets, urlpaths

PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
]
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_strong_secrets_are_those_of_the_patterns(spark):
    want = []
    for doc_id, text in cases.texts():
        spans = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[g]) >= n]
        want.append((doc_id, ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))))
    found = secrets.secret_spans(cases.documents(spark)).select("doc_id", secrets.written("base_spans"))
    assert cases.counted(found.collect()) == cases.counted(want)


def test_weak_parts_need_a_complement_in_reach(spark):
    far = "pwd: hunter2" + " filler" * 100 + " user=bob"
    rows = [(1, "pwd: hunter2"), (2, "user=bob"), (3, "pwd: hunter2 for user=bob"), (4, "see https://a.example/x pwd=hunter2"), (5, far), (5, far)]
    found = secrets.secret_spans(cases.documents(spark, rows)).select("doc_id", secrets.written("all_spans"))
    assert cases.counted(found.collect()) == cases.counted([
        (1, ""), (2, ""), (3, "weak_secret:0:12,identifier:17:25"), (4, "weak_secret:24:35"), (5, ""), (5, ""),
    ])


def test_redaction_replaces_each_span_once(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([("ab cd ef", [(0, 0, 2), (1, 1, 4), (6, 0, 8)]), ("plain", []), ("xy", [(0, 0, 2)])], f"text string, spans {secrets.SPAN}")
    assert [r[0] for r in docs.select(secrets.redacted(F.col("text"), F.col("spans"))).collect()] == ["[SECRET]d [SECRET]", "plain", "[SECRET]"]


def test_license_phrases_stand_where_their_words_do(spark):
    want = []
    for doc_id, text in cases.texts():
        words = WORDS.findall(cases.lowered(text))
        places = sorted(i for _, p in licenses.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        want.append((doc_id, len(words), tuple(places)))
    found = licenses.license_places(cases.documents(spark))
    got = [(r.doc_id, r.n_words, tuple(sorted(r.starts))) for r in found.select("doc_id", "n_words", licenses.exact_starts("spans").alias("starts")).collect()]
    assert cases.counted(got) == cases.counted(want)


def test_a_template_is_found_with_words_changed_or_missing(spark):
    words = licenses.TEMPLATES[2][1].split()
    rows = [(1, " ".join(words)), (2, " ".join(words[:9] + ["really"] + words[9:])), (3, " ".join(words[:8] + words[9:])), (4, " ".join(words[:6]))]
    found = licenses.license_places(cases.documents(spark, rows)).select("doc_id", licenses.labels_of("spans"))
    assert {tuple(r) for r in found.collect()} == {(1, "bsd"), (2, "bsd"), (3, "bsd"), (4, "")}


@pytest.mark.parametrize("width", [13, 3])
def test_contamination_by_brute_force(spark, width):
    items = [(1, cases.SHARED), (2, "one two"), (3, ""), (4, None), (5, cases.SHARED[:200]), (5, "null id text"), (None, "tail a b c"), (6, "Same same")]
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, window int")
    want = []
    for doc_id, text in cases.texts():
        words, hit, names = WORDS.findall(cases.lowered(text)), set(), set()
        for item, body in items:
            own = WORDS.findall(cases.lowered(body))
            n = min(width, len(own))
            windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
            at = [i for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows]
            hit |= {j for i in at for j in range(i, i + n)}
            names |= {str(item)} if at and item is not None else set()
        want.append((doc_id, len(words), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(words)))
    got = decontaminate.contamination(cases.documents(spark), table, width).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    assert cases.counted((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in got) == cases.counted(want)


def test_no_benchmark_hits_nothing(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.contamination(cases.documents(spark), empty).collect()} == {0}


URLS = [
    "http://example.com/en/7?x", "https://A.EXAMPLE.com/en/70", "http://x.com/en/", "http://com/en/9", "http://notcom/en/9", "http://a.net/de/8",
    "http://example.net/de/8", "http://b.example.net/de/81#f", "http://a.org/es", "http://a.org/es/", None, "", "no scheme", "a://", "http://h?q", "x://y://z/p",
    "http://a.net/1/2/3/4/5/6", "http://a.net/1/2/3/4/9/", "http://a.net//", "http://a.net/1/2/3/4/5/6",
]


def test_hosts_paths_and_rules(spark):
    want = []
    for url in URLS:
        host = path = ""
        if url and "://" in url:
            rest = re.split("[?#]", url.split("://", 1)[1])[0]
            host, slash, path = rest.partition("/")
            host, path = cases.lowered(host), slash + path
        fits = [(len(h + p), h + p, v) for v, h, p in urlpaths.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None))
    pages = spark.createDataFrame([(None if i == 3 else i, u, "x", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, n int").repartition(3)
    got = urlpaths.judge_urls(pages).collect()
    assert cases.counted((r.host, r.path, r.rule) for r in got) == cases.counted(w[:3] for w in want)
    assert all(r.verdict in ("allow", "block") for r in got)
    assert {(r.rule, r.verdict) for r in got if r.rule} == {(w[2], w[3]) for w in want if w[2]}


def test_a_template_that_rules_block_is_blocked(spark):
    blocked = [f"http://shop.com/en/{i}/x" for i in range(20)]
    rules = [("block", "shop.com", f"/en/{i}") for i in range(10, 20)]
    pages = spark.createDataFrame(list(enumerate([*blocked, "http://shop.com/about", "http://other.com/en/3/x"])), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlpaths.judge_urls(pages, rules).collect()}
    assert all(got[i] == "block" for i in range(20)) and got[20] == got[21] == "allow"


def test_empty_tables(spark):
    docs = cases.documents(spark, [])
    assert secrets.secret_spans(docs).count() == licenses.license_places(docs).count() == 0
    assert decontaminate.contamination(docs, spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert urlpaths.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
