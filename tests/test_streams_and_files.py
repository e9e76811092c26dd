"""Streams over several batches against their batch twins; files in and out."""

import json

from pyspark.sql import functions as F

from gleaner.operators import store as S
from gleaner.sources import readers, writers
from gleaner.streaming import flows

SCHEMA = "n int, url string, page_id string, error string, title string"


def write_batches(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in{i}")
    return [f"{folder}/in{i}" for i in range(len(batches))]


def stream_of(spark, folder, batches, schema):
    """One file for each batch, in order."""
    import os
    import shutil
    import time

    src = f"{folder}/src"
    os.makedirs(src)
    for i, path in enumerate(write_batches(spark, folder, batches, schema)):
        part = next(f for f in os.listdir(path) if f.endswith(".parquet"))
        shutil.copy(f"{path}/{part}", f"{src}/b{i}.parquet")
        os.utime(f"{src}/b{i}.parquet", (time.time() - 100 + i, time.time() - 100 + i))
    return flows.ingest(spark, src, schema, files_per_batch=1)


def finish(q):
    q.awaitTermination()
    assert q.exception() is None


def test_upsert_stream_equals_batches(spark, tmp_path):
    empty = spark.createDataFrame([("p0", "https://a/0", "old", 0)], "page_id string, url string, title string, ord bigint")
    batches = [[(1, "https://a/1", "", "", "one"), (2, "https://a/0", "", "", "zero")], [(3, "https://a/1", "", "", "one again"), (4, "https://a/4", "", "boom", "x")]]
    rows = stream_of(spark, str(tmp_path), batches, SCHEMA)
    finish(flows.run_batches(rows, flows.upsert_sink(f"{tmp_path}/store", empty, "n", ["title"]), f"{tmp_path}/run"))
    got = flows.open_store(f"{tmp_path}/store", empty, ["title"]).rows()
    assert sorted((r["url"], r["title"]) for r in got.collect()) == [("https://a/0", "zero"), ("https://a/1", "one again")]
    actions = spark.read.parquet(f"{tmp_path}/store/outcome").select("n", "action").collect()
    assert sorted((r["n"], r["action"]) for r in actions) == [(1, "created"), (2, "updated"), (3, "updated"), (4, "failed")]


def test_first_sightings_across_batches(spark, tmp_path):
    schema = "key string, at timestamp"
    t = lambda h: __import__("datetime").datetime(2024, 1, 1, h)
    rows = stream_of(spark, str(tmp_path), [[("a", t(1)), ("b", t(2)), ("a", t(3))], [("a", t(4)), ("c", t(5))]], schema)
    finish(flows.run_to_files(flows.first_sightings(rows, "key", "at").select("key"), f"{tmp_path}/run"))
    got = flows.read_output(spark, f"{tmp_path}/run/out", "key string")
    assert sorted(r["key"] for r in got.collect()) == ["a", "b", "c"]
    again = flows.first_sightings(spark.createDataFrame([("a", t(1)), ("a", t(2))], schema), "key", "at", force_refresh=True)
    assert again.count() == 2


def test_old_rows_of_later_batches_count(spark, tmp_path, monkeypatch):
    from gleaner.catalog import streams

    t = lambda year, month: __import__("datetime").datetime(year, month, 1)
    rows = [[(1, t(2024, 12)), (2, t(2023, 1))], [(3, t(2023, 1)), (4, t(2023, 6))], [(5, t(2022, 1)), (3, t(2024, 12))]]
    batches = [[(i, at, i, "click", 1.0, '{"k": 1}') for i, at in batch] for batch in rows]
    stream = stream_of(spark, str(tmp_path), batches, streams.EVENT)
    monkeypatch.setattr(flows, "ingest", lambda *_: stream)
    got = streams.stream_counts(spark, str(tmp_path)).collect()
    assert sorted((r.start, r.n) for r in got) == [(t(2022, 1), 1), (t(2023, 1), 2), (t(2023, 6), 1), (t(2024, 12), 2)]
    keys = streams.stream_dedupe(spark, str(tmp_path)).collect()
    assert sorted(r.key for r in keys) == [f"{i}|1" for i in range(1, 6)]


def test_better_versions_replace(spark, tmp_path):
    schema = "ord int, url string, body string, source string, at timestamp"
    at = __import__("datetime").datetime(2024, 1, 5)
    u = "https://n/paper/article/?ng=A"
    rows = stream_of(spark, str(tmp_path), [[(1, u, "", "new", at)], [(2, u, "saved", "saved", at)], [(3, u, "new", "new", at), (4, u, "late", "new", at)]], schema)
    best = flows.best_versions(rows, "url", "body", "source", "at", existing="saved")
    sink = lambda b, i: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}")
    finish(flows.run_batches(best, sink, f"{tmp_path}/run", mode="update", timers=True))
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("batch").collect()
    assert [(r["ord"], r["text"], r["first_seen"]) for r in got] == [(1, "", 1), (2, "saved", 1), (3, "new", 1)]


def test_versions_meet_across_dates_and_are_forgotten(spark, tmp_path):
    from datetime import datetime, timedelta

    schema = "ord int, url string, body string, source string, at timestamp"
    u, v = "https://n/paper/article/?ng=A", "https://n/paper/article/?ng=B"
    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    batches = [
        [(1, u, "body one", "saved", day(28))], [(2, u, "body two", "new", day(33)), (9, None, None, None, day(33))],
        [(3, u, "body three", "new", day(50)), (0, u, "", "new", day(51))], [(4, v, "x", "new", day(200))], [(5, v, "y", "new", day(201))],
        [(6, u, "body six", "new", day(202))],
    ]
    rows = stream_of(spark, str(tmp_path), batches, schema)
    best = flows.best_versions(rows, "url", "body", "source", "at", "saved", timedelta(days=30))
    running = flows.run_batches(best, flows.latest_sink(f"{tmp_path}/out"), f"{tmp_path}/run", mode="update", timers=True)
    finish(running)
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("batch", "ord").collect()
    # the second version is of another month and still replaces the first; the third does not; by day 202 all is forgotten
    assert [(r["article_id"], r["ord"], r["text"]) for r in got] == [
        ("A", 1, "body one"), ("A", 2, "body two"), ("", 9, None), ("A", 2, None), ("B", 4, "x"), ("A", 6, "body six"),
    ]
    assert [r["first_seen"] for r in got] == [1, 1, 9, 0, 4, 6]
    assert running.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 * 3  # two articles: the best, and its timer both ways
    assert spark.conf.get(flows.PROVIDER, "") != flows.ON_DISK


def test_keys_once_and_late_rows_beside(spark, tmp_path):
    from datetime import datetime

    schema = "n int, key string, at timestamp_ntz"
    t = lambda d: datetime(2024, 1, d)
    batches = [
        [(1, "a", t(10)), (2, "a", t(9)), (3, None, t(10))], [(4, "b", t(1)), (5, "a", t(12)), (6, None, None)],
        [], [(7, "b", t(2)), (8, "c", t(11))], [(9, "c", t(30)), (10, "d", t(30))],
    ]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    sink = flows.seen_sink(str(tmp_path), "key", "at", "n", lateness="2 days", every=2)
    for at in (0, 1, 1, 2, 3, 3, 4, 4):  # some batches twice
        sink(frames[at], at)
    read = lambda kind: spark.read.parquet(f"{tmp_path}/{kind}").orderBy("n").collect()
    assert [(r.n, r.key) for r in read("first")] == [(1, "a"), (3, None), (4, "b"), (8, "c"), (10, "d")]
    assert [(r.n, r.reason) for r in read("late")] == [(4, "before 2024-01-08 00:00:00"), (7, "before 2024-01-10 00:00:00")]
    assert [f.name for f in sorted((tmp_path / "keys/base").iterdir())] == ["at=1", "at=3"]
    assert sorted(f.name for f in (tmp_path / "keys/new").iterdir()) == ["at=2", "at=3", "at=4"]


def test_replayed_batch_replaces_its_output(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id string, url string, title string, ord bigint")
    sink = flows.upsert_sink(f"{tmp_path}/s", empty, "n", ["title"])
    batch = spark.createDataFrame([(1, "https://a/1", "", "", "one")], SCHEMA)
    sink(batch, 0)
    sink(batch, 0)
    assert flows.open_store(f"{tmp_path}/s", empty, ["title"]).rows().count() == 1


def test_feed_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<rss><channel><item><title>T1</title><link>https://a/1</link><pubDate>x</pubDate></item><item><title>T2</title></item></channel></rss>")
    (tmp_path / "b.xml").write_text("not a feed at all")
    rows = readers.read_feed_items(spark, str(tmp_path)).orderBy("entry_ord").collect()
    assert [(r["title"], r["link"], r["published"]) for r in rows] == [("T1", "https://a/1", "x"), ("T2", None, None)]


def test_json_arrays_and_missing_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"url": "u1"}, {"url": "u2", "other": 1}], indent=1))
    assert readers.read_json_array(spark, str(tmp_path / "a.json"), "url string").count() == 2
    assert readers.read_json_array(spark, str(tmp_path / "none.json"), "url string").count() == 0


def test_json_lines_keep_null_fields(spark, tmp_path):
    writers.write_jsonl(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "o"))
    line = "".join(f.read_text() for f in (tmp_path / "o").glob("part-*.json")).strip()
    assert json.loads(line) == {"x": "a", "y": None}


def test_blocks_are_replaced_between_headings(spark):
    blocks = spark.createDataFrame(
        [("p", 0, "paragraph", "", "cover"), ("p", 1, "heading_2", "本文", "本文"), ("p", 2, "paragraph", "", "old"), ("p", 3, "heading_2", "メタデータ", "m"), ("q", 0, "heading_2", "本文", "本文")],
        "page_id string, pos int, kind string, heading string, content string",
    )
    chunks = spark.createDataFrame([("p", i, f"c{i}") for i in range(120)], "page_id string, pos int, content string")
    got = S.replace_blocks(blocks, chunks, spark.createDataFrame([("p", "T")], "page_id string, title string")).orderBy("page_id", "part", "pos")
    rows = [(r["page_id"], r["content"]) for r in got.collect()]
    assert rows[:5] == [("p", "cover"), ("p", "m"), ("p", "タイトル"), ("p", "T"), ("p", "本文")]
    assert sum(p == "p" for p, _ in rows) == 2 + 100 and rows[-1] == ("q", "本文")


def test_captures_decode_with_replacement(spark):
    raw = spark.createDataFrame([("u1", None, bytearray("é".encode("latin-1")), "latin-1"), ("u2", "f", bytearray(b"a\xffb"), None)], "url string, final_url string, content binary, charset string")
    got = {r["url"]: (r["final_url"], r["html"]) for r in readers.decode_captures(raw).collect()}
    assert got == {"u1": ("u1", "é"), "u2": ("f", "a�b")}


def test_whole_text_is_read(spark):
    body = "x" * 50000 + "鉄鋼"
    df = spark.createDataFrame([(body,)], "t string")
    from gleaner.operators.rules import bucket_score

    assert df.select(bucket_score(F.col("t"))).first()[0] == 1


def test_tables_are_read_as_folder_or_file(spark, tmp_path):
    import pytest

    rows = spark.range(50).selectExpr("CAST(id AS INT) AS n", "concat('https://a/', id % 20) AS url", "'' AS page_id", "'' AS error", "concat('t', id) AS title")
    rows.repartition(5).write.parquet(f"{tmp_path}/many.parquet")
    one = next((tmp_path / "many.parquet").glob("part-*.parquet"))
    one.rename(tmp_path / "one.parquet")
    for name, files in (("many", 4), ("one", 1)):
        stream = flows.ingest(spark, f"{tmp_path}/{name}.parquet", SCHEMA, files_per_batch=1)
        finish(flows.run_batches(stream, flows.latest_sink(f"{tmp_path}/{name}-out"), f"{tmp_path}/{name}-run"))
        out = spark.read.parquet(f"{tmp_path}/{name}-out")
        assert out.select("batch").distinct().count() == files
        assert sorted(r.n for r in out.collect()) == sorted(r.n for r in spark.read.parquet(f"{tmp_path}/{name}.parquet").collect())
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        flows.ingest(spark, f"{tmp_path}/none.parquet", SCHEMA)


def test_upsert_keeps_all_columns_and_order_of_the_store(spark, tmp_path):
    saved = spark.createDataFrame([("p0", "https://a/0", "old", 7, "kept")], "page_id string, url string, title string, ord bigint, note string")
    batch = spark.createDataFrame([(5, "https://a/1", "", "", "one"), (6, "https://a/0", "", "", None)], SCHEMA)
    flows.upsert_sink(str(tmp_path), saved, "n", ["title"])(batch, 0)
    got = {r.url: r for r in flows.open_store(str(tmp_path), saved, ["title"]).rows().collect()}
    assert (got["https://a/0"].ord, got["https://a/0"].note, got["https://a/0"].title) == (7, "kept", "old")
    assert got["https://a/1"].ord > 7 and got["https://a/1"].note is None


def test_cut_blocks_are_counted(spark):
    chunks = spark.createDataFrame([("p", i, "x" * (5 + i)) for i in range(4)] + [("q", 0, "ab"), ("r", 0, None), ("r", 1, "y" * 9)], "page_id string, pos int, content string")
    titles = spark.createDataFrame([("p", "T"), ("q", None), ("r", "")], "page_id string, title string")
    blocks = spark.createDataFrame([], "page_id string, pos int, kind string, heading string, content string")
    cut = {r.page_id: (r.chunks_left_out, r.chars_cut) for r in S.blocks_cut(chunks, titles, text_chars=5, max_blocks=5).collect()}
    assert cut == {"p": (2, 1), "r": (0, 4)}
    kept = S.replace_blocks(blocks, chunks, titles, text_chars=5, max_blocks=5).where("kind = 'paragraph'").collect()
    assert sorted((r.page_id, r.pos, r.content) for r in kept if r.content) == [("p", 0, "xxxxx"), ("p", 1, "xxxxx"), ("q", 0, "ab"), ("r", 1, "yyyyy")]
