"""The store as base and changes against the store rewritten by every batch."""

import os
import random

import pytest

from gleaner.operators import store as S
from gleaner.operators.delta_store import UNDATED, DeltaStore
from gleaner.streaming import flows

SAVED = "page_id string, url string, title string, text string, day string, ord bigint"
BATCH = "n int, url string, page_id string, error string, title string, text string, day string"


def url(i):
    return f"https://a/{i}"


def saved_rows(n):
    return [(f"p{i}", url(i), f"old {i}", None if i % 3 else "body", f"2024-{i % 3 + 1:02d}-10", i) for i in range(n)]


def batches(count, size, seed):
    pick = random.Random(seed)
    out, n = [], 0
    for _ in range(count):
        rows = []
        for _ in range(size):
            n += 1
            i = pick.randrange(40)
            own = f"p{i}" if pick.random() < 0.2 else ""
            rows.append((n, url(i), own, "boom" if pick.random() < 0.1 else "", pick.choice([None, f"t{n}"]), pick.choice([None, f"b{n}"]), f"2024-{i % 3 + 1:02d}-10"))
        out.append(rows)
    return out


def files(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def plain(rows, fields=("page_id", "url", "title", "text")):
    return sorted(tuple(str(r[f]) for f in fields) for r in rows.collect())


@pytest.mark.parametrize("date", [None, "day"])
def test_equals_the_rewritten_store(spark, tmp_path, date):
    first = spark.createDataFrame(saved_rows(20), SAVED)
    sink = flows.upsert_sink(f"{tmp_path}/s", first, "n", ["title", "text"], date, every=2)
    whole = first
    for at, rows in enumerate(batches(3, 12, 3)):
        batch = spark.createDataFrame(rows, BATCH)
        sink(batch, at)
        whole, told = S.upsert(whole, batch, "n", ["title", "text"], order=(batch["n"] + ((at + 1) << 40)))
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        got = flows.open_store(f"{tmp_path}/s", first, ["title", "text"], date)
        assert plain(got.rows()) == plain(whole)
        assert plain(got.outcomes().where(f"at = {at}"), ("n", "url", "page_id", "action", "ok", "error")) == plain(told, ("n", "url", "page_id", "action", "ok", "error"))


def test_a_batch_writes_only_what_changed(spark, tmp_path):
    first = spark.createDataFrame(saved_rows(300), SAVED)
    store = DeltaStore(spark, str(tmp_path), first.schema, ["title"], "day", every=100)
    store.seed(first)
    before = set(files(tmp_path))
    store.apply(spark.createDataFrame([(1, url(3), "", "", "new", None, "2024-01-10")], BATCH), "n", 0)
    new = set(files(tmp_path)) - before
    assert before <= set(files(tmp_path))
    assert {f.rsplit("/", 1)[0] for f in new} == {"changes/at=0/month=2024-01", "outcome/at=0"}
    assert spark.read.parquet(f"{tmp_path}/changes/at=0").count() == 1
    assert store.rows().where("title = 'new'").count() == 1


def test_only_months_of_the_batch_are_opened(spark, tmp_path):
    first = spark.createDataFrame(saved_rows(30), SAVED)
    store = DeltaStore(spark, str(tmp_path), first.schema, ["title"], "day")
    store.seed(first)
    batch = spark.createDataFrame([(1, url(3), "", "", "new", None, "20240110")], BATCH)
    opened = store.pages(*store._range(batch)).inputFiles()
    assert opened and all("month=2024-01" in f for f in opened)
    edge = spark.createDataFrame([(1, url(3), "", "", "new", None, "2024-01-31")], BATCH)
    assert {m for m in ("01", "02", "03") if any(f"2024-{m}" in f for f in store.pages(*store._range(edge)).inputFiles())} == {"01", "02"}
    for row in [(1, url(3), "p3", "", "new", None, "2024-01-10"), (1, url(3), "", "", "new", None, None)]:
        assert store._range(spark.createDataFrame([row], BATCH)) == (None, None)
    assert store.rows(low="2024-02", high="2024-02").count() == 10


def test_old_segments_go_and_other_months_stay(spark, tmp_path):
    first = spark.createDataFrame(saved_rows(30), SAVED)
    store = DeltaStore(spark, str(tmp_path), first.schema, ["title"], "day", every=2)
    store.seed(first)
    february = [f for f in files(tmp_path) if "month=2024-02" in f]
    for at in range(7):
        store.apply(spark.createDataFrame([(at, url(3), "", "", f"t{at}", None, "2024-01-10")], BATCH), "n", at)
    left = files(tmp_path)
    assert [f for f in left if "month=2024-02" in f] == february
    assert len({f.split("/")[1] for f in left if f.startswith("base/") and "2024-01" in f}) == 2
    assert len({f.split("/")[1] for f in left if f.startswith("changes/")}) <= 4
    assert [r.title for r in store.rows().where("page_id = 'p3'").collect()] == ["t6"]
    assert store.rows().count() == 30


def test_replay_and_unfinished_writes(spark, tmp_path):
    first = spark.createDataFrame(saved_rows(20), SAVED)
    store = DeltaStore(spark, str(tmp_path), first.schema, ["title", "text"], None, every=2)
    store.seed(first)
    store.seed(first.limit(1))
    frames = [spark.createDataFrame(rows, BATCH) for rows in batches(3, 8, 7)]
    for at, batch in enumerate(frames):
        store.apply(batch, "n", at)
    done = plain(store.rows())
    store.apply(frames[2], "n", 2)
    assert plain(store.rows()) == done
    os.remove(f"{tmp_path}/changes/at=2/_SUCCESS")
    assert plain(store.rows()) == plain(store.rows(at=1)) != done
    store.apply(frames[2], "n", 2)
    assert plain(store.rows()) == done


def test_empty_batches_and_undated_pages(spark, tmp_path):
    first = spark.createDataFrame([], SAVED)
    store = DeltaStore(spark, str(tmp_path), first.schema, ["title"], "day", every=1)
    store.seed(first)
    empty = spark.createDataFrame([], BATCH)
    store.apply(empty, "n", 0)
    assert store.rows().count() == 0
    store.apply(spark.createDataFrame([(1, url(1), "", "", "a", None, None), (2, None, "", None, "b", None, "2024-02-01")], BATCH), "n", 1)
    store.apply(spark.createDataFrame([(3, url(1), "", "", "c", None, "2024-02-02")], BATCH), "n", 2)
    store.apply(empty, "n", 3)
    assert sorted((r.url or "", r.title) for r in store.rows().collect()) == [("", "b"), (url(1), "c")]
    assert {m for found in store._finished("base").values() for m in found} == {UNDATED, "2024-02"}
    with pytest.raises(ValueError):
        DeltaStore(spark, str(tmp_path), first.schema, ["day"], "day")
