"""Streams that keep state: running counts and names seen."""

import os

from jobmatch.plans import name_store
from jobmatch.streaming import keyed, running

SCHEMA = "file_no int, place long, file string, feed_index int, guid string, pos int, category string"


def test_running_counts_go_on_over_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(running, "FOLD", 2)
    monkeypatch.setattr(running, "BUCKET", 3)
    out, told, count = str(tmp_path / "out"), [], {}
    for batch in range(6):
        rows = []
        for place in range(0 if batch == 3 else 12):
            cats = ["java"] * 2 + [f"c{(batch + place) % 3}"] + ([None] if place == 4 else [])
            rows += [(place // 6, place % 6, "f", 1, f"{batch}-{place}", pos, c) for pos, c in enumerate(cats)]
        for r in rows:
            if r[6] is not None:
                count[r[6]] = count.get(r[6], 0) + 1
            told.append((r[4], r[5], r[6], count[r[6]] if r[6] is not None else None))
        frame = spark.createDataFrame(rows, SCHEMA)
        running.number_batch(frame, out, "r", batch)
        if batch in (2, 4):
            running.number_batch(frame, out, "r", batch)          # a retry writes the same again
    got = [(r.guid, r.pos, r.category, r.running_count) for r in running.read_running_counts(spark, out).collect()]
    assert sorted(got, key=str) == sorted(told, key=str)
    assert sorted(os.listdir(f"{out}/bases/run=r")) == ["batch=2", "batch=4"]
    start = running.totals_before(spark, out, "r", 5)
    assert not any("batch=2" in f or "batch=3" in f for f in start.inputFiles())


def land(folder, name, guids, t):
    folder.mkdir(parents=True, exist_ok=True)
    body = "".join(f"<item>{f'<guid>{g}</guid>' if g else ''}</item>" for g in guids)
    (folder / name).write_text(f"<rss><channel>{body}</channel></rss>")
    os.utime(folder / name, (t, t))


def stored(spark, path):
    return sorted((r.doc_name, r.url) for r in spark.read.schema("doc_name string, url string, run string").parquet(
        f"{path}/{name_store.DOCS}").filter("run <> 'before'").collect())


def test_names_come_once_without_reading_the_store(spark, tmp_path, monkeypatch):
    land_dir, store, ck = tmp_path / "land", str(tmp_path / "store"), str(tmp_path / "ck")
    from jobmatch.operators import pages
    probe = spark.createDataFrame([("http://j/old",)], "url string")
    name_store.store_run(pages.with_doc_names(probe).select("doc_name"), store, "before")
    land(land_dir, "feed_1.xml", ["http://j/a", "http://j/a", "https://j/a", "http://j/old", None], 1)
    keyed.stream_ingest_keyed(spark, str(land_dir), store, ck).awaitTermination()
    urls = [u for _n, u in stored(spark, store)]
    assert urls == ["http://j/a"]
    # the state, not the store, tells what is known
    with monkeypatch.context() as m:
        m.setattr(keyed, "stored_names", lambda s, p: s.createDataFrame([], "doc_name string"))
        land(land_dir, "feed_2.xml", ["http://j/a", "http://j/b", "http://j/old"], 2)
        keyed.stream_ingest_keyed(spark, str(land_dir), store, ck).awaitTermination()
    assert [u for _n, u in stored(spark, store)] == ["http://j/a", "http://j/b"]
    # with a time to live, names that the state forgot are found by the filters
    keyed.stream_ingest_keyed(spark, str(land_dir), store, str(tmp_path / "ck2"), ttl_ms=1).awaitTermination()
    land(land_dir, "feed_3.xml", ["http://j/a", "http://j/c"], 3)
    keyed.stream_ingest_keyed(spark, str(land_dir), store, str(tmp_path / "ck2"), ttl_ms=1).awaitTermination()
    assert [u for _n, u in stored(spark, store)] == ["http://j/a", "http://j/b", "http://j/c"]
    assert spark.conf.get(keyed.PROVIDER, "") != keyed.ROCKSDB
