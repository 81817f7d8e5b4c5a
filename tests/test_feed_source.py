"""The feed data source: items of broken feeds, in batch and as a stream."""

import os
import random
import time

from jobmatch.sources import feed_source as fs
from jobmatch.streaming import keyed

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<rss><channel><title>feed</title>'


def item(k, extra=""):
    return f"<item><guid>http://j/{k}</guid><title> t{k} </title><author><name>a</name></author><category>java</category>{extra}</item>"


def rows(path):
    return [r[2:] for r in fs.read_file(fs.FeedFile(str(path), 0))]


def test_items_are_cut_alike_in_blocks_of_any_size():
    text = (HEAD + "<!-- <item> -->" + item(1) + "\n<item a='b'><guid><![CDATA[ </item> ]]></guid></item>"
            + "<item><guid>3</guid>" + item(4) + "<item/><itemx>no</itemx><item><guid>5</guid> rest")
    whole = list(fs.cut_items([text]))
    assert [w for _t, w in whole] == [True, True, False, True, True, False]
    rng = random.Random(5)
    for _ in range(300):
        blocks, at, width = [], 0, rng.choice([3, 30, 300])
        while at < len(text):
            n = rng.randint(1, width)
            blocks.append(text[at:at + n])
            at += n
        assert list(fs.cut_items(blocks)) == whole


def test_good_items_of_broken_files_stay(tmp_path):
    f = tmp_path / "feed_1.xml"
    f.write_text(HEAD + item(0) + "<item><guid>x</guid><title>a & b</title></item>" + item(2, "<category> c++ </category><dc:creator>n</dc:creator>")
                 + "<item><title>none</title></item>" + item(4) + "<item><guid>cut")
    got = rows(f)
    assert [r[0] for r in got] == [0, 1, 2, 3, 4, 5]
    good = [r[:5] for r in got if r[5] is None]
    assert good == [(0, "http://j/0", "t0", "a", ["java"]), (2, "http://j/2", "t2", "a", ["java", "c++"]),
                    (4, "http://j/4", "t4", "a", ["java"])]
    problems = {r[0]: r[5] for r in got if r[5]}
    assert sorted(problems) == [1, 3, 5] and problems[3] == "no guid" and problems[5] == "the item has no end"


def test_encodings_and_odd_files(tmp_path):
    (tmp_path / "a").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?><item><guid>\xe9</guid></item>'.encode("latin-1"))
    (tmp_path / "b").write_bytes(HEAD.encode() + b"<item><guid>\xff</guid></item>" + item(2).encode())
    (tmp_path / "c").write_bytes(b'<?xml version="1.0" encoding="no-such"?><item><guid>1</guid></item>')
    (tmp_path / "d").write_bytes(b"")
    (tmp_path / "e").write_bytes((HEAD + item(7)).encode("utf-16"))
    assert [(r[1], r[5]) for r in rows(tmp_path / "a")] == [("\xe9", None)]
    assert [(r[1], r[5]) for r in rows(tmp_path / "b")] == [(None, "bytes outside the encoding"), ("http://j/2", None)]
    assert len(rows(tmp_path / "c")) == 1 and rows(tmp_path / "c")[0][5].startswith("the file cannot be decoded")
    assert rows(tmp_path / "d") == []
    assert [r[1] for r in rows(tmp_path / "e")] == ["http://j/7"]


def land(folder, name, text, t):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    os.utime(folder / name, (t, t))


def test_batch_reads_the_feeds_files_in_order(spark, tmp_path):
    land(tmp_path / "feed_index=3", "part-1.xml", HEAD + item("c") + "<item><guid>", 1)
    land(tmp_path / "feed_index=3", "part-0.xml", HEAD + item("a") + "<item></item>" + item("b"), 2)
    land(tmp_path, "_SUCCESS", "", 3)
    good, aside = fs.read_feeds(spark, str(tmp_path))
    assert sorted((r.feed_index, r.item_index, r.guid) for r in good.collect()) == [
        (3, 0, "http://j/a"), (3, 2, "http://j/b"), (3, 3, "http://j/c")]
    assert sorted((r.place, r.problem) for r in aside.collect()) == [(1, "no guid"), (1, "the item has no end")]


def test_offsets_name_each_file_once(tmp_path):
    reader = fs.FeedStreamReader({"path": str(tmp_path)})
    now, seen, offset = time.time() - 100, [], reader.initialOffset()
    assert reader.latestOffset() == offset
    for k, t in enumerate([now, now, now + 1, now + 1, now + 5]):     # two files land later with a time already taken
        land(tmp_path, f"feed_{9 - k}.xml", HEAD, t)
        end = reader.latestOffset()
        seen += [os.path.basename(p.path) for p in reader.partitions(offset, end)]
        assert reader.partitions(end, end) == []
        offset = end
    assert seen == [f"feed_{9 - k}.xml" for k in range(5)]
    young = fs.FeedStreamReader({"path": str(tmp_path), "settle": "97"})
    assert [os.path.basename(p) for p in young.latestOffset()["files"]] == ["feed_6.xml", "feed_7.xml"]


def test_items_aside_as_a_stream(spark, tmp_path):
    land(tmp_path / "land", "feed_1.xml", HEAD + item(0) + "<item><guid>cut", 1)
    keyed.stream_items_aside(spark, str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    land(tmp_path / "land", "feed_2.xml", HEAD + "<item/>", 2)
    keyed.stream_items_aside(spark, str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("feed_index", "problem", "raw").collect()
    assert sorted(map(tuple, got)) == [(1, "the item has no end", "<item><guid>cut"), (2, "no guid", "<item/>")]


def test_a_reader_holds_a_bounded_number_of_items(tmp_path):
    f = tmp_path / "feed_1.xml"
    f.write_text(HEAD + "".join(map(item, range(3 * fs.BATCH_ITEMS + 5))) + "<item><guid>cut")
    reader = fs.FeedSource({"path": str(tmp_path)}).reader(None)
    batches = list(reader.read(reader.partitions()[0]))
    assert [len(b) for b in batches] == [fs.BATCH_ITEMS] * 3 + [6]
    assert [tuple(r.values()) for b in batches for r in b.to_pylist()] == list(fs.read_file(reader.partitions()[0]))
