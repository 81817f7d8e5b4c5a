"""Text dataflows, names, dates, cleaning, page extraction, feeds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from jobmatch.functions import text as T
from jobmatch.operators import pages, skills, textflows
from jobmatch.sources import feeds
from tests.conftest import FIXTURES


def test_inverted_index_golden(spark):
    df = spark.createDataFrame([(0, "a b\na a\n\nc")], "k long, text string")
    got = {r.word: r.line_numbers for r in textflows.word_line_index(df, "k").collect()}
    assert got == {"a": "[0 1 1]", "b": "[0]", "c": "[3]"}


def test_word_count_keeps_empty_tokens(spark):
    lines = spark.createDataFrame([("a  b",), ("",), ("a",)], "line string")
    got = {r.token: r["count"] for r in textflows.word_count(lines).collect()}
    assert got == {"a": 2, "b": 1, "": 2}


def test_token_count_filtered_reference_params(spark):
    lines = spark.createDataFrame([("#c:d",), ("root:x:0",), ("a",), ("",)], "line string")
    assert textflows.token_count_filtered(lines, ":", "#").collect()[0]["count"] == 5


def test_text_file_sources(spark, tmp_path):
    from jobmatch.sources.text import text_lines, whole_text_files
    p = tmp_path / "f.txt"
    p.write_text("a b\nc\n")
    assert [r.line for r in text_lines(spark, str(p)).collect()] == ["a b", "c"]
    w = whole_text_files(spark, str(tmp_path)).collect()
    assert w[0].name == "f.txt" and w[0].text == "a b\nc\n"


def test_clean_text_golden():
    from jobmatch.functions.clean import nfkd_ascii
    assert nfkd_ascii("café … “q”\n\tz\x7f") == "cafe ... qz"


def test_rfc850_golden(spark):
    ts = dt.datetime(2026, 12, 1, 18, 0, 0, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(ts,)], "ts timestamp")
    assert df.select(T.rfc850(F.col("ts"))).first()[0] == "Tuesday, 01-Dec-26 18:00:00 UTC"


def test_names_round_trip(spark):
    prefix = T.SITE_PREFIX
    df = spark.createDataFrame([(prefix + "103310/senior-engineer",), (prefix + "1/a_b",)], "url string")
    out = df.select(T.url_to_doc_name(F.col("url"), prefix_regex=prefix.replace(".", r"\.")).alias("n"))
    out = out.select("n", T.base_name(F.col("n")).alias("b"))
    out = out.select("n", "b", T.doc_name_to_url(F.col("b")).alias("u")).collect()
    assert out[0].n == "jobs_sof/103310_senior-engineer"
    assert out[0].b == "103310_senior-engineer"
    assert out[0].u == prefix + "103310/senior-engineer"
    assert out[1].u != prefix + "1/a_b"    # a slug with "_" does not survive the way back


def test_page_extraction_golden(spark):
    html = open(os.path.join(FIXTURES, "job_page.html"), encoding="utf-8").read()
    df = spark.createDataFrame([("u", html)], "url string, html string")
    r = pages.extract_sections(df, pages.SITE_SELECTORS).first()
    assert r.title == "Dev & Ops cafe"
    assert r.location == "Austin,TX"
    assert r.skills == ["java", "c++"]
    assert r.description == ["Build fast & safe", "Second...", "one two"]
    assert r.requirements == ["Need", "a ", " c", "inner"]
    assert r.about == ["We", "are"]


def test_ingest_pages_skips_stored_and_counts(spark):
    html = open(os.path.join(FIXTURES, "job_page.html"), encoding="utf-8").read()
    raw = spark.createDataFrame([
        ("http://x/jobs/1/a", html, 200), ("http://x/jobs/2/b", html, 200),
        ("http://x/jobs/3/c", html, 404), ("https://x/jobs/1/a", html, 200)],
        "url string, html string, http_status int")
    stored = spark.createDataFrame([("jobs_sof/x_jobs_2_b",)], "doc_name string")
    ts = F.lit("2026-12-01T18:00:00Z").cast("timestamp")
    docs, totals = pages.ingest_pages(raw, stored, ts)
    d = docs.collect()
    assert [r.doc_name for r in d] == ["jobs_sof/x_jobs_1_a"]
    assert d[0].url == "http://x/jobs/1/a"        # lowest URL of a duplicated name
    assert d[0].body.startswith("http://x/jobs/1/a\n\nDATE: Tuesday, 01-Dec-26 18:00:00 UTC\n\nTITLE: Dev & Ops cafe")
    assert d[0].body.endswith("REQUIREMENTS: Need\na \n c\ninner\n")
    t = totals.first()
    assert (t.passed, t.failed) == (1, 2)


def test_rss_reader_quarantine(spark):
    items = feeds.read_feed_items(spark, os.path.join(FIXTURES, "rss"))
    good, bad = feeds.split_quarantine(items)
    g = sorted(good.collect(), key=lambda r: r.guid)
    assert [r.guid for r in g] == ["g1", "g2"]
    assert g[0].category == ["java", "c++"] and g[0].author == "ann" and g[0].feed_index == 0
    assert g[1].category is None or g[1].category == []
    b = bad.collect()
    assert len(b) == 1 and b[0]._corrupt_record is not None and b[0].guid is None


def test_skill_counts_seeded_and_ranked(spark):
    items = spark.createDataFrame([(0, 0, ["java", "c++"]), (0, 1, ["java"]), (1, 0, ["go"])],
                                  "feed_index int, item_index long, category array<string>")
    vocab = spark.createDataFrame([("rust",), ("java",)], "skill string")
    c = skills.skill_counts(items, vocab)
    assert {r.skill: r["count"] for r in c.collect()} == {"java": 2, "c++": 1, "go": 1, "rust": 0}
    pos = {r.skill: r.position for r in skills.skill_positions(c).collect()}
    assert pos == {"java": 0, "c++": 1, "go": 2, "rust": 3}
    rc = {(r.feed_index, r.item_index, r.category): r.running_count
          for r in skills.category_running_count(items, bucket_width=1).collect()}
    assert rc[(0, 0, "java")] == 1 and rc[(0, 1, "java")] == 2 and rc[(1, 0, "go")] == 1


def test_running_count_hot_key_many_buckets(spark):
    """A key holding most rows is cut into buckets; counts still run 1..n in order."""
    from jobmatch.plans.ranking import running_count
    rows = [(i, "hot" if i % 10 else "cold") for i in range(2000)]
    df = spark.createDataFrame(rows, "i long, k string")
    out = running_count(df, ["k"], [F.col("i")], F.floor(F.col("i") / 37))
    got = sorted((r.k, r.i, r.running_count) for r in out.collect())
    hot = [x for x in got if x[0] == "hot"]
    assert [x[2] for x in hot] == list(range(1, len(hot) + 1))
    assert [x[1] for x in hot] == sorted(x[1] for x in hot)


def test_skill_history_current(spark):
    h = spark.createDataFrame([("a", 1, dt.datetime(2026, 1, 1)), ("a", 0, dt.datetime(2026, 1, 2)),
                               ("b", 3, dt.datetime(2026, 1, 1))], "skill string, count long, run_ts timestamp")
    got = {r.skill: r["count"] for r in skills.current_counts(h).collect()}
    assert got == {"a": 0, "b": 3}


def test_sinks_round_trip(spark, tmp_path):
    from jobmatch.operators import sinks
    from jobmatch.sources.models import read_model, read_skill_history
    from jobmatch.sources.vocabulary import read_skills_csv
    c = spark.createDataFrame([("java", 2), ("c++", 5)], "skill string, count long")
    sinks.write_skills_csv(c, str(tmp_path / "skills"))
    back = read_skills_csv(spark, str(tmp_path / "skills"))
    assert {r.skill: r["count"] for r in back.collect()} == {"java": 0, "c++": 0}
    assert read_skills_csv(spark, str(tmp_path / "missing")).count() == 0
    sinks.append_skill_run(c, str(tmp_path / "hist"), "2026-12-01 00:00:00")
    sinks.append_skill_run(c.limit(1), str(tmp_path / "hist"), "2026-12-02 00:00:00")
    assert read_skill_history(spark, str(tmp_path / "hist")).count() == 3
    m = spark.createDataFrame([(1, "java", 1, 0.5, 1.0)], "doc long, skill string, tf long, idf double, weight double")
    sinks.write_model(m, str(tmp_path / "model"))
    sinks.write_model(m, str(tmp_path / "model"))
    assert read_model(spark, str(tmp_path / "model")).count() == 1


def test_parser_implies_html_head_body():
    from jobmatch.functions.html_extract import parse, select, string_value
    root = parse("<title>T</title><p>a<p>b<ul><li>x<li>y</ul>")
    assert [string_value(n) for n in select(root, "/html/head/title")] == ["T"]
    assert [string_value(n) for n in select(root, "/html/body/p")] == ["a", "b"]
    assert [string_value(n) for n in select(root, "//ul/li")] == ["x", "y"]
    full = parse("<!DOCTYPE html><html><head><title>U</title></head><body><div id='d'><p>q</p></div></body></html>")
    assert [string_value(n) for n in select(full, "p", root_id="d")] == ["q"]
    assert [string_value(n) for n in select(full, "/html/head/title")] == ["U"]


def test_extraction_job_agrees_with_native_patterns(spark):
    """On every sf0.01 page: the parser's title and nav links equal the native regex
    fields after the same cleaning (NFKD + ASCII strip, entity decoding)."""
    from jobmatch.functions.clean import nfkd_ascii, unescape
    from tests.conftest import SF01
    p = spark.read.parquet(f"{SF01}/pages.parquet")
    native = {r.page_id: (r.t, r.l) for r in p.select(
        "page_id", T.page_title(F.col("html")).alias("t"), T.page_links(F.col("html")).alias("l")).collect()}
    sec = pages.extract_sections(p, pages.DRIVER_SELECTORS, keep=("page_id",)).collect()
    assert len(sec) == len(native)
    for r in sec:
        t, links = native[r.page_id]
        assert r.title == unescape(nfkd_ascii(t))
        # an element whose text cleans to nothing stays, with an empty value
        assert r.skills == [unescape(nfkd_ascii(y)) for y in links]


def test_rfc850_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.range(1).select(F.lit("2026-12-01T18:00:00Z").cast("timestamp").alias("ts"))
        assert df.select(T.rfc850(F.col("ts"))).first()[0] == "Tuesday, 01-Dec-26 18:00:00 UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_word_line_index_row_equals_group(spark):
    from tests.conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, ""), (-2, "  \n "), (-3, "b a\n\na b a"), (-4, None)],
                                  "doc_id long, text string")
    docs = docs.unionByName(extra)
    a = textflows.word_line_index(docs, "doc_id", method="row")
    b = textflows.word_line_index(docs, "doc_id", method="group")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    got = {r.word: r.line_numbers for r in a.filter("doc_id = -3").collect()}
    assert got == {"a": "[0 2 2]", "b": "[0 2]"}


def test_feed_index_from_partitioned_landing(spark, tmp_path):
    """Feeds landed by Spark, one folder per feed, read back with their feed index and
    item positions."""
    from jobmatch.streaming.jobs import land_feed_items
    items = spark.createDataFrame(
        [(2, 0, "g1", "t", ["java"]), (2, 1, "g2", "t", []), (5, 0, "g3", "t", ["go"])],
        "feed_index int, item_index long, guid string, title string, category array<string>")
    land_feed_items(items, str(tmp_path / "land"))
    got = sorted((r.feed_index, r.guid) for r in feeds.read_feed_items(spark, str(tmp_path / "land")).collect())
    assert got == [(2, "g1"), (2, "g2"), (5, "g3")]


def test_ingest_job_first_run_and_rerun(spark, tmp_path):
    """First run into a missing store ingests; a second run adds nothing."""
    from jobmatch.plans.batch_jobs import ingest_job
    html = open(os.path.join(FIXTURES, "job_page.html"), encoding="utf-8").read()
    raw = spark.createDataFrame([("http://x/jobs/1/a", html, 200), ("http://x/jobs/2/b", html, 404)],
                                "url string, html string, http_status int")
    ts = F.lit("2026-12-01T18:00:00Z").cast("timestamp")
    store = str(tmp_path / "store")
    t1 = ingest_job(spark, raw, store, ts).first()
    assert (t1.passed, t1.failed) == (1, 1)
    t2 = ingest_job(spark, raw, store, ts).first()
    assert (t2.passed, t2.failed) == (0, 1)
    assert spark.read.parquet(store).count() == 1


def test_a_url_listed_twice_is_stored_once(spark):
    from jobmatch.operators import pages
    raw = spark.createDataFrame(
        [("http://h/a", "<p>x</p>", 200), ("http://h/a", "<p>x</p>", 200), ("http://h/b", "<p>y</p>", 200)],
        "url string, html string, http_status int")
    stored = spark.createDataFrame([], "doc_name string")
    docs, totals = pages.ingest_pages(raw, stored, F.current_timestamp(), pages.DRIVER_SELECTORS)
    assert docs.count() == 2 and tuple(totals.first()) == (2, 1)


def test_a_marked_section_does_not_cut_the_page():
    from jobmatch.operators.pages import extract_page
    rows = extract_page("<article><p>a</p><![foo[ x ]]><p>b</p></article>", [("description", 0, None, "//article/p")])
    assert ["a", "b"] in rows


def test_blanks_of_a_skill_survive_the_csv(spark, tmp_path):
    from jobmatch.operators.sinks import write_skills_csv
    from jobmatch.sources.vocabulary import read_skills_csv
    rows = [(" c ", 2), ("c", 1)]
    write_skills_csv(spark.createDataFrame(rows, "skill string, count long"), str(tmp_path / "csv"))
    assert sorted(r.skill for r in read_skills_csv(spark, str(tmp_path / "csv")).collect()) == [" c ", "c"]


def test_items_are_numbered_over_all_files_of_a_feed(spark, tmp_path):
    from jobmatch.sources.feeds import read_feed_items
    folder = tmp_path / "feed_index=3"
    folder.mkdir()
    for k in (0, 1):
        items = "".join(f"<item><guid>g{k}{i}</guid></item>" for i in range(2))
        (folder / f"part-{k}.xml").write_text(f"<channel>{items}</channel>")
    got = sorted((r.feed_index, r.item_index, r.guid) for r in read_feed_items(spark, str(tmp_path)).collect())
    assert got == [(3, 0, "g00"), (3, 1, "g01"), (3, 2, "g10"), (3, 3, "g11")]


def test_a_repeated_skill_run_is_stored_once(spark, tmp_path):
    from jobmatch.operators.sinks import append_skill_run
    counts = spark.createDataFrame([("a", 1)], "skill string, count long")
    for ts in ("2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", "2026-01-01T05:00:00Z"):
        append_skill_run(counts, str(tmp_path / "h"), ts)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 2


# ---- the corpus index (A1 over all texts) --------------------------------------------------

def corpus_texts():
    import random
    rnd = random.Random(11)
    texts = [(i * 3, "\n".join(" ".join(rnd.choice(["hot", "hot", "a", "b", f"w{rnd.randrange(50)}", ""]) for _ in range(
        rnd.randint(0, 8))) for _ in range(rnd.randint(1, 6)))) for i in range(120)]
    return texts + [(-1, "first of all"), (1000, None), (1001, ""), (1002, "\n\n")]


def test_corpus_index_has_every_line_of_every_word(spark):
    from jobmatch.operators import textflows
    rows = corpus_texts()
    want, line = [], 0
    for _, text in sorted(rows):
        if text is not None:
            for part in text.split("\n"):
                want += [(w, line) for w in part.split(" ") if w]
                line += 1
    df = spark.createDataFrame(rows, "word long, text string").repartition(5)     # a key that is named like an output
    index = textflows.corpus_word_index(df, "word", block=16)
    blocks = index.collect()
    assert sorted((r.word, r.line) for r in textflows.block_lines(index).collect()) == sorted(want)
    assert max(r.n for r in blocks) <= 16 and sum(r.word == "hot" for r in blocks) > 20
    assert sum(r.n for r in blocks) == len(want) and all(r.first_line <= r.last_line for r in blocks)
    in_order = sorted((r.block, r.word, r.first_line) for r in blocks)
    assert in_order == sorted(in_order, key=lambda x: (x[1], x[2]))               # blocks follow (word, line)


def test_corpus_index_of_nothing_and_stored(spark, tmp_path):
    from jobmatch.operators import textflows
    df = spark.createDataFrame(corpus_texts(), "id long, text string")
    assert textflows.corpus_word_index(df.limit(0), "id").count() == 0
    index = textflows.corpus_word_index(df, "id", block=16)
    textflows.write_index(index, str(tmp_path / "index"))
    back = textflows.lines_of_words(spark.read.parquet(str(tmp_path / "index")), ["all", "none"])
    assert [r.word for r in back.collect()] == ["all"]
    assert "PushedFilters: [In(word" in back._jdf.queryExecution().executedPlan().toString()


def test_running_sum_over_many_partitions(spark, monkeypatch):
    from jobmatch.plans import ranking
    monkeypatch.setattr(ranking, "RUN_ROWS", 4)
    rows = [(i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    got = {r.k: r.s for r in ranking.running_sum(df, [F.col("k")], "v", "s").collect()}
    assert got == {k: sum(v for _, v in rows[:k]) for k, _ in rows}


def test_landed_texts_are_read_whole_at_any_depth(spark, tmp_path):
    from jobmatch.sources import text as S
    rows = [(i, f"text {i}\nends here") for i in range(300)] + [(900, None), (901, ""), (902, "x"), (902, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "docs")
    assert S.land_texts(df, "doc_id", path) == S.land_texts(df, "doc_id", path) == len(rows)      # run again: replaced
    files = S.whole_text_files(spark, path)
    got = sorted((int(r.path.split("doc_id=")[1].split("/")[0]), r.text) for r in files.collect())
    assert got == [(i, t + "\n") for i, t in rows[:300]] + [(900, "\n"), (901, "\n"), (902, "x\nx\n")]
    shards = os.listdir(path)
    assert 100 < len(shards) <= S.SHARDS and sum(len(os.listdir(f"{path}/{s}")) for s in shards) == 303


def test_whole_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    import bz2
    import gzip
    import zlib

    import pyarrow as pa
    from jobmatch.sources import text as S
    root = tmp_path / "a b"
    files = {"k=a b%20c/\u00e9#x?y/f g%41+.txt": b"one\r\ntwo", "bad.txt": b"\xff\xfea\x00\xc3", "bom.txt": b"\xef\xbb\xbfhi",
             "empty.txt": b"", "deep/er/f.txt": b"x", "_h/f.txt": b"no", ".h/f.txt": b"no", "_h=1/f.txt": b"yes",
             "_metadata/f.txt": b"yes", "_f": b"no", "_f=1": b"yes", "a._COPYING_": b"no", "g.gz": gzip.compress(b"g") * 2,
             "b.BZ2": bz2.compress(b"b"), "d.deflate": zlib.compress(b"d"), "e.gz": gzip.compress(b"")}
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    with pa.CompressedOutputStream(str(root / "z.zst"), "zstd") as f:
        f.write(b"z")
    spark.createDataFrame([("l",)], "t string").coalesce(1).write.option("compression", "lz4").text(str(root / "[l]"))
    (root / "none").symlink_to("gone")
    rows = lambda df: sorted(tuple(r) for r in df.select("path", F.col("text").cast("binary")).collect())
    want, real = rows(S._spark_whole_files(spark, str(root))), S._spark_whole_files
    assert len(want) == 13
    monkeypatch.setattr(S, "_spark_whole_files", lambda s, *paths: real(s, *paths) if all(
        p.endswith(".lz4") for p in paths) else pytest.fail("the driver lists the files"))
    got = S.whole_text_files(spark, str(root))
    assert rows(got) == want
    assert {r.name for r in got.collect()} == {p.rsplit("/", 1)[1] for p, _ in want}
    (tmp_path / "no files").mkdir()
    assert S.whole_text_files(spark, str(tmp_path / "no files")).collect() == []
    monkeypatch.setattr(S, "_spark_whole_files", real)
    assert rows(S.whole_text_files(spark, str(tmp_path / "*"))) == want               # patterns are Spark's
    assert rows(S.whole_text_files(spark, str(root / "bad.txt"))) == [r for r in want if r[0].endswith("bad.txt")]


def test_words_of_a_line_are_counted_in_its_row(spark):
    rows = [("b a  b b",), ("",), (None,), (" ",), ("a",)]
    got = spark.createDataFrame(rows, "line string").select(textflows.words_of_line(F.col("line")).alias("w")).collect()
    assert [[tuple(x) for x in r.w or []] for r in got] == [[("a", 1), ("b", 3)], [], [], [], [("a", 1)]]


def test_corpus_index_is_cut_by_the_size_of_the_texts(spark, monkeypatch):
    from jobmatch.plans import ranking
    df = spark.createDataFrame(corpus_texts() + [(None, "no key\nno no")], "id long, text string")
    index = lambda: sorted(map(str, textflows.corpus_word_index(df, "id", block=16).collect()))
    want, widths, real = index(), [], ranking.running_sum
    monkeypatch.setattr(textflows, "TASK_BYTES", 200)
    monkeypatch.setattr(ranking, "running_sum", lambda *a, **k: widths.append(a[4] if len(a) > 4 else None) or real(*a, **k))
    assert index() == want
    size = sum(len(t or "") for _, t in corpus_texts()) + len("no key\nno no")
    assert widths == [None, -(-size // 200)] and widths[1] > 8
