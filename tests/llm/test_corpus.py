"""Operators that compare documents, pages and models, against brute force."""

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobmatch.llm import components, decontamination, html_templates, maxent, odd_sketch, quality, secrets
from tests.llm.conftest import CLASH, odd_rows, shingles, words

SF01 = "/root/testdata/sf0.01"


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_components(rows, n, threshold=80):
    """Smallest id that each row reaches; nodes are sets, ids only name them."""
    sets = sorted({shingles(t, n) for _, t in rows} - {frozenset()}, key=sorted)
    g = Groups()
    for i, a in enumerate(sets):
        g.find(i)
        for j, b in enumerate(sets[:i]):
            k = len(a & b)
            if 100 * k >= threshold * (len(a) + len(b) - k):
                g.join(i, j)
    place = {s: i for i, s in enumerate(sets)}
    least = {}
    for i, t in rows:
        s = shingles(t, n)
        if s and i is not None:
            c = g.find(place[s])
            least[c] = min(i, least.get(c, i))
    return collections.Counter(
        (i, len(s), i if not s else least.get(g.find(place[s]))) for i, t in rows for s in [shingles(t, n)])


def near_rows():
    """Rings of near copies around a few texts: some linked only through others."""
    rnd = np.random.default_rng(4)
    rows = []
    for base in range(3):
        text = [f"b{base}w{k}" for k in range(120)]
        for copy in range(60):
            w = list(text)
            for k in rnd.choice(120, rnd.integers(0, 12), replace=False):
                w[k] = f"x{base}y{copy}z{k}"
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_are_those_of_all_pairs(spark, odd_docs, no_docs, n):
    rows = [(i, t) for i, t, _ in odd_rows()]
    got = odd_sketch.near_duplicates(odd_docs, n).collect()
    assert collections.Counter(tuple(r[:3]) for r in got) == brute_components(rows, n)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert odd_sketch.near_duplicates(no_docs, n).count() == 0


def test_large_groups_of_near_copies(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert collections.Counter(tuple(r[:3]) for r in odd_sketch.near_duplicates(docs, 4).collect()) == brute_components(rows, 4)


def test_a_near_copy_outside_the_crowded_buckets_is_linked(spark):
    rnd = random.Random(5)
    own = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    passage = own(60)
    rows = [(i, " ".join(passage + own(25))) for i in range(120)]
    for k in range(30):
        rest = own(140)
        rows += [(1000 + 2 * k, " ".join(passage + rest)), (1001 + 2 * k, " ".join(passage[36:] + rest))]
    bands, _ = odd_sketch._signatures([odd_sketch.shingle_set(t, 4) for _, t in rows])
    size = collections.Counter(bands.ravel().tolist())
    crowded = {i for (i, _), own_ in zip(rows, bands.tolist()) if any(size[b] > odd_sketch.CROWD for b in own_)}
    assert any(i in crowded and i + 1 not in crowded for i in range(1000, 1060, 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in odd_sketch.near_duplicates(docs, 4).collect()}
    assert got == {i: i - (i > 1000 and i % 2) for i, _ in rows}


def test_sets_are_made_for_slices_of_a_batch():
    texts = ["word " * 200] * 5000 + [None, "", "x" * (3 << 20), "last"]
    batch = pa.record_batch({"id": list(range(len(texts))), "text": texts})
    slices = list(odd_sketch._slices(iter([batch, batch.slice(0, 0), batch.slice(4999)]), 1))
    assert [i for s in slices for i in s["id"].to_pylist()] == [*range(5004), *range(4999, 5004)]
    assert all(s.num_rows == 1 or sum(len(t or "") for t in s["text"].to_pylist()) <= odd_sketch.SLICE for s in slices)


def test_sketches_estimate_high_similarities():
    rnd = np.random.default_rng(1)
    for shared in (400, 450, 490):
        a = rnd.integers(0, 1 << 63, 500, np.uint64)
        b = np.concatenate([a[:shared], rnd.integers(0, 1 << 63, 500 - shared, np.uint64)])
        _, s = odd_sketch._signatures([np.unique(a), np.unique(b)])
        bits = int(np.unpackbits((s[0] ^ s[1]).view(np.uint8)).sum())
        differ = math.log(1 - 2 * bits / odd_sketch.BITS) / math.log(1 - 2 / odd_sketch.BITS)
        assert abs(1 - differ / 2 / odd_sketch.BANDS / odd_sketch.ROWS - shared / (1000 - shared)) < 0.15


def test_one_of_each_group_stays(odd_docs):
    out = odd_sketch.deduplicate(odd_docs)
    assert out.dtypes == odd_docs.dtypes
    ids = {r.doc_id for r in out.collect()}
    assert {1, 7, 9, 4, 5} <= ids and not {2, 3, 8, 10} & ids


def test_one_row_of_each_group_stays_without_ids_too(spark):
    text = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcd"]
    rows = [(1, text[0]), (None, text[0]), (None, text[1]), (None, text[1]), (5, text[2]), (5, text[2]), (5, text[3]),
            (2, text[3]), (None, "")]
    out = odd_sketch.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert collections.Counter(map(tuple, out.collect())) == collections.Counter(
        [(1, text[0]), (None, text[1]), (5, text[2]), (2, text[3]), (None, "")])


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(300, 300)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and len({got[100 + k] for k in range(50)}) == 1
    assert got[0] != got[100] and 300 not in got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- decontamination

def brute_leaks(docs, items, threshold=80):
    best = {}
    for i, t in docs:
        s = shingles(t, 5)
        for k, x in items:
            q = shingles(x, 5)
            n = len(s & q)
            if q and 100 * n >= threshold * len(q):
                best[i, k] = max(best.get((i, k), (0, 0, 0)), (n / len(q), n, len(q)))
    return {(*k, v[1], v[2]) for k, v in best.items()}


def test_leaks_are_those_of_all_pairs(spark, odd_docs, no_docs):
    items = [(1, "Line 3 says that thing 3 is good and thing 4 is not so bad."), (2, None), (3, ""), (4, "one two three"),
             (5, "line 3 says THAT thing 3 is good and thing 4 is not so bad. Line 4 says that something"), (None, "one two three"),
             (6, "word0 fills the long text number 0. word1 fills the long text number 1."), (6, "nothing of the kind is here")]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r[:4]) for r in decontamination.leaks(odd_docs, items_df).collect()}
    assert got == brute_leaks([(i, t) for i, t, _ in odd_rows()], items) and got
    assert decontamination.leaks(no_docs, items_df).count() == 0
    assert decontamination.leaks(odd_docs, items_df.limit(0)).count() == 0
    clean = decontamination.decontaminate(odd_docs, items_df)
    found = {x[0] for x in brute_leaks([(k, t) for k, (_, t, _) in enumerate(odd_rows())], items)}
    stay = collections.Counter((i, t) for k, (i, t, _) in enumerate(odd_rows()) if k not in found)
    assert clean.dtypes == odd_docs.dtypes and collections.Counter((r.doc_id, r.text) for r in clean.collect()) == stay
    assert stay[(None, None)] and not any(i in (1, 2, 7, 9) for i, _ in stay)
    assert decontamination.decontaminate(no_docs, items_df).collect() == []
    assert decontamination.decontaminate(odd_docs, items_df.limit(0)).count() == len(odd_rows())


def test_clean_rows_beside_a_leaking_one_stay(spark):
    item = "one two three four five six seven"
    rows = [(None, f"so {item} it is"), (None, "a clean text of no id at all"), (3, item), (3, "another text of this id"),
            (4, "clean and alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = decontamination.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {tuple(r) for r in out.collect()} == {rows[1], rows[3], rows[4]}


def test_leaks_of_the_benchmark(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert {tuple(r[:4]) for r in decontamination.leaks(docs, items).collect()} == want and want


# ---- main text of pages

PAGE = ('<!DOCTYPE html><html><head><title>T</title><script>var t="</p><article>";</script></head><body><nav><ul><li>'
        '<a href="/x">menu</a></ul></nav><div class="ad">buy</div><article><h1>Head {k}</h1><p><b>First  line<br><p>A &amp; '
        'B\n {k}</p><div class="comments"><p>me too</p></div><form>f<input value="a>b"></form><p>Last</p></article>'
        '<footer>&copy; end</footer></body></html>')


def test_main_text_of_one_layout(spark):
    rows = [(k, f"http://h{k % 2}.x/{k}", PAGE.replace("{k}", str(k))) for k in range(8)]
    rows += [(90, "http://lone.x/1", PAGE.replace("{k}", "9")), (91, None, None), (92, "http://h0.x/e", ""),
             (93, "http://h0.x/n", "<p>bare</p> text <![foo[ x ]]> &lt;tag&gt;"), (0, "http://h0.x/0", PAGE.replace("{k}", "0"))]
    pages = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, html string, text string, host string")
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in html_templates.main_texts(pages).collect())
    want = collections.Counter()
    for i, _, h in rows:
        text = "" if not h else "bare\ntext <tag>" if i == 93 else f"Head {i if i < 90 else 9}\nFirst line\nA & B {i if i < 90 else 9}\nLast"
        want[(i, text, len(text))] += 1
    assert got == want
    assert html_templates.main_texts(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    '<html class="no-cookies"><body class="single has-sidebar">{}</body></html>', '<body class="no-sidebar">{}</body>',
    '<body class="has-navbar-fixed-top"><main id="header">{}</main></body>',
    '<article class="post comments-open">{}</article>', '<article class="comments">{}</article>',
    '<body><div class="page with-sidebar">{}</div></body>', '<div id="modal"><div class="notice">{}</div></div>'])
def test_names_do_not_empty_pages(page):
    inner = ('<h1>Head</h1><p>All of the text that this page has.</p><div class="x site-footer">(c)</div>'
             '<div id="cookie-banner">no</div><p class="ad">buy</p>')
    assert html_templates.extract(page.format(inner), None) == "Head\nAll of the text that this page has."


LAYOUTS = {
    "main": ('<div class="topbar-links">All topics</div><main><h1>Head {k}</h1><p class="lead">Lead {k}</p><div class="content">'
             '<p>Body {k} and much more text than elsewhere</p><p>Same words</p></div></main>'),
    "divs": ('<div class="topbar-links">All topics</div><div class="post-{k}"><h2>Head {k}</h2><p class="lead">Lead {k}</p>'
             '<div class="content"><p>Body {k} and much more text than elsewhere</p><p>Same words</p></div>'
             '<div class="author-bio"><p>About the author</p></div></div>')}


def layout_pages(spark, layout, n=5):
    page = "<html><body>" + LAYOUTS[layout] + '<div class="rightcol"><p>Follow us</p><ul><li>every day</ul></div></body></html>'
    return spark.createDataFrame([(k, f"http://l.x/{k}", page.replace("{k}", str(k))) for k in range(n)],
                                 "page_id long, url string, html string")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_unnamed_boilerplate_goes_and_titles_stay(spark, layout, monkeypatch):
    pages = layout_pages(spark, layout)
    want = {k: f"Head {k}\nLead {k}\nBody {k} and much more text than elsewhere\nSame words" for k in range(5)}
    assert {r.page_id: r.text for r in html_templates.main_texts(pages).collect()} == want
    copies = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 10))      # copies change nothing
    assert {r.page_id: r.text for r in html_templates.main_texts(copies).collect()} == {
        k + d: t for k, t in want.items() for d in (0, 10)}
    if layout == "divs":                                  # without the classes nothing is the template's
        own = html_templates.classes
        monkeypatch.setattr(html_templates, "classes", lambda t: own(t).withColumn("own", F.lit(False)))
        got = {r.page_id: r.text for r in html_templates.main_texts(pages).collect()}
        assert all("Follow us" in t and "About the author" in t for t in got.values())


def test_near_copies_on_one_host_keep_their_title(spark):
    rows = [(k, f"http://n.x/{k}", f"<body><article><h1>One title</h1><p>Common</p><p>Text {k}</p></article></body>") for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_templates.main_texts(pages).collect()} == {
        k: f"One title\nCommon\nText {k}" for k in range(4)}


def test_main_text_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_templates.main_texts(pages).collect():
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# ---- language model

def test_scores(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    more = odd_docs.select("doc_id", "text")
    for table in (docs, more):
        source = [(r.doc_id, r.text) for r in table.collect()]
        fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
        count = collections.Counter(w for i, t in source if not fold(i) for w in [*words(t), None])
        total, distinct = sum(count.values()), len(count)
        got = maxent.scores(table).collect()

        def key(r):
            return str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 4)
        want = [(i, fold(i), len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), total,
                 sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in [*words(t), None])) for i, t in source]
        assert collections.Counter(map(key, got)) == collections.Counter(map(key, want))
        assert all(r.score <= 0 for r in got)
        if table is docs:
            for held in (False, True):
                assert sum(r.score for r in got if r.held_out == held) > sum(r.base_score for r in got if r.held_out == held)
    assert maxent.scores(no_docs).count() == 0


def test_counts_and_steps_are_over_all_training_tokens(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a b a c{i % 5} d " * (i % 4)) for i in range(60)], "doc_id long, text string")
    passes, real = [], maxent._counted
    monkeypatch.setattr(maxent, "_counted", lambda *a: passes.append(real(*a)) or passes[-1])
    tokens = maxent.scores(docs).first()["train_tokens"]
    assert len(passes) == 1 + maxent.STEPS
    for counted in passes:      # each token once in each of its four features
        assert abs(counted.sum() - 4 * tokens) < 1e-3 and np.allclose(counted.sum(1), passes[0].sum(1), rtol=1e-5)


def test_class_probabilities_sum_to_one():
    counts = np.array([50, 30, 20, 5, 5])
    m = maxent.Model(np.arange(5), counts, np.zeros(5, np.int64), 120, 9)
    m.weights[:] = np.random.default_rng(0).normal(size=m.weights.shape)
    ids = np.array([0, 1, 2, maxent.FREQUENT, 4], np.uint16)
    p = np.exp(m.log_softmax(m.features(ids, np.arange(5) == 0)))
    assert np.allclose(p.sum(1), 1)
    within = 10 ** m.within[:5]
    # the other words: 4 known ones with 10 tokens, and one share for all unknown ones
    rest = (10 + 4 + 1) / (m.rest + m.rest_distinct + 1)
    for row in p:
        assert abs(sum(row[m.class_of[k]] * within[k] for k in range(5)) + row[maxent.CLASSES] * rest - 1) < 1e-5


def test_history_tells_the_words_of_a_class_apart(spark):
    # b and c are as frequent and in one class: only what stands before them tells which one follows.
    texts = ["x b y c " * 40, "y c x b " * 40] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, vocabulary, encoded = maxent.fit(docs.withColumn("held_out", F.lit(False)))
    number = {r.h: i for i, r in enumerate(vocabulary.orderBy(F.desc("c"), "h").collect())}
    word = {w: number[int(maxent._hashes([w])[0][0])] for w in "xybc"}
    model.class_of[:] = 0                                             # one class holds them all
    model._grow()
    maxent._train(encoded, model)
    ids = np.array([word[w] for w in ("x", "b", "x", "c")], np.uint16)
    p = 10 ** model.word_given_class(ids, model.features(ids, np.array([True, False, True, False])))
    assert p[1] > 0.9 and p[3] < 0.05 and model.within[word["b"]] == model.within[word["c"]]


def test_words_of_a_class_sum_to_one_whatever_the_history():
    rng = np.random.default_rng(1)
    counts = np.sort(rng.integers(1, 1000, 300))[::-1].copy()
    m = maxent.Model(np.arange(300), counts, rng.integers(0, 4, 300), int(counts.sum()) + 50, 320)
    words = np.arange(300, dtype=np.uint16)
    history = np.tile(rng.integers(0, maxent.BUCKETS, 4), (300, 1))
    alone = m.word_given_class(words, history)
    assert np.allclose(alone, m.within[:300], atol=1e-4)              # without weights: the shares of counts
    m.slots[:] = rng.normal(size=len(m.slots))
    given = m.word_given_class(words, history)
    assert not np.allclose(given, alone, atol=0.1)
    for c in range(maxent.CLASSES):
        inside = m.class_of[:300] == c
        assert not inside.any() or abs((10 ** given[inside]).sum() - 1) < 1e-4
    other = np.array([maxent.FREQUENT], np.uint16)
    assert m.word_given_class(other, history[:1])[0] == 0


def test_sums_by_slot_and_by_feature_are_plain_sums(monkeypatch):
    rng = np.random.default_rng(2)
    place, rows = (rng.zipf(1.3, 5000) % 700).astype(np.uint16), rng.random((5000, 33)).astype(np.float32)
    got, want = np.zeros((700, 33)), np.zeros((700, 33))
    maxent._add_rows(got, place, rows)
    np.add.at(want, place, rows)
    assert np.allclose(got, want, rtol=1e-5)
    monkeypatch.setattr(maxent, "WALK", 100)
    counts = np.sort(rng.integers(1, 1000, 50))[::-1].copy()
    m = maxent.Model(np.arange(50), counts, np.zeros(50, np.int64), int(counts.sum()) + 50, 70)
    m.slots[:] = rng.normal(size=len(m.slots))
    ids = rng.choice(np.append(np.arange(50), maxent.FREQUENT), 730).astype(np.uint16)
    features = m.features(ids, rng.random(730) < 0.1)
    seen, step, plain = np.zeros((2, maxent.SLOTS)), np.zeros((1, maxent.SLOTS)), np.zeros((4, maxent.SLOTS))
    first, times = maxent._distinct(np.append(ids, ids), np.concatenate([features, features]))
    assert times.sum() == 2 * len(ids) and len({(*f, i) for i, f in zip(ids.tolist(), features.tolist())}) == len(times)
    twice = np.append(ids, ids)[first], np.concatenate([features, features])[first]
    m.add_turns(*twice, times, seen, True)
    m.add_turns(*twice, times, step, False)
    for i, f in zip(ids, features):
        for e in range(m.starts[i], m.starts[i] + m.steps[i]) if i < 50 else ():
            mixed = (f.astype(np.uint64) * maxent._ODD[1] >> np.uint64(40)).astype(np.int64)
            at = (mixed + m.place[e]) % maxent.SLOTS
            for x in at:
                plain[:, x] += 1, m.turn[e], 1 / (1 + math.exp(-m.odds[e])), 1 / (1 + math.exp(-m.odds[e] - m.slots[at].sum()))
    visits = np.floor(seen[0] / maxent.VISIT)
    got = np.stack([visits, seen[0] - visits * maxent.VISIT, seen[1], step[0]])
    assert np.allclose(got, 2 * plain, rtol=1e-4)


# ---- the pipeline

def test_stages_against_brute_force(spark, odd_docs, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    (tmp_path / "sf").mkdir()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    seen = docs
    for (name, stage), column in zip(corpus_pipeline.STAGES[:4], range(4)):
        out = stage(spark, seen, SF01)
        assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(column)))
        before, seen = {r.doc_id: r for r in seen.collect()}, spark.read.parquet(str(tmp_path / str(column)))
        after = {r.doc_id: r for r in seen.collect()}
        if column == 0:
            verdict = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
            assert set(after) == {i for i, k in verdict.items() if k}
        elif column == 1:
            want = brute_components([(i, r.text) for i, r in before.items()], 5)
            assert set(after) == {i for i, _, c in want if i == c}
        elif column == 2:
            assert set(before) - set(after) == {x[0] for x in brute_leaks([(i, r.text) for i, r in before.items()], items)}
        else:
            assert set(after) == set(before)
            spans = {r.doc_id: r.spans for r in secrets.scan(spark.read.parquet(str(tmp_path / "2"))).collect()}
            assert all((after[i].text != before[i].text) == bool(s) for i, s in spans.items())
        if column:
            assert all(after[i].text == before[i].text for i in after) or column == 3
    last = corpus_pipeline.STAGES[4][1](spark, seen, SF01)
    assert {r.doc_id for r in last.collect()} == set(after)
    assert corpus_pipeline.run(spark, SF01).count() == last.count()


def test_names_and_values_are_carried_by_every_stage(spark, odd_docs, no_docs):
    """Columns named like those that operators make, among them the usual key of exports."""
    names = ["_id", "_v", "_hit", "hit_id", "gone_id", "gone_v", "stays", "cd", "cv", "label", "_salt", "new", "best", "_place"]
    cells = [F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in names]
    docs = odd_docs.select("doc_id", "text", "lang", "n_chars", *cells)
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    for stage in (quality.clean, odd_sketch.deduplicate, lambda d: decontamination.decontaminate(d, items), secrets.redact):
        rows = stage(docs).collect()
        assert rows and all(r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}" for r in rows for c in names)
        empty = stage(docs.limit(0))
        assert empty.collect() == [] and empty.dtypes == docs.dtypes


def test_the_whole_pipeline_on_odd_rows_and_on_none(spark, odd_docs, no_docs, tmp_path):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert bool(out) == (name == "odd")


@pytest.mark.parametrize("rows", [300_000, 3])
def test_few_values_are_joined_with_hot_keys(spark, monkeypatch, rows):
    from jobmatch.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    left = spark.range(500).selectExpr("id as node", "if(id < 400, 0, id) as label")
    few = left.groupBy("label").agg(F.min("node").alias("least"))
    got = {(r.node, r.least) for r in common.with_few(left, few, "label").collect()}
    assert got == {(i, 0 if i < 400 else i) for i in range(500)}


def test_clashing_names_are_carried(odd_docs):
    kept = quality.clean(odd_docs).select(*CLASH).distinct().collect()
    assert [tuple(r) for r in kept] == [tuple(f"{c}?" for c in CLASH)]
