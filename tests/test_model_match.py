"""IDF, norms, scores and top-k."""

import math

import pytest
from pyspark.sql import functions as F

from jobmatch.operators import match, model, tagging


def test_idf_and_norm_golden(spark):
    tf = spark.createDataFrame([(1, "java", 2), (1, "c++", 1), (2, "java", 1)],
                               "doc long, skill string, tf long")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc long")
    w = {(r.doc, r.skill): (r.idf, r.weight)
         for r in model.weights(tf, "doc", model.document_count(docs)).collect()}
    assert w[(1, "java")][0] == pytest.approx(math.log(4 / 3), abs=1e-9)
    assert w[(1, "c++")][0] == pytest.approx(math.log(2), abs=1e-9)
    assert w[(1, "java")][1] == pytest.approx(0.63870359, abs=1e-8)
    assert w[(1, "c++")][1] == pytest.approx(0.76945287, abs=1e-8)
    assert w[(2, "java")][1] == pytest.approx(1.0, abs=1e-12)
    assert not any(d == 3 for d, _ in w)


def test_zero_vector_stays_zero(spark):
    tf = spark.createDataFrame([(1, "java", 1), (2, "java", 3)], "doc long, skill string, tf long")
    docs = spark.createDataFrame([(1,), (2,)], "doc long")
    # java in every document and m = 2: idf = ln(3/3) = 0, weights 0 (not NaN)
    out = model.weights(tf, "doc", model.document_count(docs)).collect()
    assert all(r.weight == 0.0 for r in out)


def test_scores_in_unit_interval_and_topk(spark):
    from tests.conftest import SF01
    from jobmatch.plans import queries as q
    top = q.match_top25(spark, SF01)
    rows = top.collect()
    assert rows and all(0 < r.score <= 1 + 1e-9 for r in rows)
    per = {}
    for r in rows:
        per.setdefault(r.resume_id, []).append(r)
    for lst in per.values():
        lst.sort(key=lambda r: r.rank)
        assert [r.rank for r in lst] == list(range(1, len(lst) + 1))
        assert len(lst) <= 25
        assert all(a.score >= b.score for a, b in zip(lst, lst[1:]))


def test_topk_plan_has_group_limit(spark):
    from tests.conftest import SF
    from jobmatch.plans import queries as q
    plan = q.match_top25(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_pad_with_unmatched(spark):
    top = spark.createDataFrame([(1, 5, 0.5, 1)], "q long, d long, score double, rank long")
    queries = spark.createDataFrame([(1,), (2,)], "q long")
    docs = spark.createDataFrame([(i,) for i in range(10)], "d long")
    out = match.pad_with_unmatched(top, queries, docs, "q", "d", 3).collect()
    got = sorted((r.q, r.rank, r.d, r.score) for r in out)
    assert got == [(1, 1, 5, 0.5), (1, 2, 0, 0.0), (1, 3, 1, 0.0),
                   (2, 1, 0, 0.0), (2, 2, 1, 0.0), (2, 3, 2, 0.0)]


def test_ml_variant_equals_long_table(spark):
    """HashingTF/IDF/Normalizer give the same weights as the long table when no
    two skills collide."""
    tf = spark.createDataFrame([(1, "java", 2), (1, "c++", 1), (2, "java", 1), (3, "scala", 4)],
                               "doc long, skill string, tf long")
    docs = tf.select("doc").distinct()
    long_w = {(r.doc, r.skill): r.weight for r in model.weights(tf, "doc", model.document_count(docs)).collect()}
    from pyspark.ml.feature import HashingTF
    ml = model.ml_tfidf(tf, "doc").collect()
    h = HashingTF(numFeatures=1 << 20)
    for r in ml:
        for (doc, skill), w in long_w.items():
            if doc == r.doc:
                assert r.features[h.indexOf(skill)] == pytest.approx(w, abs=1e-9)


def test_match_terms_scores(spark):
    m = spark.createDataFrame([(1, "java", 0.6), (1, "c++", 0.8), (2, "c#", 1.0), (3, "go", 1.0)],
                              "doc long, skill string, weight double")
    out = {r.doc: r.score for r in match.match_terms(spark, m, "doc").collect()}
    s = 1 / math.sqrt(3)
    assert out == {1: round(1.4 * s, 6), 2: round(s, 6)}


def test_result_links_order(spark):
    top = spark.createDataFrame([(1, "9_x", 2), (1, "8_y", 1)], "q long, d string, rank long")
    links = match.result_links(top, "q", "d").collect()[0].links
    assert links.index("8/y") < links.index("9/x")
    assert links.startswith('<div id="innerResult"><div><a href="http://careers.stackoverflow.com/jobs/8/y"')


def test_a_skill_of_every_document_pairs_nothing(spark):
    """Its weight is 0, so it joins no pairs; the same scores as by brute force."""
    docs = spark.createDataFrame([(i, "java" if i % 10 else "java ruby") for i in range(200)], "doc_id long, text string")
    resumes = spark.createDataFrame([(i, "java ruby") for i in range(50)], "resume_id long, text string")
    voc = spark.createDataFrame([("java",), ("ruby",)], "skill string")
    m = model.build_model(docs, "doc_id", voc)
    q = model.query_vectors(tagging.tag_skills(resumes, "resume_id", voc), "resume_id")
    pairs = match.score_pairs(q, m, "resume_id", "doc_id").collect()
    assert len(pairs) == 50 * 20 and all(abs(p.score - 0.5 ** 0.5) < 1e-12 for p in pairs)
    assert match.match_batch(resumes, m, voc, dkey="doc_id", k=3).count() == 150


def test_no_job_while_the_match_is_planned(spark):
    from tests.conftest import SF
    from jobmatch.plans import queries as q
    spark.sparkContext.setJobGroup("planning", "planning")
    q.match_top25(spark, SF)
    # the schema of a Parquet file is read by a job of one task; nothing else runs
    done = spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    assert len(done) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_links_carry_the_real_address(spark):
    top = spark.createDataFrame([(1, "a_b", 1, "http://x/a_b")], "q long, d string, rank long, url string")
    assert 'href="http://x/a_b"' in match.result_links(top, "q", "d", url="url").first().links


def test_stream_match_equals_batch(spark):
    from tests.conftest import SF
    from jobmatch.plans import queries as q
    a = sorted(map(tuple, q.stream_match(spark, SF).collect()))
    b = sorted(map(tuple, q.match_top25(spark, SF).collect()))
    assert a == b and a


def test_stream_counts_equals_batch(spark):
    from tests.conftest import SF
    from jobmatch.operators import skills
    from jobmatch.plans import queries as q
    from jobmatch.sources import tables
    a = sorted(map(tuple, q.stream_counts(spark, SF).collect()))
    b = sorted(map(tuple, skills.skill_counts(tables.feed_items(spark, SF)).collect()))
    assert a == b and a


def test_stream_ingest_equals_pending(spark):
    from tests.conftest import SF
    from jobmatch.plans import queries as q
    a = sorted(r.doc_name for r in q.stream_ingest(spark, SF).collect())
    b = sorted({r.doc_name for r in q.pending_pages(spark, SF).collect()})
    assert a == b and a


def test_stream_counts_quarantine_truncated_feed(spark, tmp_path):
    """A truncated feed file among good ones is quarantined; the stream keeps counting."""
    import os
    import shutil
    from jobmatch.streaming import jobs
    from tests.conftest import FIXTURES
    land = tmp_path / "land"
    land.mkdir()
    for f in os.listdir(os.path.join(FIXTURES, "rss")):
        shutil.copy(os.path.join(FIXTURES, "rss", f), land / f)
    q = jobs.stream_skill_counts(spark, str(land), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = {r.skill: r["count"] for r in jobs.current_counts(spark, str(tmp_path / "out")).collect()}
    assert got == {"java": 1, "c++": 1}


def test_match_job_equals_batch(spark, tmp_path):
    from jobmatch.operators import sinks
    from jobmatch.plans import batch_jobs
    from jobmatch.sources import tables
    from jobmatch.sources.vocabulary import driver_vocabulary
    from tests.conftest import SF
    v = driver_vocabulary(spark)
    m = model.build_model(tables.jobs(spark, SF), "doc_id", v)
    sinks.write_model(m, str(tmp_path / "model"), table="test_match_job_model", buckets=4)
    r = tables.resumes(spark, SF)
    want = sorted((a.resume_id, a.doc_id, a["rank"]) for a in match.match_batch(r, m, v, dkey="doc_id").collect())
    for _ in range(2):
        batch_jobs.match_job(spark, r, "test_match_job_model", v, str(tmp_path / "out"), dkey="doc_id")
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        assert sorted((a.resume_id, a.doc_id, a["rank"]) for a in got) == want and want


def test_two_checkpoints_on_one_store_keep_all_names(spark, tmp_path):
    from jobmatch.streaming import jobs
    item = "<channel><item><guid>http://h/%s</guid><title>t</title></item>%s</channel>"
    store, land = str(tmp_path / "store"), tmp_path / "land"
    jobs.seed_store(spark.createDataFrame([("seeded",)], "doc_name string"), store)
    for run, extra in ((1, "<item><title>no guid</title></item>"), (2, "")):
        folder = land / str(run)
        folder.mkdir(parents=True)
        (folder / "feed_0.xml").write_text(item % (f"x/{run}", extra))
        jobs.stream_ingest(spark, str(folder), store, str(tmp_path / f"ck{run}")).awaitTermination()
    names = sorted(r.doc_name.rsplit("/", 1)[-1] for r in spark.read.parquet(store).collect())
    assert names == ["h_x_1", "h_x_2", "seeded"]
    assert spark.read.parquet(f"{store}-quarantine").count() == 1


# ---- pruned matching ------------------------------------------------------------------

def random_model(spark, seed, docs=600, skills=25, norm=True):
    import random
    rnd, rows, queries = random.Random(seed), [], []
    for d in range(docs):
        own = {f"s{min(int(rnd.expovariate(.15)), skills - 1)}": rnd.choice([.25, .5, rnd.random(), 1.0])
               for _ in range(rnd.randint(1, 9))}
        size = math.sqrt(sum(w * w for w in own.values())) if norm else rnd.choice([.2, 1.0, 1 / 7])
        rows += [(d, s, w / size) for s, w in own.items()] + ([(d, "zero", 0.0)] if d % 5 == 0 else [])
    for q in range(40):
        own = {f"s{rnd.randrange(skills)}": float(rnd.randint(1, 3)) for _ in range(rnd.randint(0, 6))}
        size = math.sqrt(sum(w * w for w in own.values()))
        queries += [(q, s, w / size) for s, w in own.items()] + [(q, "unknown", 0.5), (q, "zero", 0.0)]
    return (spark.createDataFrame(rows, "doc long, skill string, weight double").repartition(3),
            spark.createDataFrame(queries, "q long, skill string, qw double"))


@pytest.mark.parametrize("seed, norm, k, entries", [(1, True, 5, 20_000), (2, False, 5, 20_000), (3, True, 25, 0),
                                                    (4, True, 1, 20_000), (5, False, 300, 0)])
def test_pruned_lists_are_those_of_all_pairs(spark, monkeypatch, seed, norm, k, entries):
    monkeypatch.setattr(match, "BROADCAST_ENTRIES", entries)
    m, q = random_model(spark, seed, norm=norm)
    rows = lambda df: {(r.q, r.doc, r["rank"], round(r.score, 10)) for r in df.collect()}
    want = rows(match.top_k(match.score_pairs(q, m, "q", "doc"), "q", "doc", k))
    assert want and rows(match.best_pairs(q, m, "q", "doc", k)) == want


def test_pruning_looks_at_few_pairs(spark):
    """Each candidate comes once, all of the best are among them, and most pairs are not."""
    m, q = random_model(spark, 9, docs=4000, skills=60)
    queries = match.query_table(q.filter(F.col("qw") > 0).withColumnRenamed("q", "_q"), "_q")
    pairs = match.candidate_pairs(queries, match.postings(m, "doc"), "_q", "doc", 5, True).select("_q", "doc").collect()
    best = match.top_k(match.score_pairs(q, m, "q", "doc"), "q", "doc", 5).select("q", "doc").collect()
    assert len(pairs) == len(set(pairs)) and set(best) <= set(pairs)
    assert len(pairs) < 0.5 * match.score_pairs(q, m, "q", "doc").count()


def test_pruned_matching_of_nothing(spark):
    m, q = random_model(spark, 1, docs=10)
    assert match.best_pairs(q.limit(0), m, "q", "doc", 5).count() == 0
    assert match.best_pairs(q, m.limit(0), "q", "doc", 5).count() == 0


def test_documents_are_not_read_while_pruning_is_planned(spark):
    """Planning reads the resume side only; a model that cannot be computed is not touched."""
    from jobmatch.sources.vocabulary import driver_vocabulary
    never = F.raise_error(F.lit("the model was read"))
    model_ = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("java").alias("skill"), never.cast("double").alias("weight"))
    resumes = spark.createDataFrame([(1, "java spark"), (2, None)], "resume_id long, text string")
    top = match.match_batch(resumes, model_, driver_vocabulary(spark), dkey="doc_id", prune=True)
    with pytest.raises(Exception, match="the model was read"):
        top.collect()


def test_counts_of_an_empty_landing(spark, tmp_path):
    from jobmatch.streaming import jobs
    (tmp_path / "landing").mkdir()
    out = str(tmp_path / "out")
    jobs.stream_skill_counts(spark, str(tmp_path / "landing"), out, str(tmp_path / "check")).awaitTermination()
    assert jobs.current_counts(spark, out).collect() == []
