"""The named queries run by the driver: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the driver tables (FIXTURES.md section 2 maps tables to roles).

Doubles are rounded to 6 places at the output so the DuckDB oracle can compare
values exactly; ranks are taken before that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (ascii_strip, doc_name_to_url, page_links, page_title, result_line,
                              result_line_name, utc_text)
from ..operators import large_vocabulary, match, model, pages, skills, tagging, textflows
from ..plans.sizing import shuffle_partitions, spread_if_narrow
from ..sources import tables
from ..sources.resumes import resume_requests
from ..sources.vocabulary import driver_vocabulary, driver_vocabulary_frame

# Fixed parameters of the driver queries.
INGEST_TS = "2026-12-01T18:00:00Z"       # ingest time of rendered documents
RUN1_TS = "2026-12-01T00:00:00Z"         # skill count runs of skills_current
RUN2_TS = "2026-12-02T00:00:00Z"
FILTER_SEP = ","                         # token_count_filtered separator
FILTER_PREFIX = "The"                    # token_count_filtered dropped line prefix
RUNNING_BUCKET = 512                     # item_index width of a running-count bucket
DIGITS = 6


# ---- tagging, model, matching ------------------------------------------------------

def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.build_model(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary(spark))


def skill_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.tag_skills(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary(spark))


def skill_tags_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + P22: the same tags from the native twin (the ordered rules as a Spark
    ``aggregate`` over a literal rules array, ``regexp_count`` with Java regex)."""
    return tagging.tag_skills(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary(spark), method="native")


def skill_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = tables.jobs(spark, sf_dir)
    tf = tagging.tag_skills(jobs, "doc_id", driver_vocabulary(spark))
    idf = model.idf_table(tf, model.document_count(jobs))
    return idf.select("skill", "df", F.round("idf", DIGITS).alias("idf"))


def model_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _model(spark, sf_dir)
    return m.select("doc_id", "skill", "tf", F.round("idf", DIGITS).alias("idf"),
                    F.round("weight", DIGITS).alias("weight"))


def match_fixed_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match_terms(spark, _model(spark, sf_dir), "doc_id")


def match_common_terms_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + O2 with the three skills of highest document frequency as the query terms
    (ties by name): the sample query of the model script, on terms the data has."""
    jobs = tables.jobs(spark, sf_dir)
    voc = driver_vocabulary(spark)
    tf = tagging.tag_skills(jobs, "doc_id", voc)
    m = model.weights(tf, "doc_id", model.document_count(jobs))
    top3 = (model.idf_table(tf, model.document_count(jobs))
            .orderBy(F.desc("df"), F.asc("skill")).limit(3).select("skill"))
    q = model.query_vectors(top3.select(F.lit(0).cast("bigint").alias("query_id"), "skill",
                                        F.lit(1).cast("bigint").alias("tf")), "query_id")
    scores = match.score_pairs(q, m, "query_id", "doc_id")
    return (scores.filter(F.col("score") > 0)
                  .select("doc_id", F.round("score", DIGITS).alias("score"))
                  .orderBy(F.desc("score"), F.asc("doc_id")).limit(10))


def match_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = match.match_batch(tables.resumes(spark, sf_dir), _model(spark, sf_dir),
                            driver_vocabulary(spark), qkey="resume_id", dkey="doc_id", k=25)
    return top.withColumn("score", F.round("score", DIGITS))


def match_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.result_links(match_top25(spark, sf_dir), "resume_id", "doc_id")


def match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed result lines ``name <tab> score`` of every resume, parsed back."""
    top = match_top25(spark, sf_dir)
    lines = top.select("resume_id", "rank", result_line(F.col("doc_id"), F.col("score")).alias("line"))
    return lines.withColumn("name", result_line_name(F.col("line")))


def resume_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = tables.resumes_with_gaps(spark, sf_dir)
    return resume_requests(r.select(F.struct("conv_id", "turn").alias("k"), "text"), "k").select(
        F.col("k.conv_id").alias("conv_id"), F.col("k.turn").alias("turn"), "text")


def resume_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web path for many requests: defaults filled in, then tagged."""
    r = tables.resumes_with_gaps(spark, sf_dir)
    req = resume_requests(r.select(F.struct("conv_id", "turn").alias("request"), "text"), "request")
    tags = tagging.tag_skills(req, "request", driver_vocabulary(spark))
    return tags.select("request.conv_id", "request.turn", "skill", "tf")


def resume_tag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 on the resume side: words left, tags, distinct skills, vocabulary size."""
    r = resume_requests(tables.resumes(spark, sf_dir), "resume_id")
    return tagging.tag_stats(r, "resume_id", driver_vocabulary(spark))


def skill_tags_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tags with the rules worked through in parts, as for a vocabulary that no task
    can hold."""
    return large_vocabulary.tag_skills_in_parts(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary_frame(spark),
                                                part_rows=5)


def _feed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed vocabulary plus every skill seen in the feeds (U1 through J6): what
    the skill table holds after a feed run, read back as keys (S8)."""
    counts = skills.skill_counts(tables.feed_items(spark, sf_dir), driver_vocabulary_frame(spark))
    return counts.select("skill")


def feed_vocab_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with the vocabulary grown from the feeds (about 320 skills)."""
    return tagging.tag_skills(tables.jobs(spark, sf_dir), "doc_id", _feed_vocabulary(spark, sf_dir))


def feed_vocab_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 + R1 with the vocabulary grown from the feeds: model, then top 25 per resume."""
    voc = tagging.prepare_vocabulary(_feed_vocabulary(spark, sf_dir))
    m = model.build_model(tables.jobs(spark, sf_dir), "doc_id", voc)
    top = match.match_batch(tables.resumes(spark, sf_dir), m, voc, qkey="resume_id", dkey="doc_id", k=25)
    return top.withColumn("score", F.round("score", DIGITS))


def feed_vocab_pruned_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lists from the pairs that upper bounds leave over (about a fifth)."""
    voc = tagging.prepare_vocabulary(_feed_vocabulary(spark, sf_dir))
    m = model.build_model(tables.jobs(spark, sf_dir), "doc_id", voc)
    top = match.match_batch(tables.resumes(spark, sf_dir), m, voc, qkey="resume_id", dkey="doc_id", k=25, prune=True)
    return top.withColumn("score", F.round("score", DIGITS))


# ---- text dataflows -------------------------------------------------------------------

def word_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textflows.word_line_index(tables.jobs(spark, sf_dir), "doc_id")


def corpus_word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 as one list per word over the whole corpus, in blocks; lists printed as text."""
    index = textflows.corpus_word_index(tables.jobs(spark, sf_dir), "doc_id")
    return index.select("word", "block", "n", "first_line", "last_line", F.array_join("gaps", " ").alias("gaps"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textflows.word_count(textflows.lines_of_texts(tables.jobs(spark, sf_dir)), " ")


def token_count_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = textflows.lines_of_texts(tables.jobs(spark, sf_dir))
    return textflows.token_count_filtered(lines, FILTER_SEP, FILTER_PREFIX)


# ---- feeds and skill counts -------------------------------------------------------------

def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.skill_counts(tables.feed_items(spark, sf_dir), driver_vocabulary_frame(spark))


def category_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc = skills.category_running_count(tables.feed_items(spark, sf_dir), RUNNING_BUCKET)
    return rc.select("feed_index", "item_index", "pos", "category", "running_count")


def category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.skill_positions(category_counts(spark, sf_dir)).select("skill", "count", "position")


def feed_guids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + U2 + A12: the GUIDs of all feeds in one read, each once, with how often
    it was listed."""
    items = tables.feed_items(spark, sf_dir)
    return items.groupBy("guid").agg(F.count(F.lit(1)).alias("listed"))


def items_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills.items_per_feed(tables.feed_items(spark, sf_dir))


def skills_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tables.feed_items(spark, sf_dir)
    run1 = skills.skill_counts(items.filter(F.col("item_index") % 2 == 0), driver_vocabulary_frame(spark))
    h1 = skills.with_run(run1, F.lit(RUN1_TS).cast("timestamp"))
    run2 = skills.skill_counts(items.filter(F.col("item_index") % 2 == 1), skills.next_vocabulary(h1))
    history = h1.unionByName(skills.with_run(run2, F.lit(RUN2_TS).cast("timestamp")))
    cur = skills.current_counts(history)
    return cur.select("skill", "count", utc_text(F.col("run_ts")).alias("run_ts"))


# ---- pages --------------------------------------------------------------------------------

def _named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.with_doc_names(tables.raw_pages(spark, sf_dir).drop("html"))


def doc_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_pages(spark, sf_dir).select("page_id", "url", "doc_name", "base_name")


def doc_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _named_pages(spark, sf_dir)
    return n.select("page_id", "base_name", doc_name_to_url(F.col("base_name")).alias("url_back"))


def pending_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.pending(_named_pages(spark, sf_dir), tables.stored_names(spark, sf_dir)).select(
        "page_id", "url", "doc_name")


def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = pages.pending(_named_pages(spark, sf_dir), tables.stored_names(spark, sf_dir))
    return pages.status_totals(pages.fetch_status(todo))


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tables.read_table(spark, sf_dir, "pages")
    return p.select("page_id", page_title(F.col("html")).alias("title"))


def page_links_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tables.read_table(spark, sf_dir, "pages")
    return p.select("page_id", F.posexplode(page_links(F.col("html"))).alias("pos", "link"))


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = pages.with_doc_names(tables.raw_pages(spark, sf_dir))
    todo = pages.pending(raw, tables.stored_names(spark, sf_dir)).filter(F.col("http_status") == 200)
    none = F.array().cast("array<string>")
    body = pages.render_document(
        F.col("url"), F.lit(INGEST_TS).cast("timestamp"),
        ascii_strip(page_title(F.col("html"))), F.lit(""),
        F.transform(page_links(F.col("html")), ascii_strip), none, none, none)
    return todo.select("page_id", "doc_name", "url", body.alias("body"))


def rendered_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents of the pending, fetched pages from the native fields (title,
    nav links as base skills), control characters stripped."""
    return _rendered(spark, sf_dir).drop("url")


def pipeline_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages end to end (Q19): rendered documents are tagged, the model is built on
    them, every resume is matched, and its links carry the documents' own addresses."""
    docs = _rendered(spark, sf_dir)
    voc = driver_vocabulary(spark)
    m = model.build_model(docs.select("doc_name", F.col("body").alias("text")), "doc_name", voc)
    top = match.match_batch(tables.resumes(spark, sf_dir), m, voc, qkey="resume_id", dkey="doc_name", k=25)
    addressed = top.join(docs.select("doc_name", "url"), "doc_name")
    return match.result_links(addressed, "resume_id", "doc_name", url="url")


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 extraction job over every page (driver layout), cleaned (P15) and decoded."""
    p = tables.read_table(spark, sf_dir, "pages")
    sec = pages.extract_sections(spread_if_narrow(p), pages.DRIVER_SELECTORS, keep=("page_id",))
    return pages.section_rows(sec, "page_id")


def job_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending pages named, fetched ones extracted and rendered as stored documents."""
    raw = spread_if_narrow(tables.raw_pages(spark, sf_dir))
    docs, _totals = pages.ingest_pages(raw, tables.stored_names(spark, sf_dir),
                                       F.lit(INGEST_TS).cast("timestamp"), pages.DRIVER_SELECTORS)
    return docs.withColumn("ingest_ts", utc_text(F.col("ingest_ts")))


# ---- streaming (R2, R3, R4): run to completion, return the sink read back --------------

def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 over the feed items landed as XML files, one micro-batch per feed."""
    from ..streaming import jobs
    wd = jobs.work_dir(spark, "counts")
    jobs.land_feed_items(tables.feed_items(spark, sf_dir), f"{wd}/land")
    jobs.stream_skill_counts(spark, f"{wd}/land", f"{wd}/out", f"{wd}/ck").awaitTermination()
    return jobs.current_counts(spark, f"{wd}/out").select("skill", "count")


def stream_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the stored model, resumes arriving in several files; equals match_top25."""
    from ..streaming import jobs
    from ..operators.sinks import write_model
    wd = jobs.work_dir(spark, "match")
    vocab = driver_vocabulary(spark)
    table = "jobmatch_model_" + wd.rsplit("-", 1)[-1]
    write_model(model.build_model(tables.jobs(spark, sf_dir), "doc_id", vocab), f"{wd}/model",
                table=table, buckets=shuffle_partitions(spark))
    tables.resumes(spark, sf_dir).repartition(4).write.parquet(f"{wd}/resumes")
    jobs.stream_match(spark, f"{wd}/resumes", "resume_id long, text string", table,
                      vocab, f"{wd}/out", f"{wd}/ck").awaitTermination()
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(f"{wd}/out").select(
        "resume_id", "doc_id", F.round("score", DIGITS).alias("score"), "rank")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of new job URLs from landed feeds, each once, minus the stored ones."""
    from ..streaming import jobs
    wd = jobs.work_dir(spark, "ingest")
    jobs.land_feed_items(tables.feed_items(spark, sf_dir), f"{wd}/land")
    jobs.seed_store(tables.stored_names(spark, sf_dir), f"{wd}/store")
    jobs.stream_ingest(spark, f"{wd}/land", f"{wd}/store", f"{wd}/ck").awaitTermination()
    return spark.read.parquet(f"{wd}/store").filter(F.col("batch") >= 0).select("doc_name")


def _land_twice(spark: SparkSession, sf_dir: str, wd: str):
    """Feeds 0 to 3, then the others, landed in several files a feed; yields after each landing."""
    from ..streaming import jobs
    items, order = tables.feed_items(spark, sf_dir), ["feed_index", "item_index"]
    for k, some in enumerate((items.filter("feed_index < 4"), items.filter("feed_index >= 4"))):
        jobs.land_feed_items(some.repartitionByRange(8, *order).sortWithinPartitions(*order), f"{wd}/land/{k}")
        yield k


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on a stream: items numbered as they arrive, over two landings."""
    from ..streaming import jobs, running
    wd = jobs.work_dir(spark, "running")
    for _landing in _land_twice(spark, sf_dir, wd):
        running.stream_running_counts(spark, f"{wd}/land", f"{wd}/out", f"{wd}/ck").awaitTermination()
    return running.read_running_counts(spark, f"{wd}/out").select("feed_index", "guid", "pos", "category", "running_count")


def stream_ingest_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 with keyed state over two landings, and once more from a checkpoint of its own, which is
    seeded from the store and finds nothing new."""
    from . import name_store
    from ..streaming import jobs, keyed
    wd = jobs.work_dir(spark, "keyed")
    name_store.store_run(tables.stored_names(spark, sf_dir).select("doc_name").distinct(), f"{wd}/store", "before")
    for _landing in _land_twice(spark, sf_dir, wd):
        keyed.stream_ingest_keyed(spark, f"{wd}/land", f"{wd}/store", f"{wd}/ck").awaitTermination()
    keyed.stream_ingest_keyed(spark, f"{wd}/land", f"{wd}/store", f"{wd}/ck2").awaitTermination()
    docs = spark.read.schema("doc_name string, run string").parquet(f"{wd}/store/{name_store.DOCS}")
    return docs.filter("run <> 'before'").select("doc_name")


# ---- sinks read back through the sources (K1-K4 with S1, S2, S6, S8, S9, S10) ------------

def _work(spark: SparkSession, name: str) -> str:
    from ..streaming.jobs import work_dir
    return work_dir(spark, name)


def word_count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as text files, read back line by line, counted (A2)."""
    from ..sources.text import text_lines
    wd = _work(spark, "text")
    tables.read_table(spark, sf_dir, "documents").select("text").write.text(f"{wd}/lines")
    return textflows.word_count(text_lines(spark, f"{wd}/lines"), " ")


def word_line_index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per document, each file read whole, indexed (A1); the
    document key comes back from the folder name."""
    from ..sources.text import land_texts, whole_text_files
    wd = _work(spark, "whole")
    land_texts(tables.read_table(spark, sf_dir, "documents"), "doc_id", f"{wd}/docs")
    files = whole_text_files(spark, f"{wd}/docs").select(
        F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id"), "text")
    return textflows.word_line_index(files, "doc_id")


def skills_csv_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 then S6: the sorted skill CSV of a feed run read back as the next
    vocabulary (first field, counts reset to 0)."""
    from ..sources.vocabulary import read_skills_csv
    from .batch_jobs import skill_count_job
    wd = _work(spark, "skills")
    skill_count_job(tables.feed_items(spark, sf_dir), driver_vocabulary_frame(spark), RUN1_TS,
                    f"{wd}/csv", f"{wd}/history")
    return read_skills_csv(spark, f"{wd}/csv")


def skills_csv_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 then S7: the skill CSV of a feed run as a lower-case vocabulary, each skill once."""
    from ..operators.sinks import write_skills_csv
    from ..sources.vocabulary import read_skills_csv_lower
    wd = _work(spark, "lower")
    write_skills_csv(category_counts(spark, sf_dir), f"{wd}/csv")
    return read_skills_csv_lower(spark, f"{wd}/csv")


def ml_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M4 as ``pyspark.ml`` stages: how many terms each document's vector has, and its
    squared length (1, or 0 if all its terms weigh nothing)."""
    from pyspark.ml.functions import vector_to_array
    tf = tagging.tag_skills(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary(spark))
    values = vector_to_array("features")
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
    terms = F.size(F.filter(vector_to_array("raw"), lambda x: x > 0))
    return model.ml_tfidf(tf, "doc_id", num_features=1 << 10).select(
        "doc_id", terms.cast("bigint").alias("n_terms"), F.round(squares, DIGITS).alias("squared_length"))


def feed_files_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + W1: the feed items landed in several XML files a feed, read back, numbered over
    the feed's files, and counted in arrival order."""
    from ..sources.feeds import read_feed_items, split_quarantine
    from ..streaming.jobs import land_feed_items
    wd = _work(spark, "feeds")
    items = tables.feed_items(spark, sf_dir)
    order = ["feed_index", "item_index"]
    land_feed_items(items.repartitionByRange(16, *order).sortWithinPartitions(*order), f"{wd}/land")
    good, _bad = split_quarantine(read_feed_items(spark, f"{wd}/land"))
    rc = skills.category_running_count(good, RUNNING_BUCKET)
    return rc.select("feed_index", "item_index", "pos", "category", "running_count")


def feed_source_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files read by the feed data source, which numbers the items of a file itself."""
    from ..sources.feed_source import read_feeds
    from ..streaming.jobs import land_feed_items
    wd = _work(spark, "feed-source")
    items, order = tables.feed_items(spark, sf_dir), ["feed_index", "item_index"]
    land_feed_items(items.repartitionByRange(16, *order).sortWithinPartitions(*order), f"{wd}/land")
    good, _aside = read_feeds(spark, f"{wd}/land")
    rc = skills.category_running_count(good, RUNNING_BUCKET)
    return rc.select("feed_index", "item_index", "pos", "category", "running_count")


def skill_history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 with two runs, each folded into a snapshot that keeps two counts a skill."""
    from . import history_store
    path, items = _work(spark, "history-store"), tables.feed_items(spark, sf_dir)
    known = driver_vocabulary_frame(spark)
    for parity, ts in enumerate((RUN1_TS, RUN2_TS)):
        history_store.append_run(skills.skill_counts(items.filter(F.col("item_index") % 2 == parity), known), path, ts)
        history_store.compact(spark, path, versions=2)
        history_store.clear(spark, path)
        known = skills.next_vocabulary(history_store.read_history(spark, path))
    cur = skills.current_counts(history_store.read_history(spark, path))
    return cur.select("skill", "count", utc_text(F.col("run_ts")).alias("run_ts"))


def skill_history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 over two stored runs, then the current view and the key-only scan."""
    from ..sources.models import read_skill_history
    from ..sources.vocabulary import read_skill_keys
    from .batch_jobs import skill_count_job
    wd = _work(spark, "history")
    items = tables.feed_items(spark, sf_dir)
    skill_count_job(items.filter(F.col("item_index") % 2 == 0), driver_vocabulary_frame(spark),
                    RUN1_TS, f"{wd}/csv1", f"{wd}/history")
    skill_count_job(items.filter(F.col("item_index") % 2 == 1),
                    read_skill_keys(spark, f"{wd}/history"), RUN2_TS, f"{wd}/csv2", f"{wd}/history")
    cur = skills.current_counts(read_skill_history(spark, f"{wd}/history"))
    return cur.select("skill", "count", utc_text(F.col("run_ts")).alias("run_ts"))


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 as a job (term frequencies checkpointed, model written, K4) read back."""
    from ..sources.models import read_model
    from .batch_jobs import model_job
    wd = _work(spark, "model")
    model_job(tables.jobs(spark, sf_dir), "doc_id", driver_vocabulary(spark), f"{wd}/model")
    m = read_model(spark, f"{wd}/model")
    return m.select("doc_id", "skill", "tf", F.round("idf", DIGITS).alias("idf"),
                    F.round("weight", DIGITS).alias("weight"))


def model_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model grown by two runs (even, then odd ids, the first listed again) and read back:
    weights are formed from the terms and document frequencies of both."""
    from . import model_store
    path, jobs = _work(spark, "model-store"), tables.jobs(spark, sf_dir)
    model_store.add_run(jobs.filter("doc_id % 2 = 0"), "doc_id", driver_vocabulary(spark), path, "first")
    model_store.add_run(jobs, "doc_id", driver_vocabulary(spark), path, "second")
    return model_store.read_model(spark, path, "doc_id").select(
        "doc_id", "skill", "tf", F.round("idf", DIGITS).alias("idf"), F.round("weight", DIGITS).alias("weight"))


def job_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 as a job run twice over the same pages: the second run stores nothing new
    (K3 + J1); returns what the store holds."""
    from ..sources.models import read_job_docs
    from .batch_jobs import ingest_job
    wd = _work(spark, "store")
    raw = spread_if_narrow(tables.raw_pages(spark, sf_dir))
    ts = F.lit(INGEST_TS).cast("timestamp")
    # the store starts with the names already stored (no body), then the ingest runs twice
    pages.placeholder_docs(tables.stored_names(spark, sf_dir)).write.parquet(f"{wd}/store")
    ingest_job(spark, raw, f"{wd}/store", ts, pages.DRIVER_SELECTORS)
    ingest_job(spark, raw, f"{wd}/store", ts, pages.DRIVER_SELECTORS)
    return read_job_docs(spark, f"{wd}/store").filter(F.col("body").isNotNull()).select("doc_name", "url")


def job_store_probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store with Bloom filters: the names stored before are its first run, two runs
    follow, the second of which stores nothing."""
    from . import name_store
    from .batch_jobs import ingest_run
    path = _work(spark, "name-store")
    raw = spread_if_narrow(tables.raw_pages(spark, sf_dir))
    ts = F.lit(INGEST_TS).cast("timestamp")
    name_store.store_run(pages.placeholder_docs(tables.stored_names(spark, sf_dir)).dropDuplicates(["doc_name"]), path, "before")
    ingest_run(spark, raw, path, "first", ts, pages.DRIVER_SELECTORS)
    ingest_run(spark, raw, path, "second", ts, pages.DRIVER_SELECTORS)
    return spark.read.parquet(f"{path}/{name_store.DOCS}").filter(F.col("body").isNotNull()).select("doc_name", "url")


QUERIES = {
    "skill_tags": skill_tags,
    "skill_tags_native": skill_tags_native,
    "skill_tags_in_parts": skill_tags_in_parts,
    "skill_idf": skill_idf,
    "model_weights": model_weights,
    "match_fixed_top10": match_fixed_top10,
    "match_common_terms_top10": match_common_terms_top10,
    "match_top25": match_top25,
    "match_links": match_links,
    "match_lines": match_lines,
    "resume_defaults": resume_defaults,
    "resume_tags": resume_tags,
    "resume_tag_stats": resume_tag_stats,
    "feed_vocab_tags": feed_vocab_tags,
    "feed_vocab_top25": feed_vocab_top25,
    "feed_vocab_pruned_top25": feed_vocab_pruned_top25,
    "word_line_index": word_line_index,
    "corpus_word_index": corpus_word_index,
    "word_count": word_count,
    "token_count_filtered": token_count_filtered,
    "category_counts": category_counts,
    "category_running_count": category_running_count,
    "category_rank": category_rank,
    "items_per_feed": items_per_feed,
    "feed_guids": feed_guids,
    "skills_current": skills_current,
    "doc_names": doc_names,
    "doc_urls": doc_urls,
    "pending_pages": pending_pages,
    "ingest_status": ingest_status,
    "page_titles": page_titles,
    "page_links": page_links_q,
    "rendered_docs": rendered_docs,
    "page_sections": page_sections,
    "job_docs": job_docs,
    "stream_counts": stream_counts,
    "stream_match": stream_match,
    "stream_ingest": stream_ingest,
    "stream_running_count": stream_running_count,
    "stream_ingest_keyed": stream_ingest_keyed,
    "word_count_files": word_count_files,
    "word_line_index_files": word_line_index_files,
    "skills_csv_reload": skills_csv_reload,
    "skill_history_stored": skill_history_stored,
    "skill_history_compacted": skill_history_compacted,
    "model_reload": model_reload,
    "model_in_runs": model_in_runs,
    "skills_csv_lower": skills_csv_lower,
    "ml_model": ml_model,
    "pipeline_top25": pipeline_top25,
    "feed_files_running_count": feed_files_running_count,
    "feed_source_running_count": feed_source_running_count,
    "job_store": job_store,
    "job_store_probed": job_store_probed,
}
