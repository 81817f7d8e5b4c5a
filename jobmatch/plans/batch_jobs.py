"""End-to-end batch jobs with their sinks (R5, R6, the skill-count run).

Each job cuts lineage where a recomputation would be costly: the model job
checkpoints the term frequencies (the output of the Python fold) into the
cluster's checkpoint folder before fitting IDF and writing, so an executor lost
while weighting or writing never re-runs the tagger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import model, pages, sinks, skills, tagging
from . import name_store
from .sizing import cut_lineage


def model_job(jobs: DataFrame, key: str, vocabulary, model_path: str,
              table: str | None = None, buckets: int = 0, text_col: str = "text") -> None:
    """R5 + K4: tag all jobs, checkpoint the term frequencies, fit IDF over all jobs,
    weight, normalise and replace the stored model (bucketed by document when a
    table name is given)."""
    voc = tagging.prepare_vocabulary(vocabulary)
    tf = cut_lineage(tagging.tag_skills(jobs, key, voc, text_col=text_col))
    sinks.write_model(model.weights(tf, key, model.document_count(jobs)), model_path, table, buckets)


def skill_count_job(items: DataFrame, vocabulary: DataFrame | None, run_ts: str,
                    csv_path: str, history_path: str) -> None:
    """One feed run: counts over the old vocabulary (each run from 0), the sorted CSV
    (K1) replaced, the run appended to the history table (K2)."""
    counts = skills.skill_counts(items, vocabulary)
    sinks.write_skills_csv(counts, csv_path)
    sinks.append_skill_run(counts, history_path, run_ts)


def ingest_job(spark: SparkSession, raw: DataFrame, store_path: str, ingest_ts: Column,
               selectors=pages.SITE_SELECTORS) -> DataFrame:
    """R6 + K3: extract and store the pages not stored yet; returns the totals
    ``(passed, failed)`` of this run (a small frame to show or log)."""
    from pyspark.errors import AnalysisException
    from ..sources.models import read_job_docs
    try:
        stored = read_job_docs(spark, store_path).select("doc_name")
    except AnalysisException as e:
        # only a missing store means "first run"; any other error must stop the run,
        # or everything would be ingested again
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        stored = spark.createDataFrame([], "doc_name string")
    docs, totals = pages.ingest_pages(raw, stored, ingest_ts, selectors)
    sinks.store_job_docs(docs, store_path)
    return totals


def ingest_run(spark: SparkSession, raw: DataFrame, store_path: str, run: str, ingest_ts: Column,
               selectors=pages.SITE_SELECTORS) -> DataFrame:
    """R6 + J1 + K3 on a ``name_store``: what is stored already is found by its filters, so the
    store is not read; returns the totals ``(passed, failed)`` of this run."""
    docs, totals = pages.ingest_pages(raw, None, ingest_ts, selectors,
                                      find_pending=lambda named: name_store.pending(named, store_path))
    totals = cut_lineage(totals)           # of the store as it was before the run
    name_store.store_run(docs, store_path, run)
    return totals


def match_job(spark: SparkSession, resumes: DataFrame, model_table: str, vocabulary, out_path: str,
              qkey: str = "resume_id", dkey: str = "doc_name", k: int = 25) -> None:
    """R1 for resume sets of any size, written in one job: a lost executor costs its tasks,
    a repeated job replaces its output."""
    from ..operators import match
    top = match.match_batch(resumes, spark.table(model_table), vocabulary, qkey, dkey, k)
    top.write.mode("overwrite").parquet(out_path)
