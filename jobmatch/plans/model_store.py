"""A TF-IDF model that grows by runs.

A run adds the term frequencies of its new jobs, what they add to the skills' document
frequencies, and its number of jobs, each in a folder of its own; rows of earlier runs are
never read for the text nor written again.  Weights depend on all document frequencies, so
they are formed when the model is read: deltas are summed per skill, and one broadcast join
and one window by document make ``model.weights`` of all jobs.

A run counts once its record is there, which is written last: what a broken run left behind is
not read, and repeating the run replaces it.  Jobs whose key is stored already are left out
(the keys of the stored jobs are read, not their rows), as are null keys; of equal keys in one
run any one stays.  All runs must use one vocabulary, as stored jobs are not tagged again: a
run with another one is refused.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model, tagging
from .sizing import cut_lineage

TERMS, KEYS, FREQUENCIES, RUNS = "terms", "keys", "frequencies", "runs"


def _digest(voc: tagging.Vocabulary) -> str:
    return hashlib.sha256("\0".join(voc.skills).encode() + repr(voc.rules).encode()).hexdigest()


def runs(spark: SparkSession, path: str) -> DataFrame | None:
    """``(run, jobs, vocabulary)`` of the runs that are complete; ``None`` before the first."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("jobs bigint, vocabulary string, run string").parquet(f"{path}/{RUNS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return None


def _of_runs(spark: SparkSession, path: str, what: str, names: list[str]) -> DataFrame:
    """The rows of complete runs: their folders, no others."""
    return spark.read.option("basePath", f"{path}/{what}").parquet(*[f"{path}/{what}/run={n}" for n in names])


def add_run(jobs: DataFrame, key: str, vocabulary, path: str, run: str, text_col: str = "text",
            literals=tagging.QUOTED_LITERALS) -> None:
    """Add the jobs that are not stored yet as one run.  ``run`` is a name of letters, digits,
    ``-`` and ``_``; a complete run of this name is left as it is."""
    spark = jobs.sparkSession
    voc = tagging.prepare_vocabulary(vocabulary, literals)
    done = runs(spark, path)
    stored = [] if done is None else done.collect()        # one row per run
    if any(r["run"] == run for r in stored):
        return
    if any(r["vocabulary"] != _digest(voc) for r in stored):
        raise ValueError("the stored jobs were tagged with another vocabulary; build the model anew")
    new = jobs.select(key, text_col).filter(F.col(key).isNotNull())
    if stored:
        new = new.join(_of_runs(spark, path, KEYS, [r["run"] for r in stored]).select(key), key, "left_anti")
    new = cut_lineage(new.dropDuplicates([key]).select(key).withColumn("_new", F.lit(True)))
    texts = jobs.select(key, text_col).join(new.select(key), key, "left_semi").dropDuplicates([key])

    def write(df: DataFrame, what: str) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{what}/run={run}")

    write(tagging.tag_skills(texts, key, voc, text_col, literals), TERMS)
    write(new.select(key), KEYS)
    terms = spark.read.parquet(f"{path}/{TERMS}/run={run}")
    write(terms.groupBy("skill").agg(F.count(F.lit(1)).alias("df")), FREQUENCIES)
    record = new.agg(F.count(F.lit(1)).alias("jobs")).withColumn("vocabulary", F.lit(_digest(voc)))
    write(record.coalesce(1), RUNS)


def idf(spark: SparkSession, path: str, min_doc_freq: int = 1) -> DataFrame:
    """``(skill, df, idf)`` over the jobs of all complete runs."""
    stored = runs(spark, path).collect()
    total = float(sum(r["jobs"] for r in stored))
    df = (_of_runs(spark, path, FREQUENCIES, [r["run"] for r in stored]).groupBy("skill").agg(F.sum("df").alias("df")))
    value = F.when(F.col("df") >= min_doc_freq, F.log(F.lit(total + 1.0) / (F.col("df").cast("double") + 1.0)))
    return df.select("skill", "df", F.coalesce(value, F.lit(0.0)).alias("idf"))


def read_model(spark: SparkSession, path: str, key: str, min_doc_freq: int = 1) -> DataFrame:
    """``(key, skill, tf, idf, weight)`` of all complete runs: what ``model.build_model`` gives
    over all of their jobs."""
    names = [r["run"] for r in runs(spark, path).collect()]
    terms = _of_runs(spark, path, TERMS, names).select(key, "skill", "tf")
    return model.weights_with(terms, key, idf(spark, path, min_doc_freq))
