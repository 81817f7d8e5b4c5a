"""Sinks (K1-K4).  Writers return nothing; the caller owns the action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skills import rank_order


def write_skills_csv(counts: DataFrame, path: str) -> None:
    """K1: ``skill,count`` lines sorted by count descending, replacing the old output.
    The sort range-partitions the rows, so part files are in order and no single
    task holds the whole list."""
    counts.select("skill", "count").orderBy(*rank_order(counts)).write.mode("overwrite").csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def append_skill_run(counts: DataFrame, path: str, run_ts) -> None:
    """K2: add one run's counts to the history table (older versions stay).  The run's
    own folder is replaced, so a run that is repeated is stored once."""
    (counts.select("skill", "count", F.lit(run_ts).cast("timestamp").alias("run_ts"))
           .withColumns({"run_date": F.to_date("run_ts"), "run": F.unix_micros("run_ts")})
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("run_date", "run").parquet(path))


def store_job_docs(job_docs: DataFrame, path: str) -> None:
    """K3: append rendered job documents, one row per document name."""
    job_docs.write.mode("append").parquet(path)


def write_model(model: DataFrame, path: str, table: str | None = None, buckets: int = 0) -> None:
    """K4: replace the model.  With a table name and ``buckets``, the model is saved
    bucketed by document so later per-document aggregations need no shuffle."""
    key = model.columns[0]
    if table and buckets:
        # one file a bucket: rows are dealt by the bucketing key before they are written
        model = model.repartition(buckets, key)
    w = model.write.mode("overwrite")
    if table and buckets:
        w.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    else:
        w.parquet(path)
