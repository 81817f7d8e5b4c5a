"""A history of skill counts that is compacted (K2).

A run writes its counts and, last, a record; it counts once the record is there.  ``compact`` folds
the newest snapshot and the complete runs after it into a new one that holds the latest
``versions`` counts of every skill, and swaps it in by writing the list of the runs it covers:
one file, written last.  A reader sees the history before or after, never a mix, and
reads one snapshot and the runs since.  ``clear`` deletes what no reader starts from any more.

Defined cases: a run repeated under its time is left as it is once complete, covered or
not, and replaced if it was not; a run that arrives late takes its place by its time; rows
without a skill are left out; ``counts`` holds a skill once; no runs give no rows.  One job
writes at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spark_context

RUNS, DONE, SNAPSHOTS, COVERED = "runs", "done", "snapshots", "covered"
COUNTS = "skill string, count bigint, run_ts timestamp"


def _records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], schema)


def newest_snapshot(spark: SparkSession, path: str) -> int:
    """The number of the newest complete snapshot, 0 if there is none."""
    return _records(spark, f"{path}/{COVERED}", "run bigint, snap int").agg(F.max("snap")).first()[0] or 0


def _covered(spark: SparkSession, path: str, snap: int) -> DataFrame:
    return _records(spark, f"{path}/{COVERED}", "run bigint, snap int").filter(F.col("snap") == snap).select("run")


def open_runs(spark: SparkSession, path: str, snap: int) -> list[int]:
    """The complete runs that the snapshot does not cover: one number each."""
    done = _records(spark, f"{path}/{DONE}", "skills bigint, run bigint").select("run")
    return sorted(r["run"] for r in done.join(_covered(spark, path, snap), "run", "left_anti").collect())


def append_run(counts: DataFrame, path: str, run_ts) -> None:
    """Add one run's counts under its time."""
    spark = counts.sparkSession
    run = spark.range(1).select(F.unix_micros(F.lit(run_ts).cast("timestamp"))).first()[0]
    done = _records(spark, f"{path}/{DONE}", "skills bigint, run bigint").select("run")
    known = done.unionByName(_covered(spark, path, newest_snapshot(spark, path)))
    if not known.filter(F.col("run") == run).isEmpty():
        return
    rows = counts.filter("skill IS NOT NULL").select(
        "skill", F.col("count").cast("bigint").alias("count"), F.lit(run_ts).cast("timestamp").alias("run_ts"))
    rows.write.mode("overwrite").parquet(f"{path}/{RUNS}/run={run}")
    n = spark.read.schema(COUNTS).parquet(f"{path}/{RUNS}/run={run}").agg(F.count(F.lit(1)).alias("skills"))
    n.coalesce(1).write.mode("overwrite").parquet(f"{path}/{DONE}/run={run}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """``(skill, count, run_ts)``: every version that is kept."""
    return _history(spark, path, newest_snapshot(spark, path))[0]


def _history(spark: SparkSession, path: str, snap: int) -> tuple[DataFrame, list[int]]:
    later = open_runs(spark, path, snap)
    folders = [f"{path}/{SNAPSHOTS}/snap={snap}"] if snap else []
    folders += [f"{path}/{RUNS}/run={r}" for r in later]
    if not folders:
        return spark.createDataFrame([], COUNTS), later
    return spark.read.schema(COUNTS).parquet(*folders), later


def compact(spark: SparkSession, path: str, versions: int) -> int:
    """Write and swap in the next snapshot; returns its number (the newest one's if no run is new)."""
    if versions < 1:
        raise ValueError("versions must be 1 or more")
    snap = newest_snapshot(spark, path)
    history, folded = _history(spark, path, snap)
    if not folded:
        return snap
    # a skill has at most ``versions`` rows and one of each run since: a small group
    latest = Window.partitionBy("skill").orderBy(F.desc("run_ts"))
    kept = history.withColumn("_v", F.row_number().over(latest)).filter(F.col("_v") <= versions).drop("_v")
    kept.write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/snap={snap + 1}")
    covered = _covered(spark, path, snap).unionByName(spark.createDataFrame([(r,) for r in folded], "run bigint"))
    covered.coalesce(1).write.mode("overwrite").parquet(f"{path}/{COVERED}/snap={snap + 1}")
    return snap + 1


def clear(spark: SparkSession, path: str) -> int:
    """Delete the snapshots before the newest and the runs it covers; returns how many folders
    went.  For when no reader that began before the last ``compact`` is at work."""
    snap = newest_snapshot(spark, path)
    covered = {r["run"] for r in _records(spark, f"{path}/{DONE}", "skills bigint, run bigint")
               .join(_covered(spark, path, snap), "run", "left_semi").select("run").collect()}
    old = [f"{path}/{kind}/run={r}" for r in sorted(covered) for kind in (RUNS, DONE)]
    # the list of an older snapshot goes after the snapshot's rows, its last mark
    listed = _records(spark, f"{path}/{COVERED}", "run bigint, snap int").filter(F.col("snap") < snap)
    old += [f"{path}/{kind}/snap={r['snap']}" for r in listed.select("snap").distinct().collect() for kind in (SNAPSHOTS, COVERED)]
    sc = spark_context(spark)
    for folder in old:
        p = sc._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    return len(old)
