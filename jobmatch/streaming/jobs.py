"""Structured Streaming jobs.

* ``stream_skill_counts`` (R4): running skill counts over landed feed files,
  ``groupBy(skill).count()`` in update mode; the state holds one row per skill and
  each batch writes only the skills it changed.
* ``stream_match`` (R2): resumes arrive as files; each micro-batch is tagged and
  matched against the stored model (read once per batch from Parquet, never
  rebuilt) with the batch operator ``match_batch``.
* ``stream_ingest`` (R3): new feed files only (the file source remembers what it
  read in its checkpoint); each document name once: within a batch by a
  ``groupBy(doc_name)`` keeping the lowest URL, across batches and runs by an
  anti join against the store, so no unbounded streaming dedup state is kept.

Every sink writes one folder per run and batch id with ``overwrite``: a retried batch
replaces its own output, so results are exactly-once without driver collects.  A run is
named by a marker inside its checkpoint: batch ids start anew with a new checkpoint, and
its folders must not replace those of an earlier one.  Unparsable files and items
without a GUID go to the quarantine folder of the job.
All working folders live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import match, pages
from ..session import ensure_checkpoint_dir, spark_context
from ..sources.feeds import ITEM_SCHEMA, split_quarantine


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run under the shared checkpoint folder, removed when the
    application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobmatch-{name}-{uuid.uuid4().hex}"
    sc = spark_context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def land_feed_items(items: DataFrame, landing: str) -> None:
    """Write feed items as RSS item XML, one folder per feed (what a fetcher lands)."""
    (items.select("feed_index", "guid", "title",
                  F.struct(F.coalesce(F.col("author") if "author" in items.columns else F.lit(None),
                                      F.lit("")).alias("name")).alias("author"),
                  "category")
          .write.partitionBy("feed_index").format("xml")
          .option("rootTag", "channel").option("rowTag", "item").save(landing))


def _stream(reader, files_per_batch: int | None):
    """All new files in a batch, or at most ``files_per_batch``."""
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def read_feed_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record").schema(ITEM_SCHEMA))
    return _stream(reader, files_per_batch).load(landing)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a checkpoint belongs to, made with the checkpoint."""
    from pyspark.errors import AnalysisException
    marker = f"{checkpoint.rstrip('/')}/run-name"
    try:
        return spark.read.text(marker).first()["value"]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    name = f"r{uuid.uuid4().hex}"
    spark.range(1).select(F.lit(name).alias("value")).coalesce(1).write.text(marker)
    return name


def _batch_writer(out: str, run: str):
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/run={run}/batch={batch_id}")
    return write


def stream_quarantine(spark: SparkSession, landing: str, out: str, checkpoint: str,
                      files_per_batch: int | None = None):
    """Q2: what the feed jobs leave out, kept for a look: unparsable files and items
    without a GUID, the same rows that the batch reader's ``split_quarantine`` sets apart."""
    _good, bad = split_quarantine(read_feed_stream(spark, landing, files_per_batch))
    return (bad.writeStream.foreachBatch(_batch_writer(out, run_id(spark, checkpoint)))
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_skill_counts(spark: SparkSession, landing: str, out: str, checkpoint: str,
                        files_per_batch: int | None = None):
    """Running counts per skill.  Update mode: each micro-batch writes only the
    skills whose count changed, into its own folder ``batch=N`` (a retry overwrites
    it), so a batch costs what it changed, not the whole table; ``current_counts``
    reads the latest count of every skill."""
    items, _bad = split_quarantine(read_feed_stream(spark, landing, files_per_batch))
    counts = (items.select(F.explode("category").alias("skill"))
                   .groupBy("skill").agg(F.count(F.lit(1)).alias("count")))
    return (counts.writeStream.outputMode("update")
                  .foreachBatch(_batch_writer(out, run_id(spark, checkpoint)))
                  .option("checkpointLocation", checkpoint)
                  .trigger(availableNow=True).start())


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    """The latest count per skill from the update-mode sink (partial ``max_by``); runs
    with checkpoints of their own count apart, so their counts add up.  A job that found no
    item has written no folder: no counts."""
    from pyspark.errors import AnalysisException
    try:
        written = spark.read.parquet(out)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "skill string, count bigint")
    latest = written.groupBy("run", "skill").agg(F.max_by("count", "batch").alias("count"))
    return latest.groupBy("skill").agg(F.sum("count").alias("count"))


def stream_match(spark: SparkSession, resume_dir: str, resume_schema: str, model_table: str,
                 vocabulary: DataFrame, out: str, checkpoint: str, qkey: str = "resume_id",
                 dkey: str = "doc_id", k: int = match.WEB_TOP, files_per_batch: int | None = None):
    """R2: top-k matches of every arriving resume against the stored model.

    ``model_table`` is the model saved bucketed by document (``sinks.write_model``
    with a table name): the bucketed scan is already partitioned by document, so the
    per-(resume, document) score sum needs no shuffle and only the top-k
    candidates of each task move."""
    resumes = _stream(spark.readStream.schema(resume_schema), files_per_batch).parquet(resume_dir)
    run = run_id(spark, checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        model = spark.table(model_table)                # stored model, not rebuilt
        top = match.match_batch(batch, model, vocabulary, qkey=qkey, dkey=dkey, k=k)
        top.write.mode("overwrite").parquet(f"{out}/run={run}/batch={batch_id}")

    return (resumes.writeStream.foreachBatch(per_batch)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())


def stream_ingest(spark: SparkSession, landing: str, store: str, checkpoint: str,
                  prefix_regex: str = r"https?://", files_per_batch: int | None = None,
                  quarantine: str | None = None):
    """New job URLs from new feed files, each document name once across runs.
    ``store`` holds ``(doc_name, url)`` of everything seen so far, one folder per run
    and batch; the caller seeds it with ``seed_store``.  ``quarantine`` (default: beside
    the store) gets the rows that name no document."""
    run = run_id(spark, checkpoint)
    aside = quarantine or f"{store.rstrip('/')}-quarantine"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_quarantine(batch)
        bad.write.mode("overwrite").parquet(f"{aside}/run={run}/batch={batch_id}")
        named = pages.with_doc_names(good.select(F.col("guid").alias("url")), prefix_regex)
        # one URL per name within the batch (lowest), then drop names already stored: in any
        # run and batch but this batch's own folder (a retry)
        first = named.groupBy("doc_name").agg(F.min("url").alias("url"))
        own = (F.col("run") == run) & (F.col("batch") == batch_id)
        seen = spark.read.parquet(store).filter(~own).select("doc_name")
        new = first.join(seen, "doc_name", "left_anti")
        new.select("doc_name", "url").write.mode("overwrite").parquet(f"{store}/run={run}/batch={batch_id}")

    return (read_feed_stream(spark, landing, files_per_batch).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def seed_store(stored_names: DataFrame, store: str) -> None:
    """Names already stored before the first run, as batch ``-1`` of the run ``seed``."""
    (stored_names.select("doc_name", F.lit(None).cast("string").alias("url"))
                 .write.mode("overwrite").parquet(f"{store}/run=seed/batch=-1"))
