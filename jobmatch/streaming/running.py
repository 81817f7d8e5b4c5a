"""Running counts as items arrive (W1 on a stream).

Each micro-batch numbers its category rows with the batch operator (``running_count``: a hot
category is cut into buckets, so no task holds its rows) and goes on from the totals of the batches
before.  A batch writes the totals of the categories it met, and every ``FOLD`` batches all
totals into one base, so a batch reads one base and at most ``FOLD`` small folders, however
long the stream runs.  Both are written per batch with ``overwrite`` and read only by later
ones: a batch that is retried gives the same numbers again.

Arrival order is (batch, file, place of the item in its file, position of the category).  Items
set aside keep their place; a null category is a value of its own in the rows, but is not
counted with others: it has no running number (null).  Runs with checkpoints of their own
count apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import running_count
from ..plans.sizing import cut_lineage
from ..sources.feed_source import read_feeds_stream
from .jobs import run_id

FOLD = 64
BUCKET = 1 << 16
STATE = "category string, total bigint, as_of int"


def totals_before(spark: SparkSession, out: str, run: str, batch_id: int) -> DataFrame:
    """``(category, start)``: the totals of the batches before ``batch_id``."""
    base = (batch_id - 1) // FOLD * FOLD if batch_id else 0
    folders = [f"{out}/totals/run={run}/batch={i}" for i in range(base + 1 if base else 0, batch_id)]
    if base:
        folders.append(f"{out}/bases/run={run}/batch={base}")
    if not folders:
        return spark.createDataFrame([], "category string, start bigint")
    # a base and the totals of its batch agree, so ties do not matter
    return (spark.read.schema(STATE).parquet(*folders)
                 .groupBy("category").agg(F.max_by("total", "as_of").alias("start")))


def number_batch(rows: DataFrame, out: str, run: str, batch_id: int) -> None:
    """Number one batch's rows (``file_no, place, pos, category`` and what else they have)."""
    spark = rows.sparkSession
    fixed = cut_lineage(rows)
    start = cut_lineage(totals_before(spark, out, run, batch_id))
    here = fixed.filter("category IS NOT NULL").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    totals = here.join(start, "category", "left").select(
        "category", (F.coalesce("start", F.lit(0)) + F.col("n")).alias("total"), F.lit(batch_id).alias("as_of"))
    totals.write.mode("overwrite").parquet(f"{out}/totals/run={run}/batch={batch_id}")
    if batch_id and batch_id % FOLD == 0:
        base = (start.select("category", F.col("start").alias("total"), F.lit(-1).alias("as_of"))
                     .unionByName(spark.read.parquet(f"{out}/totals/run={run}/batch={batch_id}"))
                     .groupBy("category").agg(F.max_by("total", "as_of").alias("start")))
        base.select("category", F.col("start").alias("total"), F.lit(batch_id).alias("as_of")).write.mode(
            "overwrite").parquet(f"{out}/bases/run={run}/batch={batch_id}")
    bucket = F.col("file_no").cast("bigint") * F.lit(1 << 40) + F.floor(F.col("place") / BUCKET)
    counted = running_count(fixed.filter("category IS NOT NULL"), ["category"],
                            [F.col("file_no"), F.col("place"), F.col("pos")], bucket, start=start)
    unnamed = fixed.filter("category IS NULL").withColumn("running_count", F.lit(None).cast("bigint"))
    counted.unionByName(unnamed).drop("file_no").write.mode("overwrite").parquet(
        f"{out}/items/run={run}/batch={batch_id}")


def stream_running_counts(spark: SparkSession, landing: str, out: str, checkpoint: str, settle: float = 0):
    """Every category of every landed item with its running number."""
    run = run_id(spark, checkpoint)
    items = read_feeds_stream(spark, landing, settle).filter("problem IS NULL")
    rows = items.select("file_no", "place", "file", "feed_index", "guid", F.posexplode("category").alias("pos", "category"))
    return (rows.writeStream.foreachBatch(lambda batch, i: number_batch(batch, out, run, i))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_running_counts(spark: SparkSession, out: str) -> DataFrame:
    """``file, place, feed_index, guid, pos, category, running_count, run, batch``."""
    return spark.read.schema("file string, place bigint, feed_index int, guid string, pos int, category string, "
                             "running_count bigint, run string, batch int").parquet(f"{out}/items")
