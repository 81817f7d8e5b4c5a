"""Feed sources (S3, S4, S5, U2): landed RSS files read with Spark's XML reader.

Every file under the landing folder is one fetched feed; all files are read in
one scan (the union of all feeds).  A file that does not parse yields a row
with ``_corrupt_record`` set (PERMISSIVE mode) instead of stopping the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ITEM_SCHEMA = ("guid string, title string, author struct<name:string>, "
               "category array<string>, _corrupt_record string")
FEED_FILE_INDEX = r"(\d+)"     # landed files are named by feed index, e.g. feed_3.xml


def feeds_table(spark: SparkSession, urls: list[str]) -> DataFrame:
    """``(feed_index, url)``."""
    return spark.createDataFrame(list(enumerate(urls)), "feed_index int, url string")


def read_feed_items(spark: SparkSession, path: str) -> DataFrame:
    """``(feed_index, item_index, guid, title, author, category, _corrupt_record)``.

    ``item_index`` is the item's position in its feed, over the feed's files in the order
    of their names: the position in the file (a window bounded by one file) plus the
    sizes of the feed's earlier files (one row a file)."""
    raw = (spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .schema(ITEM_SCHEMA).load(path))
    f = F.col("_metadata.file_path")
    df = raw.select("*", f.alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_mid"))
    local = F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_mid")) - 1
    # a landing folder partitioned by feed (feed_index=N/) names the feed; otherwise
    # the digits of the file name do
    feed = (F.col("feed_index").cast("int") if "feed_index" in raw.columns
            else F.regexp_extract(F.regexp_replace("_file", "^.*/", ""), FEED_FILE_INDEX, 1).cast("int"))
    df = df.withColumn("_feed", feed)
    before = Window.partitionBy("_feed").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy("_feed", "_file").agg(F.count(F.lit(1)).alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return df.withColumn("_local", local).join(starts, "_file").select(
        F.col("_feed").alias("feed_index"),
        (F.col("_start") + F.col("_local")).cast("bigint").alias("item_index"),
        "guid", "title", F.col("author.name").alias("author"), "category", "_corrupt_record")


def split_quarantine(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good items, and the quarantine: unparsable files or items without a GUID."""
    bad = F.col("_corrupt_record").isNotNull() | F.col("guid").isNull()
    return items.filter(~bad).drop("_corrupt_record"), items.filter(bad)
