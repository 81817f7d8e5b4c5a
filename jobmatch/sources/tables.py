"""Driver tables and the roles they play (FIXTURES.md section 2).

Every role is a projection of a driver table, so Catalyst prunes columns and
pushes filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import spread_if_narrow


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored jobs: ``documents`` with ``doc_id`` as the document name, ``text`` as the body."""
    return spread_if_narrow(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resumes: ``benchmark(item_id, text)`` as ``(resume_id, text)``."""
    return spread_if_narrow(read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("resume_id"), "text"))


def resumes_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as resume requests: text missing unless the role is
    ``user``, the keyword ``magic`` on the first turn."""
    c = read_table(spark, sf_dir, "conversations")
    text = (F.when(F.col("turn") == 0, F.lit("magic"))
            .when(F.col("role") == "user", F.col("text")))
    return c.select("conv_id", "turn", text.alias("text"))


def http_status(page_id: Column) -> Column:
    """Derived fetch status of a page: 404 for every fifth page, else 200."""
    return F.when(page_id % 5 == 0, F.lit(404)).otherwise(F.lit(200))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages ``(page_id, url, html, http_status)``."""
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", "url", "html", http_status(F.col("page_id")).alias("http_status"))


def feed_items(spark: SparkSession, sf_dir: str, n_feeds: int = 7) -> DataFrame:
    """Feed items ``(feed_index, item_index, guid, title, category)``: each page is an
    item of feed ``page_id % n_feeds``; its categories are the nav link texts."""
    from ..functions.text import page_links, page_title
    p = read_table(spark, sf_dir, "pages")
    return p.select(
        (F.col("page_id") % n_feeds).cast("int").alias("feed_index"),
        F.col("page_id").alias("item_index"),
        F.col("url").alias("guid"),
        page_title(F.col("html")).alias("title"),
        page_links(F.col("html")).alias("category"),
    )


def stored_names(spark: SparkSession, sf_dir: str, folder: str = "jobs_sof/") -> DataFrame:
    """Names already in the store: the pages with ``page_id % 3 = 0``."""
    from ..functions.text import url_to_doc_name
    p = read_table(spark, sf_dir, "pages")
    return (p.filter(F.col("page_id") % 3 == 0)
             .select(url_to_doc_name(F.col("url"), folder=folder).alias("doc_name")))
