"""Skill counts from feed categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_position, running_count

# Categories are counted exactly as written (no case folding).


def category_rows(items: DataFrame) -> DataFrame:
    """``(feed_index, item_index, pos, category)``, one row per category of an item."""
    return items.select("feed_index", "item_index",
                        F.posexplode("category").alias("pos", "category"))


def skill_counts(items: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """A4 + J6 + U1: ``(skill, count)`` over all item categories; known skills not
    seen get count 0.  Lookup-or-insert is a union of seed rows (0) and seen rows
    (1) summed by skill: one shuffle with map-side partial sums, no full join."""
    seen = category_rows(items).select(F.col("category").alias("skill"), F.lit(1).cast("bigint").alias("n"))
    if vocabulary is not None:
        seeds = vocabulary.select("skill", F.lit(0).cast("bigint").alias("n"))
        seen = seeds.unionByName(seen)
    return seen.groupBy("skill").agg(F.sum("n").alias("count"))


def items_per_feed(items: DataFrame) -> DataFrame:
    """``(feed_index, items)``."""
    return items.groupBy("feed_index").agg(F.count(F.lit(1)).alias("items"))


def category_running_count(items: DataFrame, bucket_width: int = 1 << 16) -> DataFrame:
    """Running count of each category in arrival order (feed, item, position);
    skew-safe for a hot category (see ``plans.ranking.running_count``)."""
    rows = category_rows(items)
    order = [F.col("feed_index"), F.col("item_index"), F.col("pos")]
    bucket = F.col("feed_index").cast("bigint") * F.lit(1 << 40) + F.floor(F.col("item_index") / bucket_width)
    return running_count(rows, ["category"], order, bucket)


def rank_order(counts: DataFrame) -> list[Column]:
    """O1: count descending, ties by skill."""
    return [F.desc("count"), F.asc("skill")]


def sorted_skills(counts: DataFrame) -> DataFrame:
    return counts.orderBy(*rank_order(counts))


def skill_positions(counts: DataFrame) -> DataFrame:
    """0-based position in the sorted skill list, distributed."""
    return global_position(counts, rank_order(counts), out="position")


def with_run(counts: DataFrame, run_ts: Column) -> DataFrame:
    """K2 history rows of one run: ``(skill, count, run_ts)``."""
    return counts.select("skill", "count", run_ts.cast("timestamp").alias("run_ts"))


def current_counts(history: DataFrame) -> DataFrame:
    """K2 current view: the latest run's count per skill (aggregate, not a window:
    partial ``max_by`` per task, one row per skill shuffled)."""
    latest = F.max_by(F.struct("count", "run_ts"), "run_ts")
    return (history.groupBy("skill").agg(latest.alias("_l"))
                   .select("skill", F.col("_l.count").alias("count"), F.col("_l.run_ts").alias("run_ts")))


def next_vocabulary(history: DataFrame) -> DataFrame:
    """Q1: the next run starts from every skill known so far, counts reset to 0."""
    return history.select("skill").distinct()
