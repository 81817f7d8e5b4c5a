"""Ranks and running counts that keep no unbounded group in one task.

``global_position``: 0-based position in a total order without a
single-partition window.  Rows are range-partitioned and sorted within each
range, then cut into the checkpoint folder so partition ids and in-partition
order are fixed; each row's position is its index in its partition plus the
sizes of all earlier partitions (a table with one row per partition).

``running_count``: ``count(*) over (partition by p order by o rows unbounded
preceding)`` where one key ``p`` may hold a large share of all rows.  Rows are
cut into order buckets (any column non-decreasing in the order); counts per
(p, bucket) give each bucket's offset, and the row number inside a bucket adds
the rest.  Offsets are themselves summed in two levels, over runs of buckets and
within a run, so no task sees more than one bucket's rows, one run's buckets or the
runs of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import cut_lineage

RUN_BUCKETS = 4096
RUN_ROWS = 1 << 13       # rows of one run of a partition; divides 1 << 33
_LOW33 = (1 << 33) - 1   # monotonically_increasing_id: partition id << 33 | record index


def global_position(df: DataFrame, order: list[Column], out: str = "position",
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 0-based position of each row in ``order`` (which must be total)."""
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    fixed = cut_lineage(ranged.sortWithinPartitions(*order))
    mid = fixed.withColumn("_mid", F.monotonically_increasing_id())
    mid = mid.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_idx", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    sizes = mid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single window over it is bounded by the partition count
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (mid.join(F.broadcast(offsets), "_pid")
               .withColumn(out, (F.col("_off") + F.col("_idx")).cast("bigint"))
               .drop("_mid", "_pid", "_idx", "_off"))


def running_sum(df: DataFrame, order: list[Column], value: str, out: str, width: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows in ``order``.  As in
    ``global_position``, rows are range-partitioned, sorted and fixed, and each partition needs
    one number of the others; within it, rows are cut into runs whose sums are summed first, so
    no window holds a partition.  ``width`` is how many parts the rows are cut into, for rows that
    the configured number of parts would leave too large."""
    wide = [width] if width else []
    fixed = cut_lineage(df.repartitionByRange(*wide, *order).sortWithinPartitions(*order))
    mid = fixed.withColumn("_mid", F.monotonically_increasing_id())
    mid = mid.withColumn("_run", F.expr(f"_mid div {RUN_ROWS}"))    # a run lies in one partition
    sums = mid.groupBy("_run").agg(F.sum(value).alias("_s"))
    sums = sums.withColumn("_pid", F.shiftright(F.col("_run") * RUN_ROWS, 33))
    parts = sums.groupBy("_pid").agg(F.sum("_s").alias("_p"))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per partition, and one per run of a partition
    parts = parts.select("_pid", before(Window.orderBy("_pid"), "_p").alias("_po"))
    runs = (sums.withColumn("_ro", before(Window.partitionBy("_pid").orderBy("_run"), "_s")).join(F.broadcast(parts), "_pid")
                .select("_run", (F.col("_po") + F.col("_ro")).alias("_off")))
    own = before(Window.partitionBy("_run").orderBy("_mid"), value)
    mid = mid.repartition(width, "_run") if width else mid
    return (mid.withColumn("_own", own).join(runs, "_run")
               .withColumn(out, (F.col("_off") + F.col("_own")).cast("bigint"))
               .drop("_mid", "_run", "_own", "_off"))


def running_count(df: DataFrame, partition: list[str], order: list[Column], bucket: Column,
                  out: str = "running_count", start: DataFrame | None = None) -> DataFrame:
    """Add ``out``: running row count within ``partition`` in ``order``; ``bucket`` must
    be non-decreasing along ``order`` (e.g. ``item_index div width``).  ``start`` (columns of
    ``partition`` and ``start``) is what each count goes on from; it meets runs of buckets, not
    rows, so a hot key is not joined by its rows."""
    b = df.withColumn("_bucket", bucket)
    keys = [*partition, "_bucket"]
    counts = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_run", F.expr(f"_bucket div {RUN_BUCKETS}"))
    runs = counts.groupBy(*partition, "_run").agg(F.sum("_n").alias("_m"))
    earlier = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*partition, "_run", earlier(Window.partitionBy(*partition).orderBy("_run"), "_m").alias("_ro"))
    if start is not None:
        runs = runs.join(start, partition, "left").select(
            *partition, "_run", (F.col("_ro") + F.coalesce("start", F.lit(0))).alias("_ro"))
    within = earlier(Window.partitionBy(*partition, "_run").orderBy("_bucket"), "_n")
    offsets = (counts.withColumn("_bo", within).join(runs, [*partition, "_run"])
               .select(*keys, (F.col("_ro") + F.col("_bo")).alias("_off")))
    local = b.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return (local.join(offsets, keys)
                 .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
                 .drop("_bucket", "_off", "_local"))
