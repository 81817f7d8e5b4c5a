"""Bounds on what reaches every task, lineage cuts and the width of small scans."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Largest vocabulary (rows) shipped whole to every task.  The ordered rules of
# the tagger must see the whole vocabulary in every task; 200k skills of ~20
# bytes is a few MB.
MAX_VOCABULARY_ROWS = 200_000
class TooLargeToBroadcast(ValueError):
    pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise into the cluster's checkpoint folder (reliable, survives executor loss)."""
    return df.checkpoint(eager=True)


def shuffle_partitions(spark) -> int:
    """The configured shuffle width (sized by the operator for the target scale)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SLICE_BYTES = 1 << 20


def batch_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of Arrow batches with about ``most`` bytes in a text column; a larger row stands alone.
    Spark fills batches by rows, so one of a large partition holds far more text than one of
    a small partition, and what Python makes of it is many times its size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)


SPREAD_BYTES = 1 << 28


def estimated_bytes(df: DataFrame) -> int | None:
    """The plan's own estimate of a frame's size; no job is run.  ``None`` in a Spark Connect
    session, which has none while planning."""
    from ..session import spark_context
    if spark_context(df.sparkSession) is None:
        return None
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Give a CPU-bound stage every core although a small scan may be one task, as a file
    with a single row group is.  Scans past
    ``SPREAD_BYTES`` (the plan's own estimate; no job is run) keep their partitions, so
    a corpus is never shuffled to balance it."""
    from ..session import spark_context
    size = estimated_bytes(df)
    if size is None or size > SPREAD_BYTES:
        return df
    return df.repartition(spark_context(df.sparkSession).defaultParallelism)
