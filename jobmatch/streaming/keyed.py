"""Ingest with keyed state (R3): a name is told from those seen before without the store.

``transformWithState`` keeps one small value per document name, seeded once from the store when a
checkpoint begins; later batches ask the state of the names they list and no more.  Names are
made unique per Arrow batch before they are dealt, so that a name that is listed very often
sends few rows to its task.  With a time to live, a name's value goes away that long after the name was
last seen, so the state is bounded by the names of that time; the few names that come back later are
compared with the store through its Bloom filters (``name_store``), which reads no other
buckets than those hit.

The store is a ``name_store``, one run per micro-batch.  A batch that is retried finds its run
complete, or replaces it.  The state needs the RocksDB provider, which is set while the query
starts.  Items without a GUID and those that do not parse are written aside.  A name's URL is the
lowest of the batch that brings it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import pages
from ..plans import name_store
from ..sources.feed_source import read_feeds_stream
from .jobs import run_id

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    """Emits a name once, with the lowest URL of the batch."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        url = min(r.url for r in rows)
        known = self.seen.exists()
        if not known or self.ttl_ms is not None:      # being seen starts the time to live anew
            self.seen.update((True,))
        if not known:
            yield Row(doc_name=key[0], url=url)

    def close(self) -> None:
        pass


def _once_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = pa.Table.from_batches([batch]).group_by("doc_name").aggregate([("url", "min")])
        yield from t.select(["doc_name", "url_min"]).rename_columns(["doc_name", "url"]).to_batches()


def stored_names(spark: SparkSession, store: str) -> DataFrame:
    """The names of all complete runs of the store."""
    done = name_store.runs(spark, store)
    if not done:
        return spark.createDataFrame([], "doc_name string")
    return spark.read.option("basePath", f"{store}/{name_store.DOCS}").schema("doc_name string").parquet(
        *[f"{store}/{name_store.DOCS}/run={r['run']}" for r in done])


def stream_ingest_keyed(spark: SparkSession, landing: str, store: str, checkpoint: str,
                        prefix_regex: str = r"https?://", ttl_ms: int | None = None, settle: float = 0):
    """Each new document name once, across batches and runs."""
    run = run_id(spark, checkpoint)
    items = read_feeds_stream(spark, landing, settle)
    named = pages.with_doc_names(items.filter("problem IS NULL").select(F.col("guid").alias("url")), prefix_regex)
    named = named.filter("doc_name IS NOT NULL").select("doc_name", "url").mapInArrow(_once_per_batch, "doc_name string, url string")
    seed = stored_names(spark, store).distinct().groupBy("doc_name")
    new = named.groupBy("doc_name").transformWithState(
        FirstSeen(ttl_ms), "doc_name string, url string", "Update", "None" if ttl_ms is None else "ProcessingTime", seed)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"{run}-{batch_id}"
        if any(r["run"] == name for r in name_store.runs(batch.sparkSession, store)):
            return
        if ttl_ms is not None:
            batch = name_store.pending(batch, store)
        name_store.store_run(batch, store, name)

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (new.writeStream.outputMode("update").foreachBatch(per_batch)
                   .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before) if before is not None else spark.conf.unset(PROVIDER)


def stream_items_aside(spark: SparkSession, landing: str, out: str, checkpoint: str, settle: float = 0):
    """Q2: the items that the feeds' readers leave out, with their text and what is wrong."""
    run = run_id(spark, checkpoint)
    bad = read_feeds_stream(spark, landing, settle).filter("problem IS NOT NULL")
    return (bad.writeStream.foreachBatch(
                lambda batch, i: batch.write.mode("overwrite").parquet(f"{out}/run={run}/batch={i}"))
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
