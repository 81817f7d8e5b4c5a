"""A document store whose names can be probed without reading it.

A run writes its documents, their names by hash bucket, one Bloom filter per bucket and, last, a
record; it counts once the record is there.  A run has as many buckets as keep each at about
``BUCKET_NAMES`` names, so filters and buckets are small however large the store is.

``pending`` asks the filters first: a listed name meets the filter of its bucket in each run
(cogrouped by run, bucket and a salt, so that no task holds all listed names of a small
store).  Names that no filter knows are new.  The few that one may know are compared with the
stored names themselves, of the buckets they fall in, and of these buckets alone.

Null names are not stored and never pending; a name that is listed more than once stays as
often; a run repeated under its name is left as it is once complete, and replaced if it was
not.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sizing import cut_lineage

DOCS, NAMES, FILTERS, RUNS = "docs", "names", "filters", "runs"
BUCKET_NAMES = 100_000
PROBED_NAMES = 500_000     # listed names of one cogroup, about
BITS, PROBES = 12, 6       # bits per name and places per name: about 0.5 % false hits
LISTED_BUCKETS = 5_000     # hit buckets that are named in the scan; more are joined


def runs(spark: SparkSession, path: str) -> list:
    """``(run, docs, buckets)`` of the complete runs, one small row each."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("docs bigint, buckets int, run string").parquet(f"{path}/{RUNS}").orderBy("run").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return []


def _bucket(name: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), name), buckets).cast("int")


def _hashes(name: Column) -> list[Column]:
    return [F.xxhash64(name).alias("h1"), F.xxhash64(name, F.lit(1)).alias("h2")]


def _places(table: pa.Table, size: int) -> np.ndarray:
    """The places of every name in a filter of ``size`` bits (a power of two)."""
    h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (h1 + steps * (h2 | np.uint64(1))) & np.uint64(size - 1)


def _filter_of(names: pa.Table) -> pa.Table:
    """One bucket's filter."""
    size = 1 << max(math.ceil(math.log2(max(len(names) * BITS, 8))), 3)
    bits = np.zeros(size, bool)
    bits[_places(names, size).ravel()] = True
    return pa.table({"bucket": names.column("bucket").slice(0, 1), "bits": [np.packbits(bits).tobytes()]},
                    pa.schema([("bucket", pa.int32()), ("bits", pa.binary())]))


def store_run(docs: DataFrame, path: str, run: str, name: str = "doc_name") -> None:
    """Add ``docs`` (new names, each once) as one run."""
    spark = docs.sparkSession
    if any(r["run"] == run for r in runs(spark, path)):
        return
    docs.filter(F.col(name).isNotNull()).write.mode("overwrite").parquet(f"{path}/{DOCS}/run={run}")
    stored = spark.read.parquet(f"{path}/{DOCS}/run={run}").select(F.col(name).alias("doc_name"))
    total = stored.count()
    buckets = max(1, -(-total // BUCKET_NAMES))
    named = stored.withColumn("bucket", _bucket(F.col("doc_name"), F.lit(buckets)))
    named.repartition(min(buckets, 4096), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{NAMES}/run={run}")
    filters = named.select("bucket", *_hashes(F.col("doc_name"))).groupBy("bucket").applyInArrow(
        _filter_of, "bucket int, bits binary")
    filters.write.mode("overwrite").parquet(f"{path}/{FILTERS}/run={run}")
    record = spark.range(1).select(F.lit(total).cast("bigint").alias("docs"), F.lit(buckets).alias("buckets"))
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RUNS}/run={run}")


def _known(names: pa.Table, filters: pa.Table) -> pa.Table:
    """The listed names of one bucket that its filter may know."""
    if not len(filters) or not len(names):
        return names.slice(0, 0).select(["doc_name", "run", "bucket"])
    bits = np.unpackbits(np.frombuffer(filters.column("bits")[0].as_py(), np.uint8)).view(bool)
    hit = bits[_places(names, len(bits))].all(axis=0)
    return names.filter(pa.array(hit)).select(["doc_name", "run", "bucket"])


def maybe_stored(names: DataFrame, path: str, done: list) -> DataFrame:
    """``(doc_name, run, bucket)`` of the listed names that some filter may know."""
    spark = names.sparkSession
    listed = F.array(*[F.struct(F.lit(r["run"]).alias("run"), F.lit(r["buckets"]).alias("buckets")) for r in done])
    each = names.select("doc_name", F.explode(listed).alias("r")).select(
        "doc_name", "r.run", _bucket(F.col("doc_name"), F.col("r.buckets")).alias("bucket"), *_hashes(F.col("doc_name")))
    salts = 1 + names.count() // PROBED_NAMES
    each = each.withColumn("salt", F.pmod(F.col("h2"), F.lit(salts)))
    filters = spark.read.option("basePath", f"{path}/{FILTERS}").schema("bucket int, bits binary, run string").parquet(
        *[f"{path}/{FILTERS}/run={r['run']}" for r in done])
    filters = filters.withColumn("salt", F.explode(F.sequence(*[F.lit(x).cast("bigint") for x in (0, salts - 1)])))
    keys = ["run", "bucket", "salt"]
    return each.groupBy(*keys).cogroup(filters.groupBy(*keys)).applyInArrow(_known, "doc_name string, run string, bucket int")


def stored_names(spark: SparkSession, path: str, hits: DataFrame, done: list) -> DataFrame:
    """The stored names of the buckets that ``hits`` fall in; other buckets are not read."""
    names = spark.read.option("basePath", f"{path}/{NAMES}").schema("doc_name string, run string, bucket int").parquet(
        *[f"{path}/{NAMES}/run={r['run']}" for r in done])
    met = hits.select("run", "bucket").distinct()
    some = met.limit(LISTED_BUCKETS + 1).collect()
    if len(some) > LISTED_BUCKETS:
        return names.join(met, ["run", "bucket"], "left_semi")
    by_run: dict[str, list[int]] = {}
    for r in some:
        by_run.setdefault(r["run"], []).append(r["bucket"])
    wanted = F.lit(False)
    for run, buckets in by_run.items():
        wanted = wanted | (F.col("run") == run) & F.col("bucket").isin(buckets)
    return names.filter(wanted)


def pending(listed: DataFrame, path: str, name: str = "doc_name") -> DataFrame:
    """The rows of ``listed`` whose name is not stored, in any complete run."""
    spark = listed.sparkSession
    listed = listed.filter(F.col(name).isNotNull())
    done = runs(spark, path)
    if not done:
        return listed
    names = cut_lineage(listed.select(F.col(name).alias("doc_name")).distinct())
    hits = cut_lineage(maybe_stored(names, path, done))
    found = hits.join(stored_names(spark, path, hits, done).select("doc_name", "run"), ["doc_name", "run"], "left_semi")
    return listed.join(found.select(F.col("doc_name").alias(name)), name, "left_anti")
