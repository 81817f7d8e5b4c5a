"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spark_context

# White space between words: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Rows of a side that may be broadcast (narrow rows, some tens of MB at most).
BROADCAST_ROWS = 300_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _LOWER)


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def shingles_of(words: Column, n: int) -> Column:
    """Every run of ``n`` words; the whole sequence as one when there are fewer; none
    without words.  ``words`` must be a column, not an expression, as every run reads it
    (by place: ``slice`` copies the whole array each time)."""
    size = F.size(words)
    return (F.when(size >= n, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.concat_ws(
        " ", *[F.get(words, i + k) for k in range(n)])))
            .when(size > 0, F.array(F.array_join(words, " ")))
            .otherwise(F.array().cast("array<string>")))


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` for a condition on costly columns.  A plain filter would be
    pushed below the projections that make them, and they would be made twice; the running
    number keeps it above."""
    return df.withColumn("_place", F.monotonically_increasing_id()).where(
        condition & (F.col("_place") >= 0)).drop("_place")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint folder, removed when the
    application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    sc = spark_context(spark)
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the rows are computed once, and
    a lost executor costs nothing that lies before them."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the files of a ``stored`` frame that no later step reads."""
    sc = spark_context(df.sparkSession)
    if sc is None:
        return
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        p = sc._jvm.org.apache.hadoop.fs.Path(f)
        if "/llm-" in f:
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, counted on its stored
    files; else as it is, and the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def with_few(rows: DataFrame, values: DataFrame, key: str, salts: int = 32) -> DataFrame:
    """``rows`` joined with ``values``, which has one row for each ``key`` (stored files).  Past
    the size that is broadcast, ``values`` are repeated ``salts`` times, so that the rows of
    one key are spread over as many tasks."""
    if values.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(values), key)
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c != key]), F.lit(salts))
    spread = values.withColumn("_salt", F.explode(F.sequence(*[F.lit(x).cast("long") for x in (0, salts - 1)])))
    return rows.withColumn("_salt", salt).join(spread, [key, "_salt"]).drop("_salt")


def _joined(step: int, right: str):
    return lambda h, i: F.xxhash64(h, F.get(F.col(right), i + step))


def with_shingle_hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with ``name``, the hashes of the five-word shingles of column ``text`` in
    order; the whole sequence is one shingle if there are fewer words; none without
    words.  A run's hash joins those of two shorter runs, so each word costs a few steps."""
    words, runs = f"{name}_words", name
    df = df.withColumn(words, words_of(lower_ascii(F.col(text))))
    df = df.withColumn(words, F.transform(words, lambda w: F.xxhash64(w))).withColumn(runs, F.col(words))
    for step in (1, 2):
        df = df.withColumn(runs, F.transform(runs, _joined(step, runs)))
    # Both columns are read outside the lambdas too, or they would be computed for each element.
    n = F.size(words)
    df = df.withColumn(runs, F.when((n > 0) & (F.size(runs) == n), F.transform(runs, _joined(4, words))))
    return df.withColumn(runs, F.when(F.size(runs) == n, F.filter(
        runs, lambda h, i: i < F.greatest(n - 4, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))).drop(words)
