"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered by their place in a global sort, so the numbers do not depend on how
the input is partitioned.  A Feistel network over the smallest rectangle of at least
that many cells, with cycle walking past its unused cells, permutes the numbers; the
permuted number p gives shard ``p mod n`` and slot ``p div n``.  Shards differ by at
most one row, whatever the keys or texts are, and any row's place can be computed from
its number, the row count and the seed.

Defined cases: a null text counts as no bytes; null ids sort first; repeated rows each
get a number (which of two equal rows gets which makes no difference); an empty table
gives no rows.  Columns of the input are carried in a struct, so no name can clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 40
SEED = 20_231
ROUNDS = 4
ROW_OVERHEAD = 16
_PLACE_BITS = 33         # of monotonically_increasing_id: the place within a partition


def number_rows(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``(row, number)`` with ``number`` the place of the row in the order of ``order``,
    and the number of rows.  One range shuffle; the only other exchange has one row for
    each partition.  Equal keys are told apart by a running id, so that a key with very
    many rows is spread over partitions like any other rows."""
    keyed = df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("tie"))
    keys = [F.col(f"row.{c}") for c in order] + [F.col("tie")]
    placed = stored(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .select("row", F.monotonically_increasing_id().alias("place")), "numbered")
    part = F.shiftright("place", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    placed = placed.withColumn("part", part)
    # One row for each partition of the sort.
    return placed.join(F.broadcast(starts), "part").select("row", (
        F.col("start") + F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)).alias("number")), total


def _round(seed: int, j: Column, half: Column) -> Column:
    """60 bits that depend on the seed, the round and the other half."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), j, half)), 1, 15), 16, 10).cast("long")


def _sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _pass(p: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """One pass of the network over a value in [0, sides).  Each round adds bits of the right
    half to the left one, and the halves change places."""
    a, b = _sides(n)
    side = lambda j: F.when(j % 2 == 0, F.lit(a)).otherwise(F.lit(b))

    def forward(h: Column, j: Column) -> Column:
        moved = F.pmod(h["l"] + F.pmod(_round(seed, j, h["r"]), side(j)), side(j))
        return F.struct(h["r"].alias("l"), moved.alias("r"))

    def backward(h: Column, j: Column) -> Column:
        moved = F.pmod(h["r"] - F.pmod(_round(seed, j, h["l"]), side(j)), side(j))
        return F.struct(moved.alias("l"), h["l"].alias("r"))

    rounds = list(range(ROUNDS))
    halves = F.struct(F.pmod(p, F.lit(a)).cast("long").alias("l"), F.floor(p / a).cast("long").alias("r"))
    return F.aggregate(F.array(*map(F.lit, reversed(rounds) if inverse else rounds)), halves,
                       backward if inverse else forward, lambda h: h["l"] + h["r"] * a)


def longest_walk(spark, n: int, seed: int) -> int:
    """How many passes the number that walks longest needs.  Only the unused cells (fewer
    than the square root of ``n``) are followed, from those that a number walks into."""
    a, b = _sides(n)
    p = F.col("p")
    out = spark.range(n, a * b).select(F.col("id").alias("p")).where(_pass(p, n, seed, True) < n)
    passes = 1
    while out.take(1):
        out = out.select(_pass(p, n, seed).alias("p")).where(p >= n)
        passes += 1
    return passes


def permute(number: Column, n: int, seed: int, passes: int) -> Column:
    """The permuted ``number`` in [0, n): one pass, and more while the value is past n."""
    first = _pass(number, n, seed)
    if passes == 1:
        return first
    return F.aggregate(F.sequence(F.lit(2), F.lit(passes)), first,
                       lambda p, _: F.when(p < n, p).otherwise(_pass(p, n, seed)))


def assign(df: DataFrame, *order: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(row, shard, slot)`` for every row of ``df``, which is numbered by ``order``."""
    rows, n = number_rows(df, *order)
    passes = longest_walk(df.sparkSession, n, seed) if n else 1
    return rows.select("row", permute(F.col("number"), n, seed, passes).alias("p")).select(
        "row", F.pmod("p", F.lit(shards)).cast("int").alias("shard"), F.expr(f"p div {shards}").alias("slot"))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
            seed: int = SEED) -> DataFrame:
    """The place of every document, with its size and the checksum of its text."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"))
    placed = assign(narrow, "doc_id", "text_crc32", "size", shards=shards, seed=seed)
    return placed.select("row.*", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, *order: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write whole rows of ``docs`` in a reproducible shuffle: one folder for each shard,
    its files in the order of the slots.  A shard may have many files, so its size is not
    that of one task; ``slot`` in each row tells the order."""
    placed = assign(docs, *order, shards=shards, seed=seed)
    clash = {"shard", "slot"} & set(docs.columns)
    own = placed.select(*[F.col("row")[c].alias(f"row_{c}" if c in clash else c) for c in docs.columns], "shard", "slot")
    (own.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
