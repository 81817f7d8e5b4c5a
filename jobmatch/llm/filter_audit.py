"""Filter interaction audit on sorted posting lists.

Every row gets a number, its place in the order of ids, and numbers are cut into ranges of
``RANGE``.  For each part and range there is one row with the sorted list of the numbers that
fail each filter, and of those that a label marks.  The lists of a range are merged by
galloping: from the longest list on, each shorter one jumps through what is merged so far and
leaves the numbers that are new (the difference), which are counted.  All unions of filters
grow from smaller ones that way.  Their sizes are summed over ranges, and from the sizes of
the unions of a part follow every order and step.

No list is longer than a range, however many rows a part or a filter has.  Texts that
occur again are found by digest: of each digest the smallest id is taken map-side, and the few
digests that hold more than a thousandth of all rows each are joined by broadcast.

Defined cases: a null text is empty; null parts are the empty string; a null id is in no order,
so its text never fails for being repeated, nor makes another one fail; rows with the same id
are counted each, and one of the same id and text does not make the other fail; labels that
are repeated count once, and an id is marked if any of its labels marks it; null ids have no
labels; an empty table gives no rows.  Columns other than id, text and part are not read, so
they cannot clash.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored
from .sharding import number_rows

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
RANGE = 1 << 16
HOT_PARTS = 1000         # a digest with more than one in so many rows is hot
MARKS = ("good", "toxic")
_UPPER = bytes(range(65, 91))
_ALL = (1 << len(FILTERS)) - 1
_OWN = _ALL >> 1         # the filters that look at one text alone: all but the last


# ---- which filters a row fails ------------------------------------------------------------

def fails_alone(text: bytes) -> int:
    """Bits of the filters A to D that a text (in UTF-8) fails.  ASCII white space separates
    words, as ``bytes.split`` has it."""
    words = text.split()
    points = len(text.decode("utf-8", "replace"))
    upper = len(text) - len(text.translate(None, _UPPER))
    tests = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
             100 * upper > UPPER_PERCENT * points, len(text.translate(None, SYMBOLS)) < len(text))
    return sum(bit << k for k, bit in enumerate(tests))


def _facts(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, part, fails, digest`` of every row, stored: texts are read once."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fails, digests = [], []
            for t in batch.column(2):
                text = t.as_py()
                fails.append(fails_alone(text))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fails, pa.int32()),
                                              pa.array(digests, pa.binary())], ["id", "part", "fails", "digest"])

    empty = F.lit("")
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), empty).alias("part"),
                         F.coalesce(F.col(text_col), empty).cast("binary").alias("text"))
    return stored(narrow.mapInArrow(facts, f"id {dict(narrow.dtypes)['id']}, part string, fails int, digest binary"),
                  "facts")


def _with_repeats(facts: DataFrame) -> DataFrame:
    """``facts`` with the bit of the last filter where a smaller id has the same text."""
    # Partial minima: a digest that very many rows share sends one row for each task.
    seen = stored(facts.groupBy("digest").agg(F.count("*").alias("rows"), F.min("id").alias("low"))
                  .where("rows > 1"), "repeats")
    total = facts.count()
    # At most HOT_PARTS digests can each hold more than that share of the rows.
    hot = F.broadcast(seen.where(F.col("rows") * HOT_PARTS > total).select("digest", F.col("low").alias("hot")))
    rows = facts.join(hot, "digest", "left")
    bit = lambda low: F.when(F.col("id") > F.col(low), _ALL - _OWN).otherwise(0)
    columns = ("id", "part")
    of_hot = rows.where("hot is not null").select(*columns, (F.col("fails") + bit("hot")).alias("fails"))
    cold = seen.where((F.col("rows") * HOT_PARTS <= total) & F.col("low").isNotNull()).select("digest", "low")
    others = rows.where("hot is null").join(small_side(cold), "digest", "left")
    return of_hot.unionByName(others.select(*columns, (F.col("fails") + bit("low")).alias("fails")))


def postings(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """``part, block, rows`` and a sorted list of row numbers for each filter and each mark,
    one row for each part and range of numbers."""
    facts = _with_repeats(_facts(docs, id_col, text_col, part_col))
    marks = labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"),
                          (F.col("toxic") == 1).alias("toxic")).where("id is not null and (good or toxic)")
    marks = marks.groupBy("id").agg(*[F.max(F.coalesce(m, F.lit(False))).alias(m) for m in MARKS])
    numbered, _ = number_rows(facts, "id")
    rows = numbered.select("row.*", "number").join(marks, "id", "left")
    lists = {f: F.col("fails").bitwiseAND(1 << k) > 0 for k, f in enumerate(FILTERS)} | {m: F.col(m) for m in MARKS}
    listed = [F.array_sort(F.collect_list(F.when(has, F.col("number")))).alias(f"in_{name}") for name, has in lists.items()]
    return rows.groupBy("part", F.expr(f"number div {RANGE}").alias("block")).agg(F.count("*").alias("rows"), *listed)


# ---- merging ------------------------------------------------------------------------------

def gallop(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Whether each number of one sorted list is in another one.  All of them jump ahead from
    where they would be if the numbers were spread evenly, in steps that double until they
    have passed their number, and then halve back to it."""
    if not len(small) or not len(large):
        return np.zeros(len(small), bool)
    last = len(large) - 1
    span = max(int(large[-1]) - int(large[0]), 1)
    low = np.clip((small - large[0]) * last // span, 0, last)
    step = np.ones(len(small), np.int64)
    high = low.copy()
    while (back := (large[low] > small) & (low > 0)).any():
        high[back] = low[back]
        low[back] = np.maximum(low[back] - step[back], 0)
        step[back] *= 2
    step[:] = 1
    while (on := (large[high] < small) & (high < last)).any():
        low[on] = high[on]
        high[on] = np.minimum(high[on] + step[on], last)
        step[on] *= 2
    while (open_ := low < high).any():
        middle = (low + high) // 2
        right = open_ & (large[middle] < small)
        low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
    return large[low] == small


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two sorted lists: what the shorter one has alone goes into its places in
    the longer one."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    new = small[~gallop(small, large)]
    return np.insert(large, np.searchsorted(large, new), new) if len(new) else large


def unions(lists: list[np.ndarray], marks: list[np.ndarray]) -> np.ndarray:
    """For every set of filters (by its bits), how many numbers are in the union of its lists
    and how many of these are in each mark's list."""
    order = sorted(range(len(lists)), key=lambda k: -len(lists[k]))
    merged = {0: np.zeros(0, np.int64)}
    for k in order:                                    # from the longest list on
        for bits in list(merged):
            merged[bits | 1 << k] = merge(merged[bits], lists[k])
    return np.array([[len(u), *(int(gallop(m, u).sum()) for m in marks)] for _, u in sorted(merged.items())])


def union_sizes(posted: DataFrame) -> DataFrame:
    """``part, total, sizes``: for each part the rows and, by the bits of every set of filters,
    the size of the union of their lists and how many of it each mark has."""
    lists = [f"in_{f}" for f in FILTERS]
    marks = [f"in_{m}" for m in MARKS]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                read = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                found = unions([read(c) for c in lists], [read(c) for c in marks])
                yield pa.RecordBatch.from_pydict({
                    "part": [batch.column("part")[i].as_py()] * len(found), "rows": [batch.column("rows")[i].as_py()] * len(found),
                    "bits": np.arange(len(found), dtype=np.int32), "n": found[:, 0], "good": found[:, 1], "toxic": found[:, 2]})

    rows = posted.select("part", "rows", *lists, *marks).mapInArrow(
        sizes, "part string, rows long, bits int, n long, good long, toxic long")
    by_set = rows.groupBy("part", "bits").agg(*[F.sum(c).alias(c) for c in ("rows", "n", "good", "toxic")])
    # One entry for each set of filters.
    return by_set.groupBy("part").agg(F.max("rows").alias("total"), F.array_sort(F.collect_list(
        F.struct("bits", "n", "good", "toxic"))).alias("sizes"))


# ---- orders and steps -----------------------------------------------------------------------

def _gain(k: int) -> Column:
    """A filter's removed rows, summed over all orders: each set of others that may run before
    it does so in some number of orders."""
    n, terms = len(FILTERS), []
    for before in range(1 << n):
        if not before >> k & 1:
            size = before.bit_count()
            times = math.factorial(size) * math.factorial(n - size - 1)
            terms.append((F.get("sizes", F.lit(before | 1 << k))["n"] - F.get("sizes", F.lit(before))["n"]) * times)
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley`` for each part, order of the filters and step."""
    sizes = stored(union_sizes(postings(docs, labels, id_col, text_col, part_col)), "sizes")
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append((name, step, k, before, before | 1 << k))
            before |= 1 << k
    # Each part has one row for every order and step, 600 in all.
    rows = sizes.withColumn("gains", F.array(*[_gain(k) for k in range(len(FILTERS))])).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))))
    rows = rows.withColumns({c: F.get(F.lit([s[j] for s in steps]), F.col("i")) for j, c in enumerate(
        ("filter_order", "step", "k", "before", "after"))})
    at = lambda bits: F.get("sizes", bits)
    own, others = F.expr("shiftleft(1, k)"), F.expr(f"{_ALL} - shiftleft(1, k)")
    removed = at(F.col("after"))["n"] - at(F.col("before"))["n"]
    lost = lambda m: at(F.col("after"))[m] - at(F.col("before"))[m]
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - at(F.col("after"))["n"]).alias("kept"), removed.alias("removed"),
        (at(own)["n"] - removed).alias("redundant"), (at(F.lit(_ALL))["n"] - at(others)["n"]).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("gains", F.col("k")).alias("shapley"))
