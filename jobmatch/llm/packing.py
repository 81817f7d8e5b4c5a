"""Best-fit packing by swap-based local search.

Documents become token ids; only longer ones are cut, into full pieces and one rest.
Pieces are dealt at random to groups of a fixed size, and each group is packed by itself:
best fit, longest first, and then a local search.  It takes the emptiest of the underfull
bins and moves its pieces out: a piece to another bin, one piece for a shorter one of
another bin, or two pieces for one.  Each step raises the sum of the squared fills, so
the search ends by itself: when no step is left, or the group's bins are as few as
its tokens need.  Where best fit reaches that bound, as it does for pieces that are mostly
short, there is nothing to search; for lengths near a third and a half of the capacity the
search takes off most of what best fit uses too much (``search_report`` counts both).

Defined cases: a null text is empty (its document is the end id alone); documents that
are equal in id and text are packed one by one; null ids are carried; an empty table
gives no rows.  Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import by_bytes, encoder, releasing

CAPACITY = 2048
END_ID = 0
GROUP = 4096             # pieces of a group, on average


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of pieces) by best fit, longest piece first."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0                                   # bit f: some bin has f free
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = some >> n
        if fit:
            free = n + (fit & -fit).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        by_free[free - n].append(b)
        some |= 1 << (free - n)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int,
                 steps: Counter | None = None) -> list[list[int]]:
    """Fewer bins, if single steps that raise the sum of squared fills can empty some;
    ``steps`` counts them by kind."""
    steps = Counter() if steps is None else steps
    least = -(-int(lengths.sum()) // capacity)
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    where = np.zeros(len(lengths), np.int64)
    for k, b in enumerate(bins):
        where[b] = k
    filled = len(bins)
    while True:
        before = steps.total()
        for source in np.argsort(fill, kind="stable").tolist():
            if filled <= least:
                break
            if not 0 < fill[source] < capacity:
                continue
            # Pieces of the other underfull bins.
            items = np.flatnonzero((fill[where] < capacity) & (where != source))
            if _empty(source, bins, items, lengths, where, fill, capacity, steps):
                filled -= 1
        if filled <= least or steps.total() == before:
            break
    return [b for b in bins if b]


def _shift(bins, where, fill, lengths, out: list[int], back: list[int], source: int, target: int) -> None:
    for i in out:
        bins[source].remove(i)
        bins[target].append(i)
        where[i] = target
    for j in back:
        bins[target].remove(j)
        bins[source].append(j)
        where[j] = source
    d = int(lengths[out].sum() - (lengths[back].sum() if back else 0))
    fill[source] -= d
    fill[target] += d


def _empty(source, bins, items, lengths, where, fill, capacity, steps: Counter) -> bool:
    """Move, exchange one for one, exchange two for one, as long as a step raises the sum of
    squares; whether the source is empty then."""
    stuck = False
    while bins[source] and not stuck:
        stuck = True
        own = sorted(bins[source], key=lambda i: -lengths[i])
        for out in [[i] for i in own] + [[a, b] for x, a in enumerate(own) for b in own[x + 1:]]:
            n = int(lengths[out].sum())
            at = where[items]
            free = capacity - fill[at]
            if len(out) == 1:
                fits = np.where((free >= n) & (at != source), n, 0)      # a move
                d = n - lengths[items]
            else:
                fits = np.zeros(len(items), np.int64)
                d = n - lengths[items]
            swap = np.where((d > 0) & (d <= free) & (at != source), d, 0)
            gain = lambda x: np.where(x > 0, 2 * x * (fill[at] - fill[source] + x), 0)
            g_move, g_swap = gain(fits), gain(swap)
            best = int(np.argmax(np.maximum(g_move, g_swap))) if len(items) else -1
            if best < 0 or max(g_move[best], g_swap[best]) <= 0:
                continue
            back = [] if g_move[best] >= g_swap[best] else [int(items[best])]
            _shift(bins, where, fill, lengths, out, back, source, int(at[best]))
            steps[f"{len(out)} for {len(back)}"] += 1
            stuck = False
            break
    return not bins[source]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in batches:
            texts, cols = batch.column(1), ([], [], [], [], [])
            for a, b in by_bytes(pc.binary_length(texts.cast(pa.binary())).to_pylist()):
                for k, raw in enumerate(enc.ids(texts.slice(a, b - a).to_pylist()), a):
                    ids = np.append(np.frombuffer(raw, enc.dtype), END_ID).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start:start + capacity]
                        for c, v in zip(cols, (k, piece, start, len(part), zlib.crc32(part))):
                            c.append(v)
                pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(releasing(cut), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``, and for its group the bins of best fit and
    the steps of the search.  Groups are dealt by a hash of the row
    and a running number, so that no document, however often it is repeated, has one
    group for itself."""
    parts = stored(parts, "pieces")
    groups = max(1, -(-parts.count() // group))
    dealt = parts.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()),
                                           F.lit(groups)))

    def one_group(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.drop_columns("grp").sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = t["length"].to_numpy()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        first, steps = best_fit(lengths, capacity), Counter()
        filled = len(first)
        for k, b in enumerate(local_search(first, lengths, capacity, steps)):
            sequence[b] = (key[0].as_py() << 32) + k
            offset[b] = np.cumsum(lengths[b]) - lengths[b]
        same = lambda n: pa.array(np.full(len(lengths), n, np.int64))
        for name, values in (("sequence_id", pa.array(sequence)), ("offset", pa.array(offset)),
                             ("best_fit_bins", same(filled)), ("steps", same(steps.total()))):
            t = t.append_column(name, values)
        return t

    fields = ", ".join(f"{c} {t}" for c, t in parts.dtypes)
    return dealt.groupBy("grp").applyInArrow(one_group, f"{fields}, sequence_id long, offset long, best_fit_bins long, steps long")


def search_report(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row of what ``pack`` did: groups, bins of best fit, bins after the search, the fewest
    that the groups' tokens need, and the steps taken."""
    groups = rows.groupBy(F.shiftright("sequence_id", 32).alias("grp")).agg(
        F.first("best_fit_bins").alias("best_fit_bins"), F.countDistinct("sequence_id").alias("bins"),
        F.ceil(F.sum("length") / capacity).alias("least"), F.first("steps").alias("steps"))
    return groups.agg(F.count("*").alias("groups"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                                      for c in ("best_fit_bins", "bins", "least", "steps")])


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The place of every piece of every document."""
    return pack(pieces(docs, tokenizer_path, capacity, id_col, text_col), capacity).drop("best_fit_bins", "steps")
