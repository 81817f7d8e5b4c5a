"""Near-duplicates by MinHash bands whose candidates are checked by odd sketches.

1. Each text becomes a set of word shingles, MinHash samples of the set, the hashes of
   the samples in bands, and an odd sketch: a bitmap in which each sample flips one bit.
   Texts with equal sets are one class from here on.
2. Classes that share a band are candidates.  The XOR of two odd sketches has one bit for
   each sample on which the sets differ, up to chance, so its population count estimates
   a high similarity well.  A pair is passed on unless the estimate is six standard
   deviations below the threshold; then the full sets are compared.
3. No bucket is compared pair by pair.  All its members are first compared with one
   central member, and components are formed.  Then only members outside the bucket's
   largest component are compared with members of other components.  Two documents that
   are linked are thus in one component after that, whatever the size of the bucket.
   A document's shingles that no other document of a crowded bucket has bound its
   similarity to any of those, and only to those: members which that bound rules out are
   not compared in crowded buckets, but in the others they are.

Defined cases: null and empty texts have no shingles and are linked with nothing; a text
with fewer words than a shingle is one shingle; equal texts, and rows that are repeated
as they are, are linked; a row without an id takes the component of what it is linked
with, and null if nothing there has an id; an empty table gives no rows.  Only the id
and the text are read, so other columns cannot clash.

With 32 bands of four samples a pair at the threshold shares no band with probability
5e-8.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, small_side, stored, with_few
from .components import components
from .tokens import by_bytes, releasing

THRESHOLD = 80           # per cent
BANDS, ROWS = 32, 4
BITS = 512               # of a sketch
SIGMAS = 6
CROWD = 16               # members of a crowded bucket
CHUNK = 1 << 15          # shingles hashed at a time
SLICE = 1 << 20          # bytes of text worked through at a time

_rng = np.random.default_rng(20_140_407)
_SAMPLES = BANDS * ROWS
_XOR, _MUL = (_rng.integers(0, 1 << 63, _SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_PLACE = _rng.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def max_differing_bits(threshold: int = THRESHOLD) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most, but for a
    chance of ``SIGMAS`` standard deviations of the samples."""
    j = threshold / 100
    low = j - SIGMAS * math.sqrt(j * (1 - j) / _SAMPLES)
    return math.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * _SAMPLES * (1 - low))))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of ``n`` words."""
    words = (text or "").encode().lower().split()      # ASCII letters and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    total = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        total += w[i:len(w) - k + 1 + i] * _PLACE[i]
    return np.unique(_mix(total + _U(k)))


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and odd sketches of non-empty sets."""
    samples = np.empty((len(sets), _SAMPLES), np.uint64)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= CHUNK):
            size += len(sets[j])
            j += 1
        all_, start = np.concatenate(sets[i:j]), np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        for k in range(_SAMPLES):
            samples[i:j, k] = np.minimum.reduceat((all_ ^ _XOR[k]) * _MUL[k], start)
        i = j
    place = _mix(samples + np.arange(_SAMPLES, dtype=np.uint64) * _XOR[0])
    grouped = place.reshape(len(sets), BANDS, ROWS)
    bands = np.zeros((len(sets), BANDS), np.uint64)
    for r in range(ROWS):
        bands += grouped[:, :, r] * _PLACE[r]
    bits, rows = np.zeros((len(sets), BITS), np.uint8), np.arange(len(sets))
    for k in range(_SAMPLES):
        bits[rows, (place[:, k] % _U(BITS)).astype(np.int64)] ^= 1
    return _mix(bands).view(np.int64), np.packbits(bits, axis=1).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), values.ravel())


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE`` bytes of text: Python holds the sets of one at a time."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text).cast(pa.binary())).fill_null(0)
        for a, b in by_bytes(sizes.to_pylist(), SLICE):
            yield batch.slice(a, b - a)


def signatures(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, v, n_shingles, node, bands, sketch``; ``v`` is a hash of the text, ``node`` a
    128-bit digest of the set, null for an empty one."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            sets = [shingle_set(t, n) for t in batch.column(1).to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            bands, sketch = np.zeros((len(sets), BANDS), np.int64), np.zeros((len(sets), BITS // 64), np.int64)
            if size.any():
                bands[size > 0], sketch[size > 0] = _signatures([s for s in sets if len(s)])
            node = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size), pa.array(node, pa.binary()), _lists(bands),
                 _lists(sketch)], ["doc_id", "v", "n_shingles", "node", "bands", "sketch"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("v"))
    kind = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(
        releasing(sign), f"doc_id {kind}, v long, n_shingles long, node binary, bands array<long>, sketch array<long>")


def _sets(docs: DataFrame, members: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` of the members, whose texts are read again by the id of one
    document of each."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0):
            sets = [shingle_set(t, n) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "shingles"])

    wanted = small_side(members.select(F.col("rep").alias("_rep")).distinct())
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        wanted, F.col("_id").eqNullSafe(F.col("_rep")), "left_semi").select("_text")
    found = texts.mapInArrow(releasing(shingle), "node binary, shingles array<long>")
    # A row that is repeated as it is gives its set more than once.
    return (found.join(members.select("node"), "node", "left_semi")
            .groupBy("node").agg(F.first("shingles").alias("shingles")))


def _differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _may_link(x: str, y: str, threshold: int) -> Column:
    """What two sets can share at most suffices, and so does what their sketches say.
    ``shared`` says something of pairs only that are both members of crowded buckets."""
    need = (F.col(f"{x}.n") + F.col(f"{y}.n")) * threshold
    shared = F.when(F.col(f"{x}.crowd") & F.col(f"{y}.crowd"), F.least(F.col(f"{x}.shared"), F.col(f"{y}.shared"))
                    ).otherwise(F.least(F.col(f"{x}.n"), F.col(f"{y}.n")))
    return (shared * (100 + threshold) >= need) & (
        _differing(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) <= max_differing_bits(threshold))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links by their full sets."""
    of = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(of("b"), "b").join(of("a"), "a")
            .where(both * (100 + threshold) >= (F.size("sa") + F.size("sb")) * threshold).select("a", "b"))


def _unshared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, own`` for every member of a crowded bucket: how many of its shingles no other
    such member has."""
    crowd = members.where(F.col("bucket") > CROWD).select("node").distinct()
    each = sets.join(crowd, "node").select(F.xxhash64("node").alias("h"), F.explode("shingles").alias("s"))
    own = each.groupBy("s").agg(F.count("*").alias("k"), F.min("h").alias("h")).where("k = 1").groupBy("h").count()
    return crowd.withColumn("h", F.xxhash64("node")).join(own, "h", "left").select(
        "node", F.coalesce("count", F.lit(0)).alias("own"))


def _across(open_: DataFrame, condition: Column) -> DataFrame:
    """Pairs of a member outside its bucket's largest component and a member of another
    component that meet ``condition``; two members outside are paired once."""
    outer = open_.where("label <> largest").select("key", F.col("node").alias("a"), F.col("label").alias("la"),
                                                   F.col("info").alias("x"))
    inner = open_.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("info").alias("y"),
                         (F.col("label") != F.col("largest")).alias("out"))
    return outer.join(inner, "key").where(
        (F.col("la") != F.col("lb")) & (~F.col("out") | (F.col("a") < F.col("b"))) & condition)


def links(docs: DataFrame, classes: DataFrame, n: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """Verified links ``(a, b)`` between classes: as many as are needed to join every two
    classes that are linked."""
    placed = classes.select("node", F.explode("bands").alias("key"))
    shared = placed.groupBy("key").agg(F.count("*").alias("bucket")).where("bucket > 1")
    members = stored(placed.join(shared, "key"), "members")
    info = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "rep", "n", "sketch")
    info = stored(info, "info")
    sets = stored(_sets(docs, info, n, id_col, text_col), "sets")
    own = _unshared(members, sets)
    bound = stored(info.join(own, "node", "left").select(
        "node", "n", "sketch", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"),
        F.col("own").isNotNull().alias("crowd")), "bound")
    able = F.col("shared") * 100 >= F.col("n") * threshold
    members = members.join(bound.select("node", "shared", "n"), "node").where(
        (F.col("bucket") <= CROWD) | able).select("key", "node", (F.col("shared") / F.col("n")).alias("central"))
    members = stored(members, "able")

    # All members against the most central one.
    lead = members.groupBy("key").agg(F.max(F.struct("central", "node"))["node"].alias("b"))
    pairs = members.join(lead, "key").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    x = bound.select(F.col("node").alias("a"), F.struct("n", "shared", "crowd", "sketch").alias("x"))
    y = bound.select(F.col("node").alias("b"), F.struct("n", "shared", "crowd", "sketch").alias("y"))
    first = pairs.join(x, "a").join(y, "b").where(_may_link("x", "y", threshold)).select("a", "b")
    first = stored(_verified(first, sets, threshold), "links")

    # What lies outside the largest component of a bucket against the other components.
    found = components(first)
    labelled = members.join(found, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    largest = labelled.groupBy("key", "label").count().groupBy("key").agg(
        F.max(F.struct("count", "label"))["label"].alias("largest"), F.count("*").alias("labels"),
        F.sum("count").alias("members"))
    open_ = stored(labelled.join(largest.where("labels > 1").drop("labels"), "key"), "open")
    sketched = bound.select("node", F.struct("n", "shared", "crowd", "sketch").alias("info"))
    pairs = _across(open_.where(F.col("members") <= CROWD).join(sketched, "node"), _may_link("x", "y", threshold))
    second = stored(_verified(pairs.select("a", "b").distinct(), sets, threshold), "links")
    # In crowded buckets the sets themselves are in the join's condition, so that only links
    # come out of it, and a pair is looked at in the first bucket that it shares.
    whole = bound.where(F.col("crowd") & able).join(sets, "node").join(classes.select("node", "bands"), "node").select(
        "node", F.struct("n", "shared", "crowd", "sketch", "bands", "shingles").alias("info"))
    first_shared = F.get(F.array_compact(F.zip_with("x.bands", "y.bands", lambda i, j: F.when(i == j, i))), 0)
    both = F.size(F.array_intersect("x.shingles", "y.shingles"))
    linked = both * (100 + threshold) >= (F.col("x.n") + F.col("y.n")) * threshold
    crowded = _across(open_.where(F.col("members") > CROWD).join(whole, "node"),
                      _may_link("x", "y", threshold) & (first_shared == F.col("key")) & linked)
    third = stored(crowded.select("a", "b"), "links")
    for done in (members, info, sets, bound, open_):
        forget(done)
    return first.unionByName(second).unionByName(third)


def _components(docs: DataFrame, shingle: int, threshold: int, id_col: str,
                text_col: str) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and ``node, rep, label`` of all classes, ``label`` null for
    those without links."""
    signed = stored(signatures(docs, shingle, id_col, text_col), "signed")
    classes = stored(signed.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "classes")
    found = components(links(docs, classes, shingle, threshold, id_col, text_col))
    named = stored(classes.select("node", "rep").join(found, "node", "left"), "labels")
    forget(classes)
    return signed, named


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    signed, named = _components(docs, shingle, threshold, id_col, text_col)
    smallest = named.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("rep").alias("smallest"))
    # Classes without links are their own components; a label may hold very many of the others.
    linked = with_few(named.where(F.col("label").isNotNull()), stored(smallest, "smallest"), "label")
    named = stored(linked.select("node", F.col("smallest").alias("component")).unionByName(
        named.where(F.col("label").isNull()).select("node", F.col("rep").alias("component"))), "named")
    out = signed.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, shingle: int = 5, threshold: int = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; same columns.  It is the one with the smallest
    id, rows without an id last, then with the smallest hash of its text; of rows equal in
    both any one.  Rows without shingles all stay."""
    signed, named = _components(docs, shingle, threshold, id_col, text_col)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "v")
    best = signed.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(rank).alias("best"))
    best = stored(best.join(named, "node").select("node", "label", "best"), "best")
    linked = best.where(F.col("label").isNotNull())
    first = stored(linked.groupBy("label").agg(F.min("best").alias("first")), "first-of-label")
    first = stored(with_few(linked.select("node", "label"), first, "label").select("node", "first").unionByName(
        best.where(F.col("label").isNull()).select("node", F.col("best").alias("first"))), "first")
    forget(best)
    rows = signed.select("doc_id", "v", "node").join(first, "node")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("v") == F.col("first.v"))
    rows = rows.groupBy("doc_id", "v").agg(F.first(stays).alias("stays"), F.count("*").alias("rows"))
    gone = stored(rows.where("not stays or rows > 1").select(
        F.col("doc_id").alias("gone_id"), F.col("v").alias("gone_v"), "stays"), "gone")
    forget(first)
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row")[id_col].eqNullSafe(F.col("gone_id")) & (F.xxhash64(F.col("row")[text_col]) == F.col("gone_v"))
    once = rows.join(small_side(gone.where("stays")), same).groupBy("gone_id", "gone_v").agg(F.first("row").alias("row"))
    left = rows.join(small_side(gone), same, "left_anti")
    return left.unionByName(once.select("row")).select("row.*")
