"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item leaks into a document if the document has at least 80 per cent of the
item's distinct five-word shingles.  One random order of all shingles (by hash) serves
as MinHash: the sketch of an item is its k smallest hashes, k = n - ceil(0.8 n) + 1.  A
document that has 80 per cent of the item's n shingles must have one of these, however
long it is, so the search misses nothing.  Items are partitioned by size; each partition
has the smallest document that can hold an item of it and the largest hash of its
sketches, so a document looks up only its smallest hashes, down to the partitions it is
large enough for.  Candidates are verified by exact containment of the shingles' words.

Only DataFrame functions are used.  Items are the smaller table: their sketches are
broadcast if they are counted to be few, and shuffled if not.

Defined cases: null and empty texts have no shingles, so such items are never found and
such documents hold nothing; a text of fewer than five words is one shingle, the whole
of it; documents or items that are repeated count once, and a pair of ids that occurs
with several texts is returned with its largest containment; null ids are carried; an
empty table gives no rows.  Only ids and texts are read (``decontaminate`` carries the rest in
a struct), so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, shingles_of, small_side, stored, where_computed, with_shingle_hashes, words_of

SHINGLE = 5
THRESHOLD = 80           # per cent


def _least(n, threshold: int):
    """The fewest shingles of an item of ``n`` that make a leak."""
    return F.ceil(n * threshold / 100).cast("int")


def _strings(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text`` and with ``s``, one row for each distinct shingle."""
    kept = [c for c in df.columns if c != text]
    df = df.withColumn("w", words_of(lower_ascii(F.col(text)))).select(*kept, "w")
    return df.select(*kept, F.explode(F.array_distinct(shingles_of(F.col("w"), SHINGLE))).alias("s"))


def _item_sketches(items: DataFrame, threshold: int) -> DataFrame:
    """``item_id, t, n, size_class, sketch`` of every distinct item with a shingle."""
    hashed = with_shingle_hashes(items, "t", "h").withColumn("h", F.sort_array(F.array_distinct("h")))
    n = F.size("h")
    return where_computed(hashed, n > 0).select(
        "item_id", "t", n.alias("n"), F.floor(F.log2(n)).cast("int").alias("size_class"),
        F.slice("h", 1, n - _least(n, threshold) + 1).alias("sketch"))


def _found(docs: DataFrame, items: DataFrame, threshold: int, id_col: str, text_col: str, item_id_col: str,
           item_text_col: str) -> DataFrame:
    """``doc_id, v, item_id, n, k`` for every item that leaks into a document; ``v`` is a
    hash of the document's text."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("v"))
    items = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("t")).distinct()
    sketches = stored(_item_sketches(items, threshold).withColumn("item", F.xxhash64("item_id", "t")), "items")

    # One row for each power of two that is some item's size.
    parts = sketches.groupBy("size_class").agg(
        F.min(_least(F.col("n"), threshold)).alias("least"), F.max(F.element_at("sketch", -1)).alias("top")).collect()
    bounds = [F.when(F.size("h") >= p["least"], F.lit(p["top"])) for p in parts]
    none = F.lit(None).cast("long")
    bound = F.greatest(none, none, *bounds)

    index = small_side(stored(sketches.select(F.explode("sketch").alias("m"), "item", "n"), "sketches"))
    mins = with_shingle_hashes(docs.select("doc_id", "v", "t"), "t", "h").select(
        "doc_id", "v", F.size("h").alias("size"), "h", bound.alias("bound"))
    mins = where_computed(mins, F.col("bound").isNotNull()).select(
        "doc_id", "v", "size", F.explode(F.filter("h", lambda x: x <= F.col("bound"))).alias("m"))
    found = mins.join(index, "m").where(F.col("size") >= _least(F.col("n"), threshold))
    candidates = stored(found.select("doc_id", "v", "item").distinct(), "candidates")

    # The texts of candidates only are compared word by word.
    wanted = small_side(candidates.select(F.col("doc_id").alias("cd"), F.col("v").alias("cv")).distinct())
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("v") == F.col("cv")), "left_semi")
    of_items = small_side(stored(_strings(sketches.select("item", "item_id", "n", "t"), "t"), "shingles"))
    shared = _strings(texts, "t").join(of_items, "s")
    pairs = candidates.select(F.col("doc_id").alias("cd"), F.col("v").alias("cv"), F.col("item").alias("ci"))
    shared = shared.join(pairs, F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("v") == F.col("cv"))
                         & (F.col("item") == F.col("ci")), "left_semi")
    counted = shared.groupBy("doc_id", "v", "item", "item_id", "n").agg(F.countDistinct("s").alias("k"))
    return counted.where(F.col("k") >= _least(F.col("n"), threshold))


def leaks(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` for every item that leaks into a
    document."""
    found = _found(docs, items, threshold, id_col, text_col, item_id_col, item_text_col)
    best = found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("k") / F.col("n")).alias("share"), "k", "n")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.k").cast("long").alias("n_shared"),
                       F.col("b.n").cast("long").alias("n_item"), F.col("b.share").alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text an item leaks into; same columns.  Rows with the
    same id, or none, and other texts stay, those without a text too."""
    found = _found(docs, items, threshold, id_col, text_col, item_id_col, item_text_col)
    hit = stored(found.select(F.col("doc_id").alias("hit_id"), F.col("v").alias("hit_v")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row")[id_col].eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.col("row")[text_col]) == F.col("hit_v"))
    return rows.join(small_side(hit), same, "left_anti").select("row.*")
