"""TF-IDF model as a long table.

The model is sparse and relational: ``(doc, skill, tf, idf, weight)`` with the
document key in the row, exact skill terms instead of hashed indices.

Plan shape: term frequencies come from the tagger's ``groupBy(doc, skill)``
exchange; document frequency is a partial+final count by skill (one small
shuffle of at most vocabulary-many rows per task); idf is joined back by
broadcast (its size is bounded by the size-checked vocabulary); the L2 norm is a
window by document (one shuffle by doc).  The number of documents ``m`` is a
scalar subquery, not a cross join and not a driver action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import shuffle_partitions
from .tagging import QUOTED_LITERALS, tag_skills


def document_count(docs: DataFrame) -> Column:
    """``m``: all documents, also those without any skill (scalar subquery)."""
    return docs.select(F.count(F.lit(1))).scalar()


def idf_table(tf: DataFrame, n_docs: Column, min_doc_freq: int = 1) -> DataFrame:
    """``(skill, df, idf)`` with ``idf = ln((m + 1) / (df + 1))``, 0 below ``min_doc_freq``."""
    # count rows with tf > 0 (all of them) rather than count(*): reading tf keeps the
    # tagger's aggregate identical in both branches of the model, so the plan reuses
    # its exchange instead of running the Python fold a second time
    dfreq = tf.groupBy("skill").agg(F.count(F.when(F.col("tf") > 0, F.lit(1))).alias("df"))
    idf = F.when(F.col("df") >= min_doc_freq,
                 F.log((n_docs.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0))
                 ).otherwise(F.lit(0.0))
    return dfreq.select("skill", "df", idf.alias("idf"))


def l2_normalise(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``value / ||values of key||_2``; a zero vector stays zero."""
    norm = F.sqrt(F.sum(F.col(value) * F.col(value)).over(Window.partitionBy(key)))
    return df.withColumn(out, F.when(norm > 0, F.col(value) / norm).otherwise(F.lit(0.0)))


def weights(tf: DataFrame, key: str, n_docs: Column, min_doc_freq: int = 1) -> DataFrame:
    """J7 + A9: ``(key, skill, tf, idf, weight)``.

    The term rows are partitioned by document once, with the configured width, and
    everything reads that one exchange: the document-frequency count (partial sums
    per task), the norm window and, in matching, the per-(query, document) score
    sum.  So the tagger above runs once, and an explicit width keeps AQE from
    folding a small model into one task when scoring fans it out."""
    tf = tf.repartition(shuffle_partitions(tf.sparkSession), key)
    idf = idf_table(tf, n_docs, min_doc_freq).select("skill", "idf")
    # idf has one row per tagged skill, at most the size-checked vocabulary
    scaled = tf.join(F.broadcast(idf), "skill").withColumn("_w", F.col("tf") * F.col("idf"))
    out = l2_normalise(scaled, key, "_w", "weight")
    return out.select(key, "skill", "tf", "idf", "weight")


def weights_with(tf: DataFrame, key: str, idf: DataFrame) -> DataFrame:
    """``(key, skill, tf, idf, weight)`` with a given ``(skill, idf)`` table, which has one row per
    skill that was ever tagged and is bounded by the vocabulary."""
    tf = tf.repartition(shuffle_partitions(tf.sparkSession), key)
    scaled = tf.join(F.broadcast(idf.select("skill", "idf")), "skill").withColumn("_w", F.col("tf") * F.col("idf"))
    return l2_normalise(scaled, key, "_w", "weight").select(key, "skill", "tf", "idf", "weight")


def build_model(jobs: DataFrame, key: str, vocabulary, text_col: str = "text",
                literals=QUOTED_LITERALS, min_doc_freq: int = 1) -> DataFrame:
    """Tag every job, fit IDF over all jobs, weight and normalise."""
    tf = tag_skills(jobs, key, vocabulary, text_col=text_col, literals=literals)
    return weights(tf, key, document_count(jobs), min_doc_freq)


def query_vectors(tf: DataFrame, key: str) -> DataFrame:
    """M5: query side is TF only, L2-normalised: ``(key, skill, qw)``."""
    q = tf.withColumn("_tf", F.col("tf").cast("double"))
    return l2_normalise(q, key, "_tf", "qw").select(key, "skill", "qw")


# ---- optional MLlib variant (M1-M4) ----------------------------------------------

def ml_tfidf(tf: DataFrame, key: str, num_features: int = 1 << 20) -> DataFrame:
    """HashingTF -> IDF(minDocFreq=1) -> Normalizer(p=2) with ``pyspark.ml``; terms are
    repeated ``tf`` times to feed HashingTF.  Hash collisions add up, as in MLlib."""
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    bags = (tf.groupBy(key)
              .agg(F.flatten(F.collect_list(F.array_repeat("skill", F.col("tf").cast("int")))).alias("terms")))
    hashed = HashingTF(inputCol="terms", outputCol="raw", numFeatures=num_features).transform(bags)
    fitted = IDF(inputCol="raw", outputCol="tfidf", minDocFreq=1).fit(hashed).transform(hashed)
    return Normalizer(inputCol="tfidf", outputCol="features", p=2.0).transform(fitted)
