"""Matching resumes against the model.

Scores are a sparse dot product.  ``score_pairs`` forms every (resume, document) pair that
shares a skill: one join and one sum, the shorter way while a model is small.
``best_pairs`` returns the same top lists from a small part of the pairs; ``match_batch`` uses it
for models that the plan estimates past ``PRUNE_BYTES``:

1. Each document's skills are ordered by weight, heaviest first, and every posting knows the
   norm of what follows it (``postings``: windows by document, whose partitioning the model
   has already).
2. A threshold per resume: its k-th best score among a fixed part of the documents whose
   heaviest skill it shares.  Any k documents give a lower bound on the k-th best of all, so a
   part is enough.
3. A document is looked at through the first of its skills, in its own order, that the resume
   has.  Whatever follows, its score is at most ``qw w + |other qw| |what follows|``
   (Cauchy-Schwarz), and also at most ``w`` times the sum of all qw.  Postings lie in cells of
   (w, norm of what follows), and a resume meets only the cells of its skills whose bound
   reaches its threshold: an equality join on (skill, cell).
4. Pairs that meet are scored in the row, from the document's whole vector, once each.  So
   nothing is summed across rows, and only the candidates of each task's top k are shuffled.

Resume entries up to ``BROADCAST_ENTRIES`` are read first and broadcast, and documents stay
where they are; beyond, they are checkpointed, narrow postings meet narrow cells in a shuffle,
and vectors are joined to the pairs that survive.  Top-k per resume is a ``row_number`` window filtered to ``<= k``, which
Spark plans as a partial ``WindowGroupLimit`` before the shuffle, so a resume with many
candidates sends at most k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SITE_PREFIX
from ..plans.sizing import cut_lineage, estimated_bytes
from ..sources.resumes import resume_requests
from .model import query_vectors
from .tagging import QUOTED_LITERALS, prepare_vocabulary, tag_skills

# Fixed values of the reference's matching and its result block.
SCRIPT_TERMS = ["java", "c++", "c#"]     # sample query of the model script
SCRIPT_TOP = 10
WEB_TOP = 25
LINKS_OPEN = '<div id="innerResult">'
LINK_FORMAT = '<div><a href="%s" target="_blank">%s</a></div>\n'
LINKS_CLOSE = "</div>"

SCORE_DIGITS = 6
TIE_DIGITS = 12
PRUNE_BYTES = 1 << 28        # of a model; below, the steps of pruning cost more than they save
SLACK = 1e-9                 # of a bound: ties at 12 places are never pruned
STEPS = 8                    # cells per unit of weight, and of the norm of what follows
SEED_PART = 8                # one document in so many gives the thresholds
BROADCAST_ENTRIES = 20_000   # (resume, skill) entries; each has at most (STEPS + 1)^2 cells


def score_pairs(query: DataFrame, model: DataFrame, qkey: str, dkey: str) -> DataFrame:
    """J5 + A10: ``(qkey, dkey, score)`` for every pair sharing a skill that weighs
    something on both sides (the others add 0)."""
    q = query.select(qkey, "skill", "qw").filter(F.col("qw") > 0)
    m = model.select(dkey, "skill", "weight").filter(F.col("weight") > 0)
    return (m.join(q, "skill").groupBy(qkey, dkey)
             .agg(F.sum(F.col("qw") * F.col("weight")).alias("score")))


def postings(model: DataFrame, dkey: str) -> DataFrame:
    """``(dkey, skill, w, i, tail, v)``: a document's skills of positive weight, heaviest
    first, with the norm of those after the i-th and the whole vector ``v(skills, weights)``."""
    m = model.select(dkey, "skill", F.col("weight").alias("w")).filter(F.col("w") > 0)
    own = Window.partitionBy(dkey).orderBy(F.desc("w"), "skill")
    rest = own.rowsBetween(1, Window.unboundedFollowing)
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return m.select(dkey, "skill", "w", F.row_number().over(own).alias("i"),
                    F.sqrt(F.coalesce(F.sum(F.col("w") * F.col("w")).over(rest), F.lit(0.0))).alias("tail"),
                    F.struct(F.collect_list("skill").over(whole).alias("skills"),
                             F.collect_list("w").over(whole).alias("weights")).alias("v"))


def _cell(w: Column, tail: Column) -> Column:
    level = lambda x: F.least(F.floor(x * STEPS), F.lit(STEPS)).cast("int")
    return level(w) * (STEPS + 1) + level(tail)


def _score(v: Column, q: Column) -> Column:
    """The dot product of a document's vector and a resume's entries, by the resume's order."""
    at = lambda x: F.get(v["weights"], (F.array_position(v["skills"], x["skill"]) - 1).cast("int"))
    return F.aggregate(q, F.lit(0.0), lambda acc, x: acc + x["qw"] * F.coalesce(at(x), F.lit(0.0)))


def _bound(w: Column, tail: Column) -> Column:
    """What a document can score at most whose first skill shared with the resume is this."""
    others = F.sqrt(F.greatest(F.col("norm2") - F.col("qw") * F.col("qw"), F.lit(0.0)))
    return F.least(F.col("qw") * w + others * tail, w * F.col("total"))


def _cells_reached() -> Column:
    """The cells whose upper corner reaches the threshold; the outermost cells are open."""
    top = lambda n: F.when(n == STEPS, F.lit(float("inf"))).otherwise((n + 1) / STEPS)
    reaches = lambda c: _bound(top(F.floor(c / (STEPS + 1))), top(c % (STEPS + 1))) >= F.col("least")
    every = F.sequence(F.lit(0), F.lit((STEPS + 1) ** 2 - 1))
    return F.when(F.col("least") <= 0, every).otherwise(F.filter(every, reaches))


def query_table(query: DataFrame, qkey: str) -> DataFrame:
    """``(qkey, q, norm2, total)``: one row per resume with its positive entries, by skill."""
    return query.groupBy(qkey).agg(
        F.array_sort(F.collect_list(F.struct("skill", "qw"))).alias("q"),
        F.sum(F.col("qw") * F.col("qw")).alias("norm2"), F.sum("qw").alias("total"))


def _kth_best(scores: DataFrame, qkey: str, k: int) -> DataFrame:
    """``(qkey, kth)`` for the queries that have k scores."""
    best = Window.partitionBy(qkey).orderBy(F.desc("score"))
    return (scores.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k)
                  .filter(F.col("_r") == k).select(qkey, F.col("score").alias("kth")))


def candidate_pairs(queries: DataFrame, posted: DataFrame, qkey: str, dkey: str, k: int, small: bool) -> DataFrame:
    """``(qkey, dkey, q, v)``, once for every pair that can be among the resume's best k.  The
    keys are not named like the columns made here (``best_pairs`` renames them)."""
    few = F.broadcast if small else (lambda df: df)
    entries = queries.select("*", F.inline("q"))
    part = F.pmod(F.xxhash64(F.col(dkey)), F.lit(SEED_PART)) == 0
    seeds = posted.filter((F.col("i") == 1) & part).select("skill", "v").join(
        few(entries.select(qkey, "skill", "q")), "skill").select(qkey, _score(F.col("v"), F.col("q")).alias("score"))
    least = F.coalesce(F.col("kth") - SLACK, F.lit(0.0))
    reach = entries.join(few(_kth_best(seeds, qkey, k)), qkey, "left").withColumn("least", least)
    cells = reach.select(qkey, "skill", "qw", "norm2", "total", "least", F.explode(_cells_reached()).alias("cell"))
    narrow = posted.select(dkey, "skill", "w", "i", "tail", *(["v"] if small else []),
                           _cell(F.col("w"), F.col("tail")).alias("cell"))
    met = narrow.join(few(cells), ["skill", "cell"]).filter(
        (F.col("least") <= 0) | (_bound(F.col("w"), F.col("tail")) >= F.col("least")))
    met = met.select(qkey, dkey, "i", *(["v"] if small else [])).join(few(queries.select(qkey, "q")), qkey)
    if not small:
        met = met.join(posted.filter(F.col("i") == 1).select(dkey, "v"), dkey)
    earlier = F.arrays_overlap(F.slice("v.skills", F.lit(1), F.col("i") - 1), F.col("q.skill"))
    return met.filter((F.col("i") == 1) | ~earlier).select(qkey, dkey, "q", "v")


def best_pairs(query: DataFrame, model: DataFrame, qkey: str, dkey: str, k: int) -> DataFrame:
    """J5 + A10 + W3: the rows of ``top_k(score_pairs(...), k)``, looking only at pairs that
    can be among them.  ``model`` has each (document, skill) once, and weights of any norm."""
    entries = query.select(F.col(qkey).alias("_q"), "skill", "qw").filter(F.col("qw") > 0)
    first = entries.limit(BROADCAST_ENTRIES + 1).collect()
    small = len(first) <= BROADCAST_ENTRIES
    entries = query.sparkSession.createDataFrame(first, entries.schema) if small else cut_lineage(entries)
    posted = postings(model.select(F.col(dkey).alias("_d"), "skill", "weight"), "_d")
    pairs = candidate_pairs(query_table(entries, "_q"), posted, "_q", "_d", k, small)
    # Pairs share a skill, so every score is positive.
    return _ranked(pairs.select(F.col("_q").alias(qkey), F.col("_d").alias(dkey),
                                _score(F.col("v"), F.col("q")).alias("score")), qkey, dkey, k)


def top_k(scores: DataFrame, qkey: str, dkey: str, k: int) -> DataFrame:
    """Best ``k`` documents per query; ties by document key.  Scores that are equal to
    12 places are ties: the last bits of a sum depend on the order of its terms.  Only
    matches (score > 0) are returned."""
    return _ranked(scores.filter(F.col("score") > 0), qkey, dkey, k)


def _ranked(scores: DataFrame, qkey: str, dkey: str, k: int) -> DataFrame:
    w = Window.partitionBy(qkey).orderBy(F.desc(F.round("score", TIE_DIGITS)), F.asc(dkey))
    return (scores.withColumn("rank", F.row_number().over(w))
             .filter(F.col("rank") <= k)
             .withColumn("rank", F.col("rank").cast("bigint")))


def match_batch(resumes: DataFrame, model: DataFrame, vocabulary,
                qkey: str = "resume_id", dkey: str = "doc_name", k: int = WEB_TOP,
                text_col: str = "text", literals=QUOTED_LITERALS,
                pad_docs: DataFrame | None = None, prune: bool | None = None) -> DataFrame:
    """Many resumes at once -> ``(qkey, dkey, score, rank)``, rank 1..k.  ``prune`` says
    whether pairs are pruned; by default the estimated size of the model decides.  The
    result is the same.

    ``pad_docs`` (all document keys, also those without skills) fills every list
    shorter than k with unmatched documents by name at score 0 (Q10); off by
    default, when only matches are returned."""
    r = resume_requests(resumes, qkey, text_col)
    q = query_vectors(tag_skills(r, qkey, prepare_vocabulary(vocabulary, literals), literals=literals), qkey)
    size = estimated_bytes(model)
    if prune if prune is not None else size is None or size > PRUNE_BYTES:
        out = best_pairs(q, model, qkey, dkey, k)
    else:
        out = top_k(score_pairs(q, model, qkey, dkey), qkey, dkey, k)
    if pad_docs is not None:
        out = pad_with_unmatched(out, r.select(qkey), pad_docs.select(dkey), qkey, dkey, k)
    return out


def term_query(spark: SparkSession, terms: list[str], qkey: str = "query_id") -> DataFrame:
    """A query vector from a list of terms (repeats count), L2-normalised."""
    rows = [(0, t) for t in terms]
    tf = (spark.createDataFrame(rows, f"{qkey} long, skill string")
               .groupBy(qkey, "skill").agg(F.count(F.lit(1)).alias("tf")))
    return query_vectors(tf, qkey)


def match_terms(spark: SparkSession, model: DataFrame, dkey: str,
                terms: list[str] = SCRIPT_TERMS, k: int = SCRIPT_TOP) -> DataFrame:
    """M5 + O2: score every document against a fixed term list; best ``k`` overall
    (``TakeOrderedAndProject``: each task keeps k, the driver merges k per task)."""
    q = term_query(spark, terms)
    scores = score_pairs(q, model, "query_id", dkey)
    return (scores.filter(F.col("score") > 0)
                  .select(dkey, F.round("score", SCORE_DIGITS).alias("score"))
                  .orderBy(F.desc("score"), F.asc(dkey)).limit(k))


def pad_with_unmatched(top: DataFrame, queries: DataFrame, docs: DataFrame,
                       qkey: str, dkey: str, k: int) -> DataFrame:
    """Q10 option: fill a top list shorter than ``k`` with unmatched documents by name
    at score 0, as the reference's full sort does.  A list holding n < k matches
    needs at most k candidates outside it, found among the 2k smallest names, so
    the candidate array is bounded by 2k whatever the corpus size."""
    cand = (docs.select(dkey).orderBy(dkey).limit(2 * k)
                .agg(F.array_sort(F.collect_list(dkey))).scalar())
    have = top.groupBy(qkey).agg(F.collect_list(dkey).alias("_have"))   # at most k per query
    short = (queries.select(qkey).distinct().join(have, qkey, "left")
                    .withColumn("_have", F.coalesce("_have", F.array().cast(f"array<{dict(docs.dtypes)[dkey]}>")))
                    .filter(F.size("_have") < k)
                    .withColumn("_cand", cand))
    fresh = F.filter(F.col("_cand"), lambda d: ~F.array_contains(F.col("_have"), d))
    fill = F.slice(fresh, 1, F.lit(k) - F.size("_have"))
    out = (short.select(qkey, F.size("_have").alias("_n"), F.posexplode(fill).alias("_p", dkey))
                .select(qkey, dkey, F.lit(0.0).alias("score"),
                        (F.col("_n") + F.col("_p") + 1).cast("bigint").alias("rank")))
    return top.unionByName(out.select(*top.columns))


def result_links(top: DataFrame, qkey: str, dkey: str, prefix: str = SITE_PREFIX,
                 url: str | None = None) -> DataFrame:
    """K6: one block of anchors per query, ordered by rank (at most k entries per group).
    ``url`` names the column that carries the document's address; without one the address
    is rebuilt from the document's name, which loses underscores."""
    rebuilt = F.concat(F.lit(prefix), F.replace(F.col(dkey).cast("string"), F.lit("_"), F.lit("/")))
    address = F.col(url) if url else rebuilt
    link = F.format_string(LINK_FORMAT, address, address)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("rank"), link.alias("link"))))
    body = F.array_join(F.transform(ordered, lambda x: x["link"]), "")
    return top.groupBy(qkey).agg(
        F.concat(F.lit(LINKS_OPEN), body, F.lit(LINKS_CLOSE)).alias("links"))
