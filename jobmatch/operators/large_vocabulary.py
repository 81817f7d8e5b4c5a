"""The tagger (T1, J3) for vocabularies that no task can hold whole.

The rules of a vocabulary are folded in order, but a text meets few of them: a rule does
nothing where its anchor (a literal that every match contains) does not occur.  So:

1. Rules are numbered in fold order and cut into parts of at most ``part_rows``.  Each part has
   one automaton of its anchors, and a pass over the texts with it names the rules that are
   due in each text.  A task holds one part at a time.
2. The due rules of all parts come together by document and are folded there, in order.
3. A removal joins what stood on its two sides, and only there a new anchor can appear.  The
   surroundings of all such places go through the parts again; a text for which they name a
   rule that was not due is folded once more with it, until no text gains a rule.  Rules whose
   effects can touch each other thus always meet in one fold, and all others stay apart.
4. Words left over are counted in their document and joined with the vocabulary.

The result is that of folding all rules in order.  Rules without an anchor are due in every
text.  Null texts have no tags; ``key`` is unique.  What every step makes is checkpointed, so
a lost executor costs one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_position
from ..plans.sizing import MAX_VOCABULARY_ROWS, batch_slices, cut_lineage
from ..sources.vocabulary import clean_vocabulary
from .tagging import _WORD_BYTES, QUOTED_LITERALS, _counter, _prefilter, anchor, rules_table

RULE = "struct<i:bigint,skill:string,pattern:string,kind:string,remove:boolean>"
DUE = f"array<{RULE}>"
RULE_FIELDS = ["i", "skill", "pattern", "kind", "remove"]
KEPT_COUNTERS = 50_000     # compiled patterns that a task keeps


def numbered_rules(vocabulary: DataFrame, literals=QUOTED_LITERALS) -> DataFrame:
    """``rules_table`` with ``i``, the place of a rule in the fold (checkpointed)."""
    return global_position(rules_table(vocabulary, literals), [F.col("skill"), F.col("j")], out="i")


def _due_in_part(texts: DataFrame, part: list[tuple]) -> DataFrame:
    """``(key, due)`` for every row of ``(key, parts array<string>)`` that has a rule of a part due."""
    fields = list(zip(*part))
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(fields, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()))], RULE_FIELDS)
        by_anchor: dict = {}
        for n, (_, _, pattern, how, _) in enumerate(part):
            by_anchor.setdefault(anchor(pattern, how), []).append(n)
        always, present = by_anchor.pop(None, []), _prefilter(by_anchor) or (lambda t: {a for a in by_anchor if a in t})
        for batch in batches:
            rows, numbers, ends = [], [], [0]
            # One text at a time as Python's.
            for i, pieces in enumerate(x.as_py() for x in batch.column(1)):
                met = set().union(*map(present, pieces)) if by_anchor else set()
                due = sorted({n for a in met for n in by_anchor[a]}.union(always if pieces else ()))
                if due:
                    rows.append(i)
                    numbers += due
                    ends.append(len(numbers))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rules.take(pa.array(numbers, pa.int64())))], ["key", "due"])

    return texts.select("key", "parts").mapInArrow(run, f"key {kind}, due {DUE}")


def due_rules(texts: DataFrame, rules: DataFrame, n_rules: int, part_rows: int) -> DataFrame:
    """``(key, due)``: the rules due in the ``parts`` of each row, from all parts of the rules.
    The driver reads one part of at most ``part_rows`` rules at a time."""
    found = None
    for start in range(0, n_rules, part_rows):
        part = [tuple(r) for r in rules.filter(F.col("i").between(start, start + part_rows - 1))
                                       .select(*RULE_FIELDS).orderBy("i").collect()]
        due = cut_lineage(_due_in_part(texts, part))
        found = due if found is None else found.unionByName(due)
    if found is None:
        return texts.select("key", F.array().cast(DUE).alias("due")).limit(0)
    return found.groupBy("key").agg(F.flatten(F.collect_list("due")).alias("due"))


def fold_due(t: str, due: list[dict], reach: int, counters: dict) -> tuple[str, dict[str, int], list[str]]:
    """The text left after the due rules in order, the hits per skill, and the surroundings of
    every place where a removal joined two sides."""
    hits: dict[str, int] = {}
    joins = []
    for r in sorted(due, key=lambda r: r["i"]):
        count = counters.get(r["i"])
        if count is None:
            if len(counters) >= KEPT_COUNTERS:
                counters.clear()
            count = counters[r["i"]] = _counter(r["pattern"], r["kind"])
        n, skill = count(t), r["skill"]
        if n:
            hits[skill] = hits.get(skill, 0) + n
            if r["remove"] and skill in t:
                sides, at = t.split(skill), 0
                t = "".join(sides)
                for side in sides[:-1]:
                    at += len(side)
                    joins.append(t[max(0, at - reach):at + reach])
    return t, hits, joins


def _folded(texts: DataFrame, reach: int) -> DataFrame:
    """``(key, tags, joins)`` of ``(key, text, due)`` rows: rule hits and words of the rest."""
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict = {}
        for batch in batch_slices(batches, 1):
            skills, counts, word, ends, joins = [], [], [], [0], []
            for t, due in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rest, hits, sides = fold_due(t, due or [], reach, counters)
                words: dict[bytes, int] = {}
                for w in rest.encode("utf-8", "replace").translate(_WORD_BYTES).split():
                    words[w] = words.get(w, 0) + 1
                skills += hits
                skills += (w.decode() for w in words)
                counts += hits.values()
                counts += words.values()
                word += [False] * len(hits) + [True] * len(words)
                ends.append(len(skills))
                joins.append(sides)
            pairs = pa.StructArray.from_arrays([pa.array(skills, pa.string()), pa.array(counts, pa.int64()),
                                                pa.array(word, pa.bool_())], ["skill", "n", "word"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                                              pa.array(joins, pa.list_(pa.string()))], ["key", "tags", "joins"])

    return texts.select("key", "text", "due").mapInArrow(
        run, f"key {kind}, tags array<struct<skill:string,n:bigint,word:boolean>>, joins array<string>")


def tag_skills_in_parts(df: DataFrame, key: str, vocabulary: DataFrame, text_col: str = "text",
                        literals=QUOTED_LITERALS, part_rows: int = MAX_VOCABULARY_ROWS) -> DataFrame:
    """``(key, skill, tf)`` as ``tag_skills`` returns it, for a vocabulary of any size."""
    vocab = clean_vocabulary(vocabulary)
    rules = numbered_rules(vocab, literals)
    n_rules, reach = rules.agg(F.count("*"), F.coalesce(F.max(F.length("pattern")), F.lit(0))).first()
    texts = df.select(F.col(key).alias("key"), F.lower(F.col(text_col)).alias("text")).filter(F.col("text").isNotNull())
    due = cut_lineage(due_rules(texts.select("key", F.array("text").alias("parts")), rules, n_rules, part_rows))
    folded = cut_lineage(_folded(texts.join(due, "key", "left"), reach))
    again = folded
    while True:
        joined = again.filter(F.size("joins") > 0).select("key", F.col("joins").alias("parts"))
        more = due_rules(joined, rules, n_rules, part_rows)
        known = F.transform("due", lambda r: r["i"])
        news = cut_lineage(more.join(due.select("key", known.alias("known")), "key").select(
            "key", F.filter("due", lambda r: ~F.array_contains("known", r["i"])).alias("news")).filter(F.size("news") > 0))
        if not news.take(1):
            break
        # Only texts that gained a rule are folded again.
        due = cut_lineage(due.join(news, "key", "left").select(
            "key", F.concat("due", F.coalesce("news", F.array().cast(DUE))).alias("due")))
        changed = news.select("key")
        again = cut_lineage(_folded(texts.join(due.join(changed, "key", "left_semi"), "key"), reach))
        folded = folded.join(changed, "key", "left_anti").unionByName(again)
    tags = folded.select("key", F.inline("tags"))
    words = tags.filter("word").join(vocab, "skill")           # hot words are split by AQE
    return (tags.filter("not word").select("key", "skill", "n").unionByName(words.select("key", "skill", "n"))
                .groupBy("key", "skill").agg(F.sum("n").alias("tf")).withColumnRenamed("key", key))
