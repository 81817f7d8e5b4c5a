"""Skill tagger (T1): ordered text rules, then a word pass against the vocabulary.

Per document, on the lower-cased text ``t``:

1. fold over the rules in ascending skill order; each rule counts its pattern
   in ``t`` (non-overlapping matches) and, when it removes and found anything,
   deletes every literal occurrence of the (dashed) skill from ``t``;
2. split what is left on ASCII non-word runs; each token equal to a skill
   counts once for it.

Rules come from the vocabulary (see ``rules_table``).  The fold is sequential per
document, so it runs as one Arrow function over the text column, which also counts the
words that are skills: a document's tags are an array in its own row, and no shuffle is
needed to sum them.

``method="native"`` is the slow twin made of Spark higher-order functions only
(``aggregate`` over a literal rules array); tests check that both agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NON_WORD, lit_regex
from ..plans.sizing import MAX_VOCABULARY_ROWS, TooLargeToBroadcast, batch_slices
from ..sources.vocabulary import VOCAB_SCHEMA, clean_vocabulary

# Fixed values of the rule derivation.
APACHE_SHORT = ("apache-spark", "apache-kafka", "apache-storm")  # matched without "apache-"
QUOTED_LITERALS = ("c++", "c#", "f#")                            # matched as quoted literals

HIT_TYPE = "array<struct<skill:string,n:bigint>>"
FOLD_TYPE = f"struct<rest:string,hits:{HIT_TYPE}>"
RULE_COLUMNS = ["skill", "j", "pattern", "kind", "remove"]

_REGEX_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


# ---- rules (P24) ------------------------------------------------------------

def rules_table(vocabulary: DataFrame, literals=QUOTED_LITERALS) -> DataFrame:
    """``(skill, j, pattern, kind, remove)``: zero, one or two rules per skill; the
    fold order is ``(skill, j)`` with skills in ascending byte order."""
    v = vocabulary.select("skill")
    skill = F.col("skill")
    is_apache = skill.isin(*APACHE_SHORT)
    dashed = ~is_apache & skill.contains("-")
    apache = v.filter(is_apache).select(
        skill, F.lit(0).alias("j"), F.replace(skill, F.lit("apache-"), F.lit("")).alias("pattern"),
        F.lit("regex").alias("kind"), F.lit(False).alias("remove"))
    dash = v.filter(dashed).select(
        skill, F.lit(1).alias("j"), skill.alias("pattern"),
        F.lit("regex").alias("kind"), F.lit(True).alias("remove"))
    spaced = v.filter(dashed).select(
        skill, F.lit(2).alias("j"), F.replace(skill, F.lit("-"), F.lit(" ")).alias("pattern"),
        F.lit("regex").alias("kind"), F.lit(True).alias("remove"))
    quoted = v.filter(~is_apache & ~skill.contains("-") & skill.isin(*literals)).select(
        skill, F.lit(3).alias("j"), skill.alias("pattern"),
        F.lit("literal").alias("kind"), F.lit(False).alias("remove"))
    return apache.unionByName(dash).unionByName(spaced).unionByName(quoted)


def derive_rules(skills, literals=QUOTED_LITERALS) -> tuple:
    """The rules of ``rules_table`` for an already collected vocabulary, in fold order."""
    out = []
    for skill in sorted(skills, key=lambda x: x.encode("utf-8")):
        if skill in APACHE_SHORT:
            out.append((skill, 0, skill.replace("apache-", ""), "regex", False))
        elif "-" in skill:
            out.append((skill, 1, skill, "regex", True))
            out.append((skill, 2, skill.replace("-", " "), "regex", True))
        elif skill in literals:
            out.append((skill, 3, skill, "literal", False))
    return tuple(out)


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary proven small enough to reach every task whole: the skills in fold
    order and their rules.  Built once per job by ``prepare_vocabulary``."""
    skills: tuple
    rules: tuple

    @classmethod
    def from_list(cls, skills, literals=QUOTED_LITERALS) -> "Vocabulary":
        clean = sorted({s for s in skills if s}, key=lambda x: x.encode("utf-8"))
        if len(clean) > MAX_VOCABULARY_ROWS:
            raise TooLargeToBroadcast(f"vocabulary has more than {MAX_VOCABULARY_ROWS} skills")
        return cls(tuple(clean), derive_rules(clean, literals))

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(s,) for s in self.skills], VOCAB_SCHEMA)

    def __len__(self) -> int:
        return len(self.skills)


def prepare_vocabulary(vocabulary, literals=QUOTED_LITERALS) -> Vocabulary:
    """One bounded collect of a vocabulary frame (at most ``MAX_VOCABULARY_ROWS + 1``
    rows are read); a ``Vocabulary`` passes through."""
    if isinstance(vocabulary, Vocabulary):
        return vocabulary
    rows = clean_vocabulary(vocabulary).limit(MAX_VOCABULARY_ROWS + 1).collect()
    return Vocabulary.from_list([r.skill for r in rows], literals)


def collect_rules(vocabulary, literals=QUOTED_LITERALS) -> list[tuple]:
    """The rules in fold order (size-checked vocabulary)."""
    return list(prepare_vocabulary(vocabulary, literals).rules)


# Java's "." excludes every line terminator, Python's only "\n".
_JAVA_DOT = "[^\n\r\u0085\u2028\u2029]"


def java_dots(pattern: str) -> str:
    """Rewrite unescaped ``.`` outside character classes to Java's meaning."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if c == "[":
            in_class = True
        elif c == "]":
            in_class = False
        out.append(_JAVA_DOT if c == "." and not in_class else c)
        i += 1
    return "".join(out)


def _counter(pattern: str, kind: str):
    """Count of non-overlapping matches of a rule pattern."""
    if kind == "literal" or not _REGEX_META.search(pattern):
        return lambda t, p=pattern: t.count(p)
    try:
        rx = re.compile(java_dots(pattern))
    except re.error:   # an invalid pattern is matched as a literal
        return lambda t, p=pattern: t.count(p)
    return lambda t, rx=rx: sum(1 for _ in rx.finditer(t))


def anchor(pattern: str, kind: str) -> str | None:
    """A literal every match of the pattern contains (the longest required run), or
    ``None`` when the pattern is too free-form to name one."""
    if kind == "literal" or not _REGEX_META.search(pattern):
        return pattern or None
    if re.search(r"[\\^$|()\[\]{}]", pattern):
        return None
    runs, cur = [], ""
    for c in pattern:
        if c in ".+":
            runs.append(cur)
            cur = ""
        elif c in "*?":
            runs.append(cur[:-1])      # the char before is optional
            cur = ""
        else:
            cur += c
    runs.append(cur)
    best = max(runs, key=len)
    return best or None


def _prefilter(anchors):
    """One Aho-Corasick pass over a text: the set of anchors that occur in it."""
    try:
        import ahocorasick
    except ImportError:   # no automaton: every rule is evaluated
        return None
    words = sorted({a for a in anchors if a})
    if not words:
        return None
    auto = ahocorasick.Automaton()
    for w in words:
        auto.add_word(w, w)
    auto.make_automaton()
    return lambda t: {w for _end, w in auto.iter(t)}


class Fold:
    """The ordered rules of a vocabulary, ready to run on texts (once per task)."""

    def __init__(self, rules: list[tuple], prefilter: bool = True):
        self.rules = [(skill, _counter(pattern, kind), skill if remove else None)
                      for skill, _j, pattern, kind, remove in rules]
        anchors = [anchor(pattern, kind) for _s, _j, pattern, kind, _r in rules]
        self.present = _prefilter(anchors) if prefilter else None
        self.by_anchor: dict[str, list[int]] = {}
        for i, a in enumerate(anchors):
            self.by_anchor.setdefault(a or "", []).append(i)

    def _due(self, t: str, start: int) -> list[int]:
        """The rules from ``start`` on that can match ``t``: those whose anchor occurs in
        it, and those without one."""
        if self.present is None:
            return list(range(start, len(self.rules)))
        found = [i for a in ("", *self.present(t)) for i in self.by_anchor.get(a, ())]
        return sorted(i for i in found if i >= start)

    def __call__(self, t: str) -> tuple[str, dict[str, int]]:
        """The text left after the removals and the hits per skill.  A removal can fuse its
        neighbours into new matches, so what is due is looked up again after it."""
        hits: dict[str, int] = {}
        due, k = self._due(t, 0), 0
        while k < len(due):
            i = due[k]
            k += 1
            skill, count, removal = self.rules[i]
            n = count(t)
            if n:
                hits[skill] = hits.get(skill, 0) + n
                if removal is not None and removal in t:
                    t = t.replace(removal, "")
                    due, k = self._due(t, i + 1), 0
        return t, hits


# Every byte of a word (ASCII letters, digits and "_") as it is, any other one as a space.
_WORD_BYTES = bytes(b if b < 128 and (chr(b).isalnum() or b == 95) else 32 for b in range(256))


def rule_fold_udf(rules: list[tuple]):
    """Arrow function ``lower(text) -> struct<rest, hits>`` for the given rules."""

    @F.pandas_udf(FOLD_TYPE)
    def rule_fold(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fold = Fold(rules)
        for texts in batches:
            done = [fold(t) if isinstance(t, str) else (None, {}) for t in texts]
            yield pd.DataFrame({"rest": [t for t, _ in done], "hits": [
                [{"skill": k, "n": n} for k, n in h.items()] for _, h in done]})

    return rule_fold


class Tagger:
    """Rule hits plus the words of the rest that are skills, for one text after the other.
    Words are cut from the text's bytes, by one translation and one split."""

    def __init__(self, rules: list[tuple], skills):
        self.fold = Fold(rules)
        self.number = {s: i for i, s in enumerate(skills)}
        # Only skills that are one word can equal a word.
        self.words = {s.encode(): i for s, i in self.number.items() if s.encode().translate(_WORD_BYTES) == s.encode()}

    def __call__(self, t: str) -> dict[int, int]:
        """Counts by the number of the skill."""
        rest, hits = self.fold(t)
        found = {self.number[s]: n for s, n in hits.items()}
        words, get = self.words, self.words.get
        for w in filter(words.__contains__, rest.encode("utf-8", "replace").translate(_WORD_BYTES).split()):
            i = get(w)
            found[i] = found.get(i, 0) + 1
        return found


def tagged_rows(df: DataFrame, key: str, text: Column, voc: "Vocabulary") -> DataFrame:
    """``(key, skill, tf)`` in one Arrow map: rule hits plus the words of the rest that are
    skills, each skill of a text once.  (An array column that is unnested afterwards would be
    computed twice: Spark puts a filter on its size below.)"""
    rules, skills = list(voc.rules), list(voc.skills)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, names = Tagger(rules, skills), pa.array(skills, pa.string())
        for batch in batch_slices(batches, 1):
            rows, numbers, counts = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t is not None:
                    found = tagger(t)
                    rows += [i] * len(found)
                    numbers += found
                    counts += found.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), names.take(pa.array(numbers, pa.int32())),
                 pa.array(counts, pa.int64())], [key, "skill", "tf"])

    narrow = df.select(F.col(key), F.lower(text).alias("_t"))
    kind = narrow.schema[0].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{key}` {kind}, skill string, tf bigint")


def _native_fold(t: Column, rules: list[tuple]) -> tuple[Column, Column]:
    """Slow twin: the same fold as a Spark ``aggregate`` over a literal rules array."""
    empty_hits = F.array().cast(HIT_TYPE)
    if not rules:
        return t, empty_hits
    arr = F.array(*[
        F.struct(F.lit(skill).alias("skill"),
                 F.lit(pattern if kind == "regex" and _valid(pattern) else lit_regex(pattern)).alias("pattern"),
                 F.lit(bool(remove)).alias("remove"))
        for skill, _j, pattern, kind, remove in rules])

    def step(acc, r):
        n = F.regexp_count(acc["t"], r["pattern"]).cast("bigint")
        new_t = F.when(r["remove"] & (n > 0), F.replace(acc["t"], r["skill"], F.lit(""))).otherwise(acc["t"])
        new_hits = F.when(n > 0, F.array_append(acc["hits"], F.struct(r["skill"].alias("skill"), n.alias("n")))
                          ).otherwise(acc["hits"])
        return F.struct(new_t.alias("t"), new_hits.alias("hits"))

    out = F.aggregate(arr, F.struct(t.alias("t"), empty_hits.alias("hits")), step)
    return out["t"], out["hits"]


def _valid(pattern: str) -> bool:
    try:
        re.compile(pattern)
        return True
    except re.error:
        return False


# ---- the operator -------------------------------------------------------------

def _folded(df: DataFrame, key: str, voc: Vocabulary, text_col: str, method: str):
    """``(docs, rest, hits)``: one projection with the fold, the text left after the
    removals and the rule hits."""
    rules = list(voc.rules)
    docs = df.select(F.col(key), F.lower(F.col(text_col)).alias("_t"))
    t = F.col("_t")
    if method == "arrow":
        folded = rule_fold_udf(rules)(t)
        docs = docs.select(key, "_t", folded.alias("_f"))
        return docs, F.coalesce(F.col("_f.rest"), t), F.col("_f.hits")
    if method == "native":
        rest, hits = _native_fold(t, rules)
        return docs, rest, hits
    raise ValueError(f"unknown method {method!r}")


def _terms(rest: Column, hits: Column) -> Column:
    """Rule hits and the words of the rest, as one ``array<struct<skill, n>>``."""
    words = F.transform(F.split(rest, NON_WORD, -1),
                        lambda w: F.struct(w.alias("skill"), F.lit(1).cast("bigint").alias("n")))
    return F.concat(hits, words)


def tag_skills(df: DataFrame, key: str, vocabulary, text_col: str = "text",
               literals=QUOTED_LITERALS, method: str = "arrow") -> DataFrame:
    """``(key, skill, tf)`` for every document with at least one tag; ``key`` is unique.
    All of a document's tags leave its own row, so nothing is shuffled.  The native twin
    joins the words with the vocabulary and sums per document.  A vocabulary frame that is
    too large for a task is worked through in parts (``large_vocabulary``)."""
    try:
        voc = prepare_vocabulary(vocabulary, literals)
    except TooLargeToBroadcast:
        if method != "arrow" or not isinstance(vocabulary, DataFrame):
            raise
        from .large_vocabulary import tag_skills_in_parts
        return tag_skills_in_parts(df, key, vocabulary, text_col, literals)
    if method == "arrow":
        return tagged_rows(df, key, F.col(text_col), voc)
    docs, rest, hits = _folded(df, key, voc, text_col, method)
    bag = docs.select(F.col(key), F.inline(_terms(rest, hits)))
    # the vocabulary is proven small (prepare_vocabulary)
    matched = bag.join(F.broadcast(voc.frame(df.sparkSession)), "skill")
    return matched.groupBy(key, "skill").agg(F.sum("n").alias("tf"))


def tag_stats(df: DataFrame, key: str, vocabulary, text_col: str = "text",
              literals=QUOTED_LITERALS) -> DataFrame:
    """``(key, n_words, bag_size, n_skills, vocab_size)`` per document: non-empty
    words left after the rule removals, tags in the bag (repeats count), distinct
    skills, and the vocabulary size.  One fold pass; documents without tags stay."""
    voc = prepare_vocabulary(vocabulary, literals)
    vocab = voc.frame(df.sparkSession)
    docs, rest, hits = _folded(df, key, voc, text_col, "arrow")
    n_words = F.size(F.filter(F.split(rest, NON_WORD, -1), lambda w: w != F.lit("")))
    bag = docs.select(F.col(key), n_words.alias("n_words"),
                      F.explode_outer(_terms(rest, hits)).alias("_x"))
    v = vocab.select(F.col("skill").alias("_v"))
    hit = bag.join(F.broadcast(v), F.col("_x.skill") == F.col("_v"), "left")
    n = F.when(F.col("_v").isNotNull(), F.col("_x.n")).otherwise(F.lit(0))
    return hit.groupBy(key).agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.sum(n).cast("bigint").alias("bag_size"),
        F.count_distinct(F.col("_v")).alias("n_skills"),
    ).withColumn("vocab_size", F.lit(len(voc)).cast("bigint"))
