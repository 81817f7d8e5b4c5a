"""Quality rules by line-first cleaning.

Each line of a text is judged alone (punctuation, navigation, symbols, boilerplate);
failing lines are removed, and a document that loses too much of its text is
rejected.  Everything is a projection of the row: no shuffle, no Python.

Defined cases: a null or empty text has no words and fails the base rule; blank lines
are neutral; equal rows get equal verdicts, one for each; an empty table gives no
rows.  Columns of the input are carried in a struct, so none of their names can clash.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, where_computed

# Base rule.
MIN_WORDS = 20
MAX_REPEATED = 30        # per cent of the words, in windows of:
WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
# Line rules.  The words of a line are counted by its spaces.
# Marks that end a sentence, by script (Latin, Han, Arabic, Syriac,
# Devanagari, Armenian, Ethiopic, Khmer, Burmese, Tibetan, Mongolian), and the blocks of Thai
# and Lao, which end sentences without a mark: their lines are not held to this rule.
SENTENCE_MARKS = ".!?…" "。！？｡．" "؟۔" "܀܁܂" "।॥" "։" "።፧፨" "។៕" "။" "།༎" "᠃᠉"
UNMARKED_SCRIPTS = "\u0e01-\u0e5b\u0e81-\u0edf"
SENTENCE_END = rf"""[{SENTENCE_MARKS}]["'”’»)\]]*(?:[\x20\x09-\x0D]|$)|[{UNMARKED_SCRIPTS}]"""
SEPARATORS = "[|»›·•]"
MIN_SEPARATORS = 2       # and at least one for every four words
MAX_SYMBOL_SHARE = 10    # per cent of the characters of the line
BOILERPLATE = ("nable JavaScript", "nable Javascript", "requires JavaScript", "uses cookies", "use cookies",
               "ookie policy", "ookie Policy", "rivacy policy", "rivacy Policy", "erms of use", "erms of Use",
               "erms of service", "erms of Service", "ll rights reserved", "ll Rights Reserved",
               "orem ipsum", "lick here to", "ubscribe to our")
# A document is rejected if more than this per cent of its word characters is removed.
MAX_LOST = 50


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _word_chars(words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def _has_boilerplate(text: Column) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in BOILERPLATE])


def _unended(line: Column) -> Column:
    return ~F.endswith(line, F.lit(".")) & ~line.rlike(SENTENCE_END) & line.rlike(WORD)


def line_fails(line: Column) -> Column:
    """Whether a line is removed; one without a word never is."""
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    separators, shouts = _count(line, SEPARATORS), _count(line, "!")
    return line.rlike(WORD) & (
        _unended(line)
        | (separators >= MIN_SEPARATORS) & (separators * 4 > spaces)
        | (shouts >= 3) & (shouts * 3 > spaces + 1)
        | (_count(line, SYMBOLS) * 100 > F.length(line) * MAX_SYMBOL_SHARE)
        | _has_boilerplate(line))


def _covered(windows: Column) -> Column:
    """Words covered by the windows that start at the given ascending places."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        windows, start,
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"),
                                p.alias("last")),
        lambda acc: acc["n"].cast("long"))


def _joined(step: int):
    """Hashes of runs of words, each of two shorter runs; past the end, of what there is.
    Runs of unlike numbers of words are hashed unlike, so these equal no others."""
    return lambda h, i: F.xxhash64(h, F.get(F.col("win"), i + step))


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all input columns), ``t`` (the text), ``lines``, the digests of the base rule,
    ``base_failed``, ``removed`` (the failing lines), ``lost_chars`` and ``kept`` for every
    row of ``docs``.

    Windows are compared by 64-bit hashes within one text.  A column that a lambda reads
    must be read outside it too, or it is computed again for each element."""
    df = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    df = df.select("row", "t", F.btrim("t", F.lit(" \t\n\x0b\x0c\r")).alias("w"), F.split("t", "\n", -1).alias("lines"),
                   _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"))
    df = df.withColumn("w", F.when(F.col("w") == "", F.array().cast("array<string>"))
                       .otherwise(F.split("w", SPACE, -1)))
    # Most texts have nothing that the costlier line rules look for.
    suspect = (F.col("n_symbols") > 0) | F.contains("t", F.lit("!")) | F.col("t").rlike(SEPARATORS) \
        | _has_boilerplate(F.col("t"))
    df = df.select(
        "row", "t", "lines", "n_symbols", F.size("w").cast("long").alias("n_words"),
        _word_chars(F.col("w")).alias("word_chars"), F.transform("w", lambda w: F.xxhash64(w)).alias("win"),
        F.when(suspect, F.filter("lines", line_fails)).otherwise(F.filter("lines", _unended)).alias("removed"),
        F.filter("lines", lambda x: x.rlike(WORD)).alias("worded"))
    for step in (1, 2, 4):
        df = df.withColumn("win", F.transform("win", _joined(step)))
    # Only a text that has some window twice is sorted.
    df = df.withColumn("win", F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda i, d: F.get(F.col("win"), i + d)["h"]
    df = df.withColumn("win", F.when(F.col("win").isNotNull(), F.sort_array(F.filter(F.transform(
        "win", lambda x, i: F.when(F.coalesce(x["h"] == near(i, -1), F.lit(False))
                                   | F.coalesce(x["h"] == near(i, 1), F.lit(False)), x["i"])),
        lambda p: p.isNotNull()))))
    df = df.select(
        "row", "t", "lines", "removed", "n_words", "word_chars", "n_symbols",
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("win")), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.when(F.size("removed") > 0, F.length(F.regexp_replace(F.array_join("removed", ""), SPACE, "")))
        .otherwise(F.lit(0)).cast("long").alias("lost_chars"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED))
    df = df.withColumn("kept", ~F.col("base_failed")
                       & (F.col("lost_chars") * 100 <= F.col("word_chars") * MAX_LOST))
    # Whoever filters by a verdict must not have the optimizer compute it twice.
    return where_computed(df, F.lit(True))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digests and verdicts of ``judge``, one row for each document."""
    return judge(docs.select(id_col, text_col), text_col).select(
        F.col("row")[id_col].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", F.size("removed").cast("long").alias("n_removed_lines"),
        "lost_chars")


def clean(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents that are kept, without their failing lines; same columns as
    ``docs``.  ``length_col``, if there is one, holds the new length in code points."""
    df = judge(docs, text_col).where("kept")
    df = df.withColumn("cleaned", F.when(F.size("removed") == 0, F.col("t")).otherwise(
        F.array_join(F.filter("lines", lambda x: ~line_fails(x)), "\n")))
    new = {text_col: F.col("cleaned"), length_col: F.length("cleaned").cast("long")}
    return df.select(*[(new[c].cast(t) if c in new else F.col("row")[c]).alias(c)
                       for c, t in docs.dtypes])
