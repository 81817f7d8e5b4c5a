"""The three general text dataflows.

Input is a frame of whole texts ``(key, text)`` (a ``documents`` table, or
``sources.text.whole_text_files``), or of lines (``sources.text.text_lines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_keep_empty, split_words_nonempty, text_lines
from ..plans.sizing import SPREAD_BYTES, shuffle_partitions

BLOCK = 4096             # postings of one block of the corpus index
TASK_BYTES = 16 << 20    # of text whose postings one task sorts


def word_lines(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """S2 + P1 + P4: ``(key, word, line_no)``; lines numbered from 0, words split on a
    single space, empty words dropped."""
    lines = texts.select(key, F.posexplode(text_lines(F.col(text_col))).alias("line_no", "line"))
    return lines.select(key, F.col("line_no").cast("int").alias("line_no"),
                        F.explode(split_words_nonempty(F.col("line"), " ")).alias("word"))


def word_line_index(texts: DataFrame, key: str, text_col: str = "text", method: str = "row") -> DataFrame:
    """A1: ``(key, word, line_numbers)``, one list per word of a text, repeats kept,
    numeric order, printed like ``[0 1 1]``.  Lists are per text, so a list is
    bounded by its text's size (a global list per word would put a hot word's
    occurrences of the whole corpus into one row).

    ``method="row"`` (default) builds each text's index inside its own row: the
    (word, line) pairs are sorted, the positions where the word changes mark the
    groups, and each group is read by place (``slice`` would copy the whole array for
    each), so no (text, word) rows are shuffled at all.  ``method="group"`` is the same result as ``groupBy(key, word)`` with
    ``collect_list`` (one shuffle of the partial lists)."""
    if method == "group":
        wl = word_lines(texts, key, text_col)
        lists = F.sort_array(F.collect_list("line_no"))
        return wl.groupBy(key, "word").agg(
            F.concat(F.lit("["), F.array_join(lists, " "), F.lit("]")).alias("line_numbers"))
    if method != "row":
        raise ValueError(f"unknown method {method!r}")
    pairs = F.flatten(F.transform(text_lines(F.col(text_col)), lambda line, i: F.transform(
        split_words_nonempty(line, " "), lambda w: F.struct(w.alias("word"), i.alias("line_no")))))
    d = texts.select(key, F.sort_array(pairs).alias("_s"))      # by word, then line
    s = F.col("_s")
    n = F.size(s)
    starts = F.when(n > 0, F.filter(
        F.sequence(F.lit(1), n),
        lambda k: (k == 1) | (F.element_at(s, k)["word"] != F.element_at(s, k - 1)["word"]))
    ).otherwise(F.array().cast("array<int>"))
    d = d.select(key, "_s", starts.alias("_st"))
    st = F.col("_st")
    groups = F.transform(st, lambda b, j: F.struct(
        F.element_at(s, b)["word"].alias("word"),
        F.concat(F.lit("["), F.array_join(F.transform(
            F.sequence(b, F.coalesce(F.get(st, j + 1), n + 1) - 1),
            lambda k: F.element_at(s, k)["line_no"]), " "), F.lit("]")).alias("line_numbers")))
    return d.select(key, F.inline(groups))


def line_numbers(texts: DataFrame, key: str, text_col: str = "text", width: int | None = None) -> DataFrame:
    """``(first_line, text)``: texts follow one another in the order of ``key`` (unique), and lines
    are numbered through all of them, as one file of all texts would have it.  Only keys and
    line counts are sorted; the texts move once, to their numbers (in ``width`` parts, if given)."""
    from ..plans.ranking import running_sum
    rows = texts.select(F.col(key).alias("_k"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    sized = rows.select("_k", F.size(text_lines(F.col("text"))).cast("bigint").alias("_n"))
    firsts = running_sum(sized, [F.col("_k")], "_n", out="first_line").select("_k", "first_line")
    if width:
        rows = rows.repartition(width, F.coalesce("_k", F.lit(0).cast(rows.schema["_k"].dataType)), F.isnull("_k"))
    return rows.join(firsts, rows["_k"].eqNullSafe(firsts["_k"])).select("first_line", "text")


def words_of_line(line: Column) -> Column:
    """``array<struct<word, times>>``, every word of a line once: its words are sorted, and the
    places where the word changes are read (a hash aggregate would hold all words of a task)."""
    s = F.sort_array(split_words_nonempty(line, " "))
    with_ends = F.transform(F.array(s), lambda w: F.struct(w.alias("w"), F.when(F.size(w) > 0, F.filter(
        F.sequence(F.lit(1), F.size(w)), lambda k: (k == 1) | (F.element_at(w, k) != F.element_at(w, k - 1)))
    ).otherwise(F.array().cast("array<int>")).alias("at")))
    return F.flatten(F.transform(with_ends, lambda x: F.transform(x["at"], lambda b, j: F.struct(
        F.element_at(x["w"], b).alias("word"),
        (F.coalesce(F.get(x["at"], j + 1), F.size(x["w"]) + 1) - b).cast("bigint").alias("times")))))


def _width(texts: DataFrame, text_col: str) -> int | None:
    """Parts that keep what a task sorts at the postings of about ``TASK_BYTES`` of text; ``None`` where
    the configured number of parts is enough."""
    size = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    width = -(-size // TASK_BYTES)
    return width if width > shuffle_partitions(texts.sparkSession) or size > SPREAD_BYTES else None


def corpus_word_index(texts: DataFrame, key: str, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """A1 over a whole corpus: ``(word, block, n, first_line, last_line, gaps)``, the lines of
    every word in all texts, repeats kept, ascending.

    A word's list is cut into blocks of at most ``block`` postings, so the list of a hot word
    is spread over many rows and tasks and no row grows with the corpus.  Each block is delta
    coded: its first line and the steps from one line to the next (``block_lines`` decodes
    it).  Blocks are runs of places in the order of (word, line), so those of a word follow one
    another; ``block`` numbers them through all words.  Null texts have no words, null keys
    sort first."""
    width = _width(texts, text_col)
    numbered = line_numbers(texts, key, text_col, width)
    lines = numbered.select("first_line", F.posexplode(text_lines(F.col("text"))).alias("at", "line"))
    # A word that is often in one line is counted once for it, and repeated in the list.
    once = lines.select((F.col("first_line") + F.col("at")).alias("line"), F.inline(words_of_line(F.col("line"))))
    return _blocks(once.select("word", "line", "times"), block, width)


def _blocks(once: DataFrame, block: int, width: int | None = None) -> DataFrame:
    """Blocks of ``(word, line, times)`` rows."""
    from ..plans.ranking import running_sum
    # The place of a posting among all of them, by (word, line): blocks are runs of places.
    placed = running_sum(once, [F.col("word"), F.col("line")], "times", "place", width)
    cut = placed.select("word", "line", F.explode(F.sequence(F.col("place"), F.col("place") + F.col("times") - 1)).alias("place"))
    return (cut.groupBy("word", F.expr(f"place div {block}").alias("block"))
               .agg(F.array_sort(F.collect_list("line")).alias("lines"))
               .select("word", "block", F.size("lines").cast("bigint").alias("n"),
                       F.element_at("lines", 1).alias("first_line"), F.element_at("lines", -1).alias("last_line"),
                       F.transform("lines", lambda x, i: F.when(i == 0, F.lit(0).cast("bigint"))
                                   .otherwise(x - F.get("lines", i - 1))).alias("gaps")))


def block_lines(index: DataFrame) -> DataFrame:
    """``(word, block, line)``: the blocks of ``corpus_word_index``, decoded."""
    start = F.struct(F.col("first_line").alias("at"), F.array().cast("array<bigint>").alias("out"))
    lines = F.aggregate("gaps", start, lambda acc, g: F.struct(
        (acc["at"] + g).alias("at"), F.array_append(acc["out"], acc["at"] + g).alias("out")), lambda acc: acc["out"])
    return index.select("word", "block", F.explode(lines).alias("line"))


def lines_of_words(index: DataFrame, words: list[str]) -> DataFrame:
    """The blocks of some words: a filter that reaches the scan of a stored index, whose files
    are in the order of words."""
    return index.filter(F.col("word").isin(words))


def write_index(index: DataFrame, path: str) -> None:
    """Replace a stored index.  Its files hold ranges of (word, block), so that a lookup reads
    those whose statistics have the word."""
    index.repartitionByRange("word", "block").sortWithinPartitions("word", "block").write.mode("overwrite").parquet(path)


def tokens(lines: DataFrame, sep: str = " ", line_col: str = "line") -> DataFrame:
    """One row per token of a line, empty tokens kept."""
    return lines.select(F.explode(split_keep_empty(F.col(line_col), sep)).alias("token"))


def lines_of_texts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Line view of whole texts (what a line reader yields for each text)."""
    return texts.select(F.explode(text_lines(F.col(text_col))).alias("line"))


def word_count(lines: DataFrame, sep: str = " ", line_col: str = "line") -> DataFrame:
    """A2: ``(token, count)``; partial counts per task before the shuffle, so a hot
    token costs one row per task."""
    return tokens(lines, sep, line_col).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def token_count_filtered(lines: DataFrame, sep: str = ":", drop_prefix: str = "#",
                         line_col: str = "line") -> DataFrame:
    """P5 + P3 + A3: drop lines starting with ``drop_prefix``, split on ``sep``, count
    all tokens (one global row)."""
    kept = lines.filter(~F.col(line_col).startswith(drop_prefix))
    return tokens(kept, sep, line_col).agg(F.count(F.lit(1)).alias("count"))
