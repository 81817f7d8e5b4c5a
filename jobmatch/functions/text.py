"""Native (JVM, codegen) column expressions for text, names and dates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
SITE_PREFIX = "http://careers.stackoverflow.com/jobs/"   # prefix stripped from job URLs
STORE_FOLDER = "jobs_sof/"                                # folder of stored job documents
RFC850_FORMAT = "EEEE, dd-MMM-yy HH:mm:ss"                # Go time.RFC850, rendered in UTC
RFC850_ZONE = " UTC"
NON_WORD = r"\W+"                                         # ASCII non-word split, Java regex
TRIM_CHARS = " \n"                                        # location trim set


def lit_regex(s: str) -> str:
    """Quote a literal for a Java regex."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", s)


# ---- splitting (P1, P2, P3, P25) -------------------------------------------

def split_keep_empty(c: Column, sep: str) -> Column:
    """Split on a literal separator; empty tokens stay (Go strings.Split)."""
    return F.split(c, lit_regex(sep), -1)


def split_words_nonempty(c: Column, sep: str = " ") -> Column:
    """Split on a literal separator and drop empty words."""
    return F.filter(split_keep_empty(c, sep), lambda w: w != F.lit(""))


def text_lines(c: Column) -> Column:
    """Lines of a whole text, numbered from 0 by position (split on newline)."""
    return F.split(c, "\n", -1)


def non_word_tokens(c: Column) -> Column:
    return F.split(c, NON_WORD, -1)


# ---- names and URLs (P6, P10, P11, P12, P26) --------------------------------

def first_csv_field(c: Column) -> Column:
    return F.split_part(c, F.lit(","), F.lit(1))


def base_name(path: Column) -> Column:
    """Remove directories: regex ``^.*/`` replaced by nothing."""
    return F.regexp_replace(path, r"^.*/", "")


def url_to_doc_name(url: Column, prefix_regex: str = r"https?://",
                    folder: str = STORE_FOLDER) -> Column:
    """Document name of a job URL: strip the site prefix, ``/`` to ``_``, prepend the folder."""
    stripped = F.regexp_replace(url, "^" + prefix_regex, "")
    return F.concat(F.lit(folder), F.replace(stripped, F.lit("/"), F.lit("_")))


def doc_name_to_url(name: Column, prefix: str = SITE_PREFIX) -> Column:
    """Back from a bare document name to a URL (lossy when the slug held ``_``)."""
    return F.concat(F.lit(prefix), F.replace(name, F.lit("_"), F.lit("/")))


def result_line(name: Column, score: Column, digits: int = 6) -> Column:
    """``name \\t score`` result line, the score with a fixed number of decimals."""
    return F.concat_ws("\t", name.cast("string"), F.format_string(f"%.{digits}f", score))


def result_line_name(line: Column) -> Column:
    return F.split_part(line, F.lit("\t"), F.lit(1))


# ---- page fields by pattern (P16 simple tags, P17) ---------------------------

def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)


def page_links(html: Column) -> Column:
    """Texts of ``<li><a href="..">X</a></li>`` (nav links, the feed categories)."""
    return F.regexp_extract_all(html, F.lit(r'<li><a href="[^"]*">(.*?)</a></li>'), F.lit(1))


def trim_space_newline(c: Column) -> Column:
    return F.btrim(c, F.lit(TRIM_CHARS))


def ascii_strip(c: Column) -> Column:
    """Drop code points below 32 and from 127 up (newline and tab go too)."""
    return F.regexp_replace(c, r"[^\x20-\x7e]", "")


# ---- dates (P21, P28) -----------------------------------------------------------

def utc_wall_clock(ts: Column) -> Column:
    """The UTC wall-clock of an instant, whatever the session time zone."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def rfc850(ts: Column) -> Column:
    """``Tuesday, 01-Dec-26 18:00:00 UTC``."""
    return F.concat(F.date_format(utc_wall_clock(ts), RFC850_FORMAT), F.lit(RFC850_ZONE))


def utc_text(ts: Column) -> Column:
    return F.date_format(utc_wall_clock(ts), "yyyy-MM-dd HH:mm:ss")


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)
