"""Text cleaning that Spark has no built-in for (P15, P19): Unicode NFKD and HTML
entity decoding, as Arrow functions over whole columns.  The ASCII strip alone is
native (``functions.text.ascii_strip``)."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_PRINTABLE = re.compile(r"[^\x20-\x7e]+")


def nfkd_ascii(s: str) -> str:
    """NFKD, then drop code points below 32 and from 127 up (newline and tab go too)."""
    return _NOT_PRINTABLE.sub("", unicodedata.normalize("NFKD", s))


def unescape(s: str) -> str:
    return html.unescape(s)


@F.pandas_udf(T.StringType())
def clean_text(s: pd.Series) -> pd.Series:
    """P15 column function."""
    return s.map(lambda x: None if x is None else nfkd_ascii(x))


@F.pandas_udf(T.StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """P19 column function."""
    return s.map(lambda x: None if x is None else unescape(x))
