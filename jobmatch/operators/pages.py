"""Job pages: names, the already-stored filter, fetch status, rendering (P10-P13,
P18-P21, J1, A5, R6).

The cheap anti join runs before the costly extraction (Catalyst does not move
joins across Python maps, so the order here is the plan's order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import STORE_FOLDER, base_name, rfc850, url_to_doc_name

# The labels and layout of a stored job document.
LABEL_DATE = "DATE: "
LABEL_TITLE = "TITLE: "
LABEL_LOCATION = "LOCATION: "
LABEL_SKILLS = "BASESKILLS: "
LABEL_ABOUT = "ABOUT: "
LABEL_DESCRIPTION = "DESCRIPTION: "
LABEL_REQUIREMENTS = "REQUIREMENTS: "
SKILL_SEP = " "
LINE_SEP = "\n"
BLOCK_SEP = "\n\n"


def with_doc_names(pages: DataFrame, prefix_regex: str = r"https?://",
                   folder: str = STORE_FOLDER) -> DataFrame:
    """P11 + P10: add ``doc_name`` (folder + flattened URL) and ``base_name``."""
    name = url_to_doc_name(F.col("url"), prefix_regex, folder)
    return pages.withColumn("doc_name", name).withColumn("base_name", base_name(F.col("doc_name")))


def pending(named: DataFrame, stored: DataFrame) -> DataFrame:
    """Pages whose document is not stored yet (anti join on the name)."""
    return named.join(stored.select("doc_name"), "doc_name", "left_anti")


def status_flags(status: Column) -> tuple[Column, Column]:
    """200 -> (1, 0), anything else -> (0, 1)."""
    ok = (status == 200)
    return F.when(ok, 1).otherwise(0).cast("bigint"), F.when(ok, 0).otherwise(1).cast("bigint")


def one_per_name(pages: DataFrame) -> DataFrame:
    """Q24: two pages with the same document name would overwrite each other: one row per
    name, ``(doc_name, url, row, http_status, listed)``, that of the lowest URL (then the
    lowest ``row``, a hash of the other columns); ``listed`` counts all of the name's
    pages.  Partial minima over narrow columns: bodies are not read, and a name shared by
    very many pages sends one row per task."""
    others = [c for c in pages.columns if c not in ("html", "doc_name", "url", "base_name")]
    low = F.min(F.struct("url", F.xxhash64(*others).alias("row"), "http_status"))
    return (pages.groupBy("doc_name").agg(low.alias("_low"), F.count(F.lit(1)).alias("listed"))
                 .select("doc_name", "_low.*", "listed"))


def bodies(pages: DataFrame, chosen: DataFrame) -> DataFrame:
    """The page of every chosen row of ``one_per_name``, bodies joined in once.  Pages that
    are equal in all other columns are told apart by their bodies; one stays."""
    others = [c for c in pages.columns if c not in ("html", "doc_name", "url", "base_name")]
    keyed = pages.withColumn("row", F.xxhash64(*others)).join(
        chosen.select("doc_name", "url", "row"), ["doc_name", "url", "row"])
    one = Window.partitionBy("doc_name", "url", "row").orderBy(F.xxhash64("html"))
    return keyed.withColumn("_k", F.row_number().over(one)).filter("_k = 1").drop("_k", "row")


def fetch_status(pages: DataFrame) -> DataFrame:
    """``(doc_name, url, passed, failed)`` per pending name; its further pages failed."""
    passed, failed = status_flags(F.col("http_status"))
    return one_per_name(pages).select("doc_name", "url", passed.alias("passed"),
                                      (failed + F.col("listed") - 1).alias("failed"))


def status_totals(status: DataFrame) -> DataFrame:
    """A5: ``(passed, failed)`` summed; empty input gives (0, 0)."""
    return status.agg(F.coalesce(F.sum("passed"), F.lit(0)).cast("bigint").alias("passed"),
                      F.coalesce(F.sum("failed"), F.lit(0)).cast("bigint").alias("failed"))


def labelled(label: str, items: Column, sep: str = LINE_SEP) -> Column:
    """Label followed by the list joined with ``sep`` (empty list -> label only)."""
    return F.concat(F.lit(label), F.coalesce(F.array_join(items, sep), F.lit("")))


def render_document(url: Column, ingest_ts: Column, title: Column, location: Column,
                    skills: Column, about: Column, description: Column,
                    requirements: Column) -> Column:
    """P20 + P21: url, DATE, TITLE, LOCATION, skills, about, description, requirements,
    a blank line between blocks, a newline at the end.  Missing fields are empty."""
    blocks = [
        url,
        F.concat(F.lit(LABEL_DATE), rfc850(ingest_ts)),
        F.concat(F.lit(LABEL_TITLE), F.coalesce(title, F.lit(""))),
        F.concat(F.lit(LABEL_LOCATION), F.coalesce(location, F.lit(""))),
        labelled(LABEL_SKILLS, skills, SKILL_SEP),
        labelled(LABEL_ABOUT, about),
        labelled(LABEL_DESCRIPTION, description),
        labelled(LABEL_REQUIREMENTS, requirements),
    ]
    return F.concat(F.concat_ws(BLOCK_SEP, *blocks), F.lit(LINE_SEP))


# ---- extraction job (P14, P15, P16, P19) and the ingest job (R6) -------------------------

SECTIONS = ["title", "location", "skills", "about", "description", "requirements"]
SECTION_SCHEMA = ("title string, location string, skills array<string>, about array<string>, "
                  "description array<string>, requirements array<string>")
SCALAR_SECTIONS = {"title", "location"}
JOB_DOCS_SCHEMA = ("doc_name string, url string, ingest_ts timestamp, title string, location string, "
                   "base_skills array<string>, about array<string>, description array<string>, "
                   "requirements array<string>, body string")

# Selectors of the job-site page layout, (section, order, root id, path).
SITE_SELECTORS = [
    ("title", 0, None, "/html/head/title"),
    ("location", 0, "hed", "ul[1]/li/text()"),
    ("skills", 0, "hed", "div[2]/p/a"),
    ("description", 0, "jobdetailpage", "div[2]/div[1]/div[2]/p"),
    ("description", 1, "jobdetailpage", "div[2]/div[1]/div[2]/ul/li"),
    ("requirements", 0, "jobdetailpage", "div[2]/div[1]/div[3]/p"),
    ("requirements", 1, "jobdetailpage", "div[2]/div[1]/div[3]/ul/li/text()"),
    ("requirements", 2, "jobdetailpage", "div[2]/div[1]/div[3]/ul/li/ul/li/text()"),
    ("about", 0, "jobdetailpage", "div[2]/div[1]/div[4]/p"),
]
# The driver's pages carry no ids: title, nav links as skills, headline, paragraphs.
DRIVER_SELECTORS = [
    ("title", 0, None, "/html/head/title"),
    ("skills", 0, None, "//nav/ul/li/a"),
    ("about", 0, None, "//article/h1"),
    ("description", 0, None, "//article/p"),
]


def extract_page(html_text: str | None, selectors) -> list:
    """Sections of one page, in ``SECTIONS`` order.  Order of work: parse (entities
    decoded once), NFKD + ASCII strip of every text node (nodes left empty vanish),
    select, then decode entities once more.  Scalars take the first match; the
    location is trimmed of spaces and newlines."""
    from ..functions.clean import nfkd_ascii, unescape
    from ..functions.html_extract import parse, select, string_value
    out: dict = {s: ([] if s not in SCALAR_SECTIONS else "") for s in SECTIONS}
    if not html_text:
        return [out[s] for s in SECTIONS]
    root = parse(html_text, nfkd_ascii)
    for section, _order, root_id, path in sorted(selectors, key=lambda r: (r[0], r[1])):
        found = [string_value(n) for n in select(root, path, root_id)]
        if section in SCALAR_SECTIONS:
            if found and not out[section]:
                v = found[0]
                out[section] = unescape(v.strip(" \n") if section == "location" else v)
        else:
            out[section].extend(unescape(v) for v in found)
    return [out[s] for s in SECTIONS]


def extract_sections(pages_df: DataFrame, selectors=SITE_SELECTORS, keep=("url",),
                     html_col: str = "html") -> DataFrame:
    """P16 job: ``keep`` columns plus one column per section, one row per page.
    Narrow (no shuffle): each task parses its own pages in Arrow batches."""
    keep = list(keep)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                       for f in pages_df.select(*keep).schema.fields) + ", " + SECTION_SCHEMA
    sel = [tuple(s) for s in selectors]

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = [extract_page(h, sel) for h in pdf[html_col]]
            out = pd.DataFrame(rows, columns=SECTIONS)
            for i, k in enumerate(keep):
                out.insert(i, k, pdf[k].values)
            yield out

    return pages_df.select(*keep, html_col).mapInPandas(run, schema)


def section_rows(sections: DataFrame, key: str = "url") -> DataFrame:
    """Long form ``(key, section, ordinal, text)`` of extracted sections: one
    ``inline`` over all sections, so the extraction above runs once."""
    def tag(name):
        return lambda x, i: F.struct(F.lit(name).alias("section"), i.alias("ordinal"), x.alias("text"))

    parts = [F.transform(F.array(F.col(s)) if s in SCALAR_SECTIONS else F.col(s), tag(s))
             for s in SECTIONS]
    return sections.select(key, F.inline(F.concat(*parts)))


def placeholder_docs(names: DataFrame) -> DataFrame:
    """Store rows for names stored before the store existed (no body)."""
    schema = names.sparkSession.createDataFrame([], JOB_DOCS_SCHEMA).schema
    return names.select(*[F.col(f.name) if f.name == "doc_name" else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in schema.fields])


def ingest_pages(raw: DataFrame, stored: DataFrame | None, ingest_ts: Column,
                 selectors=SITE_SELECTORS, prefix_regex: str = r"https?://",
                 folder: str = STORE_FOLDER, find_pending=None) -> tuple[DataFrame, DataFrame]:
    """``(job_docs, totals)``.  Names the pages, drops the stored ones and chooses one
    page per name, all on narrow columns; then the bodies of the fetched pages are joined
    in, once, extracted and rendered.  ``find_pending(named)``, if given, drops the stored
    ones in place of the anti join with ``stored``."""
    named = with_doc_names(raw, prefix_regex, folder)
    narrow = named.drop("html")
    todo = find_pending(narrow) if find_pending else pending(narrow, stored)
    fetched = bodies(named, one_per_name(todo).filter(F.col("http_status") == 200))
    sec = extract_sections(fetched, selectors, keep=("doc_name", "url"))
    body = render_document(F.col("url"), ingest_ts, F.col("title"), F.col("location"),
                           F.col("skills"), F.col("about"), F.col("description"), F.col("requirements"))
    docs = sec.select("doc_name", "url", ingest_ts.alias("ingest_ts"), "title", "location",
                      F.col("skills").alias("base_skills"), "about", "description", "requirements",
                      body.alias("body"))
    return docs, status_totals(fetch_status(todo))
