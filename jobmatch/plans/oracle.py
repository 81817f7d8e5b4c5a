"""DuckDB SQL equal to each named query (the driver's correctness oracle).

The tagger's SQL is generated from the driver vocabulary by a separate Python
statement of the rule derivation: one nested select per rule, counting with
``regexp_extract_all`` and removing with ``replace``, then the word pass as an
``IN`` list.  Output columns, types and rounding match ``queries.py``.
"""

from __future__ import annotations

import re

from ..operators.textflows import BLOCK
from ..functions.text import SITE_PREFIX, STORE_FOLDER
from ..sources.resumes import DEFAULT_RESUME, MAGIC_KEYWORD, MAGIC_RESUME
from ..sources.vocabulary import DRIVER_VOCABULARY
from .queries import (FILTER_PREFIX, FILTER_SEP, INGEST_TS, RUN1_TS, RUN2_TS)

LINK_RX = r'<li><a href="[^"]*">(.*?)</a></li>'
TITLE_RX = r"(?s)<title>(.*?)</title>"
NOT_PRINTABLE = r"[^\x20-\x7e]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _rules(vocab: list[str]) -> list[tuple[str, str, bool]]:
    """(skill, RE2 pattern, remove) in fold order."""
    out = []
    for s in sorted(vocab, key=lambda x: x.encode()):
        if s in ("apache-spark", "apache-kafka", "apache-storm"):
            out.append((s, s.replace("apache-", ""), False))
        elif "-" in s:
            out.append((s, s, True))
            out.append((s, s.replace("-", " "), True))
        elif s in ("c++", "c#", "f#"):
            out.append((s, re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", s), False))
    return out


def _vocab_values() -> str:
    return ", ".join(f"({q(s)})" for s in DRIVER_VOCABULARY)


def tags_ctes(source: str, key: str, p: str) -> str:
    """CTEs ending in ``{p}tags(key, skill, tf)`` for ``source(key, text)``."""
    rules = _rules(DRIVER_VOCABULARY)
    parts = [f"{p}f0 AS (SELECT {key}, lower(text) AS t0 FROM {source})"]
    for i, (skill, pat, remove) in enumerate(rules, 1):
        parts.append(f"{p}g{i} AS (SELECT *, len(regexp_extract_all(t{i - 1}, {q(pat)})) AS n{i} FROM {p}f{i - 1})")
        t = (f"CASE WHEN n{i} > 0 THEN replace(t{i - 1}, {q(skill)}, '') ELSE t{i - 1} END"
             if remove else f"t{i - 1}")
        parts.append(f"{p}f{i} AS (SELECT *, {t} AS t{i} FROM {p}g{i})")
    last = len(rules)
    hits = [f"SELECT {key}, {q(skill)} AS skill, n{i}::BIGINT AS n FROM {p}f{last} WHERE n{i} > 0"
            for i, (skill, _pat, _r) in enumerate(rules, 1)]
    vocab_in = ", ".join(q(s) for s in DRIVER_VOCABULARY)
    words = (f"SELECT {key}, w AS skill, 1::BIGINT AS n FROM "
             f"(SELECT {key}, unnest(regexp_split_to_array(t{last}, '\\W+')) AS w FROM {p}f{last}) "
             f"WHERE w IN ({vocab_in})")
    bag = " UNION ALL ".join(hits + [words])
    parts.append(f"{p}tags AS (SELECT {key}, skill, sum(n)::BIGINT AS tf FROM ({bag}) GROUP BY {key}, skill)")
    return ",\n".join(parts)


def _resume_text(col: str) -> str:
    t = f"coalesce({col}, {q(DEFAULT_RESUME)})"
    return f"CASE WHEN {t} = {q(MAGIC_KEYWORD)} THEN {q(MAGIC_RESUME)} ELSE {t} END"


MODEL_CTES = """
nd AS (SELECT count(*) AS m FROM documents),
dfreq AS (SELECT skill, count(*) AS df FROM j_tags GROUP BY skill),
idf AS (SELECT skill, df, CASE WHEN df >= 1 THEN ln((nd.m::DOUBLE + 1) / (df::DOUBLE + 1)) ELSE 0.0 END AS idf
        FROM dfreq, nd),
wt AS (SELECT doc_id, skill, tf, idf, tf * idf AS w FROM j_tags JOIN idf USING (skill)),
model AS (SELECT doc_id, skill, tf, idf, CASE WHEN nrm > 0 THEN w / nrm ELSE 0.0 END AS weight
          FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS nrm FROM wt))
"""

JOBS = "(SELECT doc_id, text FROM documents)"
RESUMES = f"(SELECT item_id AS resume_id, {_resume_text('text')} AS text FROM benchmark)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


TOP25_CTES = [
    tags_ctes(JOBS, "doc_id", "j_"), MODEL_CTES,
    tags_ctes(RESUMES, "resume_id", "r_"),
    """qv AS (SELECT resume_id, skill, tf::DOUBLE / sqrt(sum(tf * tf) OVER (PARTITION BY resume_id)) AS qw
            FROM r_tags)""",
    """sc AS (SELECT resume_id, doc_id, sum(qw * weight) AS score FROM qv JOIN model USING (skill)
            GROUP BY resume_id, doc_id)""",
    """top AS (SELECT * FROM (SELECT resume_id, doc_id, round(score, 6) AS score,
                 row_number() OVER (PARTITION BY resume_id ORDER BY round(score, 12) DESC, doc_id)::BIGINT AS rank
               FROM sc WHERE score > 0) WHERE rank <= 25)""",
]

PAGE_ITEMS = f"""items AS (SELECT (page_id % 7)::INTEGER AS feed_index, page_id AS item_index,
    regexp_extract_all(html, {q(LINK_RX)}, 1) AS category FROM pages)"""
CAT_ROWS = """cats AS (SELECT feed_index, item_index, unnest(range(len(category)))::INTEGER AS pos,
    unnest(category) AS category FROM items)"""


def _counts(where: str, vocab_sql: str, name: str) -> str:
    return (f"{name} AS (SELECT skill, sum(n)::BIGINT AS count FROM ("
            f"SELECT skill, 0 AS n FROM {vocab_sql} UNION ALL "
            f"SELECT category AS skill, 1 AS n FROM cats WHERE {where}) GROUP BY skill)")


VOCAB = f"vocab AS (SELECT * FROM (VALUES {_vocab_values()}) v(skill))"
NAMED = f"""named AS (SELECT page_id, url,
    CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END AS http_status,
    {q(STORE_FOLDER)} || replace(regexp_replace(url, '^https?://', ''), '/', '_') AS doc_name,
    html FROM pages)"""
STORED = "stored AS (SELECT doc_name FROM named WHERE page_id % 3 = 0)"
PENDING = ("pending AS (SELECT * FROM named n WHERE NOT EXISTS "
           "(SELECT 1 FROM stored s WHERE s.doc_name = n.doc_name))")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {q(NOT_PRINTABLE)}, '', 'g')"


_NL = "chr(10)"
_TAB = "chr(9)"
_BLANK = f"{_NL} || {_NL}"


def _ts(ts: str) -> str:
    return f"TIMESTAMP {q(ts.replace('T', ' ').replace('Z', ''))}"


SQL = {
    "skill_tags": _with(tags_ctes(JOBS, "doc_id", "j_")) + "SELECT doc_id, skill, tf FROM j_tags",
    "skill_idf": _with(tags_ctes(JOBS, "doc_id", "j_"), MODEL_CTES)
    + "SELECT skill, df, round(idf, 6) AS idf FROM idf",
    "model_weights": _with(tags_ctes(JOBS, "doc_id", "j_"), MODEL_CTES)
    + "SELECT doc_id, skill, tf, round(idf, 6) AS idf, round(weight, 6) AS weight FROM model",
    "match_fixed_top10": _with(
        tags_ctes(JOBS, "doc_id", "j_"), MODEL_CTES,
        """terms AS (SELECT skill, count(*) AS tf FROM (VALUES ('java'), ('c++'), ('c#')) t(skill) GROUP BY skill)""",
        """qv AS (SELECT skill, tf::DOUBLE / sqrt(sum(tf * tf) OVER ()) AS qw FROM terms)""",
        """sc AS (SELECT doc_id, sum(qw * weight) AS score FROM model JOIN qv USING (skill) GROUP BY doc_id)""")
    + "SELECT doc_id, round(score, 6) AS score FROM sc WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 10",
    "match_top25": _with(*TOP25_CTES) + "SELECT resume_id, doc_id, score, rank FROM top",
    "match_links": _with(*TOP25_CTES) + f"""SELECT resume_id,
        '<div id="innerResult">' || string_agg(
            '<div><a href="' || u || '" target="_blank">' || u || '</a></div>' || {_NL}, '' ORDER BY rank)
        || '</div>' AS links
        FROM (SELECT resume_id, rank, {q(SITE_PREFIX)} || replace(doc_id::VARCHAR, '_', '/') AS u FROM top)
        GROUP BY resume_id""",
    "resume_defaults": f"""SELECT conv_id, turn, {_resume_text('t')} AS text FROM (
        SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'magic' WHEN role = 'user' THEN text END AS t
        FROM conversations)""",
    "resume_tags": _with(tags_ctes(
        f"""(SELECT {{'c': conv_id, 't': turn}} AS request, {_resume_text('t')} AS text FROM (
            SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'magic' WHEN role = 'user' THEN text END AS t
            FROM conversations))""", "request", "q_")) + "SELECT request.c AS conv_id, request.t AS turn, skill, tf FROM q_tags",
    "word_line_index": f"""WITH l AS (
            SELECT doc_id, unnest(range(len(string_split(text, {_NL}))))::INTEGER AS line_no,
                   unnest(string_split(text, {_NL})) AS line FROM documents),
        w AS (SELECT doc_id, line_no, unnest(string_split(line, ' ')) AS word FROM l)
        SELECT doc_id, word, '[' || string_agg(line_no::VARCHAR, ' ' ORDER BY line_no) || ']' AS line_numbers
        FROM w WHERE word <> '' GROUP BY doc_id, word""",
    "corpus_word_index": f"""WITH l AS (SELECT doc_id, string_split(text, {_NL}) AS ls FROM documents WHERE text IS NOT NULL),
        o AS (SELECT ls, sum(len(ls)) OVER (ORDER BY doc_id) - len(ls) AS first FROM l),
        x AS (SELECT first, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM o),
        w AS (SELECT (first + i)::BIGINT AS line, unnest(string_split(line, ' ')) AS word FROM x),
        p AS (SELECT word, line, row_number() OVER (ORDER BY word, line) - 1 AS place FROM w WHERE word <> ''),
        g AS (SELECT word, line, place, place // {BLOCK} AS block,
                     line - lag(line) OVER (PARTITION BY word, place // {BLOCK} ORDER BY place) AS gap FROM p)
        SELECT word, block, count(*) AS n, min(line) AS first_line, max(line) AS last_line,
               string_agg(coalesce(gap, 0)::VARCHAR, ' ' ORDER BY place) AS gaps FROM g GROUP BY word, block""",
    "word_count": f"""SELECT token, count(*) AS count FROM (
            SELECT unnest(string_split(line, ' ')) AS token FROM (
                SELECT unnest(string_split(text, {_NL})) AS line FROM documents)) GROUP BY token""",
    "token_count_filtered": f"""SELECT count(*) AS count FROM (
            SELECT unnest(string_split(line, {q(FILTER_SEP)})) AS token FROM (
                SELECT unnest(string_split(text, {_NL})) AS line FROM documents)
            WHERE NOT starts_with(line, {q(FILTER_PREFIX)}))""",
    "category_counts": _with(PAGE_ITEMS, CAT_ROWS, VOCAB, _counts("true", "vocab", "cc"))
    + "SELECT skill, count FROM cc",
    "category_running_count": _with(PAGE_ITEMS, CAT_ROWS)
    + """SELECT feed_index, item_index, pos, category,
           count(*) OVER (PARTITION BY category ORDER BY feed_index, item_index, pos
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count FROM cats""",
    "category_rank": _with(PAGE_ITEMS, CAT_ROWS, VOCAB, _counts("true", "vocab", "cc"))
    + "SELECT skill, count, (row_number() OVER (ORDER BY count DESC, skill) - 1)::BIGINT AS position FROM cc",
    "items_per_feed": _with(PAGE_ITEMS) + "SELECT feed_index, count(*) AS items FROM items GROUP BY feed_index",
    "skills_current": _with(
        PAGE_ITEMS, CAT_ROWS, VOCAB, _counts("item_index % 2 = 0", "vocab", "run1"),
        _counts("item_index % 2 = 1", "(SELECT DISTINCT skill FROM run1)", "run2"),
        f"""h AS (SELECT skill, count, {_ts(RUN1_TS)} AS run_ts FROM run1
                  UNION ALL SELECT skill, count, {_ts(RUN2_TS)} AS run_ts FROM run2)""")
    + """SELECT skill, arg_max(count, run_ts) AS count, strftime(max(run_ts), '%Y-%m-%d %H:%M:%S') AS run_ts
         FROM h GROUP BY skill""",
    "doc_names": _with(NAMED) + "SELECT page_id, url, doc_name, regexp_replace(doc_name, '^.*/', '') AS base_name FROM named",
    "doc_urls": _with(NAMED) + f"""SELECT page_id, regexp_replace(doc_name, '^.*/', '') AS base_name,
        {q(SITE_PREFIX)} || replace(regexp_replace(doc_name, '^.*/', ''), '_', '/') AS url_back FROM named""",
    "pending_pages": _with(NAMED, STORED, PENDING) + "SELECT page_id, url, doc_name FROM pending",
    "ingest_status": _with(NAMED, STORED, PENDING,
                           """st AS (SELECT http_status, row_number() OVER (PARTITION BY doc_name ORDER BY url) AS rn
                                     FROM pending)""")
    + """SELECT coalesce(sum(CASE WHEN rn = 1 AND http_status = 200 THEN 1 ELSE 0 END), 0)::BIGINT AS passed,
                coalesce(sum(CASE WHEN rn > 1 OR http_status <> 200 THEN 1 ELSE 0 END), 0)::BIGINT AS failed
         FROM st""",
    "page_titles": f"SELECT page_id, regexp_extract(html, {q(TITLE_RX)}, 1) AS title FROM pages",
    "page_links": f"""SELECT page_id, unnest(range(len(l)))::INTEGER AS pos, unnest(l) AS link FROM (
        SELECT page_id, regexp_extract_all(html, {q(LINK_RX)}, 1) AS l FROM pages)""",
    "rendered_docs": _with(NAMED, STORED, PENDING) + f"""SELECT page_id, doc_name,
        url || {_BLANK}
        || 'DATE: ' || strftime({_ts(INGEST_TS)}, '%A, %d-%b-%y %H:%M:%S') || ' UTC' || {_BLANK}
        || 'TITLE: ' || {_strip(f"regexp_extract(html, {q(TITLE_RX)}, 1)")} || {_BLANK}
        || 'LOCATION: ' || {_BLANK}
        || 'BASESKILLS: ' || coalesce(array_to_string(list_transform(regexp_extract_all(html, {q(LINK_RX)}, 1),
                                                            lambda x: {_strip('x')}), ' '), '') || {_BLANK}
        || 'ABOUT: ' || {_BLANK} || 'DESCRIPTION: ' || {_BLANK} || 'REQUIREMENTS: ' || {_NL} AS body
        FROM pending WHERE http_status = 200""",
    "stream_counts": _with(PAGE_ITEMS, CAT_ROWS)
    + "SELECT category AS skill, count(*) AS count FROM cats GROUP BY category",
    "stream_match": _with(*TOP25_CTES) + "SELECT resume_id, doc_id, score, rank FROM top",
    "stream_ingest": _with(NAMED, STORED, PENDING) + "SELECT DISTINCT doc_name FROM pending",
    "resume_tag_stats": _with(tags_ctes(RESUMES, "resume_id", "r_")) + f"""SELECT f.resume_id,
        len(list_filter(regexp_split_to_array(f.t{len(_rules(DRIVER_VOCABULARY))}, '\\W+'), lambda x: x <> ''))::BIGINT
            AS n_words,
        coalesce(sum(g.tf), 0)::BIGINT AS bag_size, count(g.skill) AS n_skills,
        {len(DRIVER_VOCABULARY)}::BIGINT AS vocab_size
        FROM r_f{len(_rules(DRIVER_VOCABULARY))} f LEFT JOIN r_tags g ON f.resume_id = g.resume_id
        GROUP BY f.resume_id, f.t{len(_rules(DRIVER_VOCABULARY))}""",
    "match_lines": _with(*TOP25_CTES) + f"""SELECT resume_id, rank, line, split_part(line, {_TAB}, 1) AS name
        FROM (SELECT resume_id, rank, doc_id::VARCHAR || {_TAB} || printf('%.6f', score) AS line FROM top)""",
    "feed_guids": "SELECT url AS guid, count(*) AS listed FROM pages GROUP BY url",
}
SQL["word_count_files"] = SQL["word_count"]
SQL["word_line_index_files"] = SQL["word_line_index"]
SQL["skills_csv_reload"] = _with(PAGE_ITEMS, CAT_ROWS, VOCAB, _counts("true", "vocab", "cc")) + \
    "SELECT skill, 0::BIGINT AS count FROM cc"
SQL["skill_history_stored"] = SQL["skills_current"]
SQL["model_reload"] = SQL["model_weights"]
SQL["model_in_runs"] = SQL["model_weights"]
SQL["job_store"] = _with(NAMED, STORED, PENDING) + """SELECT doc_name, url FROM (
    SELECT doc_name, url, http_status, row_number() OVER (PARTITION BY doc_name ORDER BY url) AS rn FROM pending)
    WHERE rn = 1 AND http_status = 200"""

SQL["job_store_probed"] = SQL["job_store"]


# ---- a vocabulary that comes from the data: rules derived and folded in SQL --------------

FEED_VOCAB = (f"vocab AS (SELECT DISTINCT skill FROM (SELECT skill FROM (VALUES {_vocab_values()}) v(skill) "
              "UNION ALL SELECT category FROM cats) WHERE skill IS NOT NULL AND skill <> '')")
RULES_SQL = r"""rules AS (
    SELECT skill, 0 AS j, replace(skill, 'apache-', '') AS pat, false AS rm FROM vocab
        WHERE skill IN ('apache-spark', 'apache-kafka', 'apache-storm')
    UNION ALL SELECT skill, 1, skill, true FROM vocab
        WHERE skill NOT IN ('apache-spark', 'apache-kafka', 'apache-storm') AND contains(skill, '-')
    UNION ALL SELECT skill, 2, replace(skill, '-', ' '), true FROM vocab
        WHERE skill NOT IN ('apache-spark', 'apache-kafka', 'apache-storm') AND contains(skill, '-')
    UNION ALL SELECT skill, 3, regexp_replace(skill, '([\\^$.|?*+()\[\]{}])', '\\\1', 'g'), false FROM vocab
        WHERE skill IN ('c++', 'c#', 'f#')),
ordered AS (SELECT row_number() OVER (ORDER BY skill, j) AS i, skill, pat, rm FROM rules),
n_rules AS (SELECT count(*) AS n FROM ordered)"""


def fold_ctes(source: str, key: str, p: str) -> str:
    """``{p}tags(key, skill, tf)`` by a recursive fold over ``ordered`` rules."""
    return f"""{p}fold({key}, i, t, skill, n) AS (
        SELECT {key}, 0::BIGINT, lower(text), NULL::VARCHAR, 0::BIGINT FROM {source}
        UNION ALL
        SELECT f.{key}, f.i + 1,
               CASE WHEN r.rm AND len(regexp_extract_all(f.t, r.pat)) > 0 THEN replace(f.t, r.skill, '') ELSE f.t END,
               r.skill, len(regexp_extract_all(f.t, r.pat))::BIGINT
        FROM {p}fold f JOIN ordered r ON r.i = f.i + 1),
    {p}rest AS (SELECT {key}, t FROM {p}fold WHERE i = (SELECT n FROM n_rules)),
    {p}tags AS (SELECT {key}, skill, sum(n)::BIGINT AS tf FROM (
        SELECT {key}, skill, n FROM {p}fold WHERE i > 0 AND n > 0
        UNION ALL
        SELECT w.{key}, w.w AS skill, 1::BIGINT AS n FROM (
            SELECT {key}, unnest(regexp_split_to_array(t, '\\W+')) AS w FROM {p}rest) w
            JOIN vocab v ON v.skill = w.w) GROUP BY {key}, skill)"""


SQL["feed_vocab_tags"] = ("WITH RECURSIVE " + ",\n".join([PAGE_ITEMS, CAT_ROWS, FEED_VOCAB, RULES_SQL,
                                                          fold_ctes(JOBS, "doc_id", "j_")])
                          + "\nSELECT doc_id, skill, tf FROM j_tags")
SQL["feed_vocab_top25"] = ("WITH RECURSIVE " + ",\n".join([
    PAGE_ITEMS, CAT_ROWS, FEED_VOCAB, RULES_SQL, fold_ctes(JOBS, "doc_id", "j_"), MODEL_CTES.strip(),
    fold_ctes(RESUMES, "resume_id", "r_"), *[c.strip() for c in TOP25_CTES[3:]]])
    + "\nSELECT resume_id, doc_id, score, rank FROM top")
SQL["feed_vocab_pruned_top25"] = SQL["feed_vocab_top25"]
SQL["skill_tags_native"] = SQL["skill_tags"]
SQL["skill_tags_in_parts"] = SQL["skill_tags"]
SQL["match_common_terms_top10"] = _with(
    tags_ctes(JOBS, "doc_id", "j_"), MODEL_CTES,
    """terms AS (SELECT skill, 1 AS tf FROM idf ORDER BY df DESC, skill LIMIT 3)""",
    """qv AS (SELECT skill, tf::DOUBLE / sqrt(sum(tf * tf) OVER ()) AS qw FROM terms)""",
    """sc AS (SELECT doc_id, sum(qw * weight) AS score FROM model JOIN qv USING (skill) GROUP BY doc_id)""") + \
    "SELECT doc_id, round(score, 6) AS score FROM sc WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 10"


# ---- page sections: NFKD of the pages' characters, Latin letters with marks, is strip_accents

def _decoded(x: str) -> str:
    for ref, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "\u00a9"), ("middot", "\u00b7")):
        x = f"replace({x}, '&{ref};', {q(char)})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _section_text(x: str) -> str:
    plain = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    return f"regexp_replace(strip_accents({_decoded(plain)}), '[^\\x20-\\x7e]', '', 'g')"


def _sections(pages: str) -> str:
    """CTE ``sec(page_id, section, ordinal, text)`` of the driver layout over ``pages``."""
    def first(tag: str, of: str = "html") -> str:
        return f"regexp_extract({of}, '<{tag}>(.*?)</{tag}>', 1, 's')"

    def items(section: str, lists: str, start: int, text: str) -> str:
        return (f"SELECT page_id, '{section}', i - {start}, {text} FROM (SELECT page_id, l, "
                f"unnest(range({start}, len(l) + 1)) AS i FROM (SELECT page_id, {lists} AS l FROM {pages}))")
    links = f"regexp_extract_all({first('nav')}, '<a [^>]*>(.*?)</a>', 1, 's')"
    return f"""raw AS (SELECT page_id, 'title' AS section, 0 AS ordinal, {first('title')} AS t FROM {pages}
    UNION ALL SELECT page_id, 'location', 0, '' FROM {pages}
    UNION ALL {items('skills', links, 1, 'l[i]')}
    UNION ALL SELECT page_id, 'about', 0, {first('h1', first('article'))} FROM {pages}
    UNION ALL {items('description', f"string_split({first('article')}, '<p>')", 2, "regexp_replace(l[i], '</p>.*', '', 's')")}),
sec AS (SELECT page_id, section, ordinal::INTEGER AS ordinal, {_section_text('t')} AS text FROM raw)"""


def _listed(section: str) -> str:
    return (f"coalesce((SELECT list(text ORDER BY ordinal) FROM sec WHERE sec.page_id = p.page_id "
            f"AND section = '{section}'), [])")


SQL["page_sections"] = _with(_sections("pages")) + "SELECT page_id, section, ordinal, text FROM sec"
SQL["job_docs"] = _with(NAMED, STORED, PENDING, """chosen AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_name ORDER BY url, page_id) AS k FROM pending) WHERE k = 1 AND http_status = 200)""",
    _sections("chosen"), f"""docs AS (SELECT doc_name, url, {_listed('title')}[1] AS title, '' AS location,
    {_listed('skills')} AS base_skills, {_listed('about')} AS about, {_listed('description')} AS description,
    []::VARCHAR[] AS requirements FROM chosen p)""") + f"""SELECT *,
    strftime({_ts(INGEST_TS)}, '%Y-%m-%d %H:%M:%S') AS ingest_ts,
    url || {_BLANK} || 'DATE: ' || strftime({_ts(INGEST_TS)}, '%A, %d-%b-%y %H:%M:%S') || ' UTC' || {_BLANK}
    || 'TITLE: ' || title || {_BLANK} || 'LOCATION: ' || location || {_BLANK}
    || 'BASESKILLS: ' || coalesce(array_to_string(base_skills, ' '), '') || {_BLANK}
    || 'ABOUT: ' || coalesce(array_to_string(about, {_NL}), '') || {_BLANK}
    || 'DESCRIPTION: ' || coalesce(array_to_string(description, {_NL}), '') || {_BLANK}
    || 'REQUIREMENTS: ' || {_NL} AS body FROM docs"""

_MODEL_OF_DOCS = MODEL_CTES.replace("FROM documents", "FROM rendered").replace("doc_id", "doc_name")
SQL["pipeline_top25"] = _with(
    f"rendered AS (SELECT r.*, p.url FROM ({SQL['rendered_docs']}) r JOIN pages p USING (page_id))",
    tags_ctes("(SELECT doc_name, body AS text FROM rendered)", "doc_name", "j_"), _MODEL_OF_DOCS,
    *[c.replace("doc_id", "doc_name") for c in TOP25_CTES[2:]]) + f"""SELECT resume_id,
    {q('<div id="innerResult">')} || string_agg(
        '<div><a href="' || url || '" target="_blank">' || url || '</a></div>' || {_NL}, '' ORDER BY rank)
    || '</div>' AS links FROM top JOIN rendered USING (doc_name) GROUP BY resume_id"""
SQL["feed_files_running_count"] = _with(PAGE_ITEMS, CAT_ROWS, """numbered AS (SELECT feed_index, item_index,
    row_number() OVER (PARTITION BY feed_index ORDER BY item_index) - 1 AS k FROM items)""") + """SELECT
    feed_index, k::BIGINT AS item_index, pos, category,
    count(*) OVER (PARTITION BY category ORDER BY feed_index, k, pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
    FROM cats JOIN numbered USING (feed_index, item_index)"""
SQL["skills_csv_lower"] = _with(PAGE_ITEMS, CAT_ROWS, VOCAB, _counts("true", "vocab", "cc")) + (
    "SELECT DISTINCT lower(skill) AS skill FROM cc WHERE skill <> ''")
SQL["ml_model"] = _with(tags_ctes(JOBS, "doc_id", "j_"), """nd AS (SELECT count(DISTINCT doc_id) AS m FROM j_tags),
dfreq AS (SELECT skill, count(*) AS df FROM j_tags GROUP BY skill)""") + """SELECT doc_id, count(*) AS n_terms,
    CASE WHEN max(tf * ln((m + 1.0) / (df + 1.0))) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS squared_length
    FROM j_tags JOIN dfreq USING (skill), nd GROUP BY doc_id"""
SQL["feed_source_running_count"] = SQL["feed_files_running_count"]
SQL["skill_history_compacted"] = SQL["skills_current"]
SQL["stream_ingest_keyed"] = SQL["stream_ingest"]
SQL["stream_running_count"] = _with(PAGE_ITEMS, CAT_ROWS) + """SELECT feed_index, url AS guid, pos, category,
    count(*) OVER (PARTITION BY category ORDER BY feed_index, item_index, pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
    FROM cats JOIN pages ON page_id = item_index"""
