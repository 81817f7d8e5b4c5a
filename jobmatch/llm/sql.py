"""DuckDB SQL for the queries that SQL can state, over whole tables.

The rules' parameters come from the operators; how the rows are found is SQL's own:
joins on shingles instead of sketches, windows as strings instead of hashes, every text
scanned by every rule instead of a trigram index.
"""

from __future__ import annotations

from . import decontamination, filter_audit, odd_sketch, quality, secrets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), {_q(_SPACE)}), lambda x: x <> '')"


def _lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _shingles(name: str, table: str, key: str, n: int) -> str:
    """CTEs ``<name>w(k, w)`` and ``<name>(k, s)``: the distinct shingles of every row's text."""
    runs = f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"
    return f"""{name}w AS (SELECT {key} AS k, {_words(_lowered('text'))} AS w FROM {table}),
{name} AS (SELECT DISTINCT k, unnest(CASE WHEN len(w) >= {n} THEN {runs}
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {name}w)"""


def _leaks() -> str:
    return f"""WITH {_shingles('d', 'documents', 'doc_id', decontamination.SHINGLE)},
{_shingles('b', 'benchmark', 'item_id', decontamination.SHINGLE)},
size AS (SELECT k, count(*) AS n FROM b GROUP BY k),
shared AS (SELECT d.k AS doc_id, b.k AS item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n AS n_item, n_shared / n AS containment
FROM shared JOIN size ON item_id = k WHERE 100 * n_shared >= {decontamination.THRESHOLD} * n"""


def _quality() -> str:
    line_spaces = "length(x) - length(replace(x, ' ', ''))"
    of = lambda p: f"len(regexp_extract_all(x, {_q(p)}))"
    phrases = " OR ".join(f"contains(x, {_q(p)})" for p in quality.BOILERPLATE)
    fails = f"""regexp_matches(x, {_q(_WORD)}) AND (NOT regexp_matches(x, {_q(quality.SENTENCE_END)})
        OR ({of(quality.SEPARATORS)} >= {quality.MIN_SEPARATORS} AND {of(quality.SEPARATORS)} * 4 > {line_spaces})
        OR ({of('!')} >= 3 AND {of('!')} * 3 > {line_spaces} + 1)
        OR {of(quality.SYMBOLS)} * 100 > length(x) * {quality.MAX_SYMBOL_SHARE} OR {phrases})"""
    size = quality.WINDOW
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, {_words('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_q(_WORD)})) AS lines FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - {size - 2})) AS i, w FROM t WHERE len(w) >= {size}),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS s FROM win),
twice AS (SELECT doc_id, s FROM keyed GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS p FROM keyed JOIN twice USING (doc_id, s)),
rep AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
f AS (SELECT *, list_filter(lines, lambda x: {fails}) AS removed FROM t),
c AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, {_q(quality.SYMBOLS)})) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, len(removed) AS n_removed_lines,
    length(regexp_replace(array_to_string(removed, ''), {_q(_SPACE)}, '', 'g')) AS lost_chars
    FROM f LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality.MAX_REPEATED} AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND lost_chars * 100 <= word_chars * {quality.MAX_LOST} AS kept, n_removed_lines, lost_chars FROM j"""


def _near_dedup(n: int = 4) -> str:
    return f"""WITH RECURSIVE {_shingles('d', 'documents', 'doc_id', n)},
size AS (SELECT k, count(*) AS n FROM d GROUP BY k),
common AS (SELECT a.k AS a, b.k AS b, count(*) AS n FROM d a JOIN d b ON a.s = b.s AND a.k <> b.k GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN size x ON x.k = a JOIN size y ON y.k = b
         WHERE 100 * common.n >= {odd_sketch.THRESHOLD} * (x.n + y.n - common.n)),
reach(k, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.k, link.b FROM reach JOIN link ON link.a = reach.r),
least AS (SELECT k, min(r) AS c FROM reach GROUP BY k)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM documents JOIN least ON least.k = doc_id LEFT JOIN size ON size.k = doc_id"""


def _secrets() -> str:
    spans = []
    for kind, (_, pattern, group, least) in enumerate(secrets.RULES):
        p = _q(pattern.replace("*+", "*"))
        spans.append(f"""SELECT doc_id, {kind} AS kind,
    list_sum(list_transform(gap[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[:i - 1], lambda x: length(x))), 0) AS a,
    length(hit[i]) AS n FROM (SELECT doc_id, gap, hit, val, unnest(range(1, len(hit) + 1)) AS i FROM (
        SELECT doc_id, regexp_split_to_array(t, {p}) AS gap, regexp_extract_all(t, {p}, 0) AS hit,
            regexp_extract_all(t, {p}, {group}) AS val FROM t)) WHERE length(val[i]) >= {least}""")
    names = ", ".join(_q(r[0]) for r in secrets.RULES)
    listed = f"coalesce(string_agg([{names}][kind + 1] || ':' || a || ':' || (a + n), ',' ORDER BY a, kind){{}}, '')"
    base = listed.format(f" FILTER (kind < {secrets.BASE})")
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{secrets.RULES[k][0]}" for k in range(secrets.BASE))
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(spans)})
SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {listed.format('')} AS spans
FROM documents LEFT JOIN (SELECT doc_id, kind, a::BIGINT AS a, n FROM spans) USING (doc_id) GROUP BY doc_id"""


def _filter_audit() -> str:
    """Every row's failed filters as bits, and every order run over the counts of the 32
    combinations."""
    f = filter_audit
    tests = (f"len(w) < {f.MIN_WORDS}", f"100 * len(list_distinct(w)) < {f.DISTINCT_PERCENT} * len(w)",
             f"100 * len(regexp_extract_all(t, '[A-Z]')) > {f.UPPER_PERCENT} * length(t)",
             f"regexp_matches(t, '[{f.SYMBOLS.decode()}]')", "doc_id > low")
    bits = " + ".join(f"CASE WHEN {x} THEN {1 << k} ELSE 0 END" for k, x in enumerate(tests))
    letters = ", ".join(_q(x) for x in f.FILTERS)
    return f"""WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_words('text')} AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
rows_ AS (SELECT part, {bits} AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM t LEFT JOIN marks USING (doc_id)),
combos AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM rows_ GROUP BY ALL),
letters AS (SELECT unnest([{letters}]) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders(filter_order, used, n) AS (SELECT '', 0, 0 UNION ALL SELECT filter_order || x, used + bit, n + 1
    FROM orders JOIN letters ON used & bit = 0 WHERE n < 5),
steps AS (SELECT filter_order, step, bit, (SELECT coalesce(sum(l.bit), 0) FROM letters l
    WHERE position(l.x IN filter_order) < step) AS before
    FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders WHERE n = 5)
    JOIN letters ON x = filter_order[step]),
counted AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (before + bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM combos, (SELECT filter_order, step, bit::INTEGER AS bit, before::INTEGER AS before FROM steps) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted"""


SQL = {"op2_decontamination": _leaks(), "op4_quality_rules": _quality(), "op9_near_dedup": _near_dedup(),
       "op10_secret_scans": _secrets(), "op12_filter_audit": _filter_audit()}
