"""Secret scans with a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: any text
that the rule matches has all trigrams of one of the query's clauses.  The texts'
postings (trigram, document) for the trigrams of these queries are joined with the
clauses and intersected, and only the candidates of a rule are scanned with it.  Rules
without mandatory trigrams scan every text.

Only DataFrame functions are used; the queries are derived on the driver from the
rules, of which there are a few.  Spans count code points, the end is exclusive, and
matches of one rule are the leftmost ones that do not overlap.

Defined cases: a null text is empty; empty texts have no spans; documents that are
repeated are each returned, with the same spans; null ids are carried; an empty table
gives no rows.  Only the id and the text are read (``redact`` carries the rest in a
struct), so other columns cannot clash.
"""

from __future__ import annotations

import itertools
import re._parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, lower_ascii, small_side, stored, where_computed

# What follows the heading of a private key: header lines, then pieces of 16 or more base64
# characters with what quotes or breaks lines between them, as many as there are; then, if
# they are there, a shorter last piece and the END line.  Prose is none of these, so a
# heading that is only mentioned takes nothing along.  The runs are possessive, as Java
# would need stack for each piece else; nothing after them is mandatory, so greedy runs
# match the same.
_QUOTE = r"""[\x20\t\r\n"',>|#*\\]*"""
PEM_BODY = (rf"""(?:{_QUOTE}Proc-Type:[^\r\n]*\s+{_QUOTE}DEK-Info:[^\r\n]*)?"""
            rf"""(?:{_QUOTE}[A-Za-z0-9+/=]{{16}}[A-Za-z0-9+/=\r\n\\]*)*+"""
            rf"""(?:{_QUOTE}[A-Za-z0-9+/]{{1,15}}={{1,2}})?"""
            rf"""(?:{_QUOTE}[A-Za-z0-9+/=]{{0,15}}{_QUOTE}-----END [A-Z ]*PRIVATE KEY-----)?""")

# name, pattern, group and fewest characters of it.  The first three are the base kinds;
# runs of a fixed class need no separate length check when it is in the pattern.
RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 0, 39),
    ("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 32),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----" + PEM_BODY, 0, 27),
)
BASE = 3
MAX_STRINGS = 64         # alternatives that are followed as whole strings
SPAN = "array<struct<start:int,kind:int,end:int>>"

Clauses = list[frozenset[str]]


def _minimal(clauses: Clauses) -> Clauses:
    """Without clauses that ask for more than another one."""
    return sorted((c for c in set(clauses) if not any(d < c for d in clauses)), key=sorted)


def _and(a: Clauses, b: Clauses) -> Clauses:
    return _minimal([x | y for x, y in itertools.product(a, b)])


def _grams(strings: set[str]) -> Clauses:
    return _minimal([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings])


def _read(nodes) -> tuple[set[str] | None, Clauses]:
    """All strings that a part of a pattern matches, if they are few, and what else any of
    its matches must contain."""
    now, query, whole = {""}, [frozenset()], True

    def cut():
        nonlocal now, query, whole
        query, now, whole = _and(query, _grams(now)), {""}, False

    def add(strings: set[str] | None, inner: Clauses) -> None:
        nonlocal now, query
        if strings is not None and len(strings) * len(now) <= MAX_STRINGS:
            now = {a + b for a, b in itertools.product(now, strings)}
        else:
            cut()
            query = _and(query, inner if strings is None else _grams(strings))

    for op, arg in nodes:
        op = str(op)
        if op == "LITERAL":
            add({chr(arg).lower()}, [])
        elif op == "IN" and all(str(k) in ("LITERAL", "RANGE") for k, _ in arg):
            chars = {chr(c).lower() for k, v in arg for c in (range(v[0], v[1] + 1) if str(k) == "RANGE" else [v])}
            add(chars, [])
        elif op == "SUBPATTERN":
            add(*_read(arg[3]))
        elif op == "BRANCH":
            parts = [_read(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                add(set().union(*(s for s, _ in parts)), [])
            else:
                add(None, _minimal([c for s, q in parts for c in (q if s is None else _grams(s))]))
        elif op == "MAX_REPEAT" and arg[0] == 0:
            strings, _ = _read(arg[2])
            if arg[1] == 1 and strings is not None:
                add(strings | {""}, [])
            else:
                cut()
        elif op == "MAX_REPEAT":
            strings, inner = _read(arg[2])
            if strings is not None and arg[0] == arg[1] == 1:
                add(strings, [])
            else:
                cut()
                query = _and(query, inner if strings is None else _grams(strings))
        elif op != "AT":
            cut()
    return (now, query) if whole else (None, _and(query, _grams(now)))


def trigram_query(pattern: str) -> Clauses:
    """The clauses of a pattern, in lower case; one empty clause if it has no mandatory
    trigrams."""
    strings, query = _read(parser.parse(pattern))
    return _and(query, _grams(strings)) if strings is not None else query


def _clause_table(spark: SparkSession, rules) -> tuple[DataFrame | None, list[str], list[int]]:
    """``rule, clause, bit, whole, gram``: the clauses of the rules that have some, all
    trigrams, and the numbers of the rules that scan every text."""
    rows, grams, full = [], set(), []
    for k, (_, pattern, _, _) in enumerate(rules):
        clauses = trigram_query(pattern)
        if frozenset() in clauses:
            full.append(k)
            continue
        for j, c in enumerate(clauses):
            grams |= c
            rows += [(k, j, 1 << i, (1 << len(c)) - 1, g) for i, g in enumerate(sorted(c))]
    if not rows:
        return None, [], full
    cells = ", ".join("({}, {}, {}L, {}L, '{}')".format(*r[:4], r[4].replace("'", "\\'")) for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {cells} AS t(rule, clause, bit, whole, gram)"), sorted(grams), full


def _spans(text: str, kind: int, rule) -> Column:
    """The spans of a rule in column ``text``, from what lies between its matches."""
    _, pattern, group, least = rule
    p = F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, p, F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, p, F.lit(group)).alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["all"])
        own = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.when(x["all"].isNull(), acc).otherwise(F.struct(
            end.alias("at"), F.when(F.length(x["value"]) >= least, F.concat(acc["spans"], own))
            .otherwise(acc["spans"]).alias("spans")))

    none = F.array().cast(SPAN)
    return F.when(F.col(text).rlike(pattern), F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])).otherwise(none)


def find(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, v, spans`` for every row of ``docs``; ``v`` is a hash of the text, ``spans``
    has (start, kind, end) in ascending order."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    docs = docs.withColumn("v", F.xxhash64("t"))
    clauses, grams, full = _clause_table(docs.sparkSession, rules)
    scanned = docs.select("doc_id", "v", F.concat(F.array().cast(SPAN), *[
        _spans("t", k, rules[k]) for k in full]).alias("spans"))
    if clauses is None:
        return scanned.withColumn("spans", F.sort_array("spans"))

    low = docs.select("doc_id", "v", lower_ascii(F.col("t")).alias("low"))
    postings = low.select("doc_id", "v", F.explode(F.array_compact(F.array(*[
        F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))).alias("gram"))
    # The clauses are as many rows as the rules' trigrams.
    met = (postings.join(F.broadcast(clauses), "gram").groupBy("doc_id", "v", "rule", "clause", "whole")
           .agg(F.bit_or("bit").alias("bits")).where("bits = whole"))
    candidates = stored(met.groupBy("doc_id", "v").agg(
        F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules")), "candidates")

    wanted = candidates.select(F.col("doc_id").alias("cd"), F.col("v").alias("cv"), "rules")
    same = F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("v") == F.col("cv"))
    texts = docs.join(small_side(wanted), same).select("doc_id", "v", "t", "rules")
    each = [F.when(F.col("rules").bitwiseAND(1 << k) != 0, _spans("t", k, r)).otherwise(F.array().cast(SPAN))
            for k, r in enumerate(rules) if k not in full]
    verified = texts.select(F.col("doc_id").alias("cd"), F.col("v").alias("cv"), F.concat(*each).alias("more"))
    # A document that is repeated is verified once for each row; its spans are the same.
    verified = where_computed(verified, F.size("more") > 0).groupBy("cd", "cv").agg(F.first("more").alias("more"))
    return scanned.join(verified, same, "left").select("doc_id", "v", F.sort_array(F.concat(
        "spans", F.coalesce("more", F.array().cast(SPAN)))).alias("spans"))


def _listed(spans: Column, rules) -> Column:
    names = F.array(*[F.lit(r[0]) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row of ``docs``."""
    found = find(docs, rules, id_col, text_col)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{rules[k][0]}") for k in range(BASE)],
        F.sha2(_listed(F.filter("spans", lambda x: x["kind"] < BASE), rules), 256).alias("base_sha256"),
        _listed(F.col("spans"), rules).alias("spans"))


def redact(docs: DataFrame, rules=RULES, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text",
           length_col: str = "n_chars") -> DataFrame:
    """``docs`` with each span (overlapping ones together) replaced by ``mark``; same columns.
    ``length_col``, if there is one, holds the new length in code points."""
    found = where_computed(find(docs, rules, id_col, text_col), F.size("spans") > 0)
    found = stored(found.groupBy("doc_id", "v").agg(F.first("spans").alias("spans"), F.max(F.size("spans")).alias("n")), "spans")
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    same = F.col("row")[id_col].eqNullSafe(F.col("doc_id")) & (F.xxhash64("t") == F.col("v"))
    # Lists of spans may be long, so what is broadcast is bounded by their entries.
    few = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(found) if few else found, same, "left")

    def step(acc: Column, x: Column) -> Column:
        new = x["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring("t", acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(new, out).otherwise(acc["out"]).alias("out"))

    text = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substring("t", acc["at"] + 1, F.length("t")))))
    rows = rows.select("row", text.alias("new"))
    new = {text_col: F.col("new"), length_col: F.coalesce(
        F.length("new").cast("long"), F.col("row")[length_col]) if length_col in docs.columns else None}
    return rows.select(*[(new[c].cast(t) if c in new else F.col("row")[c]).alias(c) for c, t in docs.dtypes])
