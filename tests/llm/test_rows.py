"""Operators that judge each document alone, against plain rules."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from jobmatch.llm import quality, secrets, sharding
from tests.conftest import SF
from tests.llm.conftest import odd_rows, words


def same_rows(a, b):
    assert collections.Counter(a) == collections.Counter(b)


# ---- quality rules

def repeated(w, size=8):
    seen, covered = collections.defaultdict(list), set()
    for i in range(len(w) - size + 1):
        seen[tuple(w[i:i + size])].append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(size))
    return len(covered)


def base(text):
    text = text or ""
    w = words(text, lower=False)
    lines = [x for x in text.split("\n") if words(x)]
    n = repeated(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n,
            len(w) < 20 or 100 * n > 30 * len(w))


def test_base_rule_is_the_plain_rule(spark, odd_docs):
    got = quality.quality(odd_docs).collect()
    same_rows([(r.doc_id, *r[1:7]) for r in got], [(i, *base(t)) for i, t, _ in odd_rows()])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.quality(docs).collect():
        assert tuple(r[1:7]) == base(text[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_labelled_good_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    bad = [r.kept for r in rows if r.quality == 0]
    assert bad and sum(bad) <= 0.05 * len(bad)


def test_failing_lines_go_and_columns_stay(odd_docs, no_docs):
    out = quality.clean(odd_docs)
    assert out.dtypes == odd_docs.dtypes
    text = {r.doc_id: r for r in out.collect()}
    assert text[13].text == odd_rows()[0][1] and text[13].n_chars == len(text[13].text)
    assert 14 not in text and 15 not in text and 4 not in text and text[1].text == odd_rows()[0][1]
    assert quality.clean(no_docs).count() == quality.quality(no_docs).count() == 0


# ---- secret scans

KINDS = [("assign", re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32)]


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(KINDS) for m in p.finditer(text or "")
                  if len(m[g]) >= n)


def expected(text):
    s = base_spans(text)
    listed = ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in s)
    return (*(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest())


def secret_texts(n=300):
    rnd = random.Random(5)
    parts = ["token", "TOKEN", "pass", "word", "wd", "api", "_", "key", "secret", "=", ":", " ", "'", '"', "AKIA", "abc",
             "0123456789abcdef", "deadbeef" * 3, "ABCDEFGH", "é", "🙂", "\n", "x-y", "a.b/c+d="]
    return ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(n)]


def test_base_spans_are_the_plain_rule(spark, odd_docs, no_docs):
    rows = secrets.scan(odd_docs).collect()
    same_rows([(r.doc_id, *r[1:5]) for r in rows], [(i, *expected(t)) for i, t, _ in odd_rows()])
    texts = secret_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan(docs).collect():
        assert tuple(r[1:5]) == expected(texts[r.doc_id]), texts[r.doc_id]
    assert secrets.scan(no_docs).count() == 0


def test_trigram_queries_hold_for_every_match():
    rnd = random.Random(1)
    samples = {
        "assign": 'PASSWORD : "abcdefgh', "access": "AKIA0123456789AB", "github": "ghp_" + "a" * 36,
        "slack": "xoxb-0123456789", "google": "AIza" + "b" * 35, "stripe": "sk_live_" + "c" * 16,
        "jwt": "eyJabcdefgh.eyJabcdefgh.abcdefgh", "pem": "-----BEGIN RSA PRIVATE KEY-----"}
    for name, pattern, _, _ in secrets.RULES:
        clauses = secrets.trigram_query(pattern)
        if name == "hex":
            assert clauses == [frozenset()]
            continue
        assert frozenset() not in clauses and re.search(pattern, samples[name])
        low = samples[name].lower()
        assert any(all(g in low for g in c) for c in clauses)
        assert not any(all(g in "nothing of the kind" for g in c) for c in clauses)
    for pattern, text in (("ab?cde", "acde"), ("(foo|barbaz)+x", "barbazx"), ("[ab]cdef", "bcdef"), ("a{2,}bcd", "aabcd")):
        assert any(all(g in text for g in c) for c in secrets.trigram_query(pattern)), (pattern, rnd)


def test_spans_of_other_kinds_and_redaction(spark, odd_docs):
    text = "a sk_live_0123456789abcdefXYZ b -----BEGIN PRIVATE KEY----- c"
    r = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.spans == f"stripe:2:{text.index(' b ')},pem:{text.index('---')}:{text.index(' c')}"
    out = secrets.redact(odd_docs)
    assert out.dtypes == odd_docs.dtypes and out.count() == odd_docs.count()
    for r in out.collect():
        assert not base_spans(r.text) and (r.text is None or r.n_chars == len(r.text))
    one = secrets.redact(odd_docs.where("doc_id = 11")).first()
    assert one.text == 'Here is a [secret]" and [secret], see.'


def test_redaction_leaves_nothing_of_a_private_key(spark):
    lines = ["MIIEpAIBAAKCAQEA" + c * 48 for c in "abcdefgh"]
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n"
    key = "\n".join(lines)
    texts = [(f"see\n{head}\n{key}\nQ+9=\n{end}\nthen prose", "see\n[secret]\nthen prose"),
             (f"see {head}\n{headers}{key}\n{end} then {head}\n{key}\n{end}.", "see [secret] then [secret]."),
             ("k = '" + "\\n".join([head, *lines, end]) + "'", "k = '[secret]'"),
             (f"{head}\n{key}\nQ+9=\n(no end of it here)", "[secret](no end of it here)"),
             (f"{head}\n{headers}{key}", "[secret]"),
             (f"{head}\n{chr(10).join(lines * 4000)}\n{end} x", "[secret] x"),
             (f"{head} is a heading, {end[:9]} is not", f"[secret] is a heading, {end[:9]} is not"),
             (f"{head} only opens a key. Prose stays.\nMore of it, and then {end} closes one.",
              f"[secret] only opens a key. Prose stays.\nMore of it, and then {end} closes one.")]
    for n in (99, 1000):
        quoted = "".join(f"> {lines[i % 8]}\n" for i in range(n))
        texts += [(f"> {head}\n{quoted}", "> [secret]"), (f"> {head}\n{quoted}> Q+9=\n> {end}\nbye", "> [secret]\nbye"),
                  (f"> {head}\n{quoted}> Qab9=\nThe rest is prose.", "> [secret]\nThe rest is prose.")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in secrets.redact(docs).collect()} == {i: t for i, (_, t) in enumerate(texts)}


# ---- sharding

@pytest.mark.parametrize("n", [1, 2, 40, 41, 999, 1000])
def test_the_permutation_is_one_to_one(spark, n):
    passes = sharding.longest_walk(spark, n, 7)
    from pyspark.sql import functions as F
    got = [r.p for r in spark.range(n).select(sharding.permute(F.col("id"), n, 7, passes).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    if n > 100:
        assert got != sorted(got)


def test_shards_are_even_gapless_and_reproducible(spark, odd_docs, no_docs):
    for docs in (odd_docs, spark.read.parquet(f"{SF}/documents.parquet")):
        rows = sharding.digests(docs).collect()
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
            assert 0 <= r.shard < 40 and r.law == "rows" and r.grown_shard is None
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        sizes = [len(slots[k]) for k in range(40)]
        assert max(sizes) - min(sizes) <= 1
        same_rows(rows, sharding.digests(docs.repartition(5)).collect())
        text = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        same_rows([(r.doc_id, r["size"], r.text_crc32) for r in rows],
                  [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in text])
    assert sharding.digests(no_docs).count() == 0


def test_whole_rows_are_written_by_shard(spark, odd_docs, tmp_path):
    sharding.write_shards(odd_docs, str(tmp_path / "s"), "doc_id", "text", shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    same_rows([(r.doc_id, r.text, r.kept) for r in back.collect()], [(r.doc_id, r.text, r.kept) for r in odd_docs.collect()])
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {7}


def test_sentences_end_by_the_marks_of_their_script(spark):
    """Twenty lines each; the same prose is kept in any script, a menu in none."""
    ends = {"hi": "।", "ar": "؟", "ur": "۔", "hy": "։", "am": "።", "km": "។", "my": "။", "zh": "。", "en": "."}
    letters = {"hi": "हिन्दी", "ar": "عربي", "ur": "اردو", "hy": "Հայ", "am": "አማርኛ", "km": "ខ្មែរ", "my": "မြန်မာ", "zh": "中文", "en": "prose"}
    rows = [(k, "\n".join(f"{letters[k]} {i} {letters[k]}{i}{e}" for i in range(20)), True) for k, e in ends.items()]
    rows += [(k, "\n".join(f"{w} {i} {w}{i}" for i in range(20)), k != "menu")
             for k, w in (("th", "ภาษาไทย"), ("lo", "ພາສາລາວ"), ("menu", "Home"))]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id string, text string")
    assert {r.doc_id: r.kept for r in quality.quality(docs).collect()} == {k: v for k, _, v in rows}


def test_redaction_of_nothing(no_docs):
    assert secrets.redact(no_docs).collect() == [] and secrets.redact(no_docs).dtypes == no_docs.dtypes
