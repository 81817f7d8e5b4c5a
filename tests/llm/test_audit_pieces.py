"""Whitening against numpy's eigenvectors, the filter audit against a plain rule, and
SentencePiece against the library on whole texts."""

import collections
import hashlib
import itertools
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from jobmatch.llm import filter_audit, sentence_pieces, whitening
from jobmatch.llm.sentence_pieces import NORMALIZER, Pieces, message
from tests.llm.conftest import odd_rows, words

MODEL = P.path("piece_bpe_32k.model")


# ---- whitening ------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["random", "two values", "falling", "equal", "low rank"])
def test_eigen_splits_any_spectrum(n, kind):
    r = np.random.default_rng(n)
    q = np.linalg.qr(r.standard_normal((n, n)))[0]
    spectra = {"two values": np.r_[np.ones(n - n // 2), 5 * np.ones(n // 2)], "falling": 10.0 ** -np.arange(n),
               "equal": np.full(n, 3.0), "low rank": np.r_[np.ones(min(n, 2)), np.zeros(max(n - 2, 0))]}
    a = (q * spectra[kind]) @ q.T if kind in spectra else r.standard_normal((n, 2 * n)) @ r.standard_normal((2 * n, n))
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    size = np.linalg.norm(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * size, rtol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-13)
    assert np.allclose(a @ vectors, vectors * values, atol=1e-13 * size)


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((30, 30))
    a = (a + a.T) / 2
    e, v = np.linalg.eigh(a)
    assert np.allclose(whitening.polar(a), (v * np.sign(e)) @ v.T, atol=1e-12)


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, v string, label int").repartition(3)


def test_whitening_equals_brute_force(spark):
    r = np.random.default_rng(5)
    good = (r.standard_normal((300, 12)) * np.linspace(.1, 3, 12)).astype("f").tolist()
    rows = [(i, v, "x", "y", 1) for i, v in enumerate(good)]
    rows += [(7, good[7], None, None, None), (None, good[8], "", "", 2)]
    bad = [(900, None), (901, [1.0, None] + good[0][2:]), (902, [float("nan")] + good[0][1:]),
           (903, [float("inf")] + good[0][1:]), (904, [1.0, 2.0]), (905, [])]
    rows += [(i, v, "x", "y", 1) for i, v in bad]
    got = whitening.whitened_rows(vectors_frame(spark, rows)).toPandas()
    usable = [(i, v) for i, v, *_ in rows[:302]]
    x = np.floor(64 * np.array([v for _, v in usable], "f").astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = x - s / n
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1], v[:, ::-1]
    assert len(got) == 12 * n and set(got.n) == {n} and got.identity_error.max() < 1e-9
    assert collections.Counter(got[got.component == 1].deviation) == collections.Counter(((n * x - s) ** 2).sum(axis=1).tolist())
    w = z @ v / np.sqrt(e)
    for k in range(12):
        mine = got[got.component == k + 1]
        assert np.allclose(mine.explained, e[k] / e.sum(), rtol=1e-9)
        want, have = sorted(w[:, k]), sorted(mine.whitened)
        assert np.allclose(want, have, atol=1e-9) or np.allclose(want, sorted(-mine.whitened), atol=1e-9)


def test_whitening_without_variance(spark):
    assert whitening.whitened_rows(vectors_frame(spark, []).limit(0)).count() == 0
    assert whitening.whitened_rows(vectors_frame(spark, [(1, None, "", "", 1)])).count() == 0
    assert whitening.whitened_rows(vectors_frame(spark, [(1, [1.0, 2.0], "", "", 1)] * 5)).count() == 0
    flat = [(i, [float(i), 1.0, 2.0], "", "", 1) for i in range(9)]       # one dimension varies
    got = whitening.whitened_rows(vectors_frame(spark, flat)).toPandas()
    assert set(got.component) == {1} and np.allclose(got.explained, 1) and abs((got.whitened ** 2).mean() - 1) < 1e-12


def test_only_what_fits_into_a_long_is_returned():
    model = whitening.Whitening(1 << 50, np.zeros(1, np.int64), np.zeros((1, 0)), np.zeros(0), 0.0)
    with pytest.raises(OverflowError):
        model.centred(np.array([[1 << 20]]))


def test_nothing_varies_with_partitions(spark):
    r = np.random.default_rng(2)
    rows = [(i, v, "", "", 1) for i, v in enumerate(r.standard_normal((200, 5)).astype("f").tolist())]
    one, many = (whitening.fit(whitening._narrow(vectors_frame(spark, rows).repartition(k), "vec_id", "embedding")) for k in (1, 7))
    assert (one.sums == many.sums).all() and np.allclose(one.values, many.values, rtol=1e-12)


# ---- filter audit -----------------------------------------------------------------------

def plain_audit(rows, labels):
    """Orders run over the rows, one filter after the other."""
    def mask(i, t):
        t = t or ""
        w = words(t, lower=False)
        repeated = i is not None and any(u is not None and u < i and (s or "") == t for u, s, _ in rows)
        return (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                any(c in t for c in "#$%&*|"), repeated)
    marks = collections.defaultdict(lambda: [0, 0])
    for i, q, x in labels:
        if i is not None:
            marks[i] = [marks[i][0] or int(q == 1), marks[i][1] or int(x == 1)]
    parts = collections.defaultdict(list)
    for i, t, p in rows:
        parts[p or ""].append((mask(i, t), marks[i] if i is not None else [0, 0]))
    out = set()
    for part, docs in parts.items():
        lines = []
        for order in itertools.permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                lines.append((f, "".join("ABCDE"[k] for k in order), step, len(left), len(gone),
                              sum(d[0][f] for d in docs) - len(gone), sum(d[0][f] and sum(d[0]) == 1 for d in docs),
                              sum(d[1][0] for d in gone), sum(d[1][1] for d in gone)))
        total = collections.Counter()
        for line in lines:
            total[line[0]] += line[4]
        out |= {(part, *line[1:], total[line[0]]) for line in lines}
    return out


def audit_rows():
    rnd = random.Random(4)
    rows = [(i, t, rnd.choice(["a", "b", None])) for i, t, _ in odd_rows()]
    for i in range(300):
        n = rnd.choice([10, 49, 50, 80])
        pool = rnd.choice([10, 400])
        text = " ".join(rnd.choice(["word", "Word", "WORD"]) + str(rnd.randrange(pool)) for _ in range(n))
        rows.append((rnd.randrange(1000) if i % 9 else None, rnd.choice([text, text + " #", "same " * 60, "", None]),
                     rnd.choice(["a", "a", "b", "", None])))
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i, *_ in rows for _ in range(rnd.randint(0, 2))]
    return rows, labels + [(None, 1, 1), (-5, 1, 1)]


@pytest.mark.parametrize("hot_parts", [3, 1000])
def test_audit_equals_the_plain_rule(spark, monkeypatch, hot_parts):
    monkeypatch.setattr(filter_audit, "RANGE", 37)
    monkeypatch.setattr(filter_audit, "HOT_PARTS", hot_parts)
    rows, labels = audit_rows()
    clash = "id string, digest string, part string, fails string, block string, rows string, number string, good string"
    docs = spark.createDataFrame([(*r, *"abcdefgh") for r in rows], f"doc_id long, text string, source string, {clash}")
    marks = spark.createDataFrame([(*r, "x", "y") for r in labels], "doc_id long, quality int, toxic int, id string, good string")
    got = filter_audit.audit(docs.repartition(3), marks)
    collected = got.collect()
    assert len(collected) == 3 * 600 and {tuple(r) for r in collected} == plain_audit(rows, labels)


def test_audit_of_nothing(spark, no_docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, marks, part_col="lang").count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert {tuple(r) for r in filter_audit.audit(one, marks).collect()} == plain_audit([(1, None, None)], [])


def test_lists_hold_a_range_at_most(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 16)
    docs = spark.range(200).selectExpr("id as doc_id", "'#' as text", "'hot' as source")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    posted = filter_audit.postings(docs, marks).collect()
    assert len(posted) == 13 and sum(r["rows"] for r in posted) == 200
    assert all(r["in_D"] == sorted(r["in_D"]) and len(r["in_D"]) == r["rows"] for r in posted)
    assert sorted(x for r in posted for x in r["in_E"]) == list(range(1, 200))


def test_galloping_merges():
    rnd = random.Random(0)
    for _ in range(400):
        top = rnd.choice([5, 60, 5000])
        lists = [np.array(sorted(rnd.sample(range(top), rnd.randint(0, min(top, rnd.choice([3, 60]))))), np.int64) for _ in range(5)]
        a, b = lists[:2]
        assert filter_audit.gallop(a, b).tolist() == [x in set(b.tolist()) for x in a.tolist()]
        assert filter_audit.merge(a, b).tolist() == sorted(set(a.tolist()) | set(b.tolist()))
        got = filter_audit.unions(lists, [lists[4]])
        for bits in range(32):
            u = set().union(*(set(x.tolist()) for k, x in enumerate(lists) if bits >> k & 1))
            assert got[bits].tolist() == [len(u), len(u & set(lists[4].tolist()))]


# ---- SentencePiece --------------------------------------------------------------------------

PARTS = ["a", "b", "word", " Word", "  ", " ", "\n", "\n\n", "\t", "▁", "é", "é", "①", "ｱ", "ﷺ", "　", "日本", "🙂",
         "<0x0A>", "<unk>", "<s>", "\0", "​", "don't", ".", ",", "   ", "x" * 70, "�", "가", "ﬁ", "Å", "﻿"]


def variants():
    """The model as it is, with compiled maps of the library's rules, and with other flags."""
    with open(MODEL, "rb") as f:
        model = f.read()
    spec = lambda name: sentencepiece.SentencePieceNormalizer(rule_name=name).serialized_normalizer_spec()
    return {"own": model, "nmt_nfkc": model + message(NORMALIZER, spec("nmt_nfkc")),
            "nfkc_cf": model + message(NORMALIZER, spec("nfkc_cf")),
            "spaces removed": model + message(NORMALIZER, message(4, 1)), "no prefix": model + message(NORMALIZER, message(3, 0))}


@pytest.mark.parametrize("name", ["own", "nmt_nfkc", "nfkc_cf", "spaces removed", "no prefix"])
@pytest.mark.parametrize("stretch", [4, 1 << 16])
def test_ids_and_spans_are_those_of_whole_texts(monkeypatch, name, stretch):
    monkeypatch.setattr(sentence_pieces, "STRETCH", stretch)
    model = variants()[name]
    mine, lib, rnd = Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model), random.Random(3)
    assert mine.cuts
    for _ in range(1500):
        text = "".join(rnd.choices(PARTS, k=rnd.randint(0, 12)))
        ids, begins, ends = (x.tolist() for x in mine.encode(text))
        want = lib.encode_as_offset_mapping(text.encode())
        assert ids == list(want["ids"]) and mine.decode(ids) == lib.decode(ids)
        whole = [k for k, i in enumerate(ids) if not lib.is_byte(i)]
        assert [(begins[k], ends[k]) for k in whole] == [tuple(want["offsets"][k]) for k in whole]
        # Each byte of a character that the vocabulary lacks has its own place, if no rule changed it.
        if name == "own":
            data = text.encode()
            assert all(data[begins[k]:ends[k]] == bytes([int(lib.id_to_piece(i)[1:-1], 16)])
                       for k, i in enumerate(ids) if lib.is_byte(i))


def test_normalised_texts_are_the_library_s():
    model, rnd = variants()["nmt_nfkc"], random.Random(8)
    mine, lib = Pieces(model), sentencepiece.SentencePieceNormalizer(model_proto=model)
    for _ in range(500):
        text = "".join(rnd.choices(PARTS, k=rnd.randint(0, 12)))
        out, source = mine.normalise(text.encode())
        assert out.decode().replace("▁", " ") == lib.normalize(text).replace("▁", " ")
        assert len(source) == len(out) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


def test_digests_and_round_trip(spark, odd_docs, no_docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = collections.Counter()
    for i, t, _ in odd_rows():
        ids = lib.encode(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))] += 1
    got = sentence_pieces.digests(odd_docs, MODEL).drop("spans_crc32")
    assert collections.Counter(map(tuple, got.collect())) == want
    assert sentence_pieces.digests(no_docs, MODEL).count() == 0
    encoded = sentence_pieces.encode(odd_docs, MODEL)
    back = collections.Counter(map(tuple, sentence_pieces.decode(encoded, MODEL).collect()))
    assert back == collections.Counter((i, lib.decode(lib.encode(t or ""))) for i, t, _ in odd_rows())
    for r in encoded.where("doc_id = 12").collect():
        text = next(t for i, t, _ in odd_rows() if i == 12).encode()
        assert b"".join(text[a:b] for a, b in zip(r["begins"], r["ends"])) == text


def test_suffix_models_are_refused():
    with pytest.raises(ValueError):
        Pieces(variants()["own"] + message(2, bytes([24 << 3 & 127 | 128, 1, 1])))
