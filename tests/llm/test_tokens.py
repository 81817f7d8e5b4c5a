"""Token ids, counts and packing against the library on whole texts."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from jobmatch.llm import binary_output, packing, token_counts
from jobmatch.llm.common import work_path
from jobmatch.llm.tokens import Encoder, by_bytes
from tests.llm.conftest import odd_rows

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def whole(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_segments_give_the_ids_of_whole_texts(path):
    rnd = random.Random(2)
    parts = ["a", "b", "É", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "don't", ".", "...", "?!", "<|endoftext|>",
             "<|startoftext|>", "1", "22", " ", "　", "\x1c", "́", "e", "ß", "İ", "Σ", "ς", "-", "_", "\0",
             "日本", "🙂", " .", " ,", "word", " Word"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(5000)]
    texts += [t or "" for _, t, _ in odd_rows()]
    enc = Encoder(path)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)] == whole(path, texts)


def test_the_kept_segments_are_bounded_and_come_back(monkeypatch):
    monkeypatch.setattr("jobmatch.llm.tokens.KEPT_SEGMENTS", 50)
    enc, texts = Encoder(BYTES), [f"w{i} common text {i}" for i in range(300)]
    got = [np.frombuffer(enc.ids([t])[0], enc.dtype).tolist() for t in texts]
    assert got == whole(BYTES, texts) and len(enc.known) < 100


def test_batches_are_balanced_by_bytes():
    sizes = [5, 5, 100, 1, 1, 1, 0, 0]
    cuts = list(by_bytes(sizes, 10))
    assert cuts == [(0, 2), (2, 3), (3, 8)] and list(by_bytes([], 10)) == [] and list(by_bytes([0, 0], 1)) == [(0, 2)]


def test_token_counts(odd_docs, no_docs):
    got = collections.Counter(token_counts.token_counts(odd_docs, BYTES).collect())
    rows = odd_rows()
    want = [(i, len((t or "").encode()), len(x), len(x) > 512) for (i, t, _), x in zip(rows, whole(BYTES, [t for _, t, _ in rows]))]
    assert got == collections.Counter(want)
    assert token_counts.token_counts(no_docs, BYTES).count() == 0


def test_binary_round_trip(odd_docs, no_docs):
    rows = sorted(((r[0] is not None, r[0] or 0), r[1]) for r in ((i, t or "") for i, t, _ in odd_rows()))
    got = sorted(binary_output.round_trip(odd_docs, BYTES).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [k[1] if k[0] else None for k, _ in rows]
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = collections.Counter((k[1] if k[0] else None, len(x) + 1, crc(x + [0]))
                              for (k, t), x in zip(rows, whole(BYTES, [t for _, t in rows])))
    assert ids == collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
    assert binary_output.round_trip(no_docs, BYTES).count() == 0


def test_keyed_lookup(spark, odd_docs):
    folder = work_path(spark, "test-ids")
    manifest = binary_output.write_shards(odd_docs, BYTES, folder)
    by_key = collections.defaultdict(list)
    for i, t, _ in odd_rows():
        by_key[i].append(t)
    for key, texts in by_key.items():
        found = binary_output.lookup(spark, manifest, folder, key)
        assert sorted(found) == sorted(x + [0] for x in whole(BYTES, texts))
    assert binary_output.lookup(spark, manifest, folder, 12345) == []


def test_perfect_hash_is_minimal_and_foreign_keys_are_told_apart():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 62, 20_000, np.uint64))
    mph = binary_output.PerfectHash.build(keys)
    assert sorted(mph.number(keys).tolist()) == list(range(len(keys)))
    assert len(binary_output.PerfectHash.build(keys[:0]).number(keys[:0])) == 0


def packed_well(rows, texts, path=WORDS, capacity=2048):
    by_doc, sequences = collections.defaultdict(collections.Counter), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id][(r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    want = collections.defaultdict(collections.Counter)
    for (i, _), ids in zip(texts, whole(path, [t for _, t in texts])):
        ids = ids + [0]
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), capacity)):
            want[i][(k, s, len(ids[s:s + capacity]), crc(ids[s:s + capacity]))] += 1
    assert by_doc == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-total // capacity)


def test_packing(spark, odd_docs, no_docs):
    got, least = packed_well(packing.packed(odd_docs, WORDS).collect(), [(i, t) for i, t, _ in odd_rows()])
    assert got <= least + 1
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got, least = packed_well(packing.packed(docs, WORDS).collect(), texts)
    assert got <= 1.01 * least + 1
    assert packing.packed(no_docs, WORDS).count() == 0


def test_local_search_empties_bins_that_best_fit_leaves():
    """Sizes for which exchanges are needed: 6+4 and 5+5 fill bins, in any starting order."""
    lengths = np.array([6, 5, 5, 4])
    assert len(packing.local_search([[0], [1], [2], [3]], lengths, 10)) == 2
    lengths = np.array([7, 3, 6, 4, 5, 5])
    start = [[0], [1, 2], [3, 4], [5]]
    assert len(packing.local_search(start, lengths, 10)) == 3
    rnd = np.random.default_rng(0)
    for _ in range(30):
        lengths = rnd.integers(1, 40, 60)
        bins = packing.best_fit(lengths, 50)
        better = packing.local_search([list(b) for b in bins], lengths, 50)
        assert len(better) <= len(bins) and sorted(i for b in better for i in b) == list(range(60))
        assert all(lengths[b].sum() <= 50 for b in better)


def thirds_and_halves(bins, capacity, seed):
    """Lengths that fill ``bins`` bins by threes: one near a half of the capacity, two below a third."""
    rnd = np.random.default_rng(seed)
    a = rnd.integers(int(0.38 * capacity), int(0.49 * capacity), bins)
    b = rnd.integers(capacity // 4, (capacity - a) // 2 + 1)
    return rnd.permutation(np.concatenate([a, b, capacity - a - b]))


@pytest.mark.parametrize("bins", [60, 250, 1000])
def test_search_beats_best_fit(bins):
    lengths, steps = thirds_and_halves(bins, 1000, bins), collections.Counter()
    first = packing.best_fit(lengths, 1000)
    assert len(first) > 1.1 * bins
    after = packing.local_search(first, lengths, 1000, steps)
    assert len(after) <= 1.03 * bins + 1 and all(lengths[b].sum() <= 1000 for b in after)
    assert sorted(i for b in after for i in b) == list(range(len(lengths)))
    assert all(steps[kind] for kind in ("1 for 0", "1 for 1", "2 for 1"))


def test_search_is_reported(spark):
    lengths = thirds_and_halves(700, 2048, 7).tolist()
    parts = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                                  "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(parts, group=700).cache()
    told = packing.search_report(rows).first()
    assert told.groups == 3 and 700 <= told.least <= 702 and told.steps > 100
    assert told.bins == rows.select("sequence_id").distinct().count() <= 1.04 * told.least < 1.08 * told.least < told.best_fit_bins
    assert tuple(packing.search_report(rows.limit(0)).first()) == (0, 0, 0, 0, 0)
    rows.unpersist()


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("change", ["no normalizer", "lower case", "pre-tokenizer", "token that takes spaces"])
def test_other_tokenizers_get_no_short_cut(tmp_path, path, change):
    import json
    with open(path) as f:
        steps = json.load(f)
    if change == "no normalizer":
        steps["normalizer"] = {"type": "NFD"} if steps["normalizer"] is None else None
    elif change == "lower case":
        steps["normalizer"] = {"type": "Lowercase"}
    elif change == "pre-tokenizer":
        steps["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    else:
        steps["added_tokens"][0] |= {"lstrip": True, "rstrip": True}
    other = tmp_path / "other.json"
    other.write_text(json.dumps(steps))
    texts = ["Plain Words HERE and École, ÉCOLE.", "a <|endoftext|> b", " two  spaces\nline", "", "don't STOP"]
    enc = Encoder(str(other))
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)] == whole(str(other), texts)


def test_a_segment_is_looked_up_once_for_many_texts():
    class Counted(dict):
        looked = 0

        def __getitem__(self, k):
            Counted.looked += 1
            return dict.__getitem__(self, k)

    enc, texts = Encoder(WORDS), ["alpha beta, \n gamma", "", "alpha alpha " * 500]
    enc.known = Counted()
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)] == whole(WORDS, texts)
    assert Counted.looked < 20


def latin_texts(n=3000):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdeghilmnorstuyÀÉßàçéñöü÷×ªµ", k=rnd.randint(1, 9))).title()
    mark = lambda: rnd.choice(["", "", "", ".", ",", "%%%", "#", "...", "'s", "1", "-", "|"])
    return ["".join(rnd.choice(["\n", " ", " "]) + word() + mark() for _ in range(20))[rnd.randint(0, 1):] for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_are_asked_for_many_at_a_time(path):
    class Counted:
        calls = 0

        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **more):
            Counted.calls += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **more)

    enc, texts = Encoder(path), latin_texts()
    enc.tokenizer, enc.joined = Counted(enc.tokenizer), Counted(enc.joined)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)] == whole(path, texts)
    plain = {w for w in enc.known if w.strip(" ").isascii() and w.strip(" ").isalpha()}
    others = {w for w in enc.known if not w.strip(" ").isalpha() or not all(c.isascii() or c >= "À" for c in w.strip(" "))}
    assert len(plain) > 1000 and Counted.calls < len(others) + 100
    assert not any(w[-1:] == "." and w[:-1].strip(" ").isascii() and w[:-1].strip(" ").isalpha() for w in enc.known)


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("content", ["plain", "rds.", "1"])
def test_added_tokens_of_letters_and_signs_are_found_in_words(tmp_path, path, content):
    t = Tokenizer.from_file(path)
    t.add_special_tokens([content])
    t.save(other := str(tmp_path / "other.json"))
    texts = ["Explained plainly, in plain words.", "words. words", "a1b 1 2 plain", "", "cords.\nrds."]
    enc = Encoder(other)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.ids(texts)] == whole(other, texts)
