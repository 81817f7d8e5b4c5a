"""Skill tagger T1: golden case, rule derivation, Arrow fold = native twin."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmatch.operators.tagging import Fold, collect_rules, tag_skills
from jobmatch.sources.vocabulary import DRIVER_VOCABULARY, driver_vocabulary, vocabulary_from_list

GOLDEN = ("C++ and c# / Apache-Spark, sparkling SPARK; ruby-on-rails Ruby on Rails node.js "
          "objective-c aspXnet-mvc")
GOLDEN_TF = {"and": 1, "apache-spark": 3, "asp.net-mvc": 1, "c": 2, "c#": 1, "c++": 1,
             "objective-c": 1, "ruby": 1, "ruby-on-rails": 2, "spark": 2}


def tags(spark, texts, method="arrow", vocab=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    v = vocab if vocab is not None else driver_vocabulary(spark)
    return {(r.id, r.skill): r.tf for r in tag_skills(df, "id", v, method=method).collect()}


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_golden(spark, method):
    got = tags(spark, [GOLDEN, "", None], method)
    assert {s: n for (i, s), n in got.items() if i == 0} == GOLDEN_TF
    assert not any(i in (1, 2) for i, _ in got)


def test_rules_count_and_order(spark):
    rules = collect_rules(driver_vocabulary(spark))
    assert len(rules) == 16
    assert [r[0] for r in rules] == sorted([r[0] for r in rules], key=str.encode)
    assert ("apache-spark", 0, "spark", "regex", False) in rules
    assert ("ruby-on-rails", 2, "ruby on rails", "regex", True) in rules


def test_order_matters_shorter_dashed_skill_first(spark):
    # "de-la" comes before "de-la-soul": the shorter one eats the prefix (Q15)
    v = vocabulary_from_list(spark, ["de-la", "de-la-soul"])
    got = tags(spark, ["de-la-soul"], vocab=v)
    assert got == {(0, "de-la"): 1}


def test_spaced_form_counts_words_again(spark):
    # spaced matches are not removed, so their words count again (Q16)
    v = vocabulary_from_list(spark, ["machine-learning", "machine"])
    got = tags(spark, ["Machine Learning"], vocab=v)
    assert got == {(0, "machine-learning"): 1, (0, "machine"): 1}


def test_upper_case_skill_never_matches(spark):
    v = vocabulary_from_list(spark, ["Java", "java"])
    assert tags(spark, ["JAVA java"], vocab=v) == {(0, "java"): 2}


def test_arrow_equals_native_on_documents(spark):
    from tests.conftest import SF01
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    v = driver_vocabulary(spark)
    a = tag_skills(d, "doc_id", v, method="arrow")
    b = tag_skills(d, "doc_id", v, method="native")
    assert a.count() == 3795
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


_alphabet = st.sampled_from(list("abcdeijlnoprstuvy +#-.,;\n") + ["java", "c++", "de-la", "ruby on rails",
                                                               "asp.net-mvc", "spark", "objective-c"])


@settings(max_examples=60, deadline=None)
@given(st.lists(_alphabet, max_size=40).map("".join))
def test_fold_matches_a_plain_restatement(text):
    """The fold against an independent statement of the rules with Python's re."""
    import re
    rules = [
        ("apache-kafka", r"kafka", False), ("apache-spark", r"spark", False),
        ("asp.net-mvc", r"asp.net-mvc", True), ("asp.net-mvc", r"asp.net mvc", True),
        ("c#", r"c\#", False), ("c++", r"c\+\+", False),
        ("de-la", r"de-la", True), ("de-la", r"de la", True),
        ("machine-learning", r"machine-learning", True), ("machine-learning", r"machine learning", True),
        ("objective-c", r"objective-c", True), ("objective-c", r"objective c", True),
        ("of-the", r"of-the", True), ("of-the", r"of the", True),
        ("ruby-on-rails", r"ruby-on-rails", True), ("ruby-on-rails", r"ruby on rails", True),
    ]
    t = text.lower()
    want = {}
    for skill, pat, rm in rules:
        n = len(re.findall(pat, t))
        if n:
            want[skill] = want.get(skill, 0) + n
            if rm:
                t = t.replace(skill, "")
    spark_rules = [(s, 0, p.replace("\\", ""), "literal" if "\\" in p else "regex", r)
                   for s, p, r in rules]
    for prefilter in (False, True):
        assert Fold(spark_rules, prefilter)(text.lower()) == (t, want)


def test_vocabulary_is_sorted_fixed_list():
    assert DRIVER_VOCABULARY == sorted(DRIVER_VOCABULARY, key=str.encode)
    assert len(DRIVER_VOCABULARY) == 22


def test_native_rules_table_equals_derived_rules(spark):
    """P24 as a Spark projection gives the rules the tagger derives."""
    from jobmatch.operators.tagging import RULE_COLUMNS, derive_rules, rules_table
    from jobmatch.sources.vocabulary import driver_vocabulary_frame
    extra = vocabulary_from_list(spark, ["apache-storm", "f#", "c++-builder", "node.js"])
    v = driver_vocabulary_frame(spark).unionByName(extra)
    native = [tuple(r[c] for c in RULE_COLUMNS) for r in rules_table(v).orderBy("skill", "j").collect()]
    assert native == list(derive_rules([r.skill for r in v.collect()]))


def test_prepare_vocabulary_from_frame_dedups_and_orders(spark):
    from jobmatch.operators.tagging import prepare_vocabulary
    v = vocabulary_from_list(spark, ["of", "and", "", "of", "c++"])
    voc = prepare_vocabulary(v)
    assert voc.skills == ("and", "c++", "of")
    assert [r[0] for r in voc.rules] == ["c++"]


def test_dot_follows_java_line_terminators(spark):
    """"." in a dashed skill is a wildcard but, as in Java, not for any line terminator;
    the Arrow fold and the Java-regex twin agree."""
    v = vocabulary_from_list(spark, ["asp.net-mvc"])
    texts = ["asp\rnet-mvc aspxnet-mvc asp\u2028net-mvc asp\nnet-mvc asp.net-mvc asp net-mvc"]
    for m in ("arrow", "native"):
        # matched: "aspxnet-mvc", "asp.net-mvc" and "asp net-mvc"; not across \r, \u2028, \n
        assert tags(spark, texts, m, vocab=v) == {(0, "asp.net-mvc"): 3}


def test_arrow_equals_java_twin_on_adversarial_texts(spark):
    """Random texts built from fragments that stress the ordered rules: removals that
    fuse neighbours, overlapping literals, wildcard dots, line terminators, accents."""
    import random
    rnd = random.Random(20261203)
    frags = ["de-la", "de la", "de-", "la", "-la", "of-the", "of the", "ofthe", "c++", "c+++", "c#", "c",
             "asp.net-mvc", "asp-net-mvc", "aspxnet mvc", "asp\rnet-mvc", "asp net-mvc",
             "ruby-on-rails", "ruby on rails", "ruby", "apache-spark", "sparkling", "kafka",
             "machine-learning", "machine learning", "objective-c", "objective c", "node.js",
             "Java", "JAVA", "java", "que", "qué", "é", " ", "  ", "\n", "-", ".", ",", "_"]
    texts = ["".join(rnd.choice(frags) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    v = vocabulary_from_list(spark, ["de-la-soul"] + DRIVER_VOCABULARY)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    a = tag_skills(df, "id", v, method="arrow")
    b = tag_skills(df, "id", v, method="native")
    assert a.count() > 100
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_texts_give_no_rows_in_every_path(spark):
    from jobmatch.operators.tagging import tag_stats
    df = spark.createDataFrame([(1, None), (2, "java")], "id long, text string")
    v = vocabulary_from_list(spark, ["java"])
    for m in ("arrow", "native"):
        assert [(r.id, r.skill, r.tf) for r in tag_skills(df, "id", v, method=m).collect()] == [(2, "java", 1)]
    st = {r.id: (r.n_words, r.bag_size) for r in tag_stats(df, "id", v).collect()}
    assert st[2] == (1, 1) and st[1][1] == 0


# ---- vocabularies in parts ----------------------------------------------------------------

FUSING = ["a-b", "ab-cd", "b-c", "c++", "java", "java-script", "of-the", "script", "spark", "x-y", "z-z", "spark-x", "a.-b",
          "(free|form)-one", "q-q", "apache-spark"]


@pytest.mark.parametrize("part_rows", [1, 4, 100])
def test_parts_equal_the_whole_fold(spark, part_rows):
    """Texts whose removals join their sides into matches of rules that were not due before,
    several times over."""
    import random
    from jobmatch.operators.large_vocabulary import tag_skills_in_parts
    rnd = random.Random(part_rows)
    pieces = ["a-b", "x-y", "b-c", "a", "b", "-", "c", "ab-", "cd", " ", "java-", "script", "spark", "q-", "q-q", "q", "z-", "z-z", "z",
              "of the", "of-the", "c++", "(", "free-one", "axxb", "aé-b"]
    texts = ["aa-b-b", "ab-a-bcd", "xx-y-y", "ax-y-b", "q-q-qq", "zz-zz-z-zz", "ab-x-ycd java-x-yscript", "", None, "JAVA Spark"]
    texts += ["".join(rnd.choices(pieces, k=rnd.randint(1, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "due long, text string")
    vocab = spark.createDataFrame([(s,) for s in FUSING + ["", FUSING[0]]], "skill string")
    want = {tuple(r) for r in tag_skills(df, "due", vocab).collect()}
    got = [tuple(r) for r in tag_skills_in_parts(df, "due", vocab, part_rows=part_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_vocabulary_of_300_000_skills(spark):
    """More than one task may hold: the tagger takes the parts by itself."""
    skills = spark.range(300_000).selectExpr("concat(if(id % 3 = 0, 'k-', 'word'), id) as skill")
    texts = [(1, "word1 word1 k-3 k 3 word299999 nothing"), (2, "k-299997, k-29 and word4"), (3, None), (4, "plain")]
    df = spark.createDataFrame(texts, "id long, text string")
    got = {(r.id, r.skill): r.tf for r in tag_skills(df, "id", skills).collect()}
    near = spark.createDataFrame([(s,) for s in ["word1", "k-3", "word299999", "k-299997", "k-29", "k-2", "k-9", "k-27", "k-297",
                                                 "k-2997", "k-29997", "k-299", "k-30", "word4", "k-2999", "k-2999"]], "skill string")
    near = near.join(skills, "skill", "left_semi")
    want = {(r.id, r.skill): r.tf for r in tag_skills(df, "id", near).collect()}
    assert got == want and got[(1, "word1")] == 2


def test_a_batch_of_any_size_is_worked_through_in_slices(spark, monkeypatch):
    import pyarrow as pa
    from jobmatch.operators import large_vocabulary as large, tagging
    from jobmatch.plans.sizing import SLICE_BYTES, batch_slices
    texts = ["java spark x" * 20_000, None, "", "c++ " * 30_000] * 30
    batch = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array(texts)], ["key", "text"])
    slices = list(batch_slices(iter([batch, batch.slice(0, 0)]), 1))
    assert pa.Table.from_batches(slices).equals(pa.Table.from_batches([batch]))
    assert max(sum(len(t or "") for t in s.column(1).to_pylist()) for s in slices) <= SLICE_BYTES
    df = spark.createDataFrame([(1, "java")], "key long, text string")
    made = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: made.append(run) or self)
    tagging.tag_skills(df, "key", driver_vocabulary(spark))
    large._folded(df.selectExpr("key", "text", f"cast(array() as {large.DUE}) due"), 10)
    tagged, folded = made
    assert len(list(tagged(iter([batch])))) == len(slices) > 10
    due = pa.array([[]] * 120, pa.list_(pa.struct([("i", pa.int64())])))
    out = list(folded(iter([pa.RecordBatch.from_arrays([*batch.columns[:1], batch.column(1).fill_null(""), due], ["key", "text", "due"])])))
    assert len(out) == len(slices) and sum(map(len, out)) == 120
