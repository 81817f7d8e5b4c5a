"""A model that grows by runs equals the model of all jobs."""

import pytest

from jobmatch.operators import model
from jobmatch.plans import model_store

SKILLS = ["java", "spark", "of-the", "c++", "ruby"]


@pytest.fixture(scope="module")
def jobs(spark):
    import random
    rnd = random.Random(6)
    words = ["java", "spark", "of the", "of-the", "c++", "ruby", "prose", "and more"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 9)))) for i in range(90)]
    return spark.createDataFrame(rows + [(200, None), (201, "")], "name long, text string")


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(s,) for s in SKILLS], "skill string")


def rows(df):
    return {(r.name, r.skill, r.tf, round(r.idf, 12), round(r.weight, 12)) for r in df.collect()}


def test_two_runs_equal_one_model_of_the_union(spark, jobs, vocab, tmp_path):
    path = str(tmp_path / "store")
    model_store.add_run(jobs.filter("name < 30"), "name", vocab, path, "a")
    first = sorted(p.name for p in (tmp_path / "store/terms/run=a").iterdir())
    model_store.add_run(jobs.filter("name >= 20"), "name", vocab, path, "b")       # 20 to 29 are stored already
    want = rows(model.build_model(jobs, "name", vocab))
    assert rows(model_store.read_model(spark, path, "name")) == want
    assert sorted(p.name for p in (tmp_path / "store/terms/run=a").iterdir()) == first     # not written again
    assert [r.jobs for r in model_store.runs(spark, path).orderBy("run").collect()] == [30, 62]
    model_store.add_run(jobs, "name", vocab, path, "b")                                      # complete: left as it is
    assert rows(model_store.read_model(spark, path, "name")) == want


def test_a_broken_run_is_not_read_and_is_replaced(spark, jobs, vocab, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    model_store.add_run(jobs.filter("name < 30"), "name", vocab, path, "a")
    before = rows(model_store.read_model(spark, path, "name"))
    record = model_store.RUNS
    monkeypatch.setattr(model_store, "RUNS", "broken")
    with monkeypatch.context() as m:
        m.setattr(model_store, "runs", lambda *_: None)
        model_store.add_run(jobs, "name", vocab, path, "b")                       # all but its record
    monkeypatch.setattr(model_store, "RUNS", record)
    assert rows(model_store.read_model(spark, path, "name")) == before
    model_store.add_run(jobs, "name", vocab, path, "b")
    assert rows(model_store.read_model(spark, path, "name")) == rows(model.build_model(jobs, "name", vocab))


def test_odd_runs(spark, jobs, vocab, tmp_path):
    path = str(tmp_path / "store")
    odd = spark.createDataFrame([(1, "java"), (1, "java"), (None, "spark"), (2, None)], "name long, text string")
    model_store.add_run(odd, "name", vocab, path, "a")
    model_store.add_run(odd.limit(0), "name", vocab, path, "empty")
    assert {(r.name, r.skill, r.tf) for r in model_store.read_model(spark, path, "name").collect()} == {(1, "java", 1)}
    assert model_store.idf(spark, path).first().df == 1
    with pytest.raises(ValueError):
        model_store.add_run(jobs, "name", vocab.limit(2), path, "other")
