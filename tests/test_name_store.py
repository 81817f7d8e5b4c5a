"""Probing a document store by Bloom filters."""

import pytest
from pyspark.sql import functions as F

from jobmatch.plans import name_store


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    """Two runs of many buckets."""
    monkeypatch.setattr(name_store, "BUCKET_NAMES", 20)
    path = str(tmp_path / "store")
    for run, low, high in (("a", 0, 400), ("b", 400, 500)):
        name_store.store_run(spark.range(low, high).selectExpr("concat('n', id) as doc_name", "id as body"), path, run)
    return path


@pytest.mark.parametrize("probed, listed_buckets", [(500_000, 5_000), (50, 3)])
def test_pending_is_the_anti_join(spark, store, monkeypatch, probed, listed_buckets):
    monkeypatch.setattr(name_store, "PROBED_NAMES", probed)
    monkeypatch.setattr(name_store, "LISTED_BUCKETS", listed_buckets)
    names = [f"n{i}" for i in range(300, 900, 7)] * 2 + [None, "", "other"]
    listed = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "doc_name string, bucket int").repartition(3)
    got = sorted(tuple(r) for r in name_store.pending(listed, store).collect())
    known = {f"n{i}" for i in range(500)}
    assert got == sorted((n, i) for i, n in enumerate(names) if n is not None and n not in known)


def test_only_hit_buckets_are_read(spark, store):
    done = name_store.runs(spark, store)
    assert [(r["run"], r["docs"], r["buckets"]) for r in done] == [("a", 400, 20), ("b", 100, 5)]
    listed = spark.createDataFrame([("n7",), ("n7777",)], "doc_name string")
    hits = name_store.maybe_stored(listed, store, done)
    assert "n7" in {r.doc_name for r in hits.collect()} and hits.count() <= 3
    names = name_store.stored_names(spark, store, hits.filter("doc_name = 'n7'"), done)
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(names.inputFiles()) >= 1 and names.select("run", "bucket").distinct().count() == 1
    assert 0 < names.count() < 60


def test_filters_know_every_name_and_few_others(spark, store):
    done = name_store.runs(spark, store)
    all_ = spark.range(500).selectExpr("concat('n', id) as doc_name")
    assert name_store.maybe_stored(all_, store, done).select("doc_name").distinct().count() == 500
    others = spark.range(10_000).selectExpr("concat('other', id) as doc_name")
    assert name_store.maybe_stored(others, store, done).count() < 400      # two runs, about 0.5 % each


def test_runs_that_are_broken_or_repeated(spark, store):
    before = spark.createDataFrame([("n1",), ("new",)], "doc_name string")
    name_store.store_run(before, store, "a")                                    # complete: left as it is
    assert {r.doc_name for r in name_store.pending(before, store).collect()} == {"new"}
    before.write.parquet(f"{store}/docs/run=c")                                  # broken: no record
    assert {r.doc_name for r in name_store.pending(before, store).collect()} == {"new"}
    name_store.store_run(before.filter("doc_name = 'new'"), store, "c")
    assert name_store.pending(before, store).count() == 0
    name_store.store_run(before.limit(0), store, "empty")
    assert name_store.pending(before, store).count() == 0


def test_an_empty_store(spark, tmp_path):
    listed = spark.createDataFrame([("x",), (None,)], "doc_name string")
    assert [r.doc_name for r in name_store.pending(listed, str(tmp_path / "none")).collect()] == ["x"]
