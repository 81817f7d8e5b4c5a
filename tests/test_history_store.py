"""Compaction of the skill history."""

import os

import pytest

from jobmatch.operators import skills
from jobmatch.plans import history_store

DAY = "2026-12-{:02d}T00:00:00Z".format


def add(spark, path, day, counts):
    history_store.append_run(spark.createDataFrame(list(counts.items()), "skill string, count long"), path, DAY(day))


def versions(spark, path):
    out = {}
    for r in history_store.read_history(spark, path).orderBy("skill", "run_ts").collect():
        out.setdefault(r["skill"], []).append((r["run_ts"].day, r["count"]))
    return out


def test_history_is_the_same_before_and_after(spark, tmp_path):
    path = str(tmp_path / "h")
    assert history_store.read_history(spark, path).count() == 0 and history_store.compact(spark, path, 2) == 0
    add(spark, path, 1, {"java": 1, "c": 5, None: 9})
    add(spark, path, 2, {"java": 2})
    before = versions(spark, path)
    assert before == {"java": [(1, 1), (2, 2)], "c": [(1, 5)]}
    assert history_store.compact(spark, path, 2) == 1 and versions(spark, path) == before
    assert history_store.compact(spark, path, 2) == 1                      # nothing new
    add(spark, path, 3, {"java": 3, "c": 6})
    current = sorted(map(tuple, skills.current_counts(history_store.read_history(spark, path)).collect()))
    assert history_store.compact(spark, path, 2) == 2
    assert versions(spark, path) == {"java": [(2, 2), (3, 3)], "c": [(1, 5), (3, 6)]}
    assert sorted(map(tuple, skills.current_counts(history_store.read_history(spark, path)).collect())) == current
    after = versions(spark, path)
    assert history_store.clear(spark, path) == 8                           # three runs and a snapshot, with their records
    assert versions(spark, path) == after and history_store.clear(spark, path) == 0
    assert [f for f in os.listdir(f"{path}/{history_store.SNAPSHOTS}")] == ["snap=2"]
    add(spark, path, 1, {"java": 100})                                     # covered: left as it is
    assert versions(spark, path) == after
    with pytest.raises(ValueError):
        history_store.compact(spark, path, 0)


def test_what_was_not_recorded_does_not_count(spark, tmp_path):
    path = str(tmp_path / "h")
    add(spark, path, 2, {"java": 2})
    one = spark.createDataFrame([("java", 7)], "skill string, count long").selectExpr("*", "timestamp '2026-12-03' as run_ts")
    one.write.parquet(f"{path}/{history_store.RUNS}/run=1796256000000000")      # lost before its record
    one.write.parquet(f"{path}/{history_store.SNAPSHOTS}/snap=1")               # a snapshot without its list
    assert versions(spark, path) == {"java": [(2, 2)]}
    add(spark, path, 1, {"java": 1})                                            # a run that arrives late
    history_store.compact(spark, path, 1)
    assert versions(spark, path) == {"java": [(2, 2)]}
    add(spark, path, 3, {"java": 3})
    assert versions(spark, path) == {"java": [(2, 2), (3, 3)]}
