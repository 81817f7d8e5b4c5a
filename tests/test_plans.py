"""Scale helpers: distributed positions, size bounds, spreading."""

import random

from pyspark.sql import functions as F

from jobmatch.plans import ranking, sizing


def test_global_position_many_partitions(spark):
    rnd = random.Random(7)
    rows = [(f"s{i:05d}", rnd.randint(0, 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "skill string, count long").repartition(5)
    out = ranking.global_position(df, [F.desc("count"), F.asc("skill")], num_partitions=7).collect()
    got = {r.skill: r.position for r in out}
    want = {s: i for i, (s, _c) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want


def test_spread_only_small_narrow_inputs(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(5000).coalesce(1)
    assert sizing.spread_if_narrow(one).rdd.getNumPartitions() == cores
    monkeypatch.setattr(sizing, "SPREAD_BYTES", 100)
    assert sizing.spread_if_narrow(one).rdd.getNumPartitions() == 1


def test_running_count_over_runs_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RUN_BUCKETS", 3)
    df = spark.range(500).select((F.col("id") % 2).alias("k"), "id")
    out = ranking.running_count(df, ["k"], [F.col("id")], F.expr("id div 10")).collect()
    assert all(r.running_count == r.id // 2 + 1 for r in out) and len(out) == 500


def test_work_folder_must_be_named_on_a_cluster():
    import pytest
    from jobmatch.session import require_local
    require_local("local[4]")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077", ""):
        with pytest.raises(RuntimeError):
            require_local(master)


def test_empty_vocabulary_tags_nothing(spark):
    from jobmatch.operators.tagging import Vocabulary, tag_skills
    df = spark.createDataFrame([(1, "java and c++")], "id long, text string")
    assert tag_skills(df, "id", Vocabulary.from_list([])).count() == 0


def test_checkpoint_dir_is_read_from_session(spark):
    from jobmatch.session import checkpoint_dir, ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and checkpoint_dir(spark)


def test_vocabulary_bound_is_enforced(spark, monkeypatch):
    import pytest
    from jobmatch.operators import tagging
    monkeypatch.setattr(tagging, "MAX_VOCABULARY_ROWS", 3)
    with pytest.raises(sizing.TooLargeToBroadcast):
        tagging.Vocabulary.from_list(["a", "b", "c", "d"])
    v = spark.createDataFrame([(s,) for s in "abcd"], "skill string")
    with pytest.raises(sizing.TooLargeToBroadcast):
        tagging.prepare_vocabulary(v)
