"""Native column functions."""

import datetime as dt

from pyspark.sql import functions as F

from jobmatch.functions import text as T
from jobmatch.sources.vocabulary import decode_key


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first().o


def test_splits(spark):
    v = F.col("v")
    assert one(spark, T.split_keep_empty(v, " "), "a  b ") == ["a", "", "b", ""]
    assert one(spark, T.split_words_nonempty(v, " "), "a  b ") == ["a", "b"]
    assert one(spark, T.split_keep_empty(v, ":"), "root:x::0") == ["root", "x", "", "0"]
    assert one(spark, T.split_keep_empty(v, "."), "a.b") == ["a", "b"]      # literal, not regex
    assert one(spark, T.non_word_tokens(v), "c++ and,c#") == ["c", "and", "c", ""]


def test_fields_names_trim(spark):
    v = F.col("v")
    assert one(spark, T.first_csv_field(v), "java,12") == "java"
    assert one(spark, T.base_name(v), "s3n://opps/jobs_sof/1_a") == "1_a"
    assert one(spark, T.trim_space_newline(v), " \n Austin, TX\t\n ") == "Austin, TX\t"
    assert one(spark, T.ascii_strip(v), "caf\u00e9\n\tx\x7f") == "cafx"
    assert one(spark, decode_key(v), b"c++", "v binary") == "c++"


def test_result_line_round_trip(spark):
    df = spark.createDataFrame([("103310_a", 0.5)], "n string, s double")
    line = df.select(T.result_line(F.col("n"), F.col("s")).alias("l")).first().l
    assert line == "103310_a\t0.500000"
    assert one(spark, T.result_line_name(F.col("v")), line) == "103310_a"


def test_elapsed_seconds(spark):
    a, b = dt.datetime(2026, 1, 1, 0, 0, 0), dt.datetime(2026, 1, 1, 0, 1, 5)
    df = spark.createDataFrame([(a, b)], "s timestamp, e timestamp")
    assert df.select(T.elapsed_seconds(F.col("s"), F.col("e"))).first()[0] == 65


def test_feeds_table_and_lower_vocabulary(spark, tmp_path):
    from jobmatch.sources.feeds import feeds_table
    from jobmatch.sources.vocabulary import read_skills_csv_lower
    f = feeds_table(spark, ["u0", "u1"]).collect()
    assert [(r.feed_index, r.url) for r in f] == [(0, "u0"), (1, "u1")]
    p = tmp_path / "skills.csv"
    p.write_text("Java,3\nC++,2\n,1\njava,0\n")
    got = sorted(r.skill for r in read_skills_csv_lower(spark, str(p)).collect())
    assert got == ["c++", "java"]


def test_extra_literals_make_node_js_findable(spark):
    """Q18: ``node.js`` never matches by default; ``literals=`` extends the quoted list."""
    from jobmatch.operators.tagging import QUOTED_LITERALS, tag_skills
    from jobmatch.sources.vocabulary import vocabulary_from_list
    df = spark.createDataFrame([(1, "Node.js and node.js")], "id long, text string")
    v = vocabulary_from_list(spark, ["node.js"])
    assert tag_skills(df, "id", v).count() == 0
    got = tag_skills(df, "id", v, literals=QUOTED_LITERALS + ("node.js",)).collect()
    assert [(r.skill, r.tf) for r in got] == [("node.js", 2)]


def test_clean_and_unescape_column_functions(spark):
    from jobmatch.functions.clean import clean_text, unescape_html
    df = spark.createDataFrame([("café …\t&amp;amp;",), (None,)], "v string")
    got = df.select(clean_text("v").alias("c")).select("c", unescape_html("c").alias("u")).collect()
    assert (got[0].c, got[0].u) == ("cafe ...&amp;amp;", "cafe ...&amp;")
    assert got[1].c is None and got[1].u is None


def test_sorted_skills_and_sharded_lines(spark, tmp_path):
    from jobmatch.operators.skills import sorted_skills
    from jobmatch.sources.text import text_lines
    c = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "skill string, count long")
    assert [r.skill for r in sorted_skills(c).collect()] == ["c", "a", "b"]
    p = tmp_path / "t.txt"
    p.write_text("x y\n# c\nz\n")
    lines = text_lines(spark, str(p), shards=3)
    assert lines.rdd.getNumPartitions() == 3 and sorted(r.line for r in lines.collect()) == ["# c", "x y", "z"]
