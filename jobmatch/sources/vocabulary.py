"""Skill vocabularies (S6, S7, S8) and the stored skill table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The vocabulary of the driver queries (FIXTURES.md section 3),
# 22 skills in ascending byte order, which is also the fold order of the tagger.
DRIVER_VOCABULARY = [
    "and", "apache-kafka", "apache-spark", "asp.net-mvc", "c", "c#", "c++", "de-la",
    "in", "is", "java", "la", "machine-learning", "node.js", "objective-c", "of",
    "of-the", "que", "ruby", "ruby-on-rails", "spark", "the",
]

VOCAB_SCHEMA = T.StructType([T.StructField("skill", T.StringType(), False)])
SKILLS_SCHEMA = "skill string, count bigint, run_ts timestamp"


def vocabulary_from_list(spark: SparkSession, skills: list[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in skills], VOCAB_SCHEMA)


def driver_vocabulary(spark: SparkSession):
    """The fixed driver vocabulary, prepared without any Spark job (``Vocabulary``)."""
    from ..operators.tagging import Vocabulary
    return Vocabulary.from_list(DRIVER_VOCABULARY)


def driver_vocabulary_frame(spark: SparkSession) -> DataFrame:
    return vocabulary_from_list(spark, DRIVER_VOCABULARY)


def clean_vocabulary(df: DataFrame, col: str = "skill") -> DataFrame:
    """One row per non-empty skill (map keys are unique; empty skills dropped)."""
    return (df.select(F.col(col).alias("skill"))
              .filter(F.col("skill").isNotNull() & (F.length("skill") > 0))
              .distinct())


def _csv_first_field(spark: SparkSession, path: str) -> DataFrame:
    """First field of every line of a headerless CSV (quoted fields decoded)."""
    return spark.read.csv(path, schema="skill string, rest string", header=False,
                          mode="PERMISSIVE", ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False).select("skill")


def read_skills_csv(spark: SparkSession, path: str) -> DataFrame:
    """``skill,count`` lines; only the first field is kept and every count starts
    at 0 (counts are per run).  A missing path is an empty vocabulary."""
    from pyspark.errors import AnalysisException
    try:
        first = _csv_first_field(spark, path)
        first.schema  # noqa: B018 -- resolves the path now
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], "skill string, count bigint")
        raise
    return (first.filter(F.col("skill").isNotNull() & (F.length("skill") > 0)).distinct()
                 .select("skill", F.lit(0).cast("bigint").alias("count")))


def read_skills_csv_lower(spark: SparkSession, path: str) -> DataFrame:
    """First CSV field, lower-cased, non-empty."""
    return clean_vocabulary(_csv_first_field(spark, path).select(F.lower("skill").alias("skill")))


def read_skill_keys(spark: SparkSession, skills_table: str) -> DataFrame:
    """Key-only scan of the stored skill table (column pruning reads one column)."""
    return clean_vocabulary(spark.read.parquet(skills_table).select("skill"))


def decode_key(key_col) -> F.Column:
    """Row-key bytes to string."""
    return F.decode(key_col, "UTF-8")
