"""Stored tables read back (S10, K2 history, K3 store)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, skill, tf, idf, weight)``; read once per job or micro-batch."""
    return spark.read.parquet(path)


def read_skill_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("skill", "count", "run_ts")


def read_job_docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
