"""Plan properties: column pruning reaches the scan, top-k has a group limit, no
nested-loop or cartesian joins."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as e
    return e.queries()


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_tagging_reads_two_columns(spark, qs):
    plan = final_plan(qs["skill_tags"](spark, SF))
    assert read_schemas(plan) == ["struct<doc_id:bigint,text:string>"]


def test_page_names_never_read_html(spark, qs):
    plan = final_plan(qs["pending_pages"](spark, SF))
    assert read_schemas(plan) and all("html" not in s for s in read_schemas(plan))


@pytest.mark.parametrize("name", ["match_top25", "feed_vocab_top25"])
def test_matching_plan(spark, qs, name):
    plan = final_plan(qs[name](spark, SF))
    assert "WindowGroupLimit" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tagging_has_no_exchange(spark):
    from jobmatch.operators.tagging import tag_skills
    from jobmatch.sources.vocabulary import driver_vocabulary
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert "Exchange" not in final_plan(tag_skills(docs, "doc_id", driver_vocabulary(spark)))


def test_page_bodies_are_shuffled_once(spark):
    """With broadcasts off, html is in at most one exchange of the ingest plan."""
    from jobmatch.operators import pages
    from jobmatch.sources import tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs, _ = pages.ingest_pages(tables.raw_pages(spark, SF), tables.stored_names(spark, SF),
                                     F.current_timestamp(), pages.DRIVER_SELECTORS)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = docs._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert exchanges and sum("html" in e for e in exchanges) <= 1


@pytest.mark.parametrize("name", ["category_running_count", "category_rank", "ingest_status",
                                  "skills_current", "word_line_index", "model_weights"])
def test_no_nested_loops(spark, qs, name):
    plan = final_plan(qs[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_document_count_reads_no_columns(spark, qs):
    """The IDF's document count is a scalar subquery over the scan with nothing read."""
    df = qs["model_weights"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = read_schemas(plan)
    assert "struct<>" in schemas
    assert "struct<doc_id:bigint,text:string>" in schemas
