"""What the plans of the training-text queries must not contain."""

import pytest

import corpus_pipeline
from tablespan.llm import queries

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries.JOBS))
def test_no_all_pairs(spark, name):
    text = plan(queries.JOBS[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["op3_chat_formatting", "op8_quality_rules"])
def test_built_in_functions_only(spark, name):
    text = plan(queries.JOBS[name](spark, FOLDER))
    for unwanted in ("EvalPython", "MapInPandas", "MapInArrow", "InPandas", "PythonUDF"):
        assert unwanted not in text


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
