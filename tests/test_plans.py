"""Physical-plan properties: pruning at the scan, partial top-k, no cartesian joins."""
import pytest

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_preprocess_reads_only_needed_columns(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["preprocess"](spark, SF001))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scan, plan
    for line in scan:
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in line, line


def test_top_words_uses_partial_window_limit(spark):
    import __spark_entry__ as E
    plan = _final_plan(E.queries()["top_words"](spark, SF001))
    assert "WindowGroupLimit" in plan, plan


@pytest.mark.parametrize("name", ["preprocess", "top_words", "representative_docs", "summarize_topics",
                                  "topic_report", "embed_hashed", "knn_exact", "density_cluster_at",
                                  "assign_topics"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    import __spark_entry__ as E
    plan = _final_plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_reply_lines_are_split_once(spark):
    """Staged parsing: Catalyst must not inline the line split into every use."""
    import __spark_entry__ as E
    df = E.queries()["parse_response"](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4, plan
