"""Physical-plan checks over the whole catalogue."""

import pytest

import __spark_entry__ as entry
from keelson.plans.queries import QUERIES
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
# Only a top-k report may gather rows into one partition.
SINGLE_PARTITION_OK = {"head_rows"}
SLOW = {"cv_select", "cv_metrics", "logreg_fit", "logreg_score", "logreg_fit_two", "logreg_score_two",
        "model_roundtrip_two", "cv_metrics_two", "cv_best_two"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_plan_has_no_cross_product_or_single_partition_gather(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.collect()  # the frame's own execution: the adaptive plan read back is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    plan = plan.split("== Initial Plan ==")[0]
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    if name not in SINGLE_PARTITION_OK:
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
                # Allowed only for a global aggregate: one partial row per task.
                below = lines[i + 1] if i + 1 < len(lines) else ""
                assert "Aggregate" in below and "partial_" in below, f"{name}: {line.strip()}"


def test_lookup_reads_only_needed_feature_columns(spark):
    df = entry.queries()["feature_lookup"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan


def test_scaling_fuses_into_scan_stage(spark):
    df = entry.queries()["scaled_feature_matrix"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in plan
