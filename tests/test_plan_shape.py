"""Physical-plan checks over every query of the funnel operators."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(q for q in E.queries() if q.startswith("q_")))
def test_no_cartesian_or_python(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_anti_joins_are_explicit(spark):
    for name in ("q_contain_anti", "q_partner_noapp", "q_partner_approved", "q_anti"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan, name


def test_scan_prunes_columns(spark):
    df = E.queries()["q_semi"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
