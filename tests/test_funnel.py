"""Funnel totals (DM7) and the report order (SO1)."""

import datetime as dt

from leadlens.plans.conversion import report_order
from leadlens.plans.funnel import funnel_totals


def test_funnel_totals(spark):
    t = dt.datetime(2014, 1, 1)
    df = spark.createDataFrame(
        [("a", t, "L1"), ("a", None, None), ("b", t, None), ("b", None, "L2")],
        "code string, application_submitted_on timestamp, lease_name string")
    assert tuple(funnel_totals(df).first()) == (2, 2)
    got = {r.code: (r.applications, r.converted) for r in funnel_totals(df, ["code"]).collect()}
    assert got == {"a": (1, 1), "b": (1, 1)}


def test_report_order_nulls_last(spark):
    df = spark.createDataFrame([("b", "x"), (None, "y"), ("a", None), ("a", "c")],
                               "first_name string, last_name string")
    got = [tuple(r) for r in report_order(df).collect()]
    assert got == [("a", "c"), ("a", None), ("b", "x"), (None, "y")]
