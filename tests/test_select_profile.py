"""Per-key selection, survivor dedup and profile aggregates."""

import datetime as dt

from pyspark.sql import functions as F

from leadlens.operators import profile as P
from leadlens.operators import select as S


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, "k", 10.0), (2, "k", 20.0), (3, None, 5.0), (4, None, 6.0)],
                               "id long, k string, v double")
    got = sorted(tuple(r) for r in S.latest_per_key(df, "k", "id").select("id", "k", "v").collect())
    assert got == [(2, "k", 20.0), (4, None, 6.0)]
    got = sorted(r["id"] for r in S.first_per_key(df, "k", "id").collect())
    assert got == [1, 3]


def test_survivor_dedup(spark):
    t0 = dt.datetime(2014, 1, 1)
    rows = spark.createDataFrame(
        [(1, "x", t0, None, None),            # first copy of identity x: kept
         (2, "x", t0 + dt.timedelta(1), 20, True),   # later copy, processed: kept
         (3, "x", t0 + dt.timedelta(2), None, None),  # later copy, unprocessed: dropped
         (4, "y", t0, 40, None), (4, "y", t0, 41, None)],  # two unprocessed applicants: drops itself
        "id long, k string, created timestamp, applicant long, keep boolean")
    base = rows.select("id").distinct()
    out = S.survivor_dedup(rows, base, id_col="id", keys=["k"],
                           order=["created", "id", "applicant"],
                           keep_if=F.col("keep"))
    assert sorted(r[0] for r in out.collect()) == [1, 2]


def test_flag_latest(spark):
    df = spark.createDataFrame([(1, 7, "a"), (2, 7, "b"), (3, 7, "a"), (4, 8, "b")],
                               "id long, u long, t string")
    out = S.flag_latest(df, key="u", id_col="id", when=F.col("t") == "a", flag="f")
    assert sorted((r["id"], r["f"]) for r in out.collect()) == [(1, False), (2, False), (3, True), (4, False)]


def test_band_counts_boundaries(spark):
    # ages in 365-day years: exactly 1, 3, 5, 10, negative, NULL
    ages = [1.0, 3.0, 5.0, 10.0, 10.5, -0.5, None, 2.0]
    df = spark.createDataFrame([("r", a) for a in ages], "k string, age double")
    r = df.groupBy("k").agg(*P.band_counts(F.col("age"), [1, 3, 5, 10], "ev")).first()
    assert (r.ev_total, r.ev_0_1, r.ev_1_3, r.ev_3_5, r.ev_5_10, r.ev_10_plus) == (8, 2, 2, 1, 1, 1)
    assert sum([r.ev_0_1, r.ev_1_3, r.ev_3_5, r.ev_5_10, r.ev_10_plus]) == 7  # non-NULL ages


def test_lists(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "b", 3), (1, None, 4), (2, None, 1)],
                               "k long, v string, o long")
    rows = {r["k"]: r for r in df.groupBy("k").agg(
        P.distinct_list("v").alias("d"), P.ordered_list("v", ["o"]).alias("o"),
        P.sum_when(F.col("v") == "b").alias("s")).collect()}
    assert (rows[1].d, rows[1].o, rows[1].s) == ("a,b", "a,b,b", 2)
    assert (rows[2].d, rows[2].o, rows[2].s) == (None, None, 0)
