"""Containment match join: blocked plan equals naive plan; edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from leadlens.operators import match
from leadlens.operators.match import containment_join

SCHEMA = "id long, fn string, ln string, m string, h string, w string, c string, p boolean, d date"
PH = ["m", "h", "w"]


def people(spark, rows):
    out = []
    for r in rows:
        i, fn, ln, m, h, w, p, d = r
        c = "".join(x or "" for x in (m, w, h))
        out.append((i, fn, ln, m, h, w, c, p, d))
    return spark.createDataFrame(out, SCHEMA)


def rand_rows(seed, n=60):
    rnd = random.Random(seed)
    phones = ["3125550001", "3125550002", "312555000", "3125550001x2", "55500013125", "", None,
              "1234567890123", "0001312555"]
    out = []
    for i in range(n):
        out.append((i, rnd.choice(["a", "b"]), "z", rnd.choice(phones), rnd.choice(phones),
                    rnd.choice(phones), rnd.random() < 0.3, None))
    return out


def run(spark, l, r, how, blocked, **kw):
    out = containment_join(l, r, on=["fn", "ln"], left_id="id", right_id="id",
                           left_phones=PH, right_phones=PH, left_combined="c",
                           right_combined="c", how=how, blocked=blocked, **kw)
    cols = ["id", "r_id"] if how in ("left", "inner") else ["id"]
    return sorted(tuple(x) for x in out.select(*cols).collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_blocked_equals_naive(spark, seed, how):
    p = people(spark, rand_rows(seed))
    for kw in ({}, {"exclude_self": True}, {"exclude_self": True, "right_filter": F.col("p")},
               {"direction": "l_in_r"}):
        assert run(spark, p, p, how, True, **kw) == run(spark, p, p, how, False, **kw), kw


def test_edge_cases(spark):
    rows = [
        (1, "ann", "lee", "3125550001", None, None, False, None),      # plain
        (2, "ann", "lee", "9999999999", "3125550001", None, False, None),  # right longer
        (3, "ann", "lee", "0001312555", None, None, False, None),      # seam of 1+1 only
        (4, "bob", "lee", "3125550001", None, None, False, None),      # other name
        (5, "ann", "lee", "312555000", None, None, False, None),       # too short
        (6, "ann", "lee", "5550001999", None, None, False, None),      # seam inside 2's combined
    ]
    p = people(spark, rows)
    got = run(spark, p, p, "inner", True, exclude_self=True)
    # 1 <-> 2: 1's phone lies inside 2's longer combined "99999999993125550001".
    # 3 and 6 hold the same digits only across a seam or shifted: no match.
    assert (1, 2) in got and (2, 1) in got
    assert all(3 not in pair and 6 not in pair for pair in got)
    assert all(4 not in pair for pair in got) and all(5 not in pair for pair in got)
    assert got == run(spark, p, p, "inner", False, exclude_self=True)


def test_processed_pair_removes_each_other(spark):
    rows = [(1, "a", "b", "3125550001", None, None, True, None),
            (2, "a", "b", "3125550001", None, None, True, None),
            (3, "a", "b", "7775550001", None, None, True, None)]
    p = people(spark, rows)
    got = run(spark, p, p, "left_anti", True, exclude_self=True, right_filter=F.col("p"))
    assert got == [(3,)]   # 1 and 2 vanish; 3 only matches itself


def test_id_less_sides_keep_multiplicity(spark):
    l = people(spark, [(1, "a", "b", "3125550001", None, None, False, None)] * 2)
    r = people(spark, [(7, "a", "b", "3125550001", None, None, False, None)] * 3)
    out = containment_join(l, r, on=["fn", "ln"], left_id=None, right_id=None,
                           left_phones=PH, right_phones=PH, left_combined="c",
                           right_combined="c", how="left")
    assert out.count() == 6


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("direction", ["longer", "l_in_r"])
def test_containment_min_equals_min_over_pairs(spark, seed, direction):
    from leadlens.operators.match import containment_min
    p = people(spark, rand_rows(seed))
    got = containment_min(p, p, on=["fn", "ln"], left_id="id", left_phones=PH, right_phones=PH,
                          left_combined="c", right_combined="c", value="id",
                          direction=direction, out="m")
    pairs = containment_join(p, p, on=["fn", "ln"], left_id="id", right_id="id",
                             left_phones=PH, right_phones=PH, left_combined="c",
                             right_combined="c", how="inner", direction=direction, blocked=False)
    want = pairs.groupBy("id").agg(F.min("r_id").alias("m"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture
def small_parts(monkeypatch):
    for name, value in {"SMALL_BYTES": 0, "HOT_ROWS": 6, "HOT_PARTS": 4, "COUNT_ONE_IN": 1}.items():
        monkeypatch.setattr(match, name, value)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_names_dealt_over_parts_give_the_same(spark, small_parts, how):
    p = people(spark, rand_rows(5, 90))
    for kw in ({}, {"exclude_self": True}, {"exclude_self": True, "right_filter": F.col("p")},
               {"direction": "l_in_r"}):
        assert run(spark, p, p, how, True, **kw) == run(spark, p, p, how, False, **kw), kw


def test_least_values_over_parts_are_the_same(spark, small_parts, monkeypatch):
    p = people(spark, rand_rows(6, 90))
    spec = dict(on=["fn", "ln"], left_id="id", left_phones=PH, right_phones=PH, left_combined="c", right_combined="c",
                value="id", out="least")
    dealt = sorted(map(tuple, match.containment_min(p, p, **spec).collect()))
    monkeypatch.setattr(match, "SMALL_BYTES", 1 << 60)
    assert dealt == sorted(map(tuple, match.containment_min(p, p, **spec).collect())) != []


def test_an_identity_with_a_third_of_the_rows_meets_in_no_single_task(spark, monkeypatch):
    monkeypatch.setattr(match, "SMALL_BYTES", 0)
    monkeypatch.setattr(match, "HOT_ROWS", 100)
    monkeypatch.setattr(match, "COUNT_ONE_IN", 1)
    rows = [(i, "hot" if i % 3 == 0 else f"n{i}", "z", "3125550001" if i % 3 == 0 else f"312{i:07d}", None, None, False, None)
            for i in range(3000)]
    p = people(spark, rows)
    hot = match._hot_names(["fn", "ln"], p, "id", p, "id")
    assert [(r.fn, r._lparts, r._rparts) for r in hot.collect()] == [("hot", 10, 10)]
    a = match._explode_needles(p, PH)
    b = match._explode_slices(p.select("fn", "ln", "c", F.col("id").alias("r_id")), "c")
    met = match._dealt_join(a, "id", b, "r_id", ["fn", "ln"], hot).where("fn = 'hot'")
    assert met.count() == 1000 * 1000
    parts = met.groupBy("_lp", "_rp").agg(F.count_distinct("id").alias("l"), F.count_distinct("r_id").alias("r")).collect()
    assert len(parts) == 100 and max(max(x.l, x.r) for x in parts) < 200      # a tenth of each side, about
    assert run(spark, p, p, "left_semi", True, exclude_self=True) == [(i,) for i in range(0, 3000, 3)]


def test_slices_without_a_needle_are_screened_out(spark):
    from leadlens.operators.screen import screen, screened
    needles = spark.range(500).select(F.col("id").cast("string").alias("fn"), F.lpad("id", 10, "0").alias("_k"))
    slices = spark.range(50_000).select(F.col("id").cast("string").alias("fn"), F.lpad("id", 10, "0").alias("_k"))
    kept = screened(slices, ["fn", "_k"], screen(needles, ["fn", "_k"]))
    assert kept.join(needles, ["fn", "_k"]).count() == 500 and kept.count() < 520
    assert screened(slices, ["fn", "_k"], screen(needles, ["fn", "_k"], 4), 4).count() > 40_000      # full, but complete
    assert screened(slices, ["fn", "_k"], screen(needles.where("false"), ["fn", "_k"])).count() == 0
