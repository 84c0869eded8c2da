import random

import brute
import pytest
from fixture import documents, rows_of, texts
from pyspark.sql import functions as F

from leadlens.llm import simhash
from leadlens.llm.components import connected_components
from leadlens.llm.tables import Scratch


def groups(df):
    return rows_of(df.withColumn("fp", F.lower(F.lpad(F.hex("fp"), 16, "0"))), "id", "fp", "component_id")


def test_against_all_pairs(spark):
    named = [(d, t) for d, t in texts() if d is not None]
    want = brute.near_groups(list(dict(named).items()))
    got = groups(simhash.near_duplicates(documents(spark, list(dict(named).items()))))
    assert got == sorted(want, key=repr)


def test_null_ids_and_repeated_rows_join_their_group(spark):
    got = {(r["id"], r["component_id"]) for r in simhash.near_duplicates(documents(spark)).collect()}
    assert (None, 1) in got and (None, 4) in got and (19, 1) in got


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [4096, 3])
def test_links_join_all_close_pairs_with_either_way(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    r = random.Random(5)
    fps = set()
    for _ in range(6):
        base = r.getrandbits(64)
        for _ in range(12):
            base ^= sum(1 << b for b in r.sample(range(64), r.randrange(1, 6)))
            fps.add(base)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = [tuple(x) for x in simhash.links(df, 4).collect()]
    back = {s: f for f, s in signed.items()}
    assert all((back[a] ^ back[b]).bit_count() <= 4 for a, b in links)
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[root(back[a])] = root(back[b])
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                assert root(a) == root(b)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, x) for x in range(101, 140)]
    links = spark.createDataFrame([*chain, *star, (200, 200), (139, 141)], "a long, b long")
    found = connected_components(Scratch(spark, "test-components"), links)
    assert dict(map(tuple, found.collect())) == {**{i: 0 for i in range(1, 41)},
                                                 **{x: 100 for x in (*range(101, 140), 141)}}
