import hashlib
import re

import numpy as np
import pytest
from fixture import documents, rows_of, texts
from pyspark.sql import functions as F

from leadlens.llm import exact_dedup, fuse_filter


def expected(rows):
    plain = [(d, t or "", re.sub(r"[\x20\x09-\x0D]", "", t or "")) for d, t in rows]
    out = []
    for d, t, norm in plain:
        own = [(-len(u), e is None, e or 0, e) for e, u, m in plain if m == norm]
        keep = min(own, key=lambda x: x[:3])[3]
        out.append((d, hashlib.sha256(norm.encode()).hexdigest(), keep, len(own), d == keep))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["id % 2 = 1", "true", "false", "id > 8"])
def test_any_split_into_snapshot_and_batch_gives_the_same_groups(spark, split):
    done = exact_dedup.dedup(documents(spark), F.coalesce(F.expr(split), F.lit(False)))
    assert rows_of(done, "id", "sha", "keep_id", "group_size", "kept") == expected(texts())


def test_rows_that_repeat_an_id_with_another_text(spark):
    rows = [(1, "a b"), (1, "ab"), (2, "ab"), (3, "x"), (3, "x"), (4, "x "), (None, "ab"), (5, "other"), (5, "texts")]
    done = exact_dedup.dedup(documents(spark, rows), F.coalesce(F.col("id") % 2 == 1, F.lit(False)))
    texts_of = documents(spark, rows).select(exact_dedup.row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").distinct()
    got = sorted(((r["text"], r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in done.join(texts_of, "key").collect()),
                 key=repr)
    assert got == sorted([("a b", 1, 1, 4, True), ("ab", 1, 1, 4, False), ("ab", 2, 1, 4, False), ("ab", None, 1, 4, False),
                          ("x", 3, 4, 3, False), ("x", 3, 4, 3, False), ("x ", 4, 4, 3, True),
                          ("other", 5, 5, 1, True), ("texts", 5, 5, 1, True)], key=repr)


def test_a_full_screen_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SCREEN_WORDS", 1)
    done = exact_dedup.dedup(documents(spark), F.coalesce(F.expr("id % 2 = 1"), F.lit(False)))
    assert rows_of(done, "id", "sha", "keep_id", "group_size", "kept") == expected(texts())


def test_empty_table(spark):
    assert exact_dedup.dedup(documents(spark, []), F.col("id") > 2).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 5000])
def test_fuse_filter_has_every_key_and_few_others(n):
    r = np.random.default_rng(n)
    keys = r.integers(-2**63, 2**63 - 1, n, dtype=np.int64)
    f = fuse_filter.build(np.concatenate((keys, keys)))
    assert f.may_contain(keys).all()
    assert f.may_contain(r.integers(-2**63, 2**63 - 1, 20_000, dtype=np.int64)).mean() < 0.01


def test_screen_keeps_every_known_digest(spark):
    rows = exact_dedup.buckets(exact_dedup.digests(documents(spark)))
    for shards in (1, 3):
        found = exact_dedup.screen(rows, exact_dedup.filters(rows, shards), shards)
        assert found.count() == rows.select("d64").distinct().count()
