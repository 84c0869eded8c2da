import hashlib

import brute
import pytest
from fixture import documents, prose, rows_of, texts
from pyspark.sql import functions as F

from leadlens.llm import queries, suffix_dedup


def summary(done):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows_of(done.select("id", "n_bytes", removed.alias("removed"), F.size("spans").alias("spans"),
                               F.sha2("kept", 256).alias("sha")), "id", "n_bytes", "removed", "spans", "sha")


@pytest.mark.parametrize("batches", [1, 4])
def test_against_brute_force(spark, batches):
    number = F.pmod(F.coalesce(F.col("id"), F.lit(0)), F.lit(batches))
    got = suffix_dedup.deduplicated(documents(spark), number, batches)
    assert summary(got) == sorted(brute.repeated_bytes(texts()), key=repr)


@pytest.mark.parametrize("pairwise, heavy", [(1, 20_000), (1, 2)])
def test_other_ways_for_frequent_grams(spark, monkeypatch, pairwise, heavy):
    monkeypatch.setattr(suffix_dedup, "PAIRWISE", pairwise)
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    shared = prose(90, 1)
    rows = [(k, prose(k % 7, k) + shared[k:len(shared) - 2 * k] + prose(k % 5, 50 + k)) for k in range(24)]
    assert summary(suffix_dedup.deduplicated(documents(spark, rows))) == sorted(brute.repeated_bytes(rows), key=repr)


def test_parts_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 700)
    rows = [(1, prose(900, 1)), (2, prose(300, 2) + prose(900, 1)[500:4000]), (3, "ab" * 900)]
    assert summary(suffix_dedup.deduplicated(documents(spark, rows))) == sorted(brute.repeated_bytes(rows), key=repr)


def test_empty_table(spark):
    assert suffix_dedup.deduplicated(documents(spark, [])).count() == 0


def test_levels_merge_geometrically(spark):
    from leadlens.llm.tables import Scratch
    index = suffix_dedup.LogIndex(Scratch(spark, "test-levels"), 200)
    rows = suffix_dedup.keyed(documents(spark), "doc_id", "text")
    ranks = []
    for b in range(5):
        index.push(rows.where(F.pmod("key", F.lit(5)) == b))
        ranks.append([r for r, _ in index.levels])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0]]


def test_the_query_merges_levels(spark, tmp_dir, monkeypatch):
    documents(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    ranks, push = [], suffix_dedup.LogIndex.push

    def seen(index, rows):
        push(index, rows)
        ranks.append([r for r, _ in index.levels])
    monkeypatch.setattr(suffix_dedup.LogIndex, "push", seen)
    got = queries.op10_suffix_dedup(spark, tmp_dir)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(
        brute.repeated_bytes(texts()), key=repr)
    assert max(max(r) for r in ranks) > 0 and len(ranks[-1]) > 1


def test_kept_bytes_are_the_input_without_the_spans(spark):
    for r in suffix_dedup.deduplicated(documents(spark, [(1, "x" * 250 + "é"), (2, "short")])).collect():
        text = {1: "x" * 250 + "é", 2: "short"}[r["id"]].encode()
        for s in reversed(r["spans"]):
            text = text[:s["start"]] + text[s["end"]:]
        assert hashlib.sha256(text).digest() == hashlib.sha256(bytes(r["kept"])).digest()
