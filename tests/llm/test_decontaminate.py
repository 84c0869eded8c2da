import brute
import numpy as np
import pytest
from fixture import documents, prose, rows_of, texts

from leadlens.llm import decontaminate
from leadlens.llm.fm_index import FMIndex

ITEMS = [(1, prose(80, 1)), (2, prose(40, 2)), (2, "two words"), (3, None), (4, ""), (10, "!!"), (11, "word"),
         (12, prose(13, 8)), (13, prose(12, 4).upper())]


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block", [32_000_000, 200])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    got = decontaminate.contamination(documents(spark), benchmark(spark, ITEMS))
    assert rows_of(got, "id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(
        brute.contamination(texts(), ITEMS), key=repr)
    for r in got.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_empty_tables(spark):
    assert decontaminate.contamination(documents(spark, []), benchmark(spark, ITEMS)).count() == 0
    none = decontaminate.contamination(documents(spark), benchmark(spark, [])).collect()
    assert len(none) == len(texts()) and not any(r["n_hit"] or r["contaminated"] for r in none)


@pytest.mark.parametrize("n, sigma", [(1, 2), (60, 3), (900, 9)])
def test_index_finds_every_occurrence(n, sigma):
    r = np.random.default_rng(n)
    text = np.tile(r.integers(0, sigma, n), 3)
    index = FMIndex(text, sigma)
    for m in (1, 3, 13):
        patterns = np.array([text[a:a + m] for a in r.integers(0, len(text) - m + 1, 20)] if len(text) >= m
                            else np.zeros((0, m), dtype=np.int64)).reshape(-1, m)
        lo, hi = index.search(patterns)
        for p, a, z in zip(patterns, lo, hi, strict=True):
            want = [i for i in range(len(text) - m + 1) if (text[i:i + m] == p).all()]
            assert sorted(index.locate(np.arange(a, z)).tolist()) == want
