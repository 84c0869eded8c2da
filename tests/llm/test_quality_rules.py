import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from fixture import documents, prose, texts

from leadlens.llm import quality_rules
from leadlens.llm.anchors import GRAMS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0D\x00]+")
MASK = (1 << 64) - 1


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def brute_buckets(text):
    h = []
    for m in TOKEN.findall((text or "").encode()):
        data = np.frombuffer(m, dtype=np.uint8)
        h.append(int(GRAMS.of(GRAMS.sums(data), np.array([0]), np.array([len(data)]))[0]))
    pairs = []
    for a, b in zip(h, h[1:]):
        x = (a * 0x9E3779B97F4A7C15 & MASK) ^ (b + (b << 7 & MASK) & MASK)
        pairs.append((x ^ x >> 29) * 0xBF58476D1CE4E5B9 & MASK)
    return [(x >> 32) % quality_rules.BUCKETS for x in h + pairs]


def brute_scores(rows, trusted):
    p, q = Counter(), Counter()
    for d, t in rows:
        q.update(brute_buckets(t))
        if d in trusted:
            p.update(brute_buckets(t))
    n = quality_rules.BUCKETS
    ratio = lambda b: math.log((p[b] + 1) / (p.total() + n)) - math.log((q[b] + 1) / (q.total() + n))
    return [sum(map(ratio, g)) / len(g) if (g := brute_buckets(t)) else 0.0 for _, t in rows]


def corpus(n=160):
    r = random.Random(5)
    rows = []
    for k in range(n):
        t = prose(r.randrange(55, 120), 100 + k)
        rows.append((k, t if k % 4 else " | ".join(t.split(" "))))
    return rows


def labels_of(spark, rows):
    return spark.createDataFrame([(d, None if d % 10 == 9 else int(d % 4 > 0), "clash", 1) for d, _ in rows] + [(None, 1, "", 0)],
                                 "doc_id long, quality int, text string, id int")


@pytest.mark.parametrize("text", [None, "", " \x0b\x0c ", "a b c a b c", "a a a a", "#x\n#x\n \n\n#x", "é é x y",
                                  "one\ntwo\none\r\none", *(t for _, t in texts())])
def test_base_equals_plain_counts(text):
    assert quality_rules.base(text or "") == brute_base(text)


def test_base_of_random_words():
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice(["a", "b", "c", "#", "\n", " ", " ", "\t", "é"]) for _ in range(r.randrange(60)))
        assert quality_rules.base(t) == brute_base(t), t


def test_ngrams_of_pieces_equal_plain_ones(monkeypatch):
    rows = [t or "" for _, t in texts()] + ["x" * 500 + " y%%z " * 40, "a|b", "__ _a"]
    for block in (97, 1 << 20):
        monkeypatch.setattr(quality_rules, "BLOCK", block)
        got = [Counter() for _ in rows]
        for buckets, owner in quality_rules.ngrams(rows):
            for b, k in zip(buckets.tolist(), owner.tolist()):
                got[k][b] += 1
        for t, g in zip(rows, got):
            if block > 97 or max(map(len, t.split()), default=0) < 90:      # longer words are cut
                assert g == Counter(brute_buckets(t))


def test_verdicts_equal_brute_force_and_hold_out(spark):
    odd = [(1000, None), (1001, ""), (1002, "| | |"), (1003, " ".join(["word"] * 80)), (1004, prose(40_000, 9)), (None, prose(70, 1)),
           (5, prose(70, 2)), (5, prose(70, 2))]
    rows = corpus() + odd
    docs, labels = documents(spark, rows), labels_of(spark, corpus())
    model = quality_rules.fit(docs, labels)
    got = quality_rules.judged(docs, model).collect()
    assert len(got) == len(rows)
    held = {r["doc_id"] for r in docs.where(quality_rules.held_out(docs["doc_id"])).select("doc_id").collect()}
    trusted = {d for d, _ in corpus() if d % 4 and d % 10 != 9 and d not in held}
    brute = brute_scores(rows, trusted)
    want = sorted(((d, *brute_base(t), round(s, 9)) for (d, t), s in zip(rows, brute)), key=repr)
    have = sorted(((r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    round(r["score"], 9)) for r in got), key=repr)
    assert have == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= model.threshold)
    by = {r["id"]: r["kept"] for r in got}
    asked = [d for d, _ in corpus() if d in held]
    assert len(asked) > 25 and all(by[d] == (d % 4 > 0) for d in asked)
    assert by[1004] and not by[1003] and not by[1000]


def test_without_labels_only_base_rules_count(spark):
    rows = corpus(20)
    empty = labels_of(spark, []).where("false")
    got = quality_rules.judged(documents(spark, rows), quality_rules.fit(documents(spark, rows), empty)).collect()
    assert all(r["kept"] != r["base_failed"] and r["score"] == 0 for r in got)
    none = documents(spark, [])
    assert quality_rules.judged(none, quality_rules.fit(none, labels_of(spark, rows))).count() == 0


def test_threshold():
    t = quality_rules.best_threshold
    assert t(np.array([3.0, 4.0, 5.0]), np.array([0.0, 1.0])) == 2.0
    assert t(np.array([]), np.array([1.0])) == float("-inf")
    assert t(np.array([1.0, 1.0]), np.array([1.0])) == 1.0            # ties stay
    assert t(np.arange(1000.0), np.array([])) == 5.0


def test_every_labelled_row_counts(spark, monkeypatch):
    """Whatever bound on labelled rows there was, all of them are learned from."""
    monkeypatch.setattr(quality_rules, "SAMPLE_ROWS", 40, raising=False)
    rows = corpus()
    docs, labels = documents(spark, rows), labels_of(spark, rows)
    model = quality_rules.fit(docs, labels)
    held = {r["doc_id"] for r in docs.where(quality_rules.held_out(docs["doc_id"])).select("doc_id").collect()}
    known = {d: d % 4 > 0 for d, _ in rows if d % 10 != 9 and d not in held}
    score = dict(zip([d for d, _ in rows], brute_scores(rows, {d for d, t in known.items() if t})))
    got = {r["id"]: r["score"] for r in quality_rules.judged(docs, model).collect()}
    assert all(abs(got[d] - s) < 1e-9 for d, s in score.items())
    good = [d for d, t in rows if not (len(WORD.findall(t)) < 50)]
    want = quality_rules.best_threshold(np.array([score[d] for d in good if known.get(d) is True]),
                                        np.array([score[d] for d in good if known.get(d) is False]))
    assert abs(model.threshold - want) < 1e-9


@pytest.mark.parametrize("share", [0, 0.1, 0.5, 1])
def test_threshold_of_many_rows_equals_that_of_arrays(spark, monkeypatch, share):
    from leadlens.llm.tables import Scratch
    r = random.Random(8)
    for n, parts in ((1, 4), (7, 3), (300, 5), (300, 1)):
        monkeypatch.setattr(quality_rules, "PARTS", parts, raising=False)
        rows = [(r.randrange(-n, n) / 8, r.random() >= share) for _ in range(n)]
        got = quality_rules.fitted_threshold(spark.createDataFrame(rows, "score double, trusted boolean"), Scratch(spark, "test"))
        assert got == quality_rules.best_threshold(np.array([s for s, t in rows if t]), np.array([s for s, t in rows if not t]))
