import random

import pytest
from fixture import documents, prose, texts

from leadlens.llm import toxicity
from leadlens.llm.lexicon_automaton import LexiconAutomaton, allowed_edits

TERMS = ["scum", "idiot", "moron", "worthless", "disgusting"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distances():
    r = random.Random(3)
    words = ["scum", "scam", "idiott", "idot", "worthles", "wrthles", "disgustingly", "", "m0r0n", "idiotic"]
    for t in TERMS * 40:
        w = list(t)
        for _ in range(r.randrange(4)):
            at = r.randrange(len(w) + 1)
            w[at:at + r.randrange(2)] = r.choice(["", "x", "oo"])
        words.append("".join(w))
    automaton = LexiconAutomaton(TERMS)
    for w in words:
        near = [(distance(w, t), k) for k, t in enumerate(TERMS) if distance(w, t) <= allowed_edits(t)]
        assert automaton.match(w) == min(near, default=None), w


def corpus():
    r = random.Random(9)
    rows, labels = [], []
    for k in range(400):
        words = prose(60, k).split()
        toxic = k % 5 == 0
        if toxic:
            for t in r.sample(TERMS, 3):
                words.insert(r.randrange(len(words)), t if k % 10 else t[:-1] + "z" if len(t) > 5 else t)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    return toxicity.fit(documents(spark, rows), known)


def test_lexicon_and_held_out_accuracy(spark, fitted):
    assert set(fitted.terms) >= set(TERMS) - {"worthless", "disgusting"}
    assert not set(fitted.terms) & set("the house on a hill was sold".split())
    rows, labels = corpus()
    got = {r["id"]: r for r in toxicity.scored(documents(spark, rows), fitted).collect()}
    held = [(got[d]["predicted"], t) for d, _, t in labels if got[d]["held_out"]]
    assert len(held) > 60 and sum(a == b for a, b in held) >= 0.98 * len(held)


def test_a_quotation_weighs_less_than_abuse(fitted):
    find = fitted.matcher()
    abuse = toxicity.features("you are an idiot and a moron here", find)[0]
    assert toxicity.features('the word "idiot" and the term "moron" here', find)[0] < 0.6 * abuse


def test_odd_rows_and_empty_tables(spark, fitted):
    got = toxicity.scored(documents(spark), fitted).collect()
    assert len(got) == len(texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["predicted"] for r in got} == {0}
    assert toxicity.scored(documents(spark, []), fitted).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    blank = toxicity.fit(documents(spark), none)
    assert {r["score"] for r in toxicity.scored(documents(spark), blank).collect()} == {0.0}


def test_copies_of_one_text_make_no_terms(spark):
    rows = [(k, prose(40, k)) for k in range(300)] + [(1000 + k, "zonk blarg frobnicate quux " + prose(9, 1)) for k in range(90)]
    labels = spark.createDataFrame([(d, int(d >= 1000)) for d, _ in rows], "doc_id long, toxic int")
    assert toxicity.fit(documents(spark, rows), labels).terms == []
