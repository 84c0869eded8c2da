import random

from fixture import documents
from pyspark.sql import functions as F

from leadlens.llm import language_id

BASE = {"en": "the quick brown fox jumps over the lazy dog while many people watch from their houses",
        "de": "der schnelle braune fuchs springt über den faulen hund während viele leute aus ihren häusern zusehen",
        "fr": "le renard brun rapide saute par dessus le chien paresseux pendant que beaucoup de gens regardent"}


def corpus(n=240):
    r = random.Random(1)
    rows = []
    for k in range(n):
        lang = ("en", "en", "de", "fr")[k % 4]
        words = BASE[lang].split()
        rows.append((k, " ".join(r.choice(words) for _ in range(40)), lang))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = corpus() + [(1000, None, "en"), (1001, "12 34 !!", "de"), (1002, "", None), (None, BASE["fr"], None),
                       (1003, " ".join([BASE["de"]] * 3000), None), (5, corpus()[5][1], "en")]
    df = spark.createDataFrame([(d, t, g, "clash", "clash") for d, t, g in rows],
                               "doc_id long, text string, lang string, id string, score string")
    got = language_id.identified(df, language_id.fit(df)).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    assert [by[d]["lang_pred"] for d in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "fr", "de"]
    held = [(by[d]["lang_pred"], g) for d, _, g in corpus() if by[d]["held_out"]]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and by[1000]["score"] == 0


def test_a_header_of_all_texts_does_not_fill_the_dictionaries(spark):
    header = " ".join([BASE["en"]] * 80)
    df = spark.createDataFrame([(d, header + " " + " ".join([t] * 60), g) for d, t, g in corpus(160)],
                               "doc_id long, text string, lang string")
    learned = language_id.fit(df)
    for lang, word in (("de", "häusern"), ("fr", "paresseux")):
        body = learned[lang].count(word.encode())
        assert body > learned[lang].count(b"houses"), (lang, body)
    c = language_id.Classifier(learned)
    assert all(c.predict(t)[0] == g for _, t, g in corpus(160) if g != "en")     # the header itself is English


def test_without_labels_everything_is_unknown(spark):
    df = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    got = language_id.identified(df, language_id.fit(df)).collect()
    assert {r["lang_pred"] for r in got} == {"und"}
    assert language_id.identified(documents(spark, []), {}).count() == 0


def test_ties_go_to_the_more_frequent_language():
    c = language_id.Classifier({"b": b"same words here", "a": b"same words here"})
    lang, _, rejected, margin = c.predict("words")
    assert lang == "b" and rejected and margin == 0
