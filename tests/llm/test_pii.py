import brute
import pytest
from fixture import documents, texts

from leadlens.llm import pii, queries

CASES = [
    "write to a.b+c@d-e.co.uk, x@y, @z.de, p@q.r.s.t@u.v, a@b.c_d@e.f x@y.z.",
    "1.2.3.4 256.1.1.1 01.002.3.255 1.2.3 1.2.3.4.5.6.7.8 99999999999.1.1.1 1.2.3.4567",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111, 0000000000000000000000 5500005555555559",
    "call +49 (30) 123.456-78, +1 2, +12, ++49301234567, +1 234 567 8901 2345 678, +49 30 1234567 and 12",
    "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 but not DE88370400440532013000",
    "é\U0001F600 mail: ü@a.de é@b.de \U0001F600c@d.ef\U0001F600", "1" * 30_000, "a" * 30_000 + "@b", "1." * 9_000,
    "a@" + "b." * 9_000 + "c", "+" * 5_000, "x@y.de1.1.1.1", "+1 " * 4_000, "1 - 23 -4 5- 6",
]


def test_base_spans_against_brute_force(spark):
    rows = [*texts(), *((100 + k, t) for k, t in enumerate(CASES))]
    got = {(r["id"], r["base"]): r for r in pii.personal_data(documents(spark, rows)).collect()}
    for d, t in rows:
        spans = brute.base_spans(t)
        r = got[d, ",".join(f"{k}:{a}:{z}" for a, _, k, z in spans)]
        assert [r[f"n_{k}"] for k in brute.BASE] == [sum(s[2] == k for s in spans) for k in brute.BASE]


def test_account_numbers_and_context(spark):
    text = CASES[4]
    r = pii.personal_data(documents(spark, [(1, text)])).first()
    found = [text[s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "iban"]
    assert found == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"] and r["n_iban"] == 2
    near, far = pii.personal_data(documents(spark, [(1, "server 1.2.3.4"), (2, "in 1.2.3.4")])).orderBy("id").collect()
    assert near["spans"][0]["score"] == pytest.approx(0.6) and far["spans"][0]["score"] == pytest.approx(0.5)


ACCOUNTS = [
    ("DE89370400440532013000 Please ok", ["DE89370400440532013000"]),
    ("an DE89 3704 0044 0532 0130 00 EUR 500", ["DE89 3704 0044 0532 0130 00"]),
    ("DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32 NO9386011117947 A1",
     ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"]),
    ("DE12 3456 DE89 3704 0044 0532 0130 00 B2", ["DE89 3704 0044 0532 0130 00"]),
    ("\u00e9\U0001F600 MT84MALT011000012345MTLCAST001S X", ["MT84MALT011000012345MTLCAST001S"]),
    ("DE89370400440532013000X xDE89370400440532013000 DE8937040044053201300 ZZ89370400440532013000", []),
    ("DE12 " * 4_000 + "DE89370400440532013000 A", ["DE89370400440532013000"]),
]


def test_account_numbers_end_where_their_country_says(spark):
    rows = list(enumerate(t for t, _ in ACCOUNTS))
    got = {r["id"]: r["spans"] for r in pii.personal_data(documents(spark, rows)).collect()}
    for k, (text, want) in enumerate(ACCOUNTS):
        assert [text[s["start"]:s["end"]] for s in got[k] if s["kind"] == "iban"] == want, text[:60]


def test_the_query_returns_scores_beside_spans(spark, tmp_dir):
    rows = [(1, "server 1.2.3.4"), (2, "in 1.2.3.4, konto DE89370400440532013000 EUR"), (3, "none"),
            (4, "x " * 60 + "DE89370400440532013000 B " + "x " * 60 + "GB82WEST12345698765432 bank")]
    documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: (r["spans"], r["scores"]) for r in queries.op3_personal_data(spark, tmp_dir).collect()}
    assert got[1] == ("ip:7:14", "0.6") and got[2] == ("ip:3:10,iban:18:40", "0.5,1.0") and got[3] == ("", "")
    assert got[4][1] == "0.9,1.0"


def test_plan_has_no_python(spark):
    plan = pii.personal_data(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert pii.personal_data(documents(spark, [])).count() == 0
