"""Every registered query against its DuckDB oracle at sf0.001 (driver contract)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    own = {q for q in E.queries() if q.startswith("q_")}
    assert own == {q for q in E.oracle_sql() if q.startswith("q_")}


def test_the_master_has_its_132_columns(spark):
    df = E.queries()["q_prospect_master"](spark, SF)
    assert df.count() > 0 and len(df.columns) == 132


@pytest.mark.parametrize("name", sorted(q for q in E.oracle_sql() if q.startswith("q_")))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    dc, dr = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "r_id"]
    assert df.count() >= 0


def _rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])[1]


def test_the_data_show_a_missing_duplicate_rule(spark, duck, monkeypatch):
    """Later copies of a customer are in the data, with and without a processed
    application: a rule that drops none, or all of them, gives other rows."""
    from leadlens.operators import select
    sql = duck.execute(E.oracle_sql()["q_customers_clean"])
    want = rows_of([d[0] for d in sql.description], sql.fetchall())[1]
    right = select.survivor_dedup
    monkeypatch.setattr(select, "survivor_dedup", lambda rows, base, **k: base)
    kept_all = _rows(E.queries()["q_customers_clean"](spark, SF))
    assert len(kept_all) > len(want)

    def drops_processed_too(rows, base, **k):
        from pyspark.sql import functions as F
        return right(rows, base, **{**k, "keep_if": F.lit(False)})
    monkeypatch.setattr(select, "survivor_dedup", drops_processed_too)
    assert len(_rows(E.queries()["q_customers_clean"](spark, SF))) < len(want)


def test_few_columns_of_the_master_are_empty(spark):
    df = E.queries()["q_prospect_master"](spark, SF)
    from pyspark.sql import functions as F
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
    assert sum(n == 0 for n in counts.values()) <= 5, [c for c, n in counts.items() if not n]


def test_names_that_the_showing_query_leaves_out_are_in_the_data(spark, duck):
    from leadlens.plans.driver_domain import domain_tables
    from leadlens.plans.showings import showing_customers
    t = domain_tables(spark, SF)
    left_out = t["customers"].join(showing_customers(t).select("id"), "id", "left_anti")
    kinds = {("" if not r.first_name else "urist" if r.first_name.startswith("Urist") else "test") for r in left_out.collect()}
    assert kinds == {"", "urist", "test"}
