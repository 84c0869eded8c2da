import brute
import corpus_pipeline
import duckdb
import pytest
from fixture import documents, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
from leadlens.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_stages_on_odd_rows(spark, tmp_path):
    near = prose(300, 2)
    rows = [(1, near), (2, near), (2, near), (3, near + " end"), (4, None), (5, ""), (6, prose(80, 7)),
            (7, prose(40, 9) + " " + prose(80, 7)[:400]), (None, "a short one"), (8, prose(3000, 4))]
    rows += [(100 + k, prose(30, 100 + k) + (" idiot moron scum" if k % 4 == 0 else "")) for k in range(200)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + k, 1, int(k % 4 == 0)) for k in range(200)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(80, 7)[:400])], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == docs.columns
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(sorted((r["doc_id"] for r in docs.collect()), key=repr))
    clean = [100 + k for k in range(200) if k % 4]
    assert kept[0] == sorted([d for d, _ in rows if d not in range(100, 300)] + clean, key=repr)
    assert kept[1] == sorted([1, 3, 4, 6, 7, None, 8] + clean, key=repr)
    assert set(kept[2]) <= set(kept[1]) and 1 in kept[2] and len(kept[2]) >= len(kept[1]) - 3
    assert set(kept[2]) - set(kept[3]) == {6, 7}
    assert kept[4] == kept[3]
    again = corpus_pipeline.run(spark, str(tmp_path)).where(F.col("roundtrip")).select("doc_id").collect()
    assert sorted((r["doc_id"] for r in again), key=repr) == kept[4]


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_one_document_of_each_near_group_stays(spark, monkeypatch, words):
    monkeypatch.setattr(corpus_pipeline, "SCREEN_WORDS", words)
    base = prose(300, 2)
    rows = [(k, prose(40 + k, 50 + k)) for k in range(20)]
    rows += [(100 + k, base + " end" * (k > 3)) for k in range(8)] + [(300 - k, prose(90, 7)[: 400 + k]) for k in range(4)]
    rows += [(400, None), (401, ""), (402, " \t")]
    groups = {}
    for d, _, root in brute.near_groups(rows):
        groups.setdefault(root, []).append(d)
    assert sum(len(g) > 1 for g in groups.values()) >= 2
    docs = documents(spark, [*rows, rows[0], (None, rows[1][1]), (None, prose(70, 1))])
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([*groups, None], key=repr)


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
