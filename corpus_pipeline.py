"""From raw documents to tokens: toxicity, exact dedup, near-duplicate dedup,
benchmark decontamination, SentencePiece tokens.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of
``documents``; the last returns doc_id, n_tokens, ids, roundtrip and parity.

Defined cases follow the operators. Rows that repeat an id together with its
text leave one row after either dedup. A document without a text or with an
empty one is clean; all such documents are copies of one another. Further
columns of the documents pass through every filtering stage.

Scale: of the documents, only those that may be in a group of copies move (a
screen of bits tells); the others stay where they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import decontaminate, exact_dedup, sentencepiece_tokens, simhash, toxicity
from leadlens.llm.tables import Scratch, row_key, table
from leadlens.operators.screen import marked, screen

SCREEN_WORDS = 1 << 20     # of 64 bits


def _one_of_each(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``grouped`` (key and kept of every row of a
    group of several) drops, and with one row of each key that it keeps."""
    bits = screen(grouped, ["key"], SCREEN_WORDS)
    rows = marked(docs.withColumn("__key", row_key(F.col("doc_id"), F.col("text"))), ["__key"], bits, "__may",
                  SCREEN_WORDS)
    verdict = grouped.select(F.col("key").alias("__key"), F.col("kept").alias("__kept")).distinct()
    stay = (rows.where("__may").join(verdict, "__key", "left").where("coalesce(__kept, true)")
            .dropDuplicates(["__key"]))
    return rows.where("not __may").select(*docs.columns).unionByName(stay.select(*docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, F.col("text")) < toxicity.THRESHOLD)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = exact_dedup.dedup(docs, F.pmod(F.xxhash64("id"), F.lit(2)) == 1)
    grouped = Scratch(spark, "exact-copies").write(verdict.where("group_size > 1").select("key", "kept"), "grouped")
    return _one_of_each(docs, grouped)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key"))
    groups = (found.groupBy("label").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1")
              .select("label", F.col("first.key").alias("keep")))
    grouped = found.join(groups, "label").select("key", (F.col("key") == F.col("keep")).alias("kept"))
    return _one_of_each(docs, Scratch(spark, "near-copies").write(grouped, "grouped"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = decontaminate.verdict(table(spark, sf_dir, "benchmark"), F.col("text"))
    return docs.where(~verdict["contaminated"])


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_tokens.tokens(docs).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("sentencepiece", tokenise)]

#: The learned toxicity score, SimHash and SentencePiece can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    work = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), name)
        if k:
            work.drop(STAGES[k - 1][0])
    return docs
