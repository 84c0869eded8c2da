"""Exact deduplication of an incoming batch against an immutable snapshot.

A snapshot keeps one bucket per distinct normalised text (digest, rows, the
row that stays) and a static binary fuse filter per shard of its digests. An
incoming batch is grouped by itself first; its distinct digests are screened
by the filters, only positives join the snapshot's buckets, and the texts of
joined buckets are compared byte by byte before the groups become one.

Texts are equal when identical after deleting space, tab, line feed, vertical
tab, form feed and carriage return. Of equal texts the row with the most code
points stays, then the one with the smallest id (a null id comes last).

Defined cases: a null text counts as empty; empty texts form one group; rows
that repeat an id together with its text can't be told apart, each counts in
``group_size`` and they share their verdict; of rows that repeat an id with
another text of the same group, only the one that stays is kept; an empty
table gives an empty result; columns besides id and text are not read.

Scale: a text is read once for its digest, and once more to be compared if its
group spans snapshot and batch (then two texts a group are). Only texts whose id
passes a screen of the wanted ids move, whatever else the table holds; the
screen is a table of bits, ``SCREEN_WORDS`` rows at most. Groups are
pre-aggregated on the map side, so a group that holds a third of all rows
sends one row a task; the last join back to the rows is a plain equi-join
whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm import fuse_filter
from leadlens.llm.tables import Scratch, narrowed, row_key
from leadlens.operators.screen import screen as bit_screen
from leadlens.operators.screen import screened

KEYS_PER_SHARD = 250_000
SCREEN_WORDS = 1 << 20     # of 64 bits
BLANKS = " \t\n\x0b\x0c\r"
_BUCKET = ["sha", "d64"]


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    norm = normalised(F.col("__text"))
    return narrowed(docs, id_col, text_col).select(
        F.col("__id").alias("id"), row_key(F.col("__id"), F.col("__text")).alias("key"),
        F.sha2(F.encode(norm, "UTF-8"), 256).alias("sha"), F.xxhash64(norm).alias("d64"), F.length("__text").cast("long").alias("n_points"))


def buckets(digested: DataFrame) -> DataFrame:
    """One row per distinct text: rows and the order struct of the row that stays."""
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("id").isNull().alias("no_id"),
                          F.col("id"), F.col("key")))
    return digested.groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("n"), best.alias("best"))


def _shard(n: int) -> Column:
    return F.pmod(F.shiftrightunsigned("d64", 20), F.lit(n)).cast("int")


def filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """A static filter per shard of the snapshot's digests."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = fuse_filter.build(pdf["d64"].to_numpy())
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "seed": f.seed, "segment": f.segment,
                             "segments": f.segments, "prints": [f.prints.tobytes()]})
    return (snapshot.select(_shard(shards).alias("shard"), "d64").groupBy("shard")
            .applyInPandas(build, "shard int, seed long, segment int, segments int, prints binary"))


def screen(batch: DataFrame, filter_rows: DataFrame, shards: int) -> DataFrame:
    """The batch's distinct digests that the filters can't rule out."""
    def probe(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if found.empty or keys.empty:
            return keys.iloc[:0][["d64"]]
        r = found.iloc[0]
        f = fuse_filter.FuseFilter(int(r["seed"]), int(r["segment"]), int(r["segments"]),
                                   fuse_filter.np.frombuffer(r["prints"], dtype="uint8"))
        return keys.loc[f.may_contain(keys["d64"].to_numpy()), ["d64"]]
    keys = batch.select(_shard(shards).alias("shard"), "d64")
    return (keys.groupBy("shard").cogroup(filter_rows.groupBy("shard"))
            .applyInPandas(probe, "d64 long").distinct())


def same_bytes(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``sha`` of the joined buckets whose two texts are byte for byte equal;
    ``wanted`` has the sha and the id of both rows of each."""
    texts = screened(narrowed(docs, id_col, text_col).withColumnRenamed("__id", "t_id"), ["t_id"],
                     bit_screen(wanted, ["id"], SCREEN_WORDS), SCREEN_WORDS)
    texts = texts.select("t_id", normalised(F.col("__text")).alias("norm"))
    return (texts.join(wanted, F.col("t_id").eqNullSafe(F.col("id")))
            .where(F.sha2(F.encode("norm", "UTF-8"), 256) == F.col("sha"))
            .groupBy("sha").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
            .where(F.col("lo") == F.col("hi")).select("sha"))


def dedup(docs: DataFrame, is_new: Column, id_col: str = "doc_id", text_col: str = "text",
          ) -> DataFrame:
    """Verdict on every row of ``docs``: those where ``is_new`` (over ``id``)
    holds are the incoming batch, the others the snapshot.

    Returns id, key (of id and text, see ``row_key``), sha, keep_id, group_size, kept."""
    work = Scratch(docs.sparkSession, "exact-dedup")
    rows = work.write(digests(docs, id_col, text_col).withColumn("side", is_new.cast("int")), "digests")
    both = work.write(
        buckets(rows.where("side = 0")).withColumn("side", F.lit(0))
        .unionByName(buckets(rows.where("side = 1")).withColumn("side", F.lit(1))), "buckets")
    old, new = both.where("side = 0"), both.where("side = 1")
    shards = 1 + both.count() // KEYS_PER_SHARD
    positive = screen(new, filters(old, shards), shards)
    pairs = (new.join(positive, "d64", "left_semi")
             .select(*_BUCKET, F.col("best.id").alias("new_id"))
             .join(old.select(*_BUCKET, F.col("best.id").alias("old_id")), _BUCKET))
    wanted = work.write(pairs.select("sha", F.explode(F.array("old_id", "new_id")).alias("id")), "wanted")
    joined = work.write(same_bytes(wanted, docs, id_col, text_col), "joined").withColumn("one", F.lit(True))
    groups = (both.join(joined, "sha", "left")
              .withColumn("part", F.when(F.col("one"), F.lit(2)).otherwise(F.col("side")))
              .groupBy("sha", "part").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
              .select("sha", "group_size", F.col("best.id").alias("keep_id"), F.col("best.key").alias("keep_key"),
                      F.explode(F.when(F.col("part") == 2, F.array(F.lit(0), F.lit(1)))
                                .otherwise(F.array("part"))).alias("side")))
    return (rows.join(groups, ["sha", "side"])
            .select("id", "key", "sha", "keep_id", "group_size",
                    (F.col("key") == F.col("keep_key")).alias("kept")))
