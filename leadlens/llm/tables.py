"""Reading driver tables and keeping intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.session import checkpoint_dir, delete_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrowed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``__id`` and ``__text`` (null counts as empty): whatever else the
    table holds, clashing names included, stays out of the operator."""
    return df.select(F.col(id_col).alias("__id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("__text"))


def row_key(id_: Column, text: Column) -> Column:
    """Digest of an id and a text (null: empty), equal for rows that repeat both.

    It is never null, unlike an id, so plain equi-joins on it lose no row."""
    return F.sha2(F.concat_ws("\x00", F.coalesce(id_.cast("string"), F.lit("\x01")),
                              F.coalesce(text, F.lit(""))), 256)


class Scratch:
    """Intermediate Parquet tables in the folder named by
    ``spark.checkpoint.dir``, which driver and executors share.

    Tables that nothing reads any more are dropped with :meth:`drop`; those
    behind a returned result stay until its owner clears the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write once and continue from the written table."""
        df.write.mode("error").options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        delete_folder(self.spark, self.path(name))
