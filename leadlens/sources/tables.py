"""Table sources (SRC1, SRC6, SRC7)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def load_tables(spark: SparkSession, source: str, names: Iterable[str], *,
                fmt: str = "parquet",
                jdbc: Mapping[str, object] | None = None,
                partitioning: Mapping[str, Mapping[str, object]] | None = None
                ) -> dict[str, DataFrame]:
    """Load tables table-by-table so joins run in Spark, never in the source.

    ``fmt='parquet'`` (or any file format) reads ``{source}/{name}.{fmt}``;
    ``fmt='table'`` reads catalog tables ``{source}.{name}`` (``source`` may
    be ''); ``fmt='jdbc'`` reads ``dbtable=name`` from the JDBC URL ``source``
    with the options in ``jdbc`` (user, password, driver, fetchsize) and,
    per table, ``partitioning[name]`` = {partitionColumn, lowerBound,
    upperBound, numPartitions} so large tables are read by many tasks.
    """
    out = {}
    for name in names:
        if fmt == "jdbc":
            r = spark.read.format("jdbc").option("url", source).option("dbtable", name)
            for k, v in (jdbc or {}).items():
                r = r.option(k, str(v))
            for k, v in ((partitioning or {}).get(name) or {}).items():
                r = r.option(k, str(v))
            out[name] = r.load()
        elif fmt == "table":
            out[name] = spark.table(f"{source}.{name}" if source else name)
        else:
            out[name] = spark.read.format(fmt).load(f"{source.rstrip('/')}/{name}.{fmt}")
    return out
