"""Table sources and catalog sinks (SRC1, SRC6, SRC7, SNK1, SNK3, SNK6)."""

import os

import pytest

from leadlens.sinks.writers import jdbc_column_types, write_table
from leadlens.sources.tables import load_tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables missing")
def test_load_parquet_tables(spark):
    t = load_tables(spark, SF, ["customer", "orders"])
    assert set(t) == {"customer", "orders"} and t["customer"].count() == 150


def test_catalog_full_refresh_and_self_read(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "id long, name string, amt double")
    write_table(df, "feed_refresh_t")                     # create
    write_table(df.filter("id = 1"), "feed_refresh_t")    # full refresh replaces
    back = load_tables(spark, "", ["feed_refresh_t"], fmt="table")["feed_refresh_t"]
    assert [tuple(r) for r in back.collect()] == [(1, "a", 2.5)]
    wide = spark.sql("SELECT 1L AS id, 'a' AS name, 2.5D AS amt, CAST(1 AS DECIMAL(12,2)) AS cents, "
                     "DATE '2014-01-01' AS d, TIMESTAMP '2014-01-01 00:00:00' AS ts, true AS ok, 1 AS n")
    from pyspark.sql.types import StructType
    parsed = StructType.fromDDL(jdbc_column_types(wide))
    assert [(f.name, f.dataType) for f in parsed] == [(f.name, f.dataType) for f in wide.schema]
