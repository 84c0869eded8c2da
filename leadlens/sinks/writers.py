"""Sinks (SNK1-SNK6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from leadlens.operators.position import with_position
from leadlens.sinks.committed import Version, commit

# Fixed values of the reference's text transport: NULL is written as an
# empty field and only the two-letter text "NA" reads back as NULL; the
# delimiter is ";" with no header.
NULL_MARKER = "NA"
DELIMITER = ";"


def write_table(df: DataFrame, name: str | None = None, *, path: str | None = None,
                fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """SNK1/SNK3: full refresh of a typed table (catalog table or path).

    An absent table is created. Overwriting a path or a table removes the old
    data first: a job that fails halfway leaves it empty, and a rerun fills it.
    ``sinks.committed`` replaces tables without that gap.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.save(path)
    elif name:
        w.saveAsTable(name)
    else:
        raise ValueError("give a table name or a path")


def to_text_table(df: DataFrame) -> DataFrame:
    """SNK2 parity view: every column as text, NULL -> '' and 'NA' -> NULL."""
    out = []
    for f in df.schema.fields:
        s = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        out.append(F.when(s == F.lit(NULL_MARKER), F.lit(None).cast("string"))
                   .otherwise(s).alias(f.name.lower()))
    return df.select(out)


# Quotes are doubled, and blanks at the ends of a field are part of it.
_CSV = {"sep": DELIMITER, "header": "false", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_delimited(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK4: ';'-delimited, no header, NULL and '' both written empty."""
    df.write.mode(mode).options(**_CSV).option("nullValue", "").option("emptyValue", "").csv(path)


def read_delimited(spark: SparkSession, path: str, schema: str | Ty.StructType,
                   multi_line: bool = False) -> DataFrame:
    """SNK4 read back by ``schema``: an empty field is '' in a text column and
    NULL in any other; only the text NA is NULL in a text column (and in others).
    ``multi_line`` is for fields with line breaks, which the cleaning step of a
    refresh removes; such a file is read by one task."""
    schema = Ty.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = Ty.StructType([Ty.StructField(f.name, Ty.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).options(**_CSV, multiLine=str(multi_line).lower(), mode="FAILFAST",
                                          nullValue="\u0001").csv(path)
    out = []
    for f in schema.fields:
        cell = F.coalesce(F.col(f.name), F.lit(""))
        value = F.when(cell != F.lit(NULL_MARKER), cell)
        if not isinstance(f.dataType, Ty.StringType):
            value = F.nullif(value, F.lit("")).cast(f.dataType)
        out.append(value.alias(f.name))
    return raw.select(out)


def write_report(spark: SparkSession, root: str, frames: Mapping[str, DataFrame],
                 orders: Mapping[str, Sequence[str | Column]], *, fmt: str = "csv") -> Version:
    """SNK5: a report of several sheets, one folder each, committed together.

    Rows are numbered in their sheet's order (column ``position``) and written
    in ranges of it, so the files, one after the other, are in order too."""
    sheets = {name: with_position(df, orders[name]).select("position", *df.columns).orderBy("position")
              for name, df in frames.items()}
    return commit(spark, root, sheets, fmt=fmt, options={"header": "true"} if fmt == "csv" else None)


def sql_types(df: DataFrame) -> dict[str, str]:
    """SNK6: warehouse column types from the inferred schema, at full width."""
    names = {Ty.DateType: "date", Ty.TimestampType: "timestamp", Ty.TimestampNTZType: "timestamp",
             Ty.BooleanType: "boolean", Ty.ByteType: "integer", Ty.ShortType: "integer",
             Ty.IntegerType: "integer", Ty.LongType: "bigint", Ty.FloatType: "double", Ty.DoubleType: "double"}
    out = {}
    for f in df.schema.fields:
        t = f.dataType
        out[f.name.lower()] = (f"decimal({t.precision},{t.scale})" if isinstance(t, Ty.DecimalType)
                               else names.get(type(t), "string"))
    return out


def jdbc_column_types(df: DataFrame) -> str:
    """``createTableColumnTypes`` option text for a JDBC full refresh."""
    return ", ".join(f"`{c}` {t.upper()}" for c, t in sql_types(df).items())


def write_jdbc(df: DataFrame, url: str, table: str, *, properties: Mapping[str, str] | None = None,
               typed: bool = True, num_partitions: int | None = None) -> None:
    """SNK1 into a relational warehouse: overwrite with ``truncate`` so the
    table (and its grants) survives, column types from the schema (SNK6),
    ``numPartitions`` parallel connections."""
    w = df.write.mode("overwrite").format("jdbc").option("url", url).option("dbtable", table) \
        .option("truncate", "true")
    if typed:
        w = w.option("createTableColumnTypes", jdbc_column_types(df))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
