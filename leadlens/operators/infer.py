"""Frame cleaning and type inference for semi-structured feeds (INF0-INF5).

The reference decides each column's type from pandas ``value_counts`` and
cell-wise Python. Here every decision comes from Spark aggregates:

* ``column_stats`` counts, in a single aggregate pass, how many cells of a
  column parse as numbers, raw and after dropping '$' and ',', how many hold
  '$', and how many are shaped like dates. Where all cells or none have a
  property, so has the most (or second most) frequent value, and the type is
  decided without ranking anything;
* for the other columns ``top_two`` takes candidates from a frequent-items
  sketch, counts them exactly, and proves that no other value can be ahead of
  them. Only a column whose proof fails (values that occur about equally often)
  has its values ranked by ``top_values``, a grouped count.

Only these per-column statistics (a few rows per column) reach the driver;
the data itself is converted by built-in column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from leadlens.functions import text as T
from leadlens.session import cut_lineage

# Fixed values of the reference's rules: numbers are what Python's float()
# accepts in decimal notation; money drops "$" and ","; dates are month/day/
# four-digit year taken from the first blank-separated token; an empty cell
# in a date column becomes 1900-01-01; numbers default to 0.0.
NUMBER_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
MONEY_DROP = "$,"
DATE_FORMAT = "M/d/yyyy"
DATE_DEFAULT = "1900-01-01"
NUMBER_DEFAULT = 0.0

SKETCH_ITEMS = 10_000      # values that a column's sketch tracks
CANDIDATES = 64            # values taken from it


def top_values(df: DataFrame, k: int = 2, columns: list[str] | None = None) -> DataFrame:
    """INF4: the k most frequent non-NULL values of every column.

    Returns (column_name, value, cnt, rank); ties are broken by value, which
    the reference leaves to hash order. One shuffle for the whole frame.
    """
    cols = columns or df.columns
    counts = value_counts(df, cols)
    w = Window.partitionBy("column_name").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


@dataclass
class ColumnStats:
    non_null: int
    numeric: int
    money_numeric: int
    money: bool = False     # the most frequent value holds '$'
    date: bool = False      # the second most frequent value is shaped like a date


def _is_number(c: Column) -> Column:
    """``NUMBER_RE``, tried only where the first character may begin a number."""
    return c.substr(1, 1).isin(*"0123456789+-. \t\n\r\x0b\x0c") & c.rlike(NUMBER_RE)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, cnt) over all columns: one shuffle, map-side combined."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ids=[], values=cols, variableColumnName="column_name", valueColumnName="value")
    return long.filter(F.col("value").isNotNull()) \
               .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))


def _date_shaped(c: Column) -> Column:
    """Letter-free text with exactly three '/'-separated parts."""
    slashes = F.length(c) - F.length(F.translate(c, "/", ""))
    return F.contains(c, F.lit("/")) & (slashes == 2) & ~c.rlike(r"\p{L}")


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """A row (column_name, value) for each non-NULL cell; columns go by c0, c1, ..."""
    text = df.select([F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    return (text.unpivot(ids=[], values=text.columns, variableColumnName="column_name", valueColumnName="value")
            .where(F.col("value").isNotNull()))


def column_stats(df: DataFrame, columns: list[str] | None = None) -> dict[str, ColumnStats]:
    """Per-column statistics and what they say about the frequent values.

    Totals of all text columns come from one aggregate without a shuffle of
    cells; values are looked at only where the totals leave a type open.
    """
    cols = [c for c in (columns or df.columns)
            if isinstance(df.schema[c].dataType, Ty.StringType)]
    if not cols:
        return {}
    # Cells are tested as rows: one small aggregate, whatever the number of columns.
    v = F.col("value")
    number, dollar = _is_number(v), F.contains(v, F.lit("$"))
    bare = F.when(dollar | F.contains(v, F.lit(",")), _is_number(F.translate(v, MONEY_DROP, ""))).otherwise(F.col("number"))
    cells = (_long(df, cols).withColumn("number", number)
             .select("column_name", "number", bare.alias("bare"), dollar.alias("dollar"),
                     _date_shaped(v).alias("date"), F.xxhash64("value").alias("h")))
    rows = {r["column_name"]: r for r in cells.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in ("number", "bare", "dollar", "date")],
        (F.min("h") < F.max("h")).alias("two")).collect()}
    out, unsure = {}, {}
    for i, c in enumerate(cols):
        r = rows.get(f"c{i}")
        if r is None:
            out[c] = ColumnStats(0, 0, 0)
            continue
        x = out[c] = ColumnStats(r["n"], r["number"], r["bare"])
        if x.numeric == x.non_null:
            continue                                   # the numbers alone decide
        x.money = r["dollar"] == x.non_null
        x.date = r["date"] == x.non_null and r["two"]
        if 0 < r["dollar"] < x.non_null or (0 < r["date"] < x.non_null and not x.money):
            unsure[c] = x.non_null
    for c, top in top_two(df, unsure).items():
        out[c].money = "$" in top[0]
        out[c].date = len(top) > 1 and not any(ch.isalpha() for ch in top[1]) and len(top[1].split("/")) == 3
    return out


def top_two(df: DataFrame, non_null: dict[str, int]) -> dict[str, list[str]]:
    """The two most frequent values (ties by value) of columns that have
    ``non_null`` cells, without exchanging their distinct values where a sketch
    can be proven right.

    Candidates come from a frequent-items sketch and are counted exactly. A
    value that isn't among them occurs at most as often as the sketch's error
    allows (3.5 / its slots, of which at least 4/3 * ``SKETCH_ITEMS`` are kept),
    or as its last candidate, and no more often than there are cells left. If
    the second candidate is ahead of that, the order is proven.
    """
    if not non_null:
        return {}
    cols = list(non_null)
    sketched = df.agg(*[F.expr(f"approx_top_k(cast(`{c}` AS string), {CANDIDATES}, {SKETCH_ITEMS})").alias(f"k{i}")
                        for i, c in enumerate(cols)]).first()
    candidates = {c: [(r["item"], r["count"]) for r in sketched[f"k{i}"] or [] if r["item"] is not None]
                  for i, c in enumerate(cols)}
    listed = df.sparkSession.createDataFrame(       # CANDIDATES rows a column at most
        [(f"c{i}", v) for i, c in enumerate(cols) for v, _ in candidates[c]], "column_name string, value string")
    exact: dict[str, list[tuple[int, str]]] = {c: [] for c in cols}
    for r in (_long(df, cols).join(F.broadcast(listed), ["column_name", "value"], "left_semi")
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt")).collect()):
        exact[cols[int(r["column_name"][1:])]].append((-r["cnt"], r["value"]))
    out, open_ = {}, []
    for c in cols:
        ranked = sorted(exact[c])
        rest = non_null[c] + sum(n for n, _ in ranked)
        least = candidates[c][-1][1] if len(candidates[c]) >= CANDIDATES else 0
        others = min(rest, max(least, math.ceil(3 * non_null[c] / SKETCH_ITEMS)))
        if rest == 0 or (len(ranked) > 1 and -ranked[1][0] > others):
            out[c] = [v for _, v in ranked[:2]]
        else:
            open_.append(c)
    if open_:
        for r in top_values(df, 2, open_).orderBy("column_name", "rank").collect():
            out.setdefault(r["column_name"], []).append(r["value"])
    return out


def strip_cells(df: DataFrame) -> DataFrame:
    """SC22+SC23 over every string column."""
    return df.select([T.strip_control(T.strip_non_ascii(F.col(f.name))).alias(f.name)
                      if isinstance(f.dataType, Ty.StringType) else F.col(f.name)
                      for f in df.schema.fields])


def anchor_cells(df: DataFrame, exact: bool = False) -> DataFrame:
    """SC24 over every string column."""
    return df.select([T.anchor_name(F.col(f.name), exact).alias(f.name)
                      if isinstance(f.dataType, Ty.StringType) else F.col(f.name)
                      for f in df.schema.fields])


def numeric_plan(stats: dict[str, ColumnStats]) -> dict[str, str]:
    """INF1/INF2 decisions: column -> 'number' | 'money' | 'money_text'."""
    plan = {}
    for c, s in stats.items():
        if s.non_null > 0 and s.numeric == s.non_null:
            plan[c] = "number"
        elif s.money:
            plan[c] = "money" if s.money_numeric == s.non_null else "money_text"
    return plan


def infer_numeric(df: DataFrame, stats: dict[str, ColumnStats] | None = None) -> DataFrame:
    """INF1+INF2: whole-column float conversion, with a currency retry.

    A column whose every non-NULL cell parses becomes DOUBLE (one '' cell
    keeps it text, as in the reference). Otherwise, when its most frequent
    value holds '$', '$' and ',' are dropped and the column becomes DOUBLE
    if every cell then parses; if not, the stripped text is kept.
    """
    stats = column_stats(df) if stats is None else stats
    plan = numeric_plan(stats)
    out = []
    for c in df.columns:
        x, kind = F.col(c), plan.get(c)
        if kind == "number":
            out.append(F.trim(x).cast("double").alias(c))
        elif kind == "money":
            out.append(F.trim(F.translate(x, MONEY_DROP, "")).cast("double").alias(c))
        elif kind == "money_text":
            out.append(F.translate(x, MONEY_DROP, "").alias(c))
        else:
            out.append(x)
    return df.select(out)


def date_plan(df: DataFrame, stats: dict[str, ColumnStats]) -> list[str]:
    """INF3 decision: the *second* most frequent value is letter-free text
    with exactly three '/'-separated parts."""
    return [c for c, s in stats.items()
            if s.date and c in df.columns and isinstance(df.schema[c].dataType, Ty.StringType)]


def parse_date_cell(x: Column) -> Column:
    """First blank-separated token as M/d/yyyy; an empty token gives 1900-01-01; else NULL."""
    tok = F.split_part(x, F.lit(" "), F.lit(1))
    return F.when(tok == F.lit(""), F.lit(DATE_DEFAULT).cast("date")) \
            .otherwise(F.try_to_date(tok, DATE_FORMAT))


def infer_dates(df: DataFrame, stats: dict[str, ColumnStats] | None = None,
                key: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """INF3: convert date-like text columns to DATE.

    One Spark column has one type, so a cell that is neither '' nor a date
    becomes NULL in the converted column and is reported in the returned
    ``rejects`` frame (key columns, column name, original text).
    """
    stats = column_stats(df) if stats is None else stats
    cols = date_plan(df, stats)
    if not cols:
        return df, None
    conv = {c: parse_date_cell(F.col(c)) for c in cols}
    # Without a key, a reject row carries the row's other columns.
    key = key or [c for c in df.columns if c not in cols]
    parts = [df.filter(F.col(c).isNotNull() & conv[c].isNull())
               .select(*key, F.lit(c).alias("column_name"), F.col(c).alias("value"))
             for c in cols]
    rejects = parts[0]
    for p in parts[1:]:
        rejects = rejects.unionByName(p)
    return df.withColumns(conv), rejects


def clean_frame(df: DataFrame, key: list[str] | None = None, exact_links: bool = False
                ) -> tuple[DataFrame, DataFrame | None]:
    """INF0: link cleaning -> ASCII/control scrub -> numeric -> dates, in that order.

    The scrubbed frame is written once; statistics and result read that. The
    date rule looks at the top values of the columns left as text after the
    numeric step, which the numeric step does not change for text columns.
    """
    scrubbed = cut_lineage(strip_cells(anchor_cells(df, exact_links)), "scrubbed")
    stats = column_stats(scrubbed)
    num = infer_numeric(scrubbed, stats)
    plan = numeric_plan(stats)
    date_stats = {c: s for c, s in stats.items() if c not in plan}
    return infer_dates(num, date_stats, key)


def fill_defaults(df: DataFrame) -> DataFrame:
    """INF5: dates default to 1900-01-01 and numbers to 0.0; text stays NULL."""
    out = []
    for f in df.schema.fields:
        x = F.col(f.name)
        if isinstance(f.dataType, Ty.DateType):
            x = F.coalesce(x, F.lit(DATE_DEFAULT).cast("date"))
        elif isinstance(f.dataType, (Ty.DoubleType, Ty.FloatType, Ty.DecimalType)):
            x = F.coalesce(x, F.lit(NUMBER_DEFAULT).cast(f.dataType))
        elif isinstance(f.dataType, (Ty.IntegerType, Ty.LongType, Ty.ShortType)):
            x = F.coalesce(x, F.lit(0).cast(f.dataType))
        out.append(x.alias(f.name))
    return df.select(out)
