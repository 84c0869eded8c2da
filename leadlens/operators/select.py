"""Per-key selection: latest / first row, survivor dedup, latest flag.

All forms are skew-tolerant: they aggregate with map-side partial
aggregation (``max_by`` / ``min_by`` over a struct) or keep a
``row_number() <= k`` filter that Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so a key holding a third of the
rows still ships only one candidate row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _order_value(order: str | Sequence[str]) -> Column:
    cols = _cols(order)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                   first: bool = False) -> DataFrame:
    """LK1/LK3: the whole row with the largest (or smallest) ``order`` per key.

    Equivalent to ``id IN (SELECT max(id) ... GROUP BY key)`` when ``order``
    is a unique id. Rows with a NULL key form one group, as in SQL.
    Implemented as one aggregate with partial aggregation, so no second
    scan and no semi join are needed.
    """
    keys = _cols(key)
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if first else F.max_by
    row = F.struct(*rest)
    agg = df.groupBy(*keys).agg(pick(row, _order_value(order)).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    """LK3: the whole row with the smallest ``order`` per key."""
    return latest_per_key(df, key, order, first=True)


def top_k_per_key(df: DataFrame, key, order: Sequence[Column], k: int,
                  rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each key (ties broken by the full order)."""
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def order_key(order: Sequence[str | tuple[str, str]]) -> Column:
    """A struct whose natural ordering is the given ascending sort order.

    Entries are column names (NULLs first, Spark's default) or
    ``(name, "nulls_last")`` (PostgreSQL's default for ASC).
    """
    parts = []
    for o in order:
        name, nulls = (o, "nulls_first") if isinstance(o, str) else o
        flag = F.col(name).isNull() if nulls == "nulls_last" else F.col(name).isNotNull()
        parts += [flag.alias(f"_n{len(parts)}"), F.col(name).alias(f"_v{len(parts)}")]
    return F.struct(*parts)


def survivor_dedup(rows: DataFrame, base: DataFrame, *, id_col: str,
                   keys: Sequence[str], order: Sequence[str | tuple[str, str]],
                   keep_if: Column) -> DataFrame:
    """WN1/WN2: drop later copies of an identity unless they carry ``keep_if``.

    Same result as numbering ``rows`` with ``row_number()`` over ``keys``
    ordered by ``order`` and removing from ``base`` every id with a row
    numbered above 1 whose ``keep_if`` is not true -- provided ``order`` is
    unique within a key (give id tie-breaks). "Numbered above 1" is "ordered
    after the key's first row", so the first row comes from one partial
    aggregate (``min`` of the order struct) and no window sorts a hot
    identity in one task. As in the reference, numbering runs over ``rows``
    as given, so an id that appears twice in ``rows`` can remove itself.
    The removal is an explicit anti join (``NOT IN`` would plan as a
    null-aware broadcast).
    """
    from leadlens.operators.profile import join_null_safe
    ranked = rows.withColumn("_ord", order_key(order))
    first = ranked.groupBy(*keys).agg(F.min("_ord").alias("_first"))
    dups = (join_null_safe(ranked, first, keys, how="inner")
            .filter((F.col("_ord") > F.col("_first")) & ~F.coalesce(keep_if, F.lit(False)))
            .select(id_col).distinct())
    return base.join(dups, on=id_col, how="left_anti")


def flag_latest(df: DataFrame, *, key: str | Sequence[str], id_col: str,
                when: Column | None = None, flag: str = "is_latest") -> DataFrame:
    """LK6: boolean flag marking, per key, the row with the largest id among
    rows satisfying ``when``.

    The latest ids come from one partial aggregate and are joined back on
    the unique id, so a hot key never lands whole in one task.
    """
    src = df if when is None else df.filter(when)
    last = src.groupBy(*_cols(key)).agg(F.max(id_col).alias(id_col)) \
              .select(F.col(id_col), F.lit(True).alias(flag))
    return df.join(last, on=id_col, how="left") \
             .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
