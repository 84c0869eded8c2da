"""Code lookups (DM1, DM2, DM5): first matching list wins.

The reference writes these as long ``CASE ... WHEN x IN (...)`` chains. The
mapping is a parameter here: a list of (label, codes) in priority order,
turned into a lookup frame and joined. ``keyed_join`` is the join for wide
frames of which many rows have no key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty


def code_table(spark, mapping: Sequence[tuple[str, Sequence[str]]],
               code_col: str = "code", label_col: str = "label") -> DataFrame:
    """(code, label) with the first label listing a code winning."""
    best: dict[str, tuple[int, str]] = {}
    for prio, (label, codes) in enumerate(mapping):
        for c in codes:
            if c not in best:
                best[c] = (prio, label)
    rows = [(c, lab) for c, (_, lab) in sorted(best.items())]
    return spark.createDataFrame(rows, f"{code_col} string, {label_col} string")


def map_codes(df: DataFrame, code: str, mapping: Sequence[tuple[str, Sequence[str]]],
              out: str, fallback: Column | None = None) -> DataFrame:
    """Label each row by the first mapping entry that lists its code.

    ``fallback`` is used when no entry lists the code (NULL codes included).
    """
    # Spark knows the size of this small table and picks the join by it.
    lut = code_table(df.sparkSession, mapping, "_code", "_label")
    j = df.join(lut, df[code] == lut["_code"], "left")
    lab = F.col("_label") if fallback is None else F.coalesce(F.col("_label"), fallback)
    return j.withColumn(out, lab).drop("_code", "_label")


def case_map(x: Column, mapping: Sequence[tuple[str, Sequence[str]]],
             default: Column | None = None) -> Column:
    """The same rule as a CASE chain, for short mappings (DM2 zone -> market)."""
    out = None
    for label, codes in mapping:
        cond = x.isin(list(codes))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return default if default is not None else F.lit(None)
    return out.otherwise(default) if default is not None else out


def keyed_join(left: DataFrame, right: DataFrame, key: str, *, spread_by: str, how: str = "left") -> DataFrame:
    """``left.join(right, key, how)`` for a frame in which many rows have no key.

    A shuffle sends all rows with a NULL key to one task, though none of them
    finds a partner. Here they are dealt out by a hash of ``spread_by``, and the
    other rows, on both sides, by a hash of their key. The result is the same:
    the keys themselves are compared too. ``how``: left, left_semi or left_anti.
    """
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported how={how!r}")
    kinds = {left.schema[key].dataType, right.schema[key].dataType}
    if len(kinds) > 1 and not all(isinstance(k, Ty.IntegralType) for k in kinds):
        raise ValueError(f"{key} is of another type on the right")       # equal values would hash apart
    own = F.xxhash64(F.col(key).cast("string"))
    a = left.withColumn("_dealt", F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(own))
    return a.join(right.withColumn("_dealt", own), [key, "_dealt"], how).drop("_dealt")
