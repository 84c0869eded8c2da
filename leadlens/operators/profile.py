"""Profile aggregates: conditional counts, age bands, distinct lists.

Everything here is a plain ``groupBy().agg()`` of built-in aggregates, so
Spark combines map-side before the shuffle and a hot key only costs one
partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_when(p: Column) -> Column:
    """AG3: ``count(case when p then 1 end)``; a NULL predicate is not counted."""
    return F.count_if(F.coalesce(p, F.lit(False)))


def sum_when(p: Column) -> Column:
    """AG4: ``sum(case when p then 1 else 0 end)`` as BIGINT."""
    return F.sum(F.when(p, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def distinct_list(x: Column | str, sep: str = ",") -> Column:
    """AG7: ``string_agg(distinct x, sep)`` sorted; NULL when no value."""
    c = F.col(x) if isinstance(x, str) else x
    # collect_set skips NULLs and is bounded by the distinct values of a
    # group; an empty set gives NULL like string_agg over no rows.
    arr = F.array_sort(F.collect_set(c.cast("string")))
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def ordered_list(x: Column | str, order: Sequence[Column | str], sep: str = ",") -> Column:
    """AG8: ``string_agg(x, sep)`` keeping duplicates, ordered by ``order``.

    The reference leaves the order unspecified; it is fixed here. NULL
    values are skipped; NULL when nothing is left. The group should be
    bounded (one identity's records), as every value is held at once.
    """
    c = F.col(x) if isinstance(x, str) else x
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    arr = F.collect_list(F.when(c.isNotNull(), F.struct(*ords, c.cast("string").alias("_v"))))
    vals = F.transform(F.array_sort(arr), lambda s: s["_v"])
    return F.when(F.size(vals) > 0, F.array_join(vals, sep))


def band_counts(age: Column, edges: Sequence[float], prefix: str,
                when: Column | None = None, total: bool = True) -> list[Column]:
    """AG11: counts per age band, bands open on the left and closed on the right.

    ``edges=[1, 3, 5, 10]`` gives ``<=1``, ``(1,3]``, ``(3,5]``, ``(5,10]``,
    ``>10``. Negative ages fall in the first band; NULL ages only count in
    the total. ``when`` restricts the rows (e.g. one item type), so several
    item types are profiled in one pass.
    """
    sel = F.lit(True) if when is None else when
    out = []
    if total:
        out.append(count_when(sel).alias(f"{prefix}_total"))
    lo = None
    names = []
    bounds = list(edges)
    for i, hi in enumerate(bounds + [None]):
        if lo is None:
            p = age <= F.lit(float(hi))
            nm = f"{prefix}_0_{_fmt(hi)}"
        elif hi is None:
            p = age > F.lit(float(lo))
            nm = f"{prefix}_{_fmt(lo)}_plus"
        else:
            p = (age > F.lit(float(lo))) & (age <= F.lit(float(hi)))
            nm = f"{prefix}_{_fmt(lo)}_{_fmt(hi)}"
        names.append(nm)
        out.append(count_when(sel & p).alias(nm))
        lo = hi
    return out


def _fmt(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x).replace(".", "_")


def state_counts(col: Column | str, states: Mapping[str, str]) -> list[Column]:
    """AG3 shorthand: one ``count_if(col = state)`` per (alias -> state)."""
    c = F.col(col) if isinstance(col, str) else col
    return [count_when(c == F.lit(v)).alias(k) for k, v in states.items()]


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL keys match each other (grouping semantics)."""
    r = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        t = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = t if cond is None else (cond & t)
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_distinct(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                  specs: Sequence[dict]) -> DataFrame:
    """Aggregates plus ``count(distinct v)`` and sorted distinct lists per key
    (AG6/AG7), in one grouping.

    Each spec names a ``value`` and ``count_as`` and/or ``list_as``. The
    distinct values of a group are held as a set, combined on the map side,
    so a group must be bounded by its domain (the units one person saw).
    """
    sets = [F.collect_set(F.col(x["value"]) if isinstance(x["value"], str) else x["value"]).alias(f"_set{i}")
            for i, x in enumerate(specs)]
    out = df.groupBy(*keys).agg(*aggs, *sets)
    for i, x in enumerate(specs):
        found = F.col(f"_set{i}")
        if x.get("count_as"):
            out = out.withColumn(x["count_as"], F.size(found).cast("long"))
        if x.get("list_as"):
            text = F.array_sort(F.transform(found, lambda v: v.cast("string")))
            out = out.withColumn(x["list_as"], F.when(F.size(found) > 0, F.array_join(text, ",")))
    return out.drop(*[f"_set{i}" for i in range(len(specs))])


def approx_distinct(x: Column | str, error: float = 0.02) -> Column:
    """AG6 for very large domains: a HyperLogLog++ estimate with a stated relative error."""
    return F.approx_count_distinct(x, error)
