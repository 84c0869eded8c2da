"""Phone-containment match join (JN6, JN7, JN8, JN12).

Two records match when their cleaned names are equal and a phone of one of
them (at least 10 characters) is a substring of the other's concatenated
``combined`` phones. In the two-way form the side with the longer
``combined`` is the haystack; in the one-way form the left phones are looked
up in the right haystack.

The naive plan is a sort-merge join on the names with the substring test as
a residual: every pair inside one name is compared, so a popular name turns
into a quadratic hot key. The blocked plan is lossless and equi-joins on
``(names, k)`` where ``k`` is the first 10 characters of the needle phone on
one side and every distinct 10-character slice of the haystack on the other
side: if ``p`` (>= 10 chars) occurs in ``h`` then ``p[:10]`` is one of
``h``'s slices. Candidates are then verified with the exact predicate.

Slices of a haystack that no needle begins with are screened out before the
shuffle: the needles' keys set bits in a bounded table, which is broadcast, and a
slice whose bit isn't set has no partner. Names that hold very
many rows are dealt out: the rows of the side that holds them go to parts by a
hash of their id, the other side's rows to each of the parts, so that no task
reads such a name alone. Both take stages of their own and only matter for the
layout, so they are left out where Spark estimates both sides at less than
``SMALL_BYTES``.

For anti and semi joins (existence only) the right side is first reduced to
distinct (names, needle, haystack length) or (names, haystack) values with
the smallest and largest right id, so the work grows with distinct phone
values per name, never with the number of record pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions.text import MIN_PHONE_LEN
from leadlens.operators.screen import screen, screened
from leadlens.session import estimated_bytes

SLICE = MIN_PHONE_LEN  # block key length; must not exceed the phone minimum
SMALL_BYTES = 256 << 20
HOT_ROWS = 100_000         # of one name and side; more are dealt out
HOT_NAMES, HOT_PARTS = 1000, 64      # at most
COUNT_ONE_IN = 16          # rows counted to find such names; a matter of layout alone


def _slices(h: Column) -> Column:
    """Distinct SLICE-long substrings of ``h`` (empty array when shorter)."""
    n = F.length(h) - F.lit(SLICE - 1)
    return F.when(F.length(h) >= SLICE, F.array_distinct(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.substr(h, i, F.lit(SLICE)))))\
        .otherwise(F.array().cast("array<string>"))


def _needle_ok(p: Column, hay: Column) -> Column:
    return (F.length(p) >= MIN_PHONE_LEN) & F.contains(hay, p)


def _any_needle(phones: Sequence[Column], hay: Column) -> Column:
    out = None
    for p in phones:
        t = _needle_ok(p, hay)
        out = t if out is None else (out | t)
    return out


def match_predicate(l_names, r_names, l_phones, r_phones, l_comb, r_comb,
                    direction: str = "longer") -> Column:
    """The exact match condition (names equal and phone containment)."""
    cond = None
    for a, b in zip(l_names, r_names):
        t = a == b
        cond = t if cond is None else (cond & t)
    if direction == "longer":
        body = ((F.length(l_comb) >= F.length(r_comb)) & _any_needle(r_phones, l_comb)) | \
               ((F.length(l_comb) < F.length(r_comb)) & _any_needle(l_phones, r_comb))
    elif direction == "l_in_r":
        body = _any_needle(l_phones, r_comb)
    else:
        raise ValueError(f"unknown direction {direction!r}")
    return cond & body


class _Sides:
    """Column bookkeeping: left keeps its names, right gets a prefix."""

    def __init__(self, left, right, on, left_id, right_id, left_phones, right_phones,
                 left_combined, right_combined, prefix):
        self.prefix = prefix
        self.on = [(o, o) if isinstance(o, str) else tuple(o) for o in on]
        self.left, self.right = left, right
        self.lid, self.rid = left_id, right_id
        self.lph, self.rph = list(left_phones), list(right_phones)
        self.lc, self.rc = left_combined, right_combined
        clash = set(left.columns) & {prefix + c for c in right.columns}
        if clash:
            raise ValueError(f"right prefix {prefix!r} clashes with left columns {sorted(clash)}")

    def r(self, c: str) -> str:
        return self.prefix + c

    def right_prefixed(self, df: DataFrame | None = None) -> DataFrame:
        df = self.right if df is None else df
        return df.select([F.col(c).alias(self.r(c)) for c in df.columns])

    @property
    def l_names(self):
        return [a for a, _ in self.on]

    @property
    def r_names(self):
        return [self.r(b) for _, b in self.on]


def row_key(cols: Sequence[str]) -> Column:
    """A content key for rows without an id (SHA-256 of the JSON of the values).

    256 bits make accidental collisions negligible even over 10^12 rows,
    which a 64-bit hash would not.
    """
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def identity_matches(left: DataFrame, right: DataFrame, *, on: Sequence,
                     left_phones: Sequence[str], left_combined: str,
                     key_col: str = "_lk", extra_key: Sequence[str] = (), **kw) -> DataFrame:
    """Matches of the *distinct identities* of ``left``: (key_col, prefixed right columns).

    The key is ``row_key`` over the left identity columns (names, phones,
    combined and ``extra_key``); compute the same key on any wide frame
    holding those columns and join the result in with one equi-join. This
    keeps the wide frame out of the match plan, so it is scanned once.
    ``kw`` takes the remaining ``containment_join`` arguments (how='inner'
    or 'left_semi' typical).
    """
    names = [o if isinstance(o, str) else o[0] for o in on]
    kcols = list(dict.fromkeys([*names, *left_phones, left_combined, *extra_key]))
    ident = left.select(row_key(kcols).alias(key_col), *kcols).dropDuplicates([key_col])
    out = containment_join(ident, right, on=on, left_id=key_col, left_phones=left_phones,
                           left_combined=left_combined, **kw)
    prefix = kw.get("right_prefix", "r_")
    return out.select(key_col, *[c for c in out.columns if c.startswith(prefix)])


def identity_key(on: Sequence, left_phones: Sequence[str], left_combined: str,
                 extra_key: Sequence[str] = ()) -> Column:
    """The key ``identity_matches`` uses, for the wide frame."""
    names = [o if isinstance(o, str) else o[0] for o in on]
    return row_key(list(dict.fromkeys([*names, *left_phones, left_combined, *extra_key])))


def containment_join(left: DataFrame, right: DataFrame, *, on: Sequence,
                     left_id: str | None, right_id: str | None,
                     left_phones: Sequence[str], right_phones: Sequence[str],
                     left_combined: str, right_combined: str,
                     how: str = "left", direction: str = "longer",
                     exclude_self: bool = False, right_filter: Column | None = None,
                     pair_filter: Column | None = None,
                     pair_columns: tuple[Sequence[str], Sequence[str]] = ((), ()),
                     blocked: bool = True, right_prefix: str = "r_") -> DataFrame:
    """Match ``left`` against ``right`` by names plus phone containment.

    how           'left' / 'inner' return left columns plus prefixed right
                  columns, one row per matching pair (bag semantics);
                  'left_anti' / 'left_semi' return left rows only.
    direction     'longer' (two-way, haystack = longer combined) or 'l_in_r'.
    exclude_self  add ``left_id <> right_id`` (the anti form of the mart).
    right_filter  predicate on the *unprefixed* right columns, applied first.
    pair_filter   predicate over left columns and prefixed right columns,
                  e.g. ``to_date('r_createdtime') >= to_date('created')``;
                  the columns it reads are listed in ``pair_columns``.
    ``left_id`` and ``right_id`` must identify rows uniquely on each side.
    Pass ``None`` for a side without such an id: the match then runs on the
    distinct identities of that side (content key, see ``row_key``) and is
    joined back, so repeated rows keep their multiplicity (bag semantics)
    without repeating the match work.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"unsupported how={how!r}")
    if right_filter is not None:
        right = right.filter(right_filter)
    kw = dict(on=on, left_phones=left_phones, right_phones=right_phones,
              left_combined=left_combined, right_combined=right_combined,
              direction=direction, exclude_self=exclude_self, pair_filter=pair_filter,
              pair_columns=pair_columns, blocked=blocked, right_prefix=right_prefix)
    if left_id is None:
        if exclude_self:
            raise ValueError("exclude_self needs a left_id")
        names = [o if isinstance(o, str) else o[0] for o in on]
        kcols = list(dict.fromkeys([*names, *left_phones, left_combined, *pair_columns[0]]))
        keyed = left.withColumn("_lk", row_key(kcols))
        ident = keyed.select("_lk", *kcols).dropDuplicates(["_lk"])
        if how in ("left_anti", "left_semi"):
            hit = containment_join(ident, right, left_id="_lk", right_id=right_id,
                                   how="left_semi", **kw).select("_lk")
            return keyed.join(hit, "_lk", how).drop("_lk")
        sub = containment_join(ident, right, left_id="_lk", right_id=right_id, how=how, **kw)
        rcols = [c for c in sub.columns if c.startswith(right_prefix)]
        return keyed.join(sub.select("_lk", *rcols), "_lk", how).drop("_lk")
    dedup_right = False
    if right_id is None:
        if exclude_self:
            raise ValueError("exclude_self needs a right_id")
        if how in ("left_anti", "left_semi"):
            # Existence only: right rows need no identity (and no dedup shuffle).
            right = right.withColumn("_rk", F.lit(0).cast("long"))
            right_id = "_rk"
        else:
            right = right.withColumn("_rk", row_key(right.columns))
            right_id, dedup_right = "_rk", True
    s = _Sides(left, right, on, left_id, right_id, left_phones, right_phones,
               left_combined, right_combined, right_prefix)
    if not blocked:
        return _naive(s, how, direction, exclude_self, pair_filter)
    if how in ("left_anti", "left_semi") and pair_filter is None:
        matched = _matched_left_ids(s, direction, exclude_self)
        return left.join(matched, on=left_id, how=how)
    pairs = _pairs(s, direction, exclude_self, pair_filter, pair_columns, dedup_right)
    if how in ("left_anti", "left_semi"):
        matched = pairs.select(F.col(left_id)).distinct()
        return left.join(matched, on=left_id, how=how)
    rp = s.right_prefixed()
    joined = pairs.select(left_id, s.r(right_id)).join(rp, on=s.r(right_id), how="inner")
    if dedup_right:
        joined = joined.drop(s.r(right_id))
    return left.join(joined, on=left_id, how=how)


def _naive(s: _Sides, how, direction, exclude_self, pair_filter) -> DataFrame:
    rp = s.right_prefixed()
    cond = match_predicate([F.col(c) for c in s.l_names], [rp[c] for c in s.r_names],
                           [F.col(c) for c in s.lph], [rp[s.r(c)] for c in s.rph],
                           F.col(s.lc), rp[s.r(s.rc)], direction)
    if exclude_self:
        cond = cond & (F.col(s.lid) != rp[s.r(s.rid)])
    if pair_filter is not None:
        cond = cond & pair_filter
    return s.left.join(rp, cond, how)


def _narrow_left(s: _Sides, extra: Sequence[str] = ()) -> DataFrame:
    cols = list(dict.fromkeys([s.lid, *s.l_names, *s.lph, s.lc, *extra]))
    return s.left.select(*cols)


def _narrow_right(s: _Sides, extra: Sequence[str] = ()) -> DataFrame:
    cols = list(dict.fromkeys([s.rid, *[b for _, b in s.on], *s.rph, s.rc, *extra]))
    return s.right_prefixed(s.right.select(*cols))


def _explode_needles(df: DataFrame, phones: Sequence[str], out: str = "_needle",
                     pos: str = "_pos") -> DataFrame:
    """One row per phone of at least MIN_PHONE_LEN chars, with its position."""
    arr = F.array(*[F.col(p) for p in phones])
    return (df.select("*", F.posexplode(arr).alias(pos, out))
              .filter(F.length(out) >= MIN_PHONE_LEN)
              .withColumn("_k", F.substr(F.col(out), F.lit(1), F.lit(SLICE))))


def _explode_slices(df: DataFrame, hay: str) -> DataFrame:
    return df.select("*", F.explode(_slices(F.col(hay))).alias("_k"))


class _Layout:
    """How the exploded sides of a match come together on names and ``_k``."""

    def __init__(self, names: Sequence[str], left: DataFrame, left_id: str, right: DataFrame,
                 right_id: str | None = None):
        self.names, self.left_id, self.right_id = list(names), left_id, right_id
        self.large = max(estimated_bytes(left), estimated_bytes(right)) >= SMALL_BYTES
        if self.large:
            self.hot = _hot_names(names, left, left_id, right if right_id else None, right_id)

    def screened(self, slices: DataFrame, needles: DataFrame) -> DataFrame:
        """Slices whose key some needle may have (never fewer than have one)."""
        keys = [*self.names, "_k"]
        return screened(slices, keys, screen(needles, keys)) if self.large else slices

    def join(self, a: DataFrame, b: DataFrame) -> DataFrame:
        if self.large:
            return _dealt_join(a, self.left_id, b, self.right_id, self.names, self.hot)
        return a.join(b, on=[*self.names, "_k"], how="inner")


def _hot_names(names: Sequence[str], left: DataFrame, left_id: str, right: DataFrame | None = None,
               right_id: str | None = None) -> DataFrame:
    """Names with more than ``HOT_ROWS`` rows of a side, and the number of parts
    that each side's rows are dealt into."""
    def counted(df, id_col, side):
        some = F.pmod(F.xxhash64(id_col), F.lit(COUNT_ONE_IN)) == 0
        return df.where(some).select(*names, *[F.lit(int(s == side)).alias(s) for s in ("_l", "_r")])
    rows = counted(left, left_id, "_l")
    if right is not None:
        rows = rows.unionByName(counted(right, right_id, "_r"))
    most = HOT_ROWS / COUNT_ONE_IN
    parts = lambda c: F.greatest(F.lit(1), F.least(F.lit(HOT_PARTS), F.ceil(F.col(c) / most))).cast("int")
    return (rows.groupBy(*names).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
            .where(F.greatest("_l", "_r") > most).orderBy(F.desc(F.greatest("_l", "_r"))).limit(HOT_NAMES)
            .select(*names, parts("_l").alias("_lparts"), parts("_r").alias("_rparts")))


def _dealt_join(a: DataFrame, a_id: str, b: DataFrame, b_id: str | None, names: Sequence[str],
                hot: DataFrame) -> DataFrame:
    """Join of ``a`` (left) and ``b`` on names and ``_k``, hot names dealt out."""
    hot = F.broadcast(hot)                                  # HOT_NAMES rows at most
    lparts, rparts = F.coalesce("_lparts", F.lit(1)), F.coalesce("_rparts", F.lit(1))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = lambda id_col, n: F.pmod(F.xxhash64(id_col), n).cast("int") if id_col else F.lit(0)
    a = a.join(hot, list(names), "left").select(*a.columns, own(a_id, lparts).alias("_lp"), each(rparts).alias("_rp"))
    b = b.join(hot, list(names), "left").select(*b.columns, own(b_id, rparts).alias("_rp"), each(lparts).alias("_lp"))
    return a.join(b, on=[*names, "_k", "_lp", "_rp"], how="inner")


def _first_hit(phones: Sequence[str], pos_col: str, hay: Column) -> Column:
    """True when no phone before position ``pos_col`` also occurs in ``hay``.

    Makes each (left, right) pair appear once per branch without a
    dedup shuffle.
    """
    cond = F.lit(True)
    for j, p in enumerate(phones):
        earlier_hit = (F.col(pos_col) > F.lit(j)) & F.coalesce(_needle_ok(F.col(p), hay), F.lit(False))
        cond = cond & ~earlier_hit
    return cond


def _pairs(s: _Sides, direction, exclude_self, pair_filter, pair_columns,
           dedup_right: bool = False) -> DataFrame:
    """(left_id, r_right_id) for every matching pair, each exactly once."""
    lx, rx = pair_columns
    L = _narrow_left(s, lx)
    R = _narrow_right(s, rx)
    if dedup_right:  # content-keyed right side: match each distinct row once
        R = R.dropDuplicates([s.r(s.rid)])
    lc, rc = F.col(s.lc), F.col(s.r(s.rc))
    rkeys = {rn: ln for ln, rn in zip(s.l_names, s.r_names)}

    def renamed(df: DataFrame) -> DataFrame:
        return df.select([F.col(c).alias(rkeys.get(c, c)) for c in df.columns])

    layout = _Layout(s.l_names, L, s.lid, renamed(R), s.r(s.rid))
    branches = []
    # Branch B: a left phone occurs in the right haystack.
    lb = _explode_needles(L, s.lph)
    rb = layout.screened(renamed(_explode_slices(R, s.r(s.rc))), lb)
    cond = F.contains(rc, F.col("_needle")) & _first_hit(s.lph, "_pos", rc)
    if direction == "longer":
        cond = cond & (F.length(lc) < F.length(rc))
    branches.append(layout.join(lb, rb).filter(cond))
    if direction == "longer":
        # Branch A: a right phone occurs in the left haystack.
        ra = renamed(_explode_needles(R, [s.r(p) for p in s.rph]))
        la = layout.screened(_explode_slices(L, s.lc), ra)
        cond = F.contains(lc, F.col("_needle")) & (F.length(lc) >= F.length(rc)) & \
            _first_hit([s.r(p) for p in s.rph], "_pos", lc)
        branches.append(layout.join(la, ra).filter(cond))
    out = []
    for b in branches:
        if exclude_self:
            b = b.filter(F.col(s.lid) != F.col(s.r(s.rid)))
        if pair_filter is not None:
            b = b.filter(pair_filter)
        out.append(b.select(s.lid, s.r(s.rid)))
    res = out[0]
    for b in out[1:]:
        res = res.unionByName(b)
    return res


def _matched_left_ids(s: _Sides, direction, exclude_self) -> DataFrame:
    """Distinct left ids with at least one match (no pair is materialised)."""
    L = _narrow_left(s)
    R = s.right
    names_r = [b for _, b in s.on]
    lc = F.col(s.lc)
    rename = {b: a for a, b in s.on}

    def as_left_names(df: DataFrame) -> DataFrame:
        return df.select([F.col(c).alias(rename.get(c, c)) for c in df.columns])

    def other_exists(min_id: str, max_id: str) -> Column:
        if not exclude_self:
            return F.lit(True)
        return (F.col(min_id) != F.col(s.lid)) | (F.col(max_id) != F.col(s.lid))

    hits = []
    layout = _Layout(s.l_names, L, s.lid, R.select(*names_r, s.rc))
    # Branch B: left phone inside a right haystack. Reduce right to distinct
    # haystacks per name with the smallest and largest id holding it.
    rh = (R.select(*names_r, F.col(s.rc).alias("_hay"), F.col(s.rid).alias("_rid"))
           .filter(F.length("_hay") >= SLICE)
           .groupBy(*names_r, "_hay")
           .agg(F.min("_rid").alias("_min_id"), F.max("_rid").alias("_max_id")))
    lb = _explode_needles(L, s.lph)
    rh = layout.screened(as_left_names(_explode_slices(rh, "_hay")), lb)
    cond = F.contains(F.col("_hay"), F.col("_needle")) & other_exists("_min_id", "_max_id")
    if direction == "longer":
        cond = cond & (F.length(lc) < F.length("_hay"))
    hits.append(layout.join(lb, rh).filter(cond).select(s.lid))
    if direction == "longer":
        # Branch A: right phone inside the left haystack. Reduce right to
        # distinct (name, phone, haystack length).
        rn = _explode_needles(R.select(*names_r, *s.rph, F.col(s.rid).alias("_rid"),
                                       F.length(s.rc).alias("_rlen")), s.rph)
        rn = (rn.groupBy(*names_r, "_needle", "_k", "_rlen")
                .agg(F.min("_rid").alias("_min_id"), F.max("_rid").alias("_max_id")))
        rn = as_left_names(rn)
        la = layout.screened(_explode_slices(L, s.lc), rn)
        cond = F.contains(lc, F.col("_needle")) & (F.length(lc) >= F.col("_rlen")) & \
            other_exists("_min_id", "_max_id")
        hits.append(layout.join(la, rn).filter(cond).select(s.lid))
    res = hits[0]
    for h in hits[1:]:
        res = res.unionByName(h)
    return res.distinct()


def containment_min(left: DataFrame, right: DataFrame, *, on: Sequence, left_id: str,
                    left_phones: Sequence[str], right_phones: Sequence[str],
                    left_combined: str, right_combined: str, value: str,
                    direction: str = "longer", largest: bool = False,
                    out: str | None = None) -> DataFrame:
    """(left_id, min/max of right ``value`` over all matching right rows).

    Exact and pair-free: min and max decompose, so the right side is
    reduced to the blocking values first -- (names, haystack) for "left
    phone in right haystack", (names, phone, haystack length) for "right
    phone in left haystack" -- each carrying the min (max) of ``value``.
    Candidates then grow with distinct phone values per name, not with the
    people behind them. Left ids without any match are absent.
    """
    s = _Sides(left, right, on, left_id, "_unused", left_phones, right_phones,
               left_combined, right_combined, "r_")
    agg = F.max if largest else F.min
    out = out or value
    L = _narrow_left(s)
    names_r = [b for _, b in s.on]
    rename = {b: a for a, b in s.on}
    lc = F.col(s.lc)

    def as_left_names(df: DataFrame) -> DataFrame:
        return df.select([F.col(c).alias(rename.get(c, c)) for c in df.columns])

    hits = []
    layout = _Layout(s.l_names, L, s.lid, right.select(*names_r, s.rc))
    rh = (right.select(*names_r, F.col(s.rc).alias("_hay"), F.col(value).alias("_v"))
               .filter(F.length("_hay") >= SLICE).groupBy(*names_r, "_hay")
               .agg(agg("_v").alias("_v")))
    lb = _explode_needles(L, s.lph)
    rh = layout.screened(as_left_names(_explode_slices(rh, "_hay")), lb)
    cond = F.contains(F.col("_hay"), F.col("_needle"))
    if direction == "longer":
        cond = cond & (F.length(lc) < F.length("_hay"))
    hits.append(layout.join(lb, rh).filter(cond).select(s.lid, "_v"))
    if direction == "longer":
        rn = _explode_needles(right.select(*names_r, *s.rph, F.col(value).alias("_v"),
                                           F.length(s.rc).alias("_rlen")), s.rph)
        rn = as_left_names(rn.groupBy(*names_r, "_needle", "_k", "_rlen").agg(agg("_v").alias("_v")))
        cond = F.contains(lc, F.col("_needle")) & (F.length(lc) >= F.col("_rlen"))
        la = layout.screened(_explode_slices(L, s.lc), rn)
        hits.append(layout.join(la, rn).filter(cond).select(s.lid, "_v"))
    res = hits[0]
    for h in hits[1:]:
        res = res.unionByName(h)
    return res.groupBy(s.lid).agg(agg("_v").alias(out))
