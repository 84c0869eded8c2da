"""Column expressions for identity keys and text scrubbing.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so the expressions stay inside whole-stage
codegen and never cross into Python at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's for identical keys:
#   name cleaning removes ";" and the two-character sequence "/t"
#   (a slash followed by the letter t, not a tab), then lower-cases and trims;
#   phone stripping removes blank, "-", "(" and ")";
#   a phone counts for matching when its stripped length is at least 10;
#   text cells lose "\n", "\r", ";" and "\"; non-ASCII characters are dropped;
#   an anchor cell starts with '<a name="' and its name ends at '" href'.
NAME_DROP = (";", "/t")
PHONE_DROP = " -()"
MIN_PHONE_LEN = 10
CONTROL_DROP = "\n\r;\\"
ANCHOR_OPEN = '<a name="'
ANCHOR_CLOSE = '" href'


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_name(x: ColumnOrName) -> Column:
    """SC1: ``trim(lower(replace(replace(x, ';', ''), '/t', '')))``."""
    c = _c(x)
    for s in NAME_DROP:
        c = F.replace(c, F.lit(s), F.lit(""))
    return F.trim(F.lower(c))


def strip_phone(x: ColumnOrName) -> Column:
    """SC2: remove blanks, dashes and parentheses (dots and '+' stay)."""
    return F.translate(_c(x), PHONE_DROP, "")


def combine_phones(*phones: ColumnOrName, strip: bool = True) -> Column:
    """SC3: concatenation of the phones with NULL read as ''.

    The reference concatenates mobile, work, home in that order; the
    caller passes them in the order wanted.
    """
    parts = [strip_phone(p) if strip else _c(p) for p in phones]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def combine_long_phones(*phones: ColumnOrName, strip: bool = True) -> Column:
    """SC4: concatenation of only those phones at least 10 characters long."""
    parts = [strip_phone(p) if strip else _c(p) for p in phones]
    return F.concat(*[F.when(F.length(p) >= MIN_PHONE_LEN, p).otherwise(F.lit(""))
                      for p in parts])


def not_blank(x: ColumnOrName) -> Column:
    """FLT1: not NULL and not the empty string (a single blank passes)."""
    c = _c(x)
    return c.isNotNull() & (c != F.lit(""))


def word_after(x: ColumnOrName, marker: str) -> Column:
    """SC8: the blank-delimited word right after ``marker``.

    Missing marker gives '', NULL gives NULL (``split_part`` semantics).
    """
    return F.split_part(F.split_part(_c(x), F.lit(marker), F.lit(2)), F.lit(" "), F.lit(1))


def char_after(x: ColumnOrName, key: str, strict: bool = False) -> Column:
    """SC9: the one character that follows ``key``.

    Parity mode keeps the reference's behaviour for a missing key: ``instr``
    gives 0, so the character at position ``len(key)`` is returned.
    ``strict=True`` returns NULL when the key is absent.
    """
    c = _c(x)
    pos = F.instr(c, key)
    ch = F.substr(c, pos + F.lit(len(key)), F.lit(1))
    if strict:
        ch = F.when(pos > 0, ch)
    return ch


def strip_control(x: ColumnOrName) -> Column:
    """SC22: drop newline, carriage return, ';' and backslash characters.

    Cells are first tested with cheap byte searches; only cells holding one
    of the characters pay for the replacement.
    """
    c = _c(x)
    hit = None
    for ch in CONTROL_DROP:
        t = c.contains(ch)
        hit = t if hit is None else (hit | t)
    return F.when(hit, F.regexp_replace(c, r"[\n\r;\\]", "")).otherwise(c)


def strip_non_ascii(x: ColumnOrName) -> Column:
    """SC23: drop every character outside 0x00-0x7F.

    A cell whose UTF-8 byte length equals its character length is pure ASCII
    and is passed through without running the regular expression.
    """
    c = _c(x)
    return F.when(F.octet_length(c) == F.length(c), c) \
            .otherwise(F.regexp_replace(c, r"[^\x00-\x7F]", ""))


def anchor_name(x: ColumnOrName, exact: bool = False) -> Column:
    """SC24: the name inside an ``<a name="...">`` cell; other cells unchanged.

    Parity mode strips the *set* of characters of '<a name="' from the left
    (so 'maple' loses its 'ma'), splits on '" href' and keeps the first part
    when there are at least two parts, else ''. ``exact=True`` extracts the
    text between '<a name="' and '" href' instead.
    """
    c = _c(x)
    has = F.instr(c, ANCHOR_OPEN) > 0
    if exact:
        name = F.regexp_extract(c, r'<a name="(.*?)" href', 1)
    else:
        body = F.ltrim(c, F.lit(ANCHOR_OPEN))
        name = F.when(F.instr(body, ANCHOR_CLOSE) > 0,
                      F.split_part(body, F.lit(ANCHOR_CLOSE), F.lit(1))).otherwise(F.lit(""))
    return F.when(has, name).otherwise(c)


def yes_no(p: Column) -> Column:
    """SC25: 'yes' when the predicate is true, else 'no' (NULL reads as no)."""
    return F.when(p, F.lit("yes")).otherwise(F.lit("no"))


def contains_any(hay: ColumnOrName, needles: Iterable[ColumnOrName],
                 ignore_case: bool = True) -> Column:
    """DM6: ``hay ILIKE ANY(array['%'||n||'%', ...])`` without LIKE wildcards."""
    h = _c(hay)
    ns = [_c(n) for n in needles]
    if ignore_case:
        h = F.lower(h)
        ns = [F.lower(n) for n in ns]
    return F.exists(F.array(*ns), lambda n: n.isNotNull() & F.contains(h, n))
