"""Removal of repeated byte strings with a logarithmic family of suffix indexes.

Every window of ``window`` bytes has an anchor chosen by its content (see
``anchors``), so it is enough to index one suffix for each run of windows with
one anchor (a unit). A batch's sparse suffix array holds its units sorted by
the hash of the anchor's gram, then by the hash of the unit's whole text. A new
batch is merge-scanned against all levels of the index: neighbours with the
same unit text repeat whole, and neighbours that share only the gram are
compared byte by byte to both sides of it. A batch is then pushed as a level,
and as long as the two newest levels have the same rank they are merged into
one, so an index of n batches keeps at most log2(n) + 1 of them.

A byte is removed if a string of ``window`` bytes that covers it also starts
anywhere else in the input, in the same text or another. Strings are judged on
the input, never on what is left, and never cross texts.

Defined cases: null and empty texts have no bytes; texts below ``window`` bytes
stay whole; rows that repeat an id and a text repeat each other, so all their
bytes go if there are ``window`` of them; further columns are not read. Kept
bytes can begin or end inside a character and are returned as binary.

Scale: a unit stands for about 70 bytes and takes about 30 in the one exchange
by gram. Units that repeat inside a batch of rows are settled there, and one
of them goes on, so text that a third of all rows hold sends one row a batch.
Texts are dealt out once by their key, for the comparison and the removal
alike. A gram with more than ``HEAVY`` different units isn't gathered in one
place: its units are dealt out evenly, and their windows are hashed and counted
by a grouped sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.anchors import WHOLE, units
from leadlens.llm.tables import Scratch, narrowed

PART = 8_000_000        # bytes of a text hashed at once
PAIRWISE, HEAVY = 24, 200_000      # units of a gram that are compared in pairs, in one task
_UNITS = "done boolean, deal long, k long, u long, shape int, key long, start long, twice boolean"
_FOUND = "kind int, k long, key long, start long, shape int"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return narrowed(docs, id_col, text_col).select(
        F.col("__id").alias("id"), F.col("__text").alias("text"),
        F.xxhash64(F.col("__id").cast("string"), "__text").alias("key"))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def suffixes(rows: DataFrame, window: int) -> DataFrame:
    """A batch's units. ``shape`` packs the windows of a unit and the gram's
    offset in it; ``done`` rows are known to repeat and only pass through."""
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for key, text in zip(pdf["key"], pdf["text"], strict=True):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                for at in range(0, max(1, len(data) - window + 1), PART - window + 1):
                    own = data[at:at + PART]
                    k, anchor, first, last = units(own, window)
                    if len(k):
                        u = WHOLE.of(WHOLE.sums(own), first, last + window)
                        parts.append((k, u, (last - first) << 16 | anchor - first, first + at,
                                      np.full(len(k), key, dtype=np.int64)))
            if not parts:
                continue
            k, u, shape, start, key = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((shape, u, k))
            k, u, shape, start, key = k[order], u[order], shape[order], start[order], key[order]
            same = (k[1:] == k[:-1]) & (u[1:] == u[:-1]) & (shape[1:] == shape[:-1])
            done = np.concatenate(([False], same))
            twice = ~done & np.concatenate((same, [False]))
            yield pd.DataFrame({"done": done, "deal": np.where(done, key + start, _signed(k)), "k": _signed(k),
                                "u": _signed(u), "shape": shape.astype(np.int32), "key": key, "start": start,
                                "twice": twice})
    return rows.select("key", "text").mapInPandas(index, _UNITS)


def _sorted(run: DataFrame) -> DataFrame:
    return run.repartition("deal").sortWithinPartitions("done", "k", "u", "shape")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge-scan of sorted units: kind 0 repeats whole; kind 1 stands for a
    unit text whose gram has other unit texts too, kind 2 the same if the text
    itself is found once."""
    rest, last_k = None, None       # rows of the last unit text so far; gram of the one before it
    for pdf in batches:
        passed = pdf[pdf["done"]]
        if len(passed):
            yield _found(0, passed)
        pdf = pdf[~pdf["done"]]
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        out, last_k, rest = _settled(pdf.reset_index(drop=True), last_k, False)
        yield from out
    if rest is not None and len(rest):
        yield from _settled(rest, last_k, True)[0]


def _found(kind: int, rows: pd.DataFrame) -> pd.DataFrame:
    return rows[["k", "key", "start", "shape"]].assign(kind=kind)[["kind", "k", "key", "start", "shape"]]


def _settled(pdf: pd.DataFrame, last_k: int | None, ended: bool):
    k, u, shape = (pdf[c].to_numpy() for c in ("k", "u", "shape"))
    fresh = np.ones(len(k), dtype=bool)
    fresh[1:] = (k[1:] != k[:-1]) | (u[1:] != u[:-1]) | (shape[1:] != shape[:-1])
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, len(k)))
    gram = k[first]
    before = np.concatenate(([last_k is not None and gram[0] == last_k], gram[1:] == gram[:-1]))
    after = np.append(gram[1:] == gram[:-1], False)
    whole = len(first) if ended else len(first) - 1
    repeats = (size > 1) | np.maximum.reduceat(pdf["twice"].to_numpy().astype(np.int8), first).astype(bool)
    closed = np.arange(len(first)) < whole
    many = repeats & closed
    out = []
    if many.any():
        out.append(_found(0, pdf[np.repeat(many, size)]))
    shared = (before | after) & closed
    for kind, chosen in ((1, shared & repeats), (2, shared & ~repeats)):
        if chosen.any():
            out.append(_found(kind, pdf.iloc[first[chosen]]))
    last = gram[whole - 1] if whole else last_k
    return out, last, None if ended else pdf.iloc[first[-1]:]


class LogIndex:
    """Levels of sorted units in the shared folder, oldest and largest first."""

    def __init__(self, work: Scratch, window: int):
        self.work, self.window = work, window
        self.levels: list[tuple[int, str]] = []       # rank, table
        self._count = 0

    def _level(self, name: str) -> DataFrame:
        return self.work.spark.read.schema(_UNITS).parquet(self.work.path(name))

    def _write(self, run: DataFrame) -> str:
        self._count += 1
        name = f"level-{self._count}"
        self.work.write(_sorted(run), name)
        return name

    def push(self, rows: DataFrame) -> None:
        """Index a batch and merge levels of equal rank."""
        self.levels.append((0, self._write(suffixes(rows, self.window))))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a), (_, b) = self.levels[-2:]
            merged = self._write(self._level(a).unionByName(self._level(b)))
            self.levels[-2:] = [(rank + 1, merged)]
            self.work.drop(a)
            self.work.drop(b)

    def scan(self, rows: DataFrame) -> DataFrame:
        """Matches among a batch that isn't pushed and all levels."""
        run = suffixes(rows, self.window)
        for _, name in self.levels:
            run = run.unionByName(self._level(name))
        return _sorted(run).mapInPandas(_scan, _FOUND)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _few(group: list[tuple], window: int) -> Iterator[tuple[int, int, int]]:
    """Repeated spans of units with one gram, by comparing them in pairs."""
    sides = [(ctx[:at][::-1], ctx[at:]) for _, _, at, ctx, _ in group]
    for i, (key, start, at, _, once) in enumerate(group):
        if not once:
            continue
        spans = set()
        for j, (left, right) in enumerate(sides):
            if j != i:
                reach = _common(sides[i][1], right)
                back = _common(sides[i][0], left)
                if back + reach >= window:
                    spans.add((back, reach))
        for back, reach in spans:
            yield key, start + at - back, start + at + reach


def _windows(start: int, at: int, ctx: bytes, window: int):
    """Offset before the gram, start and hash of each window of a unit."""
    hashes = WHOLE.runs(WHOLE.sums(np.frombuffer(ctx, dtype=np.uint8)), window)
    n = np.arange(len(hashes))
    return at - n, start + n, hashes


def _many(group: list[tuple], window: int) -> Iterator[tuple[int, int, int]]:
    """The same for a larger group: texts are aligned on the gram, one byte
    column after the other, and at each offset the hashes of all units' windows
    are moved on by one byte and compared."""
    at = np.array([g[2] for g in group])
    size = np.array([len(g[3]) for g in group])
    once = np.array([g[4] for g in group])
    left, first = int(at.max()), int((at - size + window).min())
    cells = np.zeros((len(group), left + max(int((size - at).max()), window - first)), dtype=np.uint8)
    for i, (_, _, a, ctx, _) in enumerate(group):
        cells[i, left - a:left - a + len(ctx)] = np.frombuffer(ctx, dtype=np.uint8)
    cells = np.ascontiguousarray(cells.T)
    table, base = WHOLE.table, np.uint64(WHOLE.base)
    top = np.uint64(pow(WHOLE.base, window - 1, 1 << 64))
    low, high = np.full(len(group), -9), np.full(len(group), -9)     # offsets of the run of repeats in progress
    runs = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(group), dtype=np.uint64)
        for i in reversed(range(window)):
            h = h * base + table[cells[left - first + i]]
        for o in range(first, left + 1):
            has = np.flatnonzero((o <= at) & (at - o + window <= size))
            _, inverse, counts = np.unique(h[has], return_inverse=True, return_counts=True)
            hit = has[(counts[inverse] > 1) & once[has]]
            more = hit[high[hit] == o - 1]
            high[more] = o
            fresh = hit[high[hit] != o]
            runs += [(i, low[i], high[i]) for i in fresh[high[fresh] >= 0]]
            low[fresh] = high[fresh] = o
            if o < left:
                h = table[cells[left - o - 1]] + base * (h - table[cells[left - o + window - 1]] * top)
    runs += [(i, low[i], high[i]) for i in np.flatnonzero(high >= 0)]
    for i, lo, hi in runs:
        key, start, a = group[i][:3]
        yield key, int(start + a - hi), int(start + a - lo + window)


_CONTEXT = "deal long, heavy boolean, k long, key long, start long, at int, ctx binary, once boolean"
_SPANS = "k long, key long, start long, end long, at int, ctx binary, once boolean"


def _resolved(window: int):
    """Spans of units with one gram; rows of heavy grams pass through."""
    columns = ["k", "key", "start", "end", "at", "ctx", "once"]

    def finish(k: int, group: list[tuple]) -> list[tuple]:
        if len(group) < 2:
            return []
        spans = (_few if len(group) <= PAIRWISE else _many)(group, window)
        return [(k, key, start, end, None, None, None) for key, start, end in spans]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, group = None, []
        for pdf in batches:
            out = []
            for _, heavy, k, key, start, at, ctx, once in pdf.itertuples(index=False):
                if heavy:
                    out.append((k, key, start, None, at, ctx, once))
                    continue
                if k != now:
                    out += finish(now, group)
                    now, group = k, []
                group.append((key, start, at, ctx, once))
            if out:
                yield _frame(out, columns)
        if group:
            yield _frame(finish(now, group), columns)
    return run


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=columns, dtype=object)
    for c in ("end", "at"):
        pdf[c] = pdf[c].astype("Int64" if c == "end" else "Int32")
    return pdf.astype({"k": "int64", "key": "int64", "start": "int64"})


def _heavy(rows: DataFrame, window: int) -> DataFrame:
    """Spans of units of very frequent grams: windows that occur twice by a grouped sum."""
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k, key, start, at, ctx, once in pdf.itertuples(index=False):
                offset, begin, h = _windows(start, at, ctx, window)
                with np.errstate(over="ignore"):
                    h = h + offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                yield pd.DataFrame({"k": k, "h": _signed(h), "key": key, "start": begin, "once": once})
    filed = rows.select("k", "key", "start", "at", "ctx", "once").mapInPandas(
        spread, "k long, h long, key long, start long, once boolean")
    twice = filed.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "h")
    return (filed.where("once").join(twice, ["k", "h"], "left_semi")
            .select("key", "start", (F.col("start") + window).alias("end")))


def _contexts(window: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, text, asked in pdf.itertuples(index=False):
                raw = text.encode()
                for r in asked:
                    k, start, shape = r["k"], r["start"], r["shape"]
                    rows.append((key ^ start if r["heavy"] else k, r["heavy"], k, key, start, shape & 0xFFFF,
                                 raw[start:start + (shape >> 16) + window], r["kind"] == 2))
            yield pd.DataFrame(rows, columns=["deal", "heavy", "k", "key", "start", "at", "ctx", "once"])
    return cut


def repeated_spans(texts: DataFrame, found: DataFrame, window: int, work: Scratch) -> DataFrame:
    """key, start, end of repeated spans in bytes, from the matches of a scan."""
    shares = found.where("kind > 0")
    heavy = work.write(shares.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY)
                       .select("k", F.lit(True).alias("heavy")), "heavy")
    asked = (shares.join(heavy, "k", "left").groupBy("key")
             .agg(F.collect_set(F.struct("kind", "k", "start", "shape", F.coalesce("heavy", F.lit(False))
                                         .alias("heavy"))).alias("asked")))
    contexts = (texts.join(asked, "key").select("key", "text", "asked")
                .mapInPandas(_contexts(window), _CONTEXT).distinct())
    shared = work.write(contexts.repartition("deal").sortWithinPartitions("heavy", "k")
                        .mapInPandas(_resolved(window), _SPANS), "shared")
    whole = found.where("kind = 0").select(
        "key", "start", (F.col("start") + F.shiftright("shape", 16) + window).alias("end"))
    spans = whole.unionByName(shared.where("end is not null").select("key", "start", "end"))
    if heavy.isEmpty():
        return spans
    return spans.unionByName(_heavy(shared.where("end is null"), window))


def deduplicated(docs: DataFrame, batch_of: Column | None = None, batches: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", window: int = 200) -> DataFrame:
    """id, n_bytes, spans (removed byte ranges, merged) and kept (binary) of every row.

    ``batch_of`` numbers the batch of a row (over ``id``), from 0 on; the last
    batch is scanned against the index of the others."""
    work = Scratch(docs.sparkSession, "suffix-dedup")
    texts = keyed(docs, id_col, text_col)
    index = LogIndex(work, window)
    number = F.lit(0) if batch_of is None else batch_of
    for b in range(batches - 1):
        index.push(texts.where(number == b))
    found = work.write(index.scan(texts.where(number == batches - 1)), "found")
    for _, name in index.levels:
        work.drop(name)
    spans = repeated_spans(texts, found, window, work)
    per_text = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("raw"))

    @F.pandas_udf("spans array<struct<start:long,end:long>>, kept binary")
    def removed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, raw in batches:
            yield pd.DataFrame([_removed(t, r) for t, r in zip(text, raw, strict=True)],
                               columns=["spans", "kept"])
    touched = F.when(F.col("raw").isNotNull(), F.col("text"))
    return (texts.join(per_text, "key", "left")
            .select("id", F.octet_length("text").cast("long").alias("n_bytes"),
                    F.when(F.col("raw").isNull(), F.encode("text", "UTF-8")).alias("all"),
                    removed(touched, "raw").alias("r"))
            .select("id", "n_bytes", F.coalesce("r.spans", F.array().cast("array<struct<start:long,end:long>>"))
                    .alias("spans"), F.coalesce("r.kept", "all").alias("kept")))


def _removed(text: str | None, raw) -> tuple:
    if text is None:
        return None, None
    data, merged = text.encode(), []
    for start, end in sorted((r["start"], r["end"]) for r in raw):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    edges = [0, *(x for s in merged for x in s), len(data)]
    kept = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
    return [{"start": a, "end": z} for a, z in merged], kept
