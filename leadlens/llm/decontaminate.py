"""Benchmark decontamination by an FM-index per shard of training text.

A shard is a batch of documents. Its words become one sequence of small
integers; a word that no benchmark item holds becomes a separator, and runs
of words shorter than the shortest window are left out, since no window can
lie in them. All benchmark windows are searched backwards in that index, their
occurrences located by sampled suffix positions, and the covered words merged
into removal spans.

Words are runs of digits, a-z and code points from U+0080 on, after
lower-casing A-Z. A window is ``window`` consecutive words of an item; an
item with fewer words, but not none, is one window.

Defined cases: null and empty texts have no words; an item without words has
no window; rows of an item id are taken together; an item without an id marks
words but isn't counted among the items; repeated documents each get their own
row; an empty benchmark marks nothing; further columns are not read.

Scale: the documents are read once for each block of ``BLOCK_CHARS`` benchmark
characters, without a shuffle. A block is the only thing sent to executors,
and its size is checked before it is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.fm_index import FMIndex
from leadlens.llm.tables import narrowed

BLOCK_CHARS = 32_000_000
HITS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
VERDICT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "spans array<struct<start:long,end:long>>")
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                    for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class Windows:
    """The distinct windows of a block of items, as patterns of word numbers."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at:at + window]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set]]] = {}
        for m in sorted({len(p) for p in owners}):
            mine = [p for p in owners if len(p) == m]
            self.by_length[m] = np.array(mine, dtype=np.int64), [owners[p] for p in mine]
        self.shortest = min(self.by_length, default=0)

    def in_shard(self, texts: list[str]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: its words, merged spans of hit words, items found."""
        get = self.numbers.get
        rows = [np.array([get(w, 0) for w in words_of(t)], dtype=np.int32) for t in texts]
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))       # a separator after each text
        stream = np.zeros(int(starts[-1]), dtype=np.int32)
        for at, r in zip(starts[:-1].tolist(), rows, strict=True):
            stream[at:at + len(r)] = r
        cover = np.zeros(len(stream) + 1, dtype=np.int32)
        found: dict[int, set] = {}
        if self.shortest:
            for pos, which, m, owners in self._occurrences(stream):
                np.add.at(cover, pos, 1)
                np.add.at(cover, pos + m, -1)
                pairs = (np.searchsorted(starts, pos, side="right") - 1) * len(owners) + which
                for pair in np.unique(pairs).tolist():
                    doc, k = divmod(pair, len(owners))
                    found.setdefault(doc, set()).update(owners[k])
        hit = np.cumsum(cover[:-1]) > 0
        for k in range(len(texts)):
            spans = []
            if k in found:
                own = np.flatnonzero(np.diff(hit[starts[k]:starts[k] + sizes[k]].astype(np.int8),
                                             prepend=0, append=0))
                spans = list(zip(own[::2].tolist(), own[1::2].tolist(), strict=True))
            yield int(sizes[k]), spans, [x for x in found.get(k, ()) if x is not None]

    def _occurrences(self, stream: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, list[set]]]:
        """For each length of windows: places of all occurrences, and which window occurs there."""
        edge = np.flatnonzero(np.diff((stream > 0).astype(np.int8), prepend=0, append=0))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        places = np.concatenate([np.arange(a, b + 1) for a, b in
                                 zip(begin.tolist(), end.tolist(), strict=True)])
        index = FMIndex(np.append(stream, 0)[places], len(self.numbers) + 1)   # runs, each with its separator
        for m, (patterns, owners) in self.by_length.items():
            lo, hi = index.search(patterns)
            which = np.repeat(np.arange(len(lo)), hi - lo)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - hi + lo, hi - lo) + lo[which]
            yield places[index.locate(rows)], which, m, owners


def _hits(items: list[tuple[str | None, str]], window: int):
    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Windows(items, window)
        for texts in batches:
            yield pd.DataFrame([(n, [{"start": a, "end": b} for a, b in spans], found)
                                for n, spans, found in known.in_shard(texts.tolist())],
                               columns=["n_words", "spans", "items"])
    return hits


def _merged(blocks: list[pd.DataFrame], row: int, share: int) -> tuple:
    spans: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for x in blocks for s in x["spans"].iat[row]):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    items = sorted({i for x in blocks for i in x["items"].iat[row]})
    n_words, n_hit = int(blocks[0]["n_words"].iat[row]), sum(b - a for a, b in spans)
    return (n_words, n_hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(),
            n_hit > 0 and share * n_hit >= n_words, [{"start": a, "end": b} for a, b in spans])


def verdict(benchmark: DataFrame, text: Column, window: int = 13, share: int = 20,
            id_col: str = "item_id", text_col: str = "text") -> Column:
    """A struct column (``VERDICT``) for a text column of the training data.

    A text is contaminated if at least one in ``share`` of its words is hit.
    ``spans`` are the merged spans of hit words, end exclusive."""
    items = narrowed(benchmark, id_col, text_col).select(F.col("__id").cast("string").alias("id"),
                                                         F.col("__text").alias("text"))
    size = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    count = 1 + size // BLOCK_CHARS
    blocks = [items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == b).collect() for b in range(count)]

    @F.pandas_udf(VERDICT)
    def merge(batches: Iterator[tuple[pd.DataFrame, ...]]) -> Iterator[pd.DataFrame]:
        for found in batches:
            found = [found] if isinstance(found, pd.DataFrame) else list(found)
            yield pd.DataFrame([_merged(found, r, share) for r in range(len(found[0]))],
                               columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])
    text = F.coalesce(text, F.lit(""))
    return merge(*[_hits([tuple(r) for r in b], window)(text) for b in blocks])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", window: int = 13, share: int = 20) -> DataFrame:
    """id and the verdict's columns for every row of ``docs``."""
    return (narrowed(docs, id_col, text_col)
            .select(F.col("__id").alias("id"), verdict(benchmark, F.col("__text"), window, share).alias("v"))
            .select("id", "v.*"))
