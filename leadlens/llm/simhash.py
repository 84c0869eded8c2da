"""SimHash near-duplicate groups by pigeonhole blocks.

A text's fingerprint has a bit set where over half of its shingle hashes have
it (XXH64, seed 42, over the UTF-8 bytes of a run of words joined by one
space). Distinct fingerprints at a Hamming distance of at most ``max_bits``
are linked; a component's id is the smallest document id in it.

Candidates: 64 bits are cut into ``max_bits + 2`` blocks. A close pair differs
in at most ``max_bits`` of them, so at least two blocks are equal, and joining
on each pair of blocks finds every close pair. Rows of a bucket are sorted
side by side and compared in numpy; a bucket sends on one link for each row at
most (a spanning forest of what it found), never all its pairs.

A bucket above ``HOT_BUCKET`` rows isn't compared pairwise. Its rows go
through a second, linear, exact way: each fingerprint is filed under all
values at half the distance, and two fingerprints within ``max_bits`` meet
under one of them. All rows that meet there are close, so a link to the
smallest one is enough.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; fewer words than a shingle give one shingle of all words; repeated rows
and ids are linked like any others; a null id never becomes a component's id
unless all its ids are null; empty tables give empty results; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.components import connected_components
from leadlens.llm.tables import Scratch, narrowed, row_key

HOT_BUCKET = 4096
_STRIDE = 1 << 14


def fingerprint(text: str, words: int = 4) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    parts = text.encode().lower().split()      # bytes: ASCII blanks and A-Z only
    if not parts:
        return 0
    joined = memoryview(b" ".join(parts))
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(words, len(parts))
    n = len(parts) - k + 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], 42) for a, b in
                     zip(starts[:n].tolist(), (ends[k - 1:] - 1).tolist(), strict=True)),
                    dtype=np.uint64, count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _STRIDE):
        block = h[at:at + _STRIDE]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 4) -> DataFrame:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")
    return narrowed(docs, id_col, text_col).select(
        F.col("__id").alias("id"), row_key(F.col("__id"), F.col("__text")).alias("key"), of("__text").alias("fp"))


def _masks(max_bits: int) -> list[int]:
    """Bit masks of each pair of blocks, as signed integers."""
    blocks = max_bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    whole = [sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:], strict=False)]
    return [(m ^ (1 << 63)) - (1 << 63) for m in (x | y for x, y in combinations(whole, 2))]


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links (a, b) that join two trees; the others close a circle."""
    nodes, ids = np.unique(np.concatenate((a, b)), return_inverse=True)
    up = list(range(len(nodes)))
    ia, ib = ids[:len(a)].tolist(), ids[len(a):].tolist()
    keep = []
    for k, (x, y) in enumerate(zip(ia, ib, strict=True)):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x != y:
            up[max(x, y)] = min(x, y)
            keep.append(k)
    return np.asarray(keep, dtype=np.int64)


def _bucket_links(max_bits: int):
    def close(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        """Links between rows of a bucket; rows come sorted by (mask, key)."""
        left, right = [], []
        step, at = 1, np.arange(len(fp))
        while True:
            at = at[at + step < len(fp)]
            at = at[(key[at] == key[at + step]) & (mask[at] == mask[at + step])]
            if not len(at):
                break
            near = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= max_bits]
            if len(near):
                near = near[_forest(fp[near], fp[near + step])]
                left.append(fp[near])
                right.append(fp[near + step])
            step += 1
        if not left:
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        a, b = np.concatenate(left), np.concatenate(right)
        keep = _forest(a, b)
        return pd.DataFrame({"a": a[keep], "b": b[keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            if rest is not None:
                pdf = pd.concat([rest, pdf], ignore_index=True)
            mask, key, fp = (pdf[c].to_numpy() for c in ("mask", "key", "fp"))
            if not len(fp):
                continue
            whole = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))   # the last bucket may go on
            cut = whole[-1] + 1 if len(whole) else 0
            if cut:
                yield close(mask[:cut], key[:cut], fp[:cut])
            rest = pdf.iloc[cut:]
        if rest is not None and len(rest):
            yield close(*(rest[c].to_numpy() for c in ("mask", "key", "fp")))
    return run


def _hot_links(hot: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of hot buckets by values at half the distance."""
    half = (max_bits + 1) // 2
    flips = [0, *(sum(1 << b for b in c) for n in range(1, half + 1) for c in combinations(range(64), n))]
    signed = np.array(flips, dtype=np.uint64).view(np.int64)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy()
            for at in range(0, len(fp), 256):
                part = fp[at:at + 256]
                yield pd.DataFrame({"near": (part[:, None] ^ signed[None, :]).ravel(),
                                    "fp": np.repeat(part, len(signed))})
    filed = hot.select("fp").distinct().mapInPandas(spread, "near long, fp long")
    least = filed.groupBy("near").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
    links = filed.join(least.select("near", "a"), "near").where("a <> fp")
    return links.select("a", F.col("fp").alias("b")).distinct().where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links (a, b) that join every pair of distinct fingerprints within
    ``max_bits`` through links of that kind."""
    filed = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in _masks(max_bits)])).alias("mask"))
    filed = filed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    hot = filed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET)
    work = Scratch(distinct.sparkSession, "simhash-hot")
    hot = work.write(hot, "buckets")
    if hot.isEmpty():
        return _bucketed(filed, max_bits)
    cool = filed.join(hot, ["mask", "key"], "left_anti")
    return _bucketed(cool, max_bits).unionByName(
        _hot_links(filed.join(hot, ["mask", "key"], "left_semi"), max_bits))


def _bucketed(filed: DataFrame, max_bits: int) -> DataFrame:
    return (filed.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInPandas(_bucket_links(max_bits), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 4, max_bits: int = 4) -> DataFrame:
    """id, key (of id and text, see ``row_key``), fp, component_id and label (the
    component's smallest fingerprint, never null) of every row."""
    work = Scratch(docs.sparkSession, "simhash")
    rows = work.write(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = work.write(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    labels = connected_components(work, links(distinct.select("fp"), max_bits))
    named = (distinct.join(labels, distinct.fp == labels.node, "left")
             .select("fp", "least", F.coalesce("label", "fp").alias("label")))
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(roots, "label").select("fp", "component_id", "label")
    return rows.join(named, "fp").select("id", "key", "fp", "component_id", "label")
