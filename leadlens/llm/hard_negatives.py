"""Hard negatives by best-first search in a packed R-tree.

Vectors become integer vectors. Sort-tile-recursive packing orders them: the
coordinates with the largest spread cut the space into tiles of about equal
numbers of rows, each task packs its tiles into leaves of ``LEAF`` rows the
same way, and inner nodes join ``FANOUT`` neighbours. A node's minimum bounding
box has an interval for each coordinate, so the inner product of an anchor with
whatever lies in the box has an interval too. A search keeps the nodes in a
queue by their upper ends, the best first. It leaves out boxes that lie outside
the score windows or strictly below the k-th score found so far, and is exact.

For each anchor, a first search finds its positives (best rows of its label), a
second one the best rows of other labels in the window of each positive, all
windows in one walk.

Cuts are fitted on about ``SAMPLE_ROWS`` rows (chosen by a hash) and
``CUT_DIMS`` coordinates; every row is indexed, whatever tile it falls in. A
tile with many rows (a vector that a third of all rows hold) is dealt over
several trees, whose boxes may overlap.

Defined cases: rows with a null label, a null vector or a null or non-finite
entry take no part; missing entries of shorter vectors count as zero; scaled
entries beyond 10^15 count as that, scores beyond 64 bits as the nearest such
number; rows that repeat an id are rows of their own, a null id comes after all
others, equal scores and ids are taken in the order of the written rows; an
anchor without other rows of its label has no result, nor has a positive with
a negative score (its window is empty); empty tables give empty results;
further columns are not read.

Scale: anchors are collected ``BLOCK`` at a time and sent to all trees, each
task returns the best few rows of an anchor, and a window keeps the best of
those. That is the query set against all rows, in blocks: with vectors without
any clusters no box can be left out, and the work grows with rows times anchors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.tables import Scratch

LEAF, FANOUT = 64, 16
TREE_LEAVES = 1024         # searched as one tree
TILE_ROWS = 2048           # of a tree, about
TILES = (32, 1 << 14)      # least and most
CUT_DIMS = 14
SAMPLE_ROWS = 60_000
BLOCK = 4096               # anchors
_LIMIT = 1e15
_LONG = (1 << 63) - 1
_EXACT = float(1 << 53)
_LEAVES = "part long, leaf int, rids binary, ids binary, nulls binary, labels binary, dims int, wide boolean, x binary"
_FOUND = "anchor long, slot int, score long, id long, rid long"


# ---- packing

def slabs(tiles: int, dims: int) -> int:
    """Slabs of the next coordinate, of ``dims`` that are left."""
    return math.ceil(tiles ** (1 / dims) - 1e-9)


def cuts(points: np.ndarray, tiles: int, dim: int = 0):
    """Nested (coordinate, bounds, parts) that cut the space into ``tiles`` tiles."""
    if tiles <= 1 or dim >= points.shape[1]:
        return None
    s = slabs(tiles, points.shape[1] - dim)
    ordered = points[np.argsort(points[:, dim], kind="stable")]
    places = [len(ordered) * k // s for k in range(s + 1)]
    bounds = [ordered[p, dim] for p in places[1:-1]] if len(ordered) else []
    parts = [cuts(ordered[a:b], math.ceil(tiles / s), dim + 1) for a, b in zip(places, places[1:])]
    return (dim, np.array(bounds), parts) if len(ordered) else None


def tile_numbers(points: np.ndarray, tree) -> np.ndarray:
    """The tile of each point."""
    out = np.zeros(len(points), dtype=np.int64)

    def walk(node, rows, number):
        if node is None:
            out[rows] = number
            return number + 1
        dim, bounds, parts = node
        slab = np.searchsorted(bounds, points[rows, dim], side="right")
        for k, part in enumerate(parts):
            number = walk(part, rows[slab == k], number)
        return number
    walk(tree, np.arange(len(points)), 0)
    return out


def packed(x: np.ndarray) -> list[np.ndarray]:
    """Rows of each leaf."""
    dims = np.argsort(-x.std(axis=0), kind="stable") if len(x) else []

    def split(rows, depth):
        leaves = math.ceil(len(rows) / LEAF)
        if leaves <= 1 or depth >= len(dims):
            return [rows[a:a + LEAF] for a in range(0, len(rows), LEAF)]
        s = slabs(leaves, len(dims) - depth)
        ordered = rows[np.argsort(x[rows, dims[depth]], kind="stable")]
        size = LEAF * math.ceil(leaves / s)
        return [leaf for a in range(0, len(ordered), size) for leaf in split(ordered[a:a + size], depth + 1)]
    return split(np.arange(len(x)), 0)


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    inside = lambda c: F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), c * scale))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"),
                        F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
            .select("id", "label", "anchor", F.transform("v", lambda c: F.floor(inside(c)).cast("double")).alias("x"))
            .withColumn("rid", F.monotonically_increasing_id()))


def pack(rows: DataFrame, work: Scratch) -> tuple[DataFrame, int]:
    """The leaves of all trees as a written table, and the number of coordinates."""
    spark = rows.sparkSession
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    dims = dims or 0
    if not n or not dims:
        return spark.createDataFrame([], _LEAVES), 0
    tiles = min(TILES[1], max(TILES[0], math.ceil(n / TILE_ROWS)))
    spread = {r["pos"]: r["s"] for r in rows.select(F.posexplode("x").alias("pos", "c"))
              .groupBy("pos").agg(F.var_pop("c").alias("s")).collect()}
    first = sorted(range(dims), key=lambda j: (-spread.get(j, 0.0), j))[:CUT_DIMS]
    draw = F.pmod(F.xxhash64("rid"), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, SAMPLE_ROWS / n))
    chosen = F.array(*[F.coalesce(F.get("x", F.lit(j)), F.lit(0.0)) for j in first])
    sample = np.array([r["c"] for r in rows.where(draw).select(chosen.alias("c")).collect()])
    tree = cuts(sample.reshape(-1, len(first)), tiles)

    @F.pandas_udf("long")
    def tile(column: pd.Series) -> pd.Series:
        return pd.Series(tile_numbers(_matrix(column, len(first)), tree))
    rows = work.write(rows.withColumn("tile", tile(chosen)), "tiles")
    most = min(TILE_ROWS, max(4 * LEAF, math.ceil(1.5 * n / tiles)))      # rows of a tree
    count = rows.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    trees = count.select("tile", F.ceil(F.col("n") / most).cast("long").alias("trees"))
    parts = F.pmod(F.xxhash64("rid", F.lit(1)), F.col("trees"))
    dealt = rows.join(F.broadcast(trees), "tile").select(      # a row for each tile: TILES[1] at most
        F.xxhash64("tile", parts).alias("part"), "rid", F.coalesce("id", F.lit(0)).alias("id"),
        F.col("id").isNull().alias("none"), "label", "x")

    def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid")
        x = _matrix(pdf["x"], dims)
        wide = bool(np.abs(x).max(initial=0) >= 1 << 15)
        kept = x.astype(np.float64 if wide else np.int16)
        rid, ids, none, label = (pdf[c].to_numpy() for c in ("rid", "id", "none", "label"))
        return pd.DataFrame([(pdf["part"].iloc[0], k, rid[r].tobytes(), ids[r].tobytes(),
                              none[r].astype(np.uint8).tobytes(), label[r].tobytes(), dims, wide, kept[r].tobytes())
                             for k, r in enumerate(packed(x))],
                            columns=["part", "leaf", "rids", "ids", "nulls", "labels", "dims", "wide", "x"])
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(n / (16 * TILE_ROWS)))
    found = work.write(dealt.repartition(tasks, "part").groupBy("part").applyInPandas(leaves, _LEAVES), "leaves")
    return found, dims


# ---- search

@dataclass
class Anchor:
    rid: int
    label: int
    x: np.ndarray
    windows: list[tuple[float, float]]        # lowest and highest score, both included
    found: list[list[tuple]] = field(default_factory=list)       # for each window, sorted

    def __post_init__(self):
        self.found = [[] for _ in self.windows]
        self.above, self.below = np.maximum(self.x, 0), np.minimum(self.x, 0)
        self.size = float(np.abs(self.x).max(initial=0))


class Tree:
    """Nodes over the leaves of some rows of the table, levels from the top."""

    def __init__(self, leaves: pd.DataFrame):
        self.rows = []
        for r in leaves.itertuples():
            x = np.frombuffer(r.x, dtype=np.float64 if r.wide else np.int16).reshape(-1, r.dims).astype(np.float64)
            self.rows.append((x, *(np.frombuffer(b, dtype=np.int64) for b in (r.rids, r.ids, r.labels)),
                              np.frombuffer(r.nulls, dtype=np.uint8)))
        low = np.array([x.min(axis=0) for x, *_ in self.rows])
        high = np.array([x.max(axis=0) for x, *_ in self.rows])
        self.size = float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
        self.levels = [(low, high)]
        while len(low) > FANOUT:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.insert(0, (low, high))

    def interval(self, level: int, a: int, b: int, q: Anchor) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner product of the anchor with nodes a to b."""
        low, high = self.levels[level][0][a:b], self.levels[level][1][a:b]
        return low @ q.above + high @ q.below, high @ q.above + low @ q.below

    def search(self, q: Anchor, same: bool, k: int) -> None:
        """Put the anchor's best ``k`` rows of each window among ``q.found``."""
        dims = len(q.x)
        exact = dims * q.size * self.size < _EXACT
        slack = 0.0 if exact else dims * q.size * self.size * 1e-12       # more than sums can be off
        floors = [max(low, -f[k - 1][0]) if len(f) == k else low for (low, _), f in zip(q.windows, q.found)]
        top = max(high for _, high in q.windows)
        least = min(floors)
        last = len(self.levels) - 1
        queue: list[tuple[float, int, int]] = []

        def offer(level, a, b):
            lows, highs = self.interval(level, a, b, q)
            for j in np.flatnonzero((highs + slack >= least) & (lows - slack <= top)).tolist():
                heapq.heappush(queue, (-highs[j], level, a + j))
        offer(0, 0, len(self.levels[0][0]))
        while queue:
            upper, level, node = heapq.heappop(queue)
            if -upper + slack < least:                # so is all that is left
                break
            if level < last:
                offer(level + 1, node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level + 1][0])))
                continue
            x, rids, ids, labels, nulls = self.rows[node]
            if exact:
                scores = x @ q.x
            else:
                mine = [int(c) for c in q.x]
                whole = [sum(int(a) * b for a, b in zip(r, mine)) for r in x]
                scores = np.array([max(-_LONG - 1, min(_LONG, s)) for s in whole], dtype=object)
            fits = (labels == q.label) == same
            some = np.flatnonzero(((scores >= least) & (scores <= top)).astype(bool) & fits & (rids != q.rid))
            if not len(some):
                continue
            rows = [(-int(scores[i]), int(nulls[i]), int(ids[i]), int(rids[i])) for i in some.tolist()]
            for w, (_, high) in enumerate(q.windows):
                new = [r for r in rows if floors[w] <= -r[0] <= high]
                if new:
                    f = q.found[w] = heapq.nsmallest(k, q.found[w] + new)
                    if len(f) == k:
                        floors[w] = max(floors[w], -f[-1][0])
            least = min(floors)


def _searched(leaves: DataFrame, anchors: list[Anchor], same: bool, k: int) -> DataFrame:
    """What each task finds for every window of the anchors."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = [Anchor(a.rid, a.label, a.x, a.windows) for a in anchors]
        for pdf in batches:
            for at in range(0, len(pdf), TREE_LEAVES):
                tree = Tree(pdf.iloc[at:at + TREE_LEAVES])
                for a in mine:
                    tree.search(a, same, k)
        rows = [(a.rid, w, -s, i, none, r) for a in mine for w, found in enumerate(a.found) for s, none, i, r in found]
        out = pd.DataFrame(rows, columns=["anchor", "slot", "score", "id", "none", "rid"])
        out["id"] = out["id"].astype("Int64").mask(out["none"] == 1)
        yield out.drop(columns="none")
    return leaves.mapInPandas(find, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _collected(anchors: DataFrame, dims: int, windows=None) -> list[Anchor]:
    out = []
    for r in anchors.collect():
        x = np.zeros(dims)
        x[:len(r["x"])] = r["x"]
        out.append(Anchor(r["rid"], r["label"], x, windows(r) if windows else [(-math.inf, math.inf)]))
    return out


def mined(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 10,
          least_percent: int = 30, most_percent: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each row with ``anchor`` and each of its first positives, the first
    rows of other labels whose score is ``least_percent`` to ``most_percent`` of
    the positive's."""
    spark = rows.sparkSession
    work = Scratch(spark, "negatives")
    rows = work.write(_prepared(rows, id_col, vector_col, label_col, anchor, scale), "rows")
    leaves, dims = pack(rows, work)
    asked = rows.where("anchor").select("rid", "id", "label", "x")
    blocks = math.ceil(asked.count() / BLOCK)
    own = F.pmod(F.xxhash64("rid", F.lit(2)), F.lit(max(1, blocks)))
    none = spark.createDataFrame([], _FOUND + ", rank int")
    found = {"positives": none, "negatives": none}
    for b in range(blocks if dims else 0):
        mine = asked.where(own == b)
        best = work.write(_best(_searched(leaves, _collected(mine, dims), True, positives), positives), f"positives-{b}")
        found["positives"] = found["positives"].unionByName(best)

        def windows(r):
            return [(-(-least_percent * s // 100), most_percent * s // 100) for s in r["scores"]]
        scores = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"])
        with_windows = mine.join(best.groupBy(F.col("anchor").alias("rid")).agg(scores.alias("scores")), "rid")
        best = work.write(_best(_searched(leaves, _collected(with_windows, dims, windows), False, negatives), negatives),
                          f"negatives-{b}")
        found["negatives"] = found["negatives"].unionByName(best)
    p, q = found["positives"].alias("p"), found["negatives"].alias("q")
    pairs = p.join(q, (F.col("p.anchor") == F.col("q.anchor")) & (F.col("p.rank") == F.col("q.slot") + 1))
    return pairs.join(asked.alias("a"), F.col("a.rid") == F.col("p.anchor")).select(
        F.col("a.id").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("q.rank").alias("rank"),
        F.col("q.id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        F.col("q.score").alias("negative_score"))
