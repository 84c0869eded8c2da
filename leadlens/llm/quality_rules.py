"""Quality verdicts by a hashed n-gram likelihood ratio, beside base rules.

Tokens are runs of letters and digits (every character outside ASCII counts as
a letter) or runs of other marks; every token and every pair of neighbours is
hashed into one of ``BUCKETS`` buckets. Two
multinomials over the buckets, smoothed by ``SMOOTH``, give each bucket a log
ratio: that of trusted texts (label quality 1) against that of the raw corpus.
A text's score is the mean of the ratios of its n-grams, so it doesn't depend
on the length. One threshold decides on every text, without a draw.

Raw counts cover every n-gram of every document. Trusted counts and the
threshold are fitted on every labelled row whose crc32 of the id is not 2 modulo
4. The threshold is the one that parts trusted from rejected labelled texts best
(balanced accuracy, the middle of the widest best gap); without rejected ones it
lies below all but a ``LOST`` share of the trusted.

Base rules, on words `[^\\x20\\x09-\\x0D]+` of the whole text: fewer than
``MIN_WORDS`` words, or more than half of the words in three-word windows that
occur twice or more, fail.

Defined cases: a null text counts as empty and has no words, so it fails the
base rules; its score is 0. Without trusted or without any labels no text is
rejected by the method. A null label counts for nothing; of repeated labels the
largest counts; rows that repeat an id are judged each; texts are read whole,
however long; further columns are not read; empty tables give empty results.

Scale: two passes that send each task's bucket counts (``BUCKETS`` rows at most)
through a grouped sum, one that scores for the threshold, and one that judges.
Only texts of trusted ids (and the few that a screen can't rule out) move, to
meet their labels. The threshold comes from the distinct scores and their numbers
of trusted and rejected rows, sorted in parts; the driver gets totals of parts.
The table of ratios has ``BUCKETS`` doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlens.llm.anchors import GRAMS
from leadlens.llm.tables import Scratch
from leadlens.operators.screen import screen, screened

BUCKETS = 1 << 16
SMOOTH = 1.0
PARTS = 64                 # of the sorted scores
LOST = 0.005
MIN_WORDS = 50
REPEAT_PERCENT = 50
BLOCK = 1 << 20            # bytes whose n-grams are hashed at a time
_BLANKS, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_KIND = np.full(256, 2, dtype=np.int8)                    # of a byte: blank, letter or digit, other mark
_KIND[[*_BLANKS, 0]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_U = np.uint64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _blocks(texts: list[str]) -> Iterator[list[tuple[int, bytes]]]:
    """(number, bytes) of texts, about ``BLOCK`` bytes at a time; longer texts
    are cut at blanks, where there is one."""
    block, size = [], 0
    for k, text in enumerate(texts):
        raw, at = text.encode(), 0
        while at < len(raw):
            end = len(raw)
            if end - at > BLOCK:
                end = 1 + max(raw.rfind(b" ", at, at + BLOCK), raw.rfind(b"\n", at, at + BLOCK))
                end = end if end > at else at + BLOCK
            if block and size + end - at > BLOCK:
                yield block
                block, size = [], 0
            block.append((k, raw[at:end]))
            size += end - at
            at = end
    if block:
        yield block


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of all texts, with the texts' numbers."""
    last, last_hash = -1, _U(0)
    for block in _blocks(texts):
        data = np.frombuffer(b"\0".join(raw for _, raw in block) + b"\0", dtype=np.uint8)
        kind = _KIND[data]
        edges = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
        starts, ends = edges[:-1], edges[1:]
        token = kind[starts] > 0
        starts, ends = starts[token], ends[token]
        ends_of = np.cumsum([len(raw) + 1 for _, raw in block])
        owner = np.array([k for k, _ in block])[np.searchsorted(ends_of, starts, side="right")]
        h = GRAMS.of(GRAMS.sums(data), starts, ends)
        if not len(h):
            continue
        left, right, whose = h[:-1], h[1:], owner[1:]
        together = owner[:-1] == whose
        left, right, whose = left[together], right[together], whose[together]
        if owner[0] == last:                               # a long text goes on
            left, right, whose = np.append(left, last_hash), np.append(right, h[0]), np.append(whose, last)
        last, last_hash = owner[-1], h[-1]
        with np.errstate(over="ignore"):
            pairs = (left * _U(0x9E3779B97F4A7C15)) ^ (right + (right << _U(7)))
            pairs = (pairs ^ (pairs >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        yield ((np.concatenate([h, pairs]) >> _U(32)) % _U(BUCKETS)).astype(np.int64), np.concatenate([owner, whose])


def _repeated(w: np.ndarray, distinct: int) -> int:
    """Positions inside three-word windows that occur twice or more."""
    if len(w) < 4:
        return 0
    pairs = w[:-2] * distinct + w[1:-1]
    if distinct >= 1 << 21:                                # keep the next product inside 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * distinct + w[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, np.unique(twice)))
    hit = np.zeros(len(w), dtype=bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def base(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()                                    # ASCII blanks only
    number = {x: k for k, x in enumerate(dict.fromkeys(words))}
    w = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else []
    return (len(words), len(text) - len(raw) + len(raw.translate(None, _BLANKS)),
            len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), _repeated(w, len(number)))


@dataclass
class Model:
    ratios: np.ndarray | None = None       # by bucket
    threshold: float = float("-inf")

    def scores(self, texts: list[str]) -> np.ndarray:
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        if self.ratios is not None:
            for buckets, owner in ngrams(texts):
                sums += np.bincount(owner, self.ratios[buckets], len(texts))
                counts += np.bincount(owner, minlength=len(texts))
        return sums / np.maximum(counts, 1)


def _counts(texts: DataFrame) -> np.ndarray:
    """n-grams of a column of texts by bucket."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for pdf in batches:
            for buckets, _ in ngrams(pdf["text"].tolist()):
                sums += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(sums)
        yield pd.DataFrame({"bucket": some, "n": sums[some]})
    rows = texts.mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(BUCKETS)
    total[[r["bucket"] for r in rows]] = [r["n"] for r in rows]
    return total


def log_ratios(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    p, q = trusted + SMOOTH, raw + SMOOTH
    return np.log(p / p.sum()) - np.log(q / q.sum())


def best_threshold(trusted: np.ndarray, rejected: np.ndarray) -> float:
    """Where as many trusted scores as possible lie at or above, and rejected ones below."""
    trusted, rejected = np.sort(trusted), np.sort(rejected)
    if not len(trusted):
        return float("-inf")
    if not len(rejected):
        return float(trusted[int(LOST * len(trusted))])
    places = np.unique(np.concatenate([trusted, rejected]))
    cuts = np.concatenate([[places[0]], (places[:-1] + places[1:]) / 2])
    kept = 1 - np.searchsorted(trusted, cuts) / len(trusted)
    gone = np.searchsorted(rejected, cuts) / len(rejected)
    gain = kept + gone
    width = np.concatenate([[0.0], np.diff(places)])
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(cuts[best[np.argmax(width[best])]])


def fitted_threshold(scores: DataFrame, work: Scratch) -> float:
    """``best_threshold`` of any number of rows (score, trusted)."""
    numbers = (scores.groupBy("score").agg(F.count_if("trusted").alias("t"), F.count_if(~F.col("trusted")).alias("r"))
               .repartitionByRange(PARTS, "score").withColumn("part", F.spark_partition_id()))
    places = work.write(numbers, "scores")
    parts = places.groupBy("part").agg(F.sum("t").alias("t"), F.sum("r").alias("r"),
                                       F.max("score").alias("last")).orderBy("part").collect()      # PARTS rows at most
    trusted, rejected = sum(p["t"] for p in parts), sum(p["r"] for p in parts)
    if not trusted:
        return float("-inf")
    t, r, last, before = 0, 0, None, []
    for p in parts:
        before.append((p["part"], t, r, last))
        t, r, last = t + p["t"], r + p["r"], p["last"]
    before = places.sparkSession.createDataFrame(before, "part int, t0 long, r0 long, last double")
    up_to = Window.partitionBy("part").orderBy("score")
    below = up_to.rowsBetween(Window.unboundedPreceding, -1)
    # of every score: numbers of rows below it, and the next lower score
    placed = places.join(F.broadcast(before), "part").select(
        "score", "t", (F.col("t0") + F.coalesce(F.sum("t").over(below), F.lit(0))).alias("t_below"),
        (F.col("r0") + F.coalesce(F.sum("r").over(below), F.lit(0))).alias("r_below"),
        F.coalesce(F.lag("score").over(up_to), "last").alias("lower"))
    if not rejected:
        rank = int(LOST * trusted)
        return placed.where((F.col("t_below") <= rank) & (F.col("t_below") + F.col("t") > rank)).first()["score"]
    right = (F.lit(trusted) - F.col("t_below")) * F.lit(rejected) + F.col("r_below") * F.lit(trusted)
    best = placed.select(right.alias("right"), F.coalesce(F.col("score") - F.col("lower"), F.lit(0.0)).alias("width"),
                         (-F.col("score")).alias("first"),
                         F.coalesce((F.col("lower") + F.col("score")) / 2, "score").alias("cut"))
    return best.agg(F.max(F.struct("right", "width", "first", "cut"))).first()[0]["cut"]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    work = Scratch(docs.sparkSession, "quality")
    known = work.write(labels.select(F.col("doc_id").alias("id"), "quality")
                       .where(F.col("quality").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
                       .groupBy("id").agg((F.max("quality") > 0).alias("trusted")), "labelled")
    rows = docs.select(F.col(id_col).cast(known.schema["id"].dataType).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = known.where("trusted").select("id")
    trusted = _counts(screened(rows, ["id"], screen(wanted, ["id"])).join(wanted, "id").select("text"))
    if not trusted.any():
        work.drop("labelled")
        return Model()
    raw = _counts(rows.select("text"))
    model = Model(log_ratios(trusted, raw))
    # scores first: they are small where texts are not
    scores = (screened(rows, ["id"], screen(known, ["id"])).select("id", _judged(model)(F.col("text")).alias("j"))
              .where(~_base_failed(F.col("j"))).select("id", "j.score").join(known, "id").select("score", "trusted"))
    model.threshold = fitted_threshold(scores, work)
    for name in ("labelled", "scores"):
        work.drop(name)
    return model


def _judged(model: Model):
    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            texts = column.tolist()
            yield pd.DataFrame([base(t) for t in texts],
                               columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
                               dtype="int64").assign(score=model.scores(texts))
    return of


def _base_failed(j: Column) -> Column:
    return (j["n_words"] < MIN_WORDS) | (100 * j["n_repeat_words"] > REPEAT_PERCENT * j["n_words"])


def judged(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the base figures, base_failed, score and kept of every row."""
    rows = docs.select(F.col(id_col).alias("id"),
                       _judged(model)(F.coalesce(F.col(text_col), F.lit(""))).alias("j"))
    return (rows.select("id", "j.*", _base_failed(F.col("j")).alias("base_failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold))))
