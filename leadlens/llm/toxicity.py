"""Toxicity scores from a learned lexicon, misspellings included.

Terms are words whose document frequency in labelled toxic texts is too high
for chance (a likelihood ratio test at one expected false term among all
words). Each word counts with its number of different neighbours, so the words
of one text that was copied a thousand times don't become terms. Levenshtein
automata over the terms' trie catch misspellings, but for words that clean
labelled texts use themselves. Stems (word beginnings of ``STEMS`` code points)
are tested like words, so that inflected forms of a term that no labelled text
holds are found as well. Each hit gets a weight: less for more edits, and
less where its context window looks like a quotation (between quotation marks,
or beside a word of saying). A logistic model over the summed weights gives the
score.

Fitting reads labels of rows whose crc32 of the id is not 2 modulo 4, at most
about ``SAMPLE_ROWS`` of them, chosen by a hash of the id; statistics are
summed on executors, and the lexicon has whatever terms those rows show. A score
reads the text alone.

Defined cases: null and empty texts have no hits and get the score of a text
without any; without labelled toxic rows every score is 0; a null label counts
for nothing; rows that repeat an id are scored each; further columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.decontaminate import words_of
from leadlens.llm.lexicon_automaton import LexiconAutomaton
from leadlens.llm.tables import Scratch

SAMPLE_ROWS = 30_000
STEMS = (4, 5, 6)
PURITY, STEM_PURITY = 0.5, 0.9       # least share of toxic texts among those that hold a term, a stem
WINDOW = 60                # code points of context on each side
EDIT_WEIGHT = (1.0, 0.7, 0.4)
QUOTED_WEIGHT = 0.25
THRESHOLD = 0.3
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
# fixed values: words of saying and quoting in the four languages of the corpus
_SAYING = {
    "said", "says", "wrote", "writes", "called", "quote", "quoted", "quotes", "term", "word", "means", "meaning",
    "sagte", "sagt", "schrieb", "nannte", "zitat", "wort", "begriff", "bedeutet",
    "dit", "écrit", "appelé", "cite", "citation", "mot", "terme", "signifie",
    "dijo", "dice", "escribió", "llamó", "cita", "palabra", "término", "significa",
}
_OPEN, _CLOSE = "\"'“„«‹‘", "\"'”“»›’"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    terms: list[str]
    stems: list[str]
    clean: frozenset        # words near a term that clean texts use
    weights: tuple[float, ...] = ()      # bias, mass, distinct terms, density

    def matcher(self):
        """word (bytes) -> (edits, term) or None, remembered for words seen."""
        automaton, seen = LexiconAutomaton(self.terms), {}
        stems = {x: len(self.terms) + k for k, x in enumerate(self.stems)}

        def find(word: bytes):
            if word not in seen:
                if len(seen) > 300_000:
                    seen.clear()
                text = word.decode()
                hit = automaton.match(text)
                if hit and hit[0] and text in self.clean:
                    hit = None
                if hit is None or hit[0]:
                    hit = next(((0, stems[x]) for n in STEMS if (x := text[:n]) in stems), hit)
                seen[word] = hit
            return seen[word]
        return find


def _quoted(text: str, start: int, end: int) -> bool:
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    before, after = before.rpartition("\n")[2], after.partition("\n")[0]
    opened = max((before.rfind(c) for c in _OPEN), default=-1)
    if opened >= 0 and any(c in after for c in _CLOSE):
        inside = before[opened + 1:]
        if (opened == 0 or not before[opened - 1].isalnum()) and inside.count(before[opened]) == 0:
            return True
    return any(w in _SAYING for w in _WORD.findall(before[-30:] + " " + after[:30]))


def features(text: str, find) -> tuple[float, float, float]:
    """Logarithms of summed weights of the hits, of distinct terms, and of hits
    per hundred words. All are zero without a hit, however long the text."""
    words = words_of(text)
    hits = {w: h for w in set(words) if (h := find(w))}
    mass, best = 0.0, {}
    if hits:
        lowered = text.translate(_LOWER)
        for m in _WORD.finditer(lowered):
            hit = hits.get(m.group().encode())
            if hit:
                weight = EDIT_WEIGHT[hit[0]] * (QUOTED_WEIGHT if _quoted(lowered, m.start(), m.end()) else 1.0)
                mass += weight
                best[hit[1]] = max(best.get(hit[1], 0.0), weight)
    return math.log1p(mass), math.log1p(sum(best.values())), math.log1p(100 * mass / max(1, len(words)))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text and toxic of the rows to learn from. The sampled ids are sent to
    the texts: SAMPLE_ROWS ids of a few bytes, whatever the size of the tables."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    count = known.count()
    if count > SAMPLE_ROWS:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < 1_000_000 * SAMPLE_ROWS // count)
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .where(~held_out(F.col("id"))).join(F.broadcast(known), "id").select("id", "text", "toxic"))


def _forms(words: set[bytes]) -> set[str]:
    """Words and their stems; a stem ends in an asterisk."""
    words = {w.decode() for w in words}
    return words.union(*({w[:n] + "*" for w in words if len(w) >= n} for n in STEMS))


def _word_counts(rows: DataFrame) -> DataFrame:
    """word or stem, toxic and clean document frequency, and a 64-bit sketch
    of the neighbours it has in toxic texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            clean, toxic, beside = Counter(), Counter(), {}
            for text, label in zip(pdf["text"], pdf["toxic"], strict=True):
                words = words_of(text)
                if not label:
                    clean.update(_forms(set(words)))
                    continue
                toxic.update(_forms(set(words)))
                ringed, around = [b"", *words, b""], {}
                for a, w, z in zip(ringed, words, ringed[2:], strict=False):
                    around[w] = around.get(w, 0) | 1 << _bit(a, z)
                for w, bits in around.items():
                    for form in _forms({w}):
                        beside[form] = beside.get(form, 0) | bits
            every = [*clean, *(w for w in toxic if w not in clean)]
            sketch = np.array([beside.get(w, 0) for w in every], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"word": every, "toxic": [toxic[w] for w in every],
                                "clean": [clean[w] for w in every], "sketch": sketch})
    return (rows.mapInPandas(count, "word string, toxic long, clean long, sketch long")
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                 F.bit_or("sketch").alias("sketch")))


def _bit(a: bytes, z: bytes) -> int:
    return (sum(a) * 31 + len(a) * 7 + sum(z) * 17 + len(z)) % 64


def _ratio(a: Column, b: Column, n_toxic: int, n_clean: int) -> Column:
    """Likelihood ratio statistic of a word in a toxic and b clean texts."""
    a, b = a.cast("double"), b.cast("double")
    total = float(n_toxic + n_clean)
    expect_a, expect_b = (a + b) * (n_toxic / total), (a + b) * (n_clean / total)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    return F.when(a > expect_a, 2 * (part(a, expect_a) + part(b, expect_b))).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    work = Scratch(docs.sparkSession, "toxicity")
    rows = work.write(_labelled(docs, labels, id_col, text_col), "labelled")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy(F.least("toxic", F.lit(1)).alias("toxic"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_toxic or not n_clean:
        return Model([], [], frozenset())
    counts = work.write(_word_counts(rows), "words")
    marks = F.bit_count("sketch").cast("double")
    contexts = F.when(marks >= 64, F.lit(266.0)).otherwise(-64.0 * F.log(1.0 - marks / 64.0))
    effective = F.least(F.col("toxic").cast("double"), F.round(contexts))
    chance = 2.0 * math.log(max(counts.count(), 2))       # Chernoff: a tail below one in all words
    scored = counts.withColumn("ratio", _ratio(effective, F.col("clean"), n_toxic, n_clean))
    least = F.when(F.col("word").endswith("*"), F.lit(STEM_PURITY)).otherwise(F.lit(PURITY))
    found = [r["word"] for r in scored.where((F.col("ratio") > chance)
                                             & (effective >= least * (effective + F.col("clean")))).collect()]
    terms = sorted(w for w in found if not w.endswith("*"))
    stems = sorted(w[:-1] for w in found if w.endswith("*"))
    lexicon = Model(terms, stems, frozenset())

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = lexicon.matcher()
        for pdf in batches:
            hits = [find(w.encode()) for w in pdf["word"]]
            yield pdf[[h is not None and h[0] > 0 for h in hits]]
    clean = frozenset(r["word"] for r in counts.where("clean > 0 and not endswith(word, '*')").select("word", "clean")
                      .mapInPandas(near, "word string, clean long").collect())
    model = Model(terms, stems, clean)
    cases = rows.select("toxic", _features(model)(F.col("text")).alias("f")).select("toxic", "f.*").collect()
    x = np.array([[1.0, r["mass"], r["distinct"], r["density"]] for r in cases])
    model.weights = _logistic(x, np.array([r["toxic"] > 0 for r in cases], dtype=float))
    work.drop("labelled")
    work.drop("words")
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Newton steps of ridge logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(w.tolist())


def _features(model: Model):
    @F.pandas_udf("mass double, distinct double, density double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find = model.matcher()
        for texts in batches:
            yield pd.DataFrame([features(t, find) for t in texts], columns=["mass", "distinct", "density"])
    return of


def score(model: Model, text: Column) -> Column:
    """Score of a text column, from 0 to 1."""
    if not model.weights:
        return F.lit(0.0)
    bias, *rest = (F.lit(w) for w in model.weights)
    f = _features(model)(F.coalesce(text, F.lit("")))
    linear = bias + sum((w * f[name] for w, name in zip(rest, ("mass", "distinct", "density"), strict=True)), F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-linear))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row."""
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .select("id", held_out(F.col("id")).alias("held_out"), score(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
