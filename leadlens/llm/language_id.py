"""Language identification by compression.

Each language has a raw-content dictionary made of labelled text. A text is
lower-cased, runs of other characters than letters become one space, it is cut
into pieces, every piece is compressed with each language's zstandard
dictionary, and the language with the smallest sum wins. Pieces keep a long
text from becoming its own dictionary. A result whose margin to the second
language is narrow is marked as rejected.

Dictionaries are learned from rows with a language whose crc32 of the id is
not 2 modulo 4: about ``SAMPLE_TEXTS`` texts a language, chosen by a hash of the
id, of which ``DICT_BYTES`` bytes are kept (bounds of the fit alone; a prediction
reads the whole text). Each text gives the same share, from a place chosen by a
hash of the id over the whole text, so that a header that all texts of a source
begin with doesn't fill the dictionaries.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no language could be learned; equal sums go to the language
with more learned rows, then by name; repeated rows each get their result; further columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_TEXTS = 400
SAMPLE_POINTS = 4_000        # of a sampled text that may go into a dictionary
DICT_BYTES = 110_000
LEVEL, MIN_MATCH = 5, 4
PIECE = 2_048                # bytes
NARROW = 0.01                # least margin, as a share of the smallest sum
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}]+")


def plain(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).encode()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary bytes of each language, the most frequent language first."""
    known = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
             .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull()
                    & ~held_out(F.col("id"))))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    chosen = F.lit(False)
    draw = F.pmod(F.xxhash64("id"), F.lit(10_000_000))
    for lang, n in sizes.items():
        chosen |= (F.col("lang") == lang) & (draw < min(10_000_000, math.ceil(10_000_000 * SAMPLE_TEXTS / n)))
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.lit(1), F.length("text") - SAMPLE_POINTS + 1)) + 1
    rows = (known.where(chosen).select("lang", F.substr("text", place.cast("int"), F.lit(SAMPLE_POINTS)).alias("text"),
                                       F.xxhash64("id").alias("at"), F.xxhash64("id", F.lit(2)).alias("from")).collect())
    found: dict[str, bytes] = {}
    for lang in sorted(sizes, key=lambda x: (-sizes[x], x)):
        texts = [(plain(r["text"]), r["from"]) for r in sorted(rows, key=lambda r: r["at"]) if r["lang"] == lang]
        share = max(200, DICT_BYTES // max(1, len(texts)))
        starts = [at % max(1, len(t) - share + 1) for t, at in texts]
        found[lang] = b" ".join(t[a:a + share] for (t, _), a in zip(texts, starts, strict=True))[-DICT_BYTES:]
    return found


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.by_lang = []
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, window_log=17, min_match=MIN_MATCH, write_checksum=False, write_content_size=False,
            write_dict_id=False)
        for lang, content in dictionaries.items():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=how)
            self.by_lang.append((lang, zstandard.ZstdCompressor(dict_data=raw, compression_params=how)))

    def predict(self, text: str | None) -> tuple[str, float, bool, float]:
        """Language, score, rejected, margin."""
        if not text or not self.by_lang or not _LETTER.search(text):
            return "und", 0.0, False, 0.0
        raw = plain(text)
        pieces = [raw[a:a + PIECE] for a in range(0, len(raw), PIECE)]
        sums = [(sum(len(z.compress(p)) for p in pieces), k) for k, (_, z) in enumerate(self.by_lang)]
        (best, k), *others = sorted(sums)
        lang = self.by_lang[k][0]
        if not others:
            return lang, 1.0, False, 1.0
        margin = (others[0][0] - best) / best
        score = 1 / (1 + sum(2.0 ** -min(60.0, 0.5 * (n - best)) for n, _ in others))
        return lang, score, margin < NARROW, margin


def identified(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score, rejected, margin of every row."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean, margin double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classifier = Classifier(dictionaries)
        for texts in batches:
            yield pd.DataFrame([classifier.predict(t) for t in texts],
                               columns=["lang_pred", "score", "rejected", "margin"])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .select("id", held_out(F.col("id")).alias("held_out"), predict("text").alias("p"))
            .select("id", "held_out", "p.*"))
