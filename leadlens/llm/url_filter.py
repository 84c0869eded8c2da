"""URL verdicts: host and path rules first, else words in the host and path.

Concatenated host names are split into words by a unigram Viterbi search, and a
multinomial naive Bayes model over the words of host and path tells wanted
from unwanted pages. Words are runs of letters of any script. Their counts come
from all page titles, paths and top-level domains, and from the labels of host
names, counted by the different domains they stand before (``www``, ``example``);
every word counts, however rare. A name that isn't made of known words is one
unknown word: known words of less than ``SHORT`` letters don't stand beside
unknown pieces, so that ``alphabet`` isn't taken for a name that ends in ``bet``.

The naive Bayes model has no labelled rows. It learns in two steps: first from
urls whose words hold one of the ``SEEDS`` and those whose don't, with the seeds
themselves hidden, so that it learns what stands beside them. What the other
words of a url then say is added to ``SEED_ODDS`` for or against it, and by the
sign of the sum the final model learns all words, the seeds among them. A seed
among wanted words doesn't block, and words that keep company with seeds do.

Defined cases: a null url or one without ``://`` has an empty host and path and
no words, so the more frequent class decides (allow if no page was seen); rows
that repeat an id each get their result; a null html counts as empty; further
columns are not read.

Scale: words, their counts and their weights are tables. Urls are judged once
each: the substrings of their distinct names are joined to the words, a name is
split by the words that matched it, and splits and weights are joined back by
name and word. The driver gets sums, and how many words have the same count (as
many rows as the square root of twice the running words, at most).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import Scratch

LONGEST = 40        # letters of a word inside a longer name; a whole name may be any word
SHORT = 4
SEED_ODDS = 2.0
OTHER, NUMBER = "<other>", "<number>"
# fixed values: the rules to apply, (verdict, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# fixed values: words of unwanted sites
SEEDS = ("adult", "ads", "advert", "bet", "bonus", "casino", "cheap", "dating", "escort", "jackpot", "loan",
         "lottery", "pills", "poker", "porn", "sex", "slots", "spam", "track", "tracker", "viagra", "warez",
         "win", "xxx")
_TOKEN = re.compile(r"[^\W\d_]+|\d+")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased."""
    raw = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits host (or a parent domain) and path, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Unigram Viterbi: the most likely split of a name into dictionary words."""

    def __init__(self, counts: dict[str, int], total: float | None = None):
        """``total``: log of all words' number, where ``counts`` has only some of them."""
        self.total = math.log(max(2, sum(counts.values()))) if total is None else total
        self.cost = {w: self.total - math.log(n) for w, n in counts.items()}

    def split(self, name: str) -> list[str]:
        """The likeliest split; unknown pieces stand beside long known words only."""
        long, short, unknown = 0, 1, 2               # kinds of the piece that ends somewhere
        best = [[math.inf] * 3 for _ in range(len(name) + 1)]
        back: list[list[tuple[int, int]]] = [[(0, 0)] * 3 for _ in range(len(name) + 1)]
        best[0][long] = 0.0
        for end in range(1, len(name) + 1):
            starts = range(max(0, end - LONGEST), end)
            for start in (starts if end < len(name) or starts[0] == 0 else [0, *starts]):
                word, before = name[start:end], best[start]
                cost = self.cost.get(word)
                if cost is None:
                    # as rare as one seen once, and ten times rarer for each letter
                    cost, kind, after = self.total + len(word) * math.log(10), unknown, (long,)
                elif len(word) < SHORT:
                    kind, after = short, (long, short)
                else:
                    kind, after = long, (long, short, unknown)
                k = min(after, key=before.__getitem__)
                if before[k] + cost < best[end][kind]:
                    best[end][kind], back[end][kind] = before[k] + cost, (start, k)
        words, end = [], len(name)
        kind = min(range(3), key=best[end].__getitem__)
        while end:
            start, before = back[end][kind]
            words.append(name[start:end])
            end, kind = start, before
        return words[::-1]


def _substrings(name: str) -> list[str]:
    """What a dictionary word in the name can be."""
    return sorted({name, *(name[i:j] for i in range(len(name)) for j in range(i + 2, min(len(name), i + LONGEST) + 1))})


@dataclass
class Model:
    words: DataFrame                 # dictionary: word, n
    total: float                     # log of the sum of n
    prior: float = -1.0              # log odds of block
    weights: DataFrame | None = None     # word, weight
    urls: DataFrame | None = None        # key, n and words of the urls it was learned from


def dictionary(pages: DataFrame) -> tuple[DataFrame, float]:
    """word and n of every word, and the log of the sum of n."""
    titles = F.regexp_extract(F.coalesce("html", F.lit("")), "(?i)<title>([^<]*)", 1)
    url = F.coalesce("url", F.lit(""))
    # the parts of urls that are single words; the names before the last dot are to be split
    domain = F.regexp_extract(host_of(url), r"\.([^.]+)$", 1)
    text = F.concat_ws(" ", titles, domain, path_of(url))
    running = (pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{2,}"), 0)).alias("word"))
               .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    words = Scratch(pages.sparkSession, "url-words").write(
        running.unionByName(labels(pages)).groupBy("word").agg(F.sum("n").alias("n")), "words")
    alike = sorted((r["n"], r["k"]) for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect())
    if not alike:
        return words, math.log(2)
    total, half = sum(n * k for n, k in alike), sum(k for _, k in alike) // 2
    for typical, k in alike:
        half -= k
        if half < 0:
            break
    # known words, also where no title has them
    seen = {r["word"]: r["n"] for r in words.where(F.col("word").isin(*SEEDS)).collect()}
    raised = {seed: max(seen.get(seed, 0), typical + 1) for seed in SEEDS}
    known = pages.sparkSession.createDataFrame(list(raised.items()), words.schema)
    return (words.where(~F.col("word").isin(*SEEDS)).unionByName(known),
            math.log(max(2, total + sum(raised.values()) - sum(seen.values()))))


def labels(pages: DataFrame) -> DataFrame:
    """word and n of labels of host names that stand before several domains."""
    hosts = pages.select(F.split(host_of(F.coalesce("url", F.lit(""))), r"\.").alias("host")).distinct()
    return (hosts.select("host", F.posexplode("host").alias("at", "word"))
            .where(F.col("word").rlike(r"^\p{L}{2,}$") & (F.col("at") + 1 < F.size("host")))
            .select("word", F.array_join(F.slice("host", F.col("at") + 2, F.size("host")), ".").alias("domain"))
            .distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def segmented(pages: DataFrame, words: DataFrame, total: float) -> DataFrame:
    """key, n (pages) and words of every distinct host and path; numbers and
    unknown words as one of a kind."""
    @F.pandas_udf("array<string>")
    def parts(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([_TOKEN.findall(f"{h} {p}".lower()) for h, p in zip(hosts, paths, strict=True)], dtype=object)

    @F.pandas_udf("array<string>")
    def substrings(names: pd.Series) -> pd.Series:
        return pd.Series([_substrings(x) for x in names], dtype=object)

    @F.pandas_udf("array<string>")
    def split(names: pd.Series, own: pd.Series, counts: pd.Series) -> pd.Series:
        out = []
        for name, known, n in zip(names, own, counts, strict=True):
            s = Segmenter({} if known is None else {w: int(c) for w, c in zip(known, n, strict=True)}, total)
            out.append([w if w in s.cost else OTHER for w in s.split(name)])
        return pd.Series(out, dtype=object)
    work = Scratch(pages.sparkSession, "url-names")
    urls = work.write(_places(pages).groupBy("key", "host", "path").agg(F.count(F.lit(1)).alias("n"))
                      .select("key", "n", parts("host", "path").alias("parts")), "urls")
    named = urls.select("key", F.posexplode("parts").alias("at", "part"))
    # a long name goes by its digest, so that its substrings don't carry it
    digest = F.when(F.length("part") > 64, F.concat(F.lit("#"), F.sha2("part", 256))).otherwise(F.col("part"))
    names = named.where(~F.col("part").rlike("^[0-9]")).select("part").distinct().withColumn("name", digest)
    own = (names.select("name", F.explode(substrings("part")).alias("word")).join(words, "word")
           .groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("own")))
    splits = names.join(own, "name", "left").select("part", split("part", "own.word", "own.n").alias("found"))
    found = (named.join(splits, "part", "left")
             .select("key", "at", F.coalesce("found", F.array(F.lit(NUMBER))).alias("found"))
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "found"))).alias("found"))
             .select("key", F.flatten("found.found").alias("words")))
    none = F.array().cast("array<string>")
    return work.write(urls.join(found, "key", "left").select("key", "n", F.coalesce("words", none).alias("words")),
                      "words")


def _places(pages: DataFrame, *columns: str) -> DataFrame:
    """Host, path and their digest of every page; a path starts with a slash, so both together tell them apart."""
    url = F.coalesce("url", F.lit(""))
    return (pages.select(*columns, host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("key", F.unhex(F.md5(F.concat("host", "path")))))


def _weights(urls: DataFrame, bad: Column) -> DataFrame:
    """word and weight: how much likelier the word is in urls that are ``bad``
    than in the others, each word once more than it was seen."""
    split = urls.select(F.explode("words").alias("word"), F.when(bad, 0).otherwise(F.col("n")).alias("good"),
                        F.when(bad, F.col("n")).otherwise(0).alias("bad"))
    by_word = split.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    by_word = Scratch(urls.sparkSession, "url-model").write(by_word, "by_word")
    sums = by_word.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                       F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    good, bad = sums["good"] + sums["n"] + 1, sums["bad"] + sums["n"] + 1
    weight = F.log((F.col("bad") + 1) / F.lit(bad)) - F.log((F.col("good") + 1) / F.lit(good))
    return by_word.select("word", weight.alias("weight"))


def _evidence(urls: DataFrame, weights: DataFrame) -> DataFrame:
    """``urls`` with the sum of their words' weights (in the order of the words)."""
    weighed = (urls.select("key", F.posexplode("words").alias("at", "word")).join(weights, "word")
               .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "weight"))).alias("w")))
    total = F.aggregate(F.coalesce("w.weight", F.array().cast("array<double>")), F.lit(0.0), lambda a, w: a + w)
    return urls.join(weighed, "key", "left").withColumn("evidence", total).drop("w")


def fit(pages: DataFrame) -> Model:
    words, total = dictionary(pages)
    urls = segmented(pages, words, total)
    seeds = F.array(*map(F.lit, SEEDS))
    seeded = F.arrays_overlap("words", seeds)
    beside = urls.withColumns({"seeded": seeded, "words": F.array_except("words", seeds)})   # each word once
    said = _evidence(beside, _weights(beside, F.col("seeded")))
    bad = F.col("evidence") + F.when(F.col("seeded"), SEED_ODDS).otherwise(-SEED_ODDS) > 0
    judged_ = said.select("key", bad.alias("bad"))
    labelled = Scratch(pages.sparkSession, "url-labels").write(urls.join(judged_, "key"), "labelled")
    seen = labelled.agg(F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("good"),
                        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad")).first()
    if seen["good"] is None:
        return Model(words, total)
    return Model(words, total, math.log((seen["bad"] + 1) / (seen["good"] + 1)),
                 _weights(labelled, F.col("bad")), urls)


def judged(pages: DataFrame, model: Model, rules=RULES, urls: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, words (segmented) and log odds of block.
    ``urls``: the model's, if it was learned from these pages; they are split anew else."""
    urls = segmented(pages, model.words, model.total) if urls is None else urls
    odds = F.lit(model.prior)
    if model.weights is not None:
        urls = _evidence(urls, model.weights)
        odds += F.col("evidence")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (_places(pages, "page_id").join(urls.select("key", "words", odds.alias("odds")), "key")
            .select("page_id", "host", "path", name.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"),
                    "words", "odds"))
