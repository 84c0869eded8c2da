"""JSON report feeds (SRC2-SRC5).

A report document is ``{"columns": [{"index": i, "label": "..."}, ...],
"records": [[cell, ...], ...]}`` (records may also be objects keyed by the
column index). One document is one file; Spark reads each file whole
(``wholetext``), repairs its escapes and parses it once into a VARIANT, so many
report files are parsed in parallel. Every record is read by the header of its
own document: documents may order their columns differently, number them
differently, or lack some; a column that a document lacks is NULL in its rows.
Only the distinct headers reach the driver, to name the columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER = "array<struct<index: int, label: string>>"
# Fixed values of JSON: the characters that a backslash may stand before.
_ESCAPES = r'(\\["\\/bfnrtu])|\\(.)'

# Fixed values of the reference's label rule: runs of non-word characters or
# underscores are removed; a label starting with a digit gets a "_" prefix;
# names are lower-cased when written.
LABEL_DROP = re.compile(r"[\W_]+")


def sanitize_label(label: str) -> str:
    s = LABEL_DROP.sub("", label)
    if s and s[0].isdigit():
        s = "_" + s
    return s


def sanitize_columns(labels: list[str], lower: bool = True) -> list[str]:
    """SRC5: clean labels; raise on empty or clashing names."""
    names = [sanitize_label(x) for x in labels]
    if lower:
        names = [n.lower() for n in names]
    bad = [labels[i] for i, n in enumerate(names) if not n]
    if bad:
        raise ValueError(f"labels with no usable characters: {bad}")
    seen: dict[str, str] = {}
    for lab, n in zip(labels, names):
        if n in seen:
            raise ValueError(f"labels {seen[n]!r} and {lab!r} both sanitise to {n!r}")
        seen[n] = lab
    return names


def repair_escapes(text: Column) -> Column:
    r"""SRC3: a backslash before a character that JSON doesn't escape (``\'``,
    ``\>``) is dropped; legal escapes, ``\\`` among them, are stepped over."""
    return F.regexp_replace(text, _ESCAPES, "$1$2")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per report file: path, modified, columns and records."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"), "value")
    return parse_documents(raw)


def parse_documents(raw: DataFrame, value: str = "value") -> DataFrame:
    """SRC2: ``columns`` (index and label of each) and ``records`` (VARIANT) in
    place of ``value``; both are NULL where the text is no such document."""
    rest = [c for c in raw.columns if c != value]
    # A generated column: filters on the parsed parts stay above it, else each would parse again.
    doc = raw.select(*rest, F.explode(F.array(F.try_parse_json(repair_escapes(F.col(value))))).alias("doc"))
    return doc.select(*rest, F.try_variant_get("doc", "$.columns", HEADER).alias("columns"),
                      F.try_variant_get("doc", "$.records", "array<variant>").alias("records"))


def headers_of(docs: DataFrame) -> list[list[tuple[int, str]]]:
    """The distinct (index, label) headers, that of the newest document first."""
    seen = (docs.where(F.col("columns").isNotNull())
            .groupBy(F.array_sort("columns").alias("columns"))
            .agg(F.max(F.struct("modified", "path")).alias("last")).collect())
    if not seen:
        raise ValueError("no parsable report document")

    def age(row):
        modified, path = row["last"]
        return (modified is not None, modified or 0, path)
    return [[(h["index"], h["label"]) for h in row["columns"]] for row in sorted(seen, key=age, reverse=True)]


def column_names(headers: list[list[tuple[int, str]]], lower: bool = True) -> list[str]:
    """The sanitised names of all headers in order of their first appearance."""
    names: dict[str, None] = {}
    for header in headers:
        names.update(dict.fromkeys(sanitize_columns([label for _, label in header], lower)))
    return list(names)


def _name(label: Column, lower: bool) -> Column:
    """``sanitize_label`` as a column expression."""
    s = F.regexp_replace(label, "(?U)" + LABEL_DROP.pattern, "")
    s = F.when(s.rlike(r"^\p{Nd}"), F.concat(F.lit("_"), s)).otherwise(s)
    return F.lower(s) if lower else s


def records(docs: DataFrame, names: list[str] | None = None, lower: bool = True,
            partitions: int | None = None) -> DataFrame:
    """SRC4: one row per record, with the columns ``names`` (by default all that
    any document has). Each cell is found through its own document's labels.
    After the explode, rows are spread over ``partitions`` tasks (one document
    is otherwise one task).
    """
    if names is None:
        names = column_names(headers_of(docs), lower)
    places = F.map_from_entries(F.transform("columns", lambda h: F.struct(_name(h["label"], lower), h["index"])))
    rows = (docs.where(F.col("columns").isNotNull())
            .select(places.alias("places"), F.explode("records").alias("record"))
            .select("places", F.try_variant_get("record", "$", "array<string>").alias("cells"),
                    F.try_variant_get("record", "$", "map<string,string>").alias("named")))
    if partitions:
        rows = rows.repartition(partitions)
    out = []
    for name in names:
        at = F.element_at("places", F.lit(name))
        out.append(F.coalesce(F.get("cells", at), F.element_at("named", at.cast("string"))).alias(name))
    return rows.select(out)


def read_report(spark: SparkSession, path: str, *, newest_only: bool = True,
                lower: bool = True, partitions: int | None = None) -> DataFrame:
    """SRC2-SRC5: the records of the report(s) under ``path`` as a text frame.

    A feed refresh replaces the table with the newest report, so by default
    only the newest document is read; ``newest_only=False`` unions all
    documents, each read by its own header.
    """
    # Documents are read twice (headers, then records) rather than cached:
    # a report can be large and the second read is a plain file scan.
    docs = read_documents(spark, path)
    if newest_only:
        newest = docs.where(F.col("columns").isNotNull()) \
                     .agg(F.max_by("path", F.struct("modified", "path")).alias("p")).first()["p"]
        docs = docs.filter(F.col("path") == newest)
    return records(docs, None, lower, partitions)
