"""Tables that are replaced as a whole, or not at all (SNK1-SNK3).

A refresh writes all its tables into a folder of a new version. Only when the
last of them is complete does one rename put the version's entry into the log;
readers follow the entry with the highest number. A refresh that fails, at
whatever point, leaves readers with the version before, and a reader that began
before a refresh can finish, because the version before is kept.

    root/_log/00000007                  the folder and the tables of version 7
    root/v00000007-<unique>/<table>     their files

The rename puts a small complete file in place and refuses to replace one, so
of two refreshes that end at the same time one fails and can be repeated.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LOG = "_log"
KEEP = 2                   # versions, the current one included


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    tables: dict[str, dict]        # name -> format, options and schema (DDL) to read it with


class _Files:
    """What is needed of Hadoop's file systems, whatever the store."""

    def __init__(self, spark: SparkSession, root: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def put(self, text: str, name: str) -> None:
        """A complete file ``name`` at once; an error if there is one."""
        folder, _, last = name.rpartition("/")
        draft = f"{folder}/.{last}-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.fs.exists(self.path(name)) or not self.fs.rename(self.path(draft), self.path(name)):
                raise RuntimeError(f"{name} is there already: another refresh came first")
        finally:
            self.delete(draft)


def _entries(files: _Files, root: str) -> list[str]:
    return sorted(n for n in files.names(f"{root}/{LOG}") if n.isdigit())


def _version(spark: SparkSession, root: str, entry: str) -> Version:
    found = json.loads(spark.read.text(f"{root}/{LOG}/{entry}", wholetext=True).first()["value"])
    return Version(int(entry), f"{root}/{found['folder']}", found["tables"])


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that readers see now."""
    root = root.rstrip("/")
    entries = _entries(_Files(spark, root), root)
    return _version(spark, root, entries[-1]) if entries else None


def commit(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], *, fmt: str = "parquet",
           options: Mapping[str, str] | None = None, partition_by: list[str] | None = None) -> Version:
    """Replace the tables under ``root`` by these."""
    root, files, options = root.rstrip("/"), _Files(spark, root), dict(options or {})
    entries = _entries(files, root)
    number = int(entries[-1]) + 1 if entries else 1
    folder = f"v{number:08d}-{uuid.uuid4().hex}"
    try:
        said = {}
        for name, df in tables.items():
            w = df.write.mode("error").format(fmt).options(**options)
            (w.partitionBy(*partition_by) if partition_by else w).save(f"{root}/{folder}/{name}")
            said[name] = {"format": fmt, "options": options, "schema": df.schema.toDDL()}
        files.put(json.dumps({"folder": folder, "tables": said}), f"{root}/{LOG}/{number:08d}")
    except BaseException:
        files.delete(f"{root}/{folder}")
        raise
    kept = entries[-(KEEP - 1):] if KEEP > 1 else []
    for entry in [e for e in entries if e not in kept]:
        old = _version(spark, root, entry)
        files.delete(f"{root}/{LOG}/{entry}")
        files.delete(old.folder)
    return Version(number, f"{root}/{folder}", said)


def read_committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current version."""
    version = current(spark, root)
    if version is None or name not in version.tables:
        raise ValueError(f"no table {name!r} was committed under {root}")
    how = version.tables[name]
    return (spark.read.format(how["format"]).schema(how["schema"]).options(**how["options"])
            .load(f"{version.folder}/{name}"))


def publish(spark: SparkSession, root: str, views: Mapping[str, str]) -> None:
    """Point catalog views at the current version: view -> table under ``root``.
    A view is replaced in one step, so a query sees one version or the other."""
    version = current(spark, root)
    if version is None:
        raise ValueError(f"nothing was committed under {root}")
    for view, name in views.items():
        how = version.tables[name]
        if how["format"] != "parquet":
            raise ValueError("views are published over parquet tables")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{version.folder}/{name}`")
