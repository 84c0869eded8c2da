"""Feed refresh (PIPE11): report -> cleaned, typed table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from leadlens.operators.infer import clean_frame
from leadlens.sinks.committed import Version, commit, publish
from leadlens.sources.report import read_report

TABLE, REJECTS = "data", "rejects"
# The tables of the three feeds.
FEEDS = ("pw_building", "pw_lease", "pw_unit")
_NO_REJECTS = "column_name string, value string"


def cleaned_feed(spark: SparkSession, path: str, *, partitions: int | None = None, newest_only: bool = True,
                 key: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Read the newest report under ``path`` (or all) and clean/infer its columns."""
    return clean_frame(read_report(spark, path, partitions=partitions, newest_only=newest_only), key)


def refresh(spark: SparkSession, path: str, root: str, *, partitions: int | None = None,
            newest_only: bool = True, key: list[str] | None = None) -> Version:
    """Full refresh of one feed's table under ``root``.

    The table and its rejects (cells that are no dates in a date column keep
    their text there) are committed together: readers see both of the last
    complete refresh (``read_committed(spark, root, TABLE)``). A report is one
    document, read by one task; its records are dealt out over ``partitions``
    (Spark's shuffle partitions by default) before they are cleaned."""
    spread = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df, rejects = cleaned_feed(spark, path, partitions=spread, newest_only=newest_only, key=key)
    if rejects is None:
        rejects = spark.createDataFrame([], _NO_REJECTS)
    return commit(spark, root, {TABLE: df, REJECTS: rejects})


def refresh_feeds(spark: SparkSession, landings: Mapping[str, str], root: str, *,
                  partitions: int | None = None, views: bool = False) -> dict[str, Version]:
    """Refresh the tables of the feeds (``FEEDS``) from their landing folders.

    Each is committed on its own: a broken report leaves its own table as it
    was and the others refreshed; the errors are raised together at the end.
    ``views`` also points a catalog view of the feed's name at the table."""
    unknown = set(landings) - set(FEEDS)
    if unknown:
        raise ValueError(f"no such feeds: {sorted(unknown)}")
    done, failed = {}, {}
    for name, landing in landings.items():
        home = f"{root.rstrip('/')}/{name}"
        try:
            done[name] = refresh(spark, landing, home, partitions=partitions)
            if views:
                publish(spark, home, {name: TABLE})
        except Exception as e:  # noqa: BLE001 - reported below
            failed[name] = e
    if failed:
        raise RuntimeError("feeds not refreshed: " + "; ".join(f"{n}: {e}" for n, e in failed.items()))
    return done
