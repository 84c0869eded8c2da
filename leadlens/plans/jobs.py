"""The nightly jobs, end to end: extract, scrub, write, build on what was written.

Each job commits its tables together under a root (``sinks.committed``), so
readers see all of one run or all of the run before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from leadlens.functions import text as T
from leadlens.plans.conversion import partner_list, prospect_conversion
from leadlens.plans.prospects import Tables, prospect_master
from leadlens.plans.showings import showing_attribution
from leadlens.session import cut_lineage
from leadlens.sinks.committed import Version, commit
from leadlens.sinks.writers import to_text_table, write_report

# Names of the tables and sheets.
PROSPECT_TABLE, PROSPECT_MART, SHOWING_TABLE = "pcore_prospect_data", "prospects", "pcore_showing_data"
SHEET_NO_APP, SHEET_APPROVED = "prospects_without_app", "approved_prospects"


def scrubbed(df: DataFrame) -> DataFrame:
    """Line breaks, ``;`` and backslashes are dropped from text cells (SC22)."""
    return df.select([T.strip_control(F.col(f.name)).alias(f.name) if isinstance(f.dataType, Ty.StringType)
                      else F.col(f.name) for f in df.schema.fields])


def prospect_job(t: Tables, pw_lease: DataFrame, root: str, *, pw_building: DataFrame | None = None,
                 as_of: str | None = None) -> Version:
    """PIPE6 and PIPE7: the prospect master as a text table, and the mart.

    The scrubbed master is written once; the text table and the mart read it."""
    spark = pw_lease.sparkSession
    data = cut_lineage(scrubbed(prospect_master(t, as_of=as_of)), "master")
    return commit(spark, root, {PROSPECT_TABLE: to_text_table(data),
                                PROSPECT_MART: prospect_conversion(data, pw_lease, pw_building)})


def showing_job(t: Tables, root: str) -> Version:
    """PIPE8: the attributed showings as a text table."""
    showings = showing_attribution(t)
    return commit(showings.sparkSession, root, {SHOWING_TABLE: to_text_table(scrubbed(showings))})


def report_sort(df: DataFrame) -> list:
    """SO1: first and last name, NULLs last; other columns part equal names."""
    return [F.col(c).asc_nulls_last() for c in ["first_name", "last_name",
                                                *[c for c in df.columns if c not in ("first_name", "last_name")]]]


def partner_report_job(spark: SparkSession, prospect_data: DataFrame, pw_lease: DataFrame, root: str, *, code: str,
                       pw_building: DataFrame | None = None, fmt: str = "csv") -> Version:
    """PIPE9 and PIPE10 as the two ordered sheets of one report."""
    sheets = {name: partner_list(prospect_data, pw_lease, code=code, approved=approved, pw_building=pw_building)
              for name, approved in ((SHEET_NO_APP, False), (SHEET_APPROVED, True))}
    return write_report(spark, root, sheets, {name: report_sort(df) for name, df in sheets.items()}, fmt=fmt)
