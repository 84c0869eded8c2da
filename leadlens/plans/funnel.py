"""Funnel columns of the conversion mart (DM2-DM8).

The reference keeps these columns commented out; they are built here as an
optional last step over the mart rows (``prospect_conversion(...,
funnel_inputs=True)``), restated for typed columns: a text test
``x != ''`` is ``x IS NOT NULL`` and a count read as text ``''`` is 0.
Code lists (lead channels, agencies) are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions import text as T
from leadlens.operators.lookup import case_map
from leadlens.operators.profile import count_when

# Fixed values of the market rule (zone name -> market), in the reference's order.
ZONE_MARKETS = [
    ("Indianapolis", ["ZONE 20", "ZONE 21"]),
    ("Baltimore", ["ZONE 30", "ZONE 31"]),
    ("Chicago", ["ZONE 1", "ZONE 2", "ZONE 3", "ZONE 4", "ZONE 5"]),
]
WALK_CODE = "walk"
NO_ASSISTANCE = "None"


def _approved(decision: Column) -> Column:
    return decision.contains("Approved") & ~decision.contains("Pending")


def _flag(p: Column) -> Column:
    return F.when(p, F.lit("1")).otherwise(F.lit("0"))


def _na(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("N/A"))


def funnel_columns(df: DataFrame, *, channels: Sequence[tuple[str, Sequence[str]]] = (),
                   agency_codes: Sequence[str] = ()) -> list[Column]:
    """DM2-DM8 as column expressions over mart rows.

    ``df`` needs the prospect master columns used below, the building feed
    columns (portfolioabbreviation, buildingabbreviation, zonename, zonepm,
    leasingagent) and the primary lease's leasename / publicassistanceprogram
    as ``pl_leasename`` / ``pl_publicassistanceprogram``.
    """
    cnt = {c: F.coalesce(F.col(c), F.lit(0)) for c in (
        "total_showing_count", "pending_showing_count", "missed_showing_count",
        "cancelled_showing_count", "rescheduled_showing_count", "shown_showing_count")}
    sub = F.col("sub_lead_provider")
    master = F.col("master_lead_provider")
    chan = case_map(sub, channels, None) if channels else F.lit(None).cast("string")
    master_clean = F.coalesce(
        chan, F.when(F.lower(sub) == WALK_CODE, F.lit("Walk")),
        F.when(master.isNull() | (master == ""), F.lit("none")).otherwise(master))
    pap = F.col("pl_publicassistanceprogram")
    return [
        F.concat(F.col("portfolioabbreviation"), F.lit(" | "), F.col("buildingabbreviation"),
                 F.lit(" | "), F.col("desired_unit_name")).alias("desired_location"),       # DM8
        F.col("approval_type").alias("approval_type_clean"),
        F.col("missed_showing_count").alias("no_show_clean"),
        F.col("cancelled_showing_count").alias("cancelled_clean"),
        _flag((F.col("total_showing_count") > 0)
              | F.col("application_submitted_on").isNotNull()).alias("had_showing_set"),  # DM3
        cnt["total_showing_count"].alias("total_showings_set"),
        cnt["pending_showing_count"].alias("pending_showing"),
        cnt["missed_showing_count"].alias("no_show"),
        cnt["cancelled_showing_count"].alias("cancelled"),
        cnt["rescheduled_showing_count"].alias("rescheduled"),
        cnt["shown_showing_count"].alias("show"),
        F.when(cnt["pending_showing_count"] != 0, F.lit("Pending")).otherwise(F.lit("N/A"))
         .alias("showing_pending"),
        _flag(F.col("application_submitted_on").isNotNull()).alias("application_in"),
        F.when(_approved(F.col("decision")), F.lit("Approved")).otherwise(F.col("decision"))
         .alias("app_status"),
        _flag(F.coalesce(_approved(F.col("decision")), F.lit(False))).alias("approved"),
        _flag(F.col("pl_leasename").isNotNull()).alias("converted"),
        _flag(F.col("lease_signing_count").isNotNull()).alias("lease_signing_set"),
        _na("portfolioabbreviation").alias("fund"), _na("buildingabbreviation").alias("building"),
        F.coalesce(F.nullif(F.col("desired_unit_name"), F.lit("")), F.lit("N/A")).alias("unit"),
        _na("zonename").alias("zone"), _na("zonepm").alias("pm"),
        _na("leasingagent").alias("leasing_agent"),
        case_map(F.col("zonename"), ZONE_MARKETS, F.lit("N/A")).alias("market"),           # DM2
        F.concat(F.col("buildingabbreviation"), F.col("desired_unit_name")).alias("building_unit_uid"),
        F.when(F.col("max_rent").isNull() | F.col("target_rent").isNull(), F.lit(0.0))
         .otherwise(F.col("max_rent") - F.col("target_rent")).alias("rent_shortfall"),     # DM4
        F.col("prospect_created_quarter").alias("quarter"),
        F.coalesce(F.nullif(sub, F.lit("")), F.lit("none")).alias("sub_lead_clean"),
        master_clean.alias("master_lead_clean"),                                            # DM1
        F.col("subsidy_type").alias("public_assistance"),
        pap.alias("pap_clean"),
        T.yes_no(F.col("subsidy_type").isNotNull() | (pap != NO_ASSISTANCE)).alias("subsidy_lead"),
        T.yes_no(sub.isin(list(agency_codes)) if agency_codes else F.lit(False))
         .alias("agency"),                                                                  # DM5
    ]


def funnel_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """DM7: applications and conversions (primary or secondary lease) counted."""
    aggs = [count_when(F.col("application_submitted_on").isNotNull()).alias("applications"),
            count_when(F.col("lease_name").isNotNull()).alias("converted")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
