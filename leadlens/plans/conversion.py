"""Prospect -> lease conversion mart (PIPE7) and partner lists (PIPE9, PIPE10).

Input ``prospect_data`` is the prospect master (PIPE6) with at least:
id, first_name, last_name, mobile_phone, home_phone, work_phone (stripped),
combined, email, created, application_id, primary_or_secondary_applicant,
application_processed_on, decision, sub_lead_provider, desired_building_name.
``pw_lease`` is the lease feed: leasename, primarycontactfirstname,
primarycontactlastname, primarycontacthomephone, primarycontactmobile,
primarycontactworkphone, createdtime.

Typed restatement of the reference's text comparisons (see SURVEY 1.3):
``x != ''`` on a column that was NULL upstream becomes ``x IS NOT NULL``,
``x = ''`` becomes ``x IS NULL`` and ``role <> 'Secondary'`` keeps NULL roles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions import text as T
from leadlens.operators.lookup import keyed_join
from leadlens.operators.match import containment_join
from leadlens.session import cut_lineage

PHONES = ["mobile_phone", "home_phone", "work_phone"]
NAMES = ["first_name", "last_name"]
SECONDARY = "Secondary"
CREATED_FLOOR = "2013-10-01 00:00:00"


def lease_identity(pw_lease: DataFrame) -> DataFrame:
    """The ``pw_leases`` CTE: stripped phones, long-only combined phone
    (home | mobile | work), lower-cased contact names for the name match."""
    return pw_lease.select(
        "*",
        T.strip_phone("primarycontacthomephone").alias("home_phone"),
        T.strip_phone("primarycontactmobile").alias("mobile_phone"),
        T.strip_phone("primarycontactworkphone").alias("work_phone"),
        T.combine_long_phones("primarycontacthomephone", "primarycontactmobile",
                              "primarycontactworkphone").alias("combined_phone"),
        F.lower("primarycontactfirstname").alias("contact_first"),
        F.lower("primarycontactlastname").alias("contact_last"))


def not_secondary(role: str = "primary_or_secondary_applicant") -> Column:
    """``role <> 'Secondary'`` where a NULL role (text '' upstream) passes."""
    return ~F.col(role).eqNullSafe(F.lit(SECONDARY))


def drop_processed_duplicates(prospect_data: DataFrame, blocked: bool = True,
                              candidates: DataFrame | None = None) -> DataFrame:
    """JN7: non-secondary prospects that match no *other* processed record.

    Two processed records that match each other remove each other, as in
    the reference. ``candidates`` (default: all prospects) restricts the
    left side only; the processed records are always the whole table, so
    filters on prospect columns may be applied before this step.
    """
    pd = (prospect_data if candidates is None else candidates).filter(not_secondary())
    right = prospect_data.select("id", *NAMES, *PHONES, "combined", "application_processed_on")
    return containment_join(
        pd, right, on=NAMES, left_id="id", right_id="id",
        left_phones=PHONES, right_phones=PHONES,
        left_combined="combined", right_combined="combined",
        how="left_anti", exclude_self=True,
        right_filter=F.col("application_processed_on").isNotNull(), blocked=blocked)


def attach_secondary(pd: DataFrame, prospect_data: DataFrame) -> DataFrame:
    """JN9: the secondary applicant of the same application (left join; most
    prospects have no application)."""
    sec = prospect_data.filter(F.col("primary_or_secondary_applicant") == SECONDARY).select(
        "application_id",
        F.col("id").alias("secondary_customer_id"),
        F.col("first_name").alias("secondary_first_name"),
        F.col("last_name").alias("secondary_last_name"),
        *[F.col(p).alias(f"secondary_{p}") for p in PHONES],
        F.col("created").alias("secondary_created"))
    return keyed_join(pd, sec, "application_id", spread_by="id")


IDENTITY = [*NAMES, *PHONES, "created"]


def _identity(role: str) -> list[Column]:
    """The columns that the lease match reads of the primary (``""``) or the
    ``secondary_`` applicant, under the primary's names."""
    return [F.col(role + c).alias(c) for c in IDENTITY]


def _identity_key(role: str) -> Column:
    """NULL for those without a name, whom no lease matches."""
    named = F.col(role + NAMES[0]).isNotNull() & F.col(role + NAMES[1]).isNotNull()
    return F.when(named, F.sha2(F.to_json(F.struct(*_identity(role))), 256))


def lease_pairs(x: DataFrame, leases: DataFrame, *, blocked: bool = True, checkpoint: bool = True) -> DataFrame:
    """JN8 for both applicants of a row in one pass: (``_lk``, lease columns
    with prefix ``r_``) for each distinct identity and lease where a phone of the
    identity occurs in the lease's combined phone, the names equal the
    lower-cased contact names, and the lease date isn't before the prospect's."""
    people = x.select(_identity("")).unionByName(x.select(_identity("secondary_")))
    people = (people.where(F.col(NAMES[0]).isNotNull() & F.col(NAMES[1]).isNotNull())
              .withColumn("_lk", _identity_key("")).dropDuplicates(["_lk"]))
    found = containment_join(
        people, leases, on=[(NAMES[0], "contact_first"), (NAMES[1], "contact_last")],
        left_id="_lk", right_id="lease_id" if "lease_id" in leases.columns else None, left_phones=PHONES,
        right_phones=["mobile_phone", "home_phone", "work_phone"],
        left_combined=PHONES[0], right_combined="combined_phone",
        how="inner", direction="l_in_r",
        pair_filter=F.to_date(F.col("r_createdtime")) >= F.to_date(F.col("created")),
        pair_columns=(["created"], ["createdtime"]), blocked=blocked, right_prefix="r_")
    found = found.select("_lk", *[c for c in found.columns if c.startswith("r_")])
    return cut_lineage(found, "leases") if checkpoint else found


def _with_leases(x: DataFrame, pairs: DataFrame, role: str, how: str, prefix: str = "") -> DataFrame:
    """``x`` with the leases of one applicant (or without rows that have one)."""
    pairs = pairs.select("_lk").distinct() if how == "left_anti" else pairs.select(
        "_lk", *[F.col(c).alias(prefix + c[2:]) for c in pairs.columns if c != "_lk"])
    return keyed_join(x.withColumn("_lk", _identity_key(role)), pairs, "_lk", spread_by="id", how=how).drop("_lk")


def _with_buildings(x: DataFrame, pw_building: DataFrame | None,
                    keep_columns: bool = False) -> DataFrame:
    """JN10: the building feed joined on abbreviation (a row multiplier only,
    unless ``keep_columns`` keeps the feed's columns for the funnel step)."""
    if pw_building is None:
        return x
    b = pw_building.withColumn("desired_building_name", F.col("buildingabbreviation"))
    if not keep_columns:
        b = b.select("desired_building_name")
    return keyed_join(x, b, "desired_building_name", spread_by="id")


def prospect_conversion(prospect_data: DataFrame, pw_lease: DataFrame,
                        pw_building: DataFrame | None = None, *,
                        blocked: bool = True, checkpoint: bool = True,
                        funnel_inputs: bool = False) -> DataFrame:
    """PIPE7: the analytics.prospects mart (active columns of the reference).

    prospect_data.* plus dups_id / dups_combined (always NULL after the anti
    join, kept for parity), the secondary applicant and the matched lease
    name (primary's lease, else the secondary's). Rows repeat per matching
    lease, as the reference's left joins do. ``funnel_inputs`` also keeps
    the building feed's columns and the primary lease's columns (``pl_*``)
    for ``plans.funnel``.
    """
    # The WHERE clause reads prospect columns only, so it runs before the
    # de-duplication match (it commutes with the anti and left joins).
    cand = prospect_data.filter(
        (F.col("first_name") != "") & (F.col("last_name") != "")
        & (F.col("created") >= F.lit(CREATED_FLOOR).cast(prospect_data.schema["created"].dataType)))
    pd = drop_processed_duplicates(prospect_data, blocked, candidates=cand)
    pd = pd.withColumns({"dups_id": F.lit(None).cast(prospect_data.schema["id"].dataType),
                         "dups_combined": F.lit(None).cast("string")})
    x = attach_secondary(pd, prospect_data)
    x = _with_buildings(x, pw_building, keep_columns=funnel_inputs)
    # The lease match reads x for its identities, then x is joined: materialise
    # it once in the shared checkpoint folder instead of re-running the
    # de-duplication match.
    x = cut_lineage(x) if checkpoint else x
    pairs = lease_pairs(x, lease_identity(pw_lease), blocked=blocked, checkpoint=checkpoint)
    x = _with_leases(x, pairs, "", "left", "pl_")
    x = _with_leases(x, pairs, "secondary_", "left", "sl_")
    keep = [*pd.columns, "secondary_customer_id", "secondary_first_name", "secondary_last_name"]
    if funnel_inputs:
        extra = [c for c in (pw_building.columns if pw_building is not None else [])
                 if c not in keep]
        keep += extra + [c for c in x.columns if c.startswith("pl_")]
    return x.select(*keep, F.coalesce("pl_leasename", "sl_leasename").alias("lease_name"))


def funnel_mart(prospect_data: DataFrame, pw_lease: DataFrame, pw_building: DataFrame, *,
                channels=(), agency_codes=(), blocked: bool = True) -> DataFrame:
    """PIPE7 plus the dormant funnel columns (DM2-DM8), one row per mart row."""
    from leadlens.plans.funnel import funnel_columns
    m = prospect_conversion(prospect_data, pw_lease, pw_building, blocked=blocked,
                            funnel_inputs=True)
    return m.select("id", "lease_name",
                    *funnel_columns(m, channels=channels, agency_codes=agency_codes))


def partner_list(prospect_data: DataFrame, pw_lease: DataFrame, *, code: str,
                 approved: bool, pw_building: DataFrame | None = None,
                 blocked: bool = True, checkpoint: bool = True) -> DataFrame:
    """PIPE9 (``approved=False``: no processed application) and PIPE10
    (``approved=True``: processed and approved, not pending), both for one
    lead code and without a matching lease. Rows repeat per secondary lease
    match and per building row, as in the reference."""
    cond = ((F.col("first_name") != "") & (F.col("last_name") != "")
            & (F.col("created") >= F.lit(CREATED_FLOOR).cast(prospect_data.schema["created"].dataType))
            & (F.col("sub_lead_provider") == code))
    if approved:
        d = F.col("decision")
        cond = cond & F.col("application_processed_on").isNotNull() \
            & d.contains("Approved") & ~d.contains("Pending")
    else:
        cond = cond & F.col("application_processed_on").isNull()
    # The WHERE clause reads prospect columns only: apply it first.
    pd = drop_processed_duplicates(prospect_data, blocked, candidates=prospect_data.filter(cond))
    x = attach_secondary(pd, prospect_data)
    x = _with_buildings(x, pw_building)
    x = cut_lineage(x) if checkpoint else x   # see prospect_conversion
    pairs = lease_pairs(x, lease_identity(pw_lease), blocked=blocked, checkpoint=checkpoint)
    # JN12: "left join pw_leases ... where leasename is null" is an anti join.
    x = _with_leases(x, pairs, "", "left_anti")
    x = _with_leases(x, pairs, "secondary_", "left", "sl_")
    return x.select(
        "first_name", "last_name",
        F.coalesce("secondary_first_name", F.lit("N/A")).alias("co_applicant_first_name"),
        F.coalesce("secondary_last_name", F.lit("N/A")).alias("co_applicant_last_name"),
        "mobile_phone", "home_phone", "work_phone", "email")


def report_order(df: DataFrame) -> DataFrame:
    """SO1: the report sinks' order (first, last name; NULLs last)."""
    return df.orderBy(F.col("first_name").asc_nulls_last(), F.col("last_name").asc_nulls_last())
