"""Prospect master extract (PIPE1-PIPE6) over the operational tables.

``t`` maps table names to DataFrames: customers, customers_promos, promos,
prospects, applicants, applicants_applications, applications,
applications_occupants, approvals, legacy_process_approval_reports, units,
buildings, showings, activities, lease_signings, subscriptions, clv_reports,
lexis_nexis_reports, lexis_nexis_items.

Parity choices (SURVEY 2.6, 2.13, 7.5): fan-out counts, repeated master-lead
rows and raw-phone showing matches are kept by default; ``stripped=True``
matches showings on stripped phones and ``pii='hash'`` hashes SSN and date of
birth. ``as_of`` replaces the reference's ``'today'`` literal.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.functions import dates as D
from leadlens.functions import text as T
from leadlens.operators import match as M
from leadlens.operators import profile as P
from leadlens.operators import select as S
from leadlens.operators.lookup import keyed_join
from leadlens.session import cut_lineage

Tables = Mapping[str, DataFrame]
CREATED_FLOOR = "2013-01-01 00:00:00"
RAW_PHONES = ["mobile_phone", "home_phone", "work_phone"]
CLEAN_PHONES = ["mobile_phone_clean", "home_phone_clean", "work_phone_clean"]
NAMES = ["first_name_clean", "last_name_clean"]


def _ts(v: str) -> Column:
    return F.lit(v).cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# PIPE1: customers_clean
# ---------------------------------------------------------------------------

def processed_last_application(t: Tables) -> DataFrame:
    """Per applicant: last and first application that has an approval (JN4)."""
    aa = t["applicants_applications"]
    approved = t["approvals"].select("application_id").distinct()
    return aa.join(approved, "application_id", "left_semi").groupBy("applicant_id").agg(
        F.max("application_id").alias("application_id"),
        F.min("application_id").alias("first_application_id"))


def lead_attribution(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JN2 + LK5: master lead rows, the newest marketing promo, lead source rows."""
    cp, pr = t["customers_promos"], t["promos"].select("id", "name", "promo_type")

    def of_type(kind: str) -> DataFrame:
        p = pr.filter(F.col("promo_type") == kind).select(F.col("id").alias("promo_id"), "name")
        return cp.join(p, "promo_id", "inner")

    master = of_type("master lead").select(F.col("customer_id").alias("id"),
                                           F.col("name").alias("master_lead_provider"))
    sub = of_type("marketing").groupBy("customer_id").agg(F.max("promo_id").alias("promo_id"))
    sub = sub.join(pr.select(F.col("id").alias("promo_id"), "name"), "promo_id", "left") \
             .select(F.col("customer_id").alias("id"), F.col("name").alias("sub_lead_provider"))
    desk = of_type("lead_source").select(F.col("customer_id").alias("id"),
                                         F.col("name").alias("desktop_or_mobile"))
    return master, sub, desk


def dedup_rows(t: Tables) -> tuple[DataFrame, list]:
    """WN1/WN2 input: customer x applicant rows with the processed flag, and
    their numbering order (created_at, then ids as tie-breaks)."""
    c = t["customers"]
    rows = (c.select("id", "created_at", "first_name", "last_name",
                     T.clean_name("first_name").alias("first_name_clean"),
                     T.clean_name("last_name").alias("last_name_clean"),
                     T.combine_phones("mobile_phone", "work_phone", "home_phone", strip=False)
                      .alias("raw_combined"))
             .join(t["applicants"].select(F.col("customer_id").alias("id"),
                                          F.col("id").alias("applicant_id")), "id", "left")
             .join(processed_last_application(t).select(
                   "applicant_id", F.lit(True).alias("has_processed")), "applicant_id", "left")
             .filter((F.col("first_name") != "") & (F.col("last_name") != "")))
    # PostgreSQL sorts NULL created_at last; ids make the order unique.
    return rows, [("created_at", "nulls_last"), "id", "applicant_id"]


def customers_clean(t: Tables) -> DataFrame:
    """PIPE1: cleaned identities, lead attribution, later duplicates removed."""
    c = t["customers"]
    base = c.filter(T.not_blank("first_name") & T.not_blank("last_name")
                    & (F.col("created_at") > _ts(CREATED_FLOOR)))
    rows, order = dedup_rows(t)
    base = S.survivor_dedup(rows, base, id_col="id",
                            keys=["first_name_clean", "last_name_clean", "raw_combined"],
                            order=order, keep_if=F.col("has_processed"))
    cc = base.select(
        T.clean_name("first_name").alias("first_name_clean"),
        T.clean_name("last_name").alias("last_name_clean"),
        T.strip_phone("home_phone").alias("home_phone_clean"),
        T.strip_phone("mobile_phone").alias("mobile_phone_clean"),
        T.strip_phone("work_phone").alias("work_phone_clean"),
        T.combine_phones("mobile_phone", "work_phone", "home_phone").alias("combined"),
        "*")
    master, sub, desk = lead_attribution(t)
    # master and lead-source rows multiply customers (bag semantics, LK5).
    return cc.join(master, "id", "left").join(sub, "id", "left").join(desk, "id", "left")


# ---------------------------------------------------------------------------
# PIPE2: showing profile per identity
# ---------------------------------------------------------------------------

def showing_profile(t: Tables, cc: DataFrame, as_of: str | None = None,
                    phones: list[str] = RAW_PHONES, exact: bool = False) -> DataFrame:
    """Counts by state, before/after application, units and setters per identity.
    ``exact`` counts each showing once instead of once per joined row.

    Counts run over showings joined with applicants and activities (fan-out
    parity, AG14). Showings without a clean customer would form one group with
    a NULL identity, which matches nothing; they are left out before grouping.
    """
    today = D.as_of(as_of)
    sh = t["showings"]
    pr = t["prospects"].select(F.col("id").alias("prospect_id"), F.col("customer_id"))
    # customers_clean keeps its lead-attribution fan-out here, as in the reference.
    ident = cc.select(F.col("id").alias("customer_id"), *NAMES, *phones, "combined")
    app = t["applicants"].select(F.col("prospect_id"), F.col("created_at").alias("app_created_at"))
    units = t["units"].select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name"))
    act = t["activities"].filter((F.col("record_type") == "showing")
                                 & (F.col("action") == "created_showing")) \
                         .select(F.col("record_id").alias("showing_id"), F.col("user").alias("set_by"))
    j = (sh.select(F.col("id").alias("showing_id"), "prospect_id", "unit_id", "showable_state",
                   "start_time", "created_at", "name")
           .join(pr, "prospect_id").join(ident, "customer_id")
           .join(app, "prospect_id", "left").join(units, "unit_id", "left")
           .join(act, "showing_id", "left"))
    st, start, created = F.col("showable_state"), F.col("start_time"), F.col("created_at")
    keys = [*NAMES, *phones, "combined"]
    def count(p: Column) -> Column:
        return F.count_distinct(F.when(p, F.col("showing_id"))) if exact else P.count_when(p)

    return P.with_distinct(j, keys, [
        count(F.lit(True)).alias("total_showing"),
        count((st == "showing_set") & (start < today)).alias("showing_shown"),
        *[count(st == x).alias(f"showing_{x}") for x in ("cancelled", "rescheduled", "missed")],
        count((st == "showing_set") & (start > today)).alias("showing_pending"),
        count(created < F.col("app_created_at")).alias("showings_before_app"),
        count(created > F.col("app_created_at")).alias("showings_after_app"),
        F.avg(D.seconds_between(start, created)).alias("avg_days_out_scheduled"),
        F.min(created).alias("first_showing_created"),
        F.min("showing_id").alias("first_showing_id"),
        F.max(created).alias("last_showing_created"),
        P.ordered_list(F.when(st == "showing_set", F.col("name")),
                       ["start_time", "showing_id"]).alias("leasing_agents_shown_list"),
    ], [
        {"value": "unit_id", "count_as": "units_visited_count"},
        {"value": "unit_name", "list_as": "units_visited_list"},
        {"value": "set_by", "count_as": "showing_set_by_count", "list_as": "showing_set_by_list"}])


# ---------------------------------------------------------------------------
# PIPE3: application / approval profile
# ---------------------------------------------------------------------------

def approval_profile(t: Tables) -> dict[str, DataFrame]:
    """Per-application aggregates used by the master (LK3 in one pass each)."""
    ap = t["approvals"]
    aa = t["applicants_applications"]
    roles = aa.groupBy("application_id").agg(
        F.min("applicant_id").alias("primary_applicant_id"),
        F.nullif(F.max("applicant_id"), F.min("applicant_id")).alias("secondary_applicant_id"))
    dec, ps = F.lower("decision"), F.lower("process_state")
    detail = F.struct("id", "underwriting_model_id", "decision", "score", "tier", "amount",
                      "move_in_fee", "created_at", "approved_for_unit_reason")
    last = ap.groupBy("application_id").agg(
        F.max("id").alias("approval_id"),
        P.sum_when(dec.like("%error%")).alias("error_count"),
        P.sum_when(dec.like("%pending manager%")).alias("pending_count"),
        P.sum_when(ps == "underwritten").alias("run_count"),
        F.max_by(detail, "id").alias("approval_details"))
    first = ap.filter(F.col("process_state") == "underwritten").groupBy("application_id").agg(
        F.min_by(F.col("approved_for_unit_reason"), "id").alias("first_approved_for_unit_reason"))
    return {"roles": roles, "last_approval": last, "first_approval": first}


# ---------------------------------------------------------------------------
# PIPE4: background-record profile
# ---------------------------------------------------------------------------

EV_BANDS = [1, 3, 5, 10]
FEL_BANDS = [3, 5, 10]
MISD_BANDS = [2]


def latest_reports(t: Tables, report_type: str) -> DataFrame:
    """LK4: per subscribed applicant, the newest complete report of a type."""
    sub = t["subscriptions"].filter(
        (F.col("third_party_type") == "ThirdParty::LexisNexisReport")
        & (F.col("subscriber_type") == "Applicant")).select("third_party_id", "subscriber_id")
    r = t["lexis_nexis_reports"].filter((F.col("status") == "complete")
                                        & (F.col("report_type") == report_type))
    return r.join(sub, r["id"] == sub["third_party_id"], "inner").groupBy("subscriber_id").agg(
        F.max("id").alias("report_id"), F.max("subscriber_id").alias("subscriber"),
        F.max("created_at").alias("report_created_at"),
        F.max("updated_at").alias("report_updated_at"))


def item_profile(items: DataFrame) -> DataFrame:
    """AG11: all item types of every report in one pass; a type with no item
    on a report gives NULL counts, like the reference's per-type subqueries."""
    age = D.age_years("created_at", "date")
    t = F.col("item_type")
    specs = [("ev_count", "eviction", EV_BANDS), ("fel_count", "felony", FEL_BANDS),
             ("misd_count", "misdemeanor", MISD_BANDS)]
    aggs = []
    for prefix, typ, edges in specs:
        aggs += P.band_counts(age, edges, prefix, when=t == typ)
    aggs.append(P.count_when(t == "sex offense").alias("so_count"))
    prof = items.groupBy(F.col("lexis_nexis_report_id").alias("report_id")).agg(*aggs)
    out = [F.col("report_id")]
    for prefix, _, _ in specs:
        tot = F.col(f"{prefix}_total")
        out += [F.when(tot > 0, F.col(c)).alias(c) for c in prof.columns
                if c.startswith(prefix + "_")]
    out.append(F.when(F.col("so_count") > 0, F.col("so_count")).alias("so_count"))
    return prof.select(out)


def record_profile(t: Tables) -> DataFrame:
    """PIPE4: EV and CM band counts per applicant (subscriber)."""
    prof = item_profile(t["lexis_nexis_items"])
    ev_cols = [c for c in prof.columns if c.startswith("ev_")]
    cm_cols = [c for c in prof.columns if c.startswith(("fel_", "misd_", "so_"))]
    ev = latest_reports(t, "EV").join(prof.select("report_id", *ev_cols), "report_id", "left") \
                                .select(F.col("subscriber").alias("applicant_id"), *ev_cols)
    cm = latest_reports(t, "CM").join(prof.select("report_id", *cm_cols), "report_id", "left") \
                                .select(F.col("subscriber").alias("applicant_id"), *cm_cols)
    return ev.filter(F.col("applicant_id").isNotNull()) \
             .join(cm.filter(F.col("applicant_id").isNotNull()), "applicant_id", "full")


# ---------------------------------------------------------------------------
# PIPE5: lease-signing profile
# ---------------------------------------------------------------------------

def signing_profile(t: Tables, as_of: str | None = None) -> DataFrame:
    today = D.as_of(as_of)
    ls = t["lease_signings"]
    units = t["units"].select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name"),
                              "building_id")
    bld = t["buildings"].select(F.col("id").alias("building_id"),
                                F.col("name").alias("building_name"))
    j = ls.join(units, "unit_id", "left").join(bld, "building_id", "left")
    st = F.col("showable_state")
    return j.groupBy("prospect_id").agg(
        F.count(F.lit(1)).alias("lease_signing_count"),
        P.count_when((st == "lease_signing_set") & (F.col("start_time") < today)).alias("ls_shown"),
        P.count_when((st == "lease_signing_set") & (F.col("start_time") > today)).alias("ls_pending"),
        F.min("created_at").alias("first_signing_set"),
        P.distinct_list(F.col("building_name").cast("string")).alias("ls_buildings_visited"),
        P.distinct_list(F.col("unit_name").cast("string")).alias("ls_units_visited"))


# ---------------------------------------------------------------------------
# PIPE6: the prospect master
# ---------------------------------------------------------------------------

APPLICANT_COLUMNS = [
    "ssn_itin", "months_at_residence", "years_at_job", "current_address", "current_city",
    "current_state", "current_zip", "employer_name", "employer_address", "employer_phone",
    "is_temp_employee"]
APPLICANT_COLUMNS_2 = [
    "monthly_income_payment_method", "monthly_income_proof", "second_income_payment_method",
    "second_income_proof", "has_permanent_subsidy", "has_temporary_subsidy", "bank_name",
    "bank_type", "credit_card_type"]
APPLICANT_COLUMNS_3 = [
    "first_apartment", "spanish_speaking", "education_level", "employment_type", "salutation",
    "marriage_status", "school_attending", "school_id", "school_year", "enrollment_status",
    "financial_aid_organization", "quarterly_aid_provided", "quarterly_aid_for_rent",
    "years_remaining_on_aid"]
PROSPECT_COLUMNS = [
    "desired_beds", "desired_baths", "desired_location", "number_of_occupants",
    "number_of_pets", "move_in_date", "income_source", "evictions_within_twelve_months",
    "felonies_within_three_years", "monthly_income", "reason_not_converting",
    "subsidy_voucher", "building_name", "unit_name", "waitlisted_at", "desired_history"]
MANUAL_ENTRY_KEY = '"evictions_0_to_1_years":'


def _opt(df: DataFrame, c: str, typ: str = "string") -> Column:
    """A column of ``df`` or a typed NULL when the source lacks it."""
    return F.col(c) if c in df.columns else F.lit(None).cast(typ)


def applicant_profile(t: Tables, a: DataFrame) -> DataFrame:
    """``a`` (applicants, by ``applicant_id``) with their applications and
    approvals, CLV scores and background records.

    Each step is looked up from the rows that have its key, never from the wide
    master: most customers have no applicant and most applicants no
    application, and a shuffle would send all of their NULL keys to one task.
    """
    apps = t["applications"].select(F.col("id").alias("application_id"),
                                    F.col("created_at").alias("application_submitted_on"),
                                    F.lit(True).alias("_app_found"),
                                    _opt(t["applications"], "cached_rendered_hash").alias("_hash"))
    prof = approval_profile(t)
    lp = t["legacy_process_approval_reports"].select(
        F.col("approval_id"), F.col("tier").alias("lp_tier"), F.col("amount").alias("lp_amount"),
        F.col("move_in_fee").alias("lp_move_in_fee"))
    last_approval = keyed_join(prof["last_approval"], lp, "approval_id", spread_by="application_id")
    applied = (processed_last_application(t)           # only applications that have an approval
               .join(apps, "application_id", "left")
               .join(prof["roles"], "application_id", "left")
               .join(last_approval, "application_id", "left")
               .join(prof["first_approval"].withColumnRenamed("application_id", "first_application_id"),
                     "first_application_id", "left"))

    clv_sub = t["subscriptions"].filter(
        (F.col("third_party_type") == "ThirdParty::CLVReport")
        & (F.col("subscriber_type") == "Applicant")).groupBy(F.col("subscriber_id").alias("applicant_id")).agg(
        F.max("third_party_id").alias("clv_report_id"))
    clv = t["clv_reports"].select(F.col("id").alias("clv_report_id"), F.col("clv").alias("_clv"))
    scores = keyed_join(clv_sub, clv, "clv_report_id", spread_by="applicant_id")
    for part in (applied, scores, record_profile(t)):
        a = keyed_join(a, part, "applicant_id", spread_by="id")
    return a


def prospect_master(t: Tables, *, as_of: str | None = None, stripped: bool = False,
                    pii: str = "keep", blocked: bool = True, checkpoint: bool = True,
                    exact: bool = False, coalesce_fee: bool = False) -> DataFrame:
    """PIPE6: one wide row per clean customer (x lead-attribution rows).

    ``exact`` counts showings once (AG14); ``coalesce_fee`` gives the legacy
    move-in fee where there is one instead of null (SC12).

    Customers listed as occupants are removed first (explicit anti join).
    ``customers_clean`` feeds the master, the showing profile and the
    showing match; it is materialised once in the shared checkpoint folder
    (``checkpoint=True``) instead of being re-derived in each branch.
    """
    cc_all = customers_clean(t)
    cc_all = cut_lineage(cc_all) if checkpoint else cc_all
    occ = t["applications_occupants"].select(F.col("customer_id").alias("id")).distinct()
    cc = cc_all.join(occ, "id", "left_anti")

    prospects = S.latest_per_key(t["prospects"], "customer_id", "id")
    applicants = S.latest_per_key(t["applicants"], "customer_id", "id")
    units = t["units"].select(F.col("id").alias("desired_unit"),
                              F.col("name").alias("desired_unit_name"), "target_rent",
                              F.col("building_id").alias("_bld"))
    blds = t["buildings"].select(F.col("id").alias("_bld"),
                                 F.col("name").alias("desired_building_name"))
    p = prospects.select(F.col("id").alias("prospect_id"), F.col("customer_id").alias("id"),
                         "desired_unit", "updated_at", "subsidy_type",
                         *[F.col(c).alias(f"prospect_{c}") for c in PROSPECT_COLUMNS
                           if c in prospects.columns])
    p = keyed_join(p, keyed_join(units, blds, "_bld", spread_by="desired_unit"), "desired_unit", spread_by="id")
    p = keyed_join(p, signing_profile(t, as_of), "prospect_id", spread_by="id")
    a = applicants.select(F.col("id").alias("applicant_id"), F.col("customer_id").alias("id"),
                          *[F.col(c).alias(f"a_{c}") for c in applicants.columns
                            if c not in ("id", "customer_id")])
    x = cc.join(p, "id", "left").join(applicant_profile(t, a), "id", "left")

    # Showing counts, matched back by the containment rule (JN6).
    # Parity: raw phones are looked up in stripped ``combined`` strings.
    # The showing profile groups the *unfiltered* clean customers, as the
    # reference's CTE does; matches are computed per distinct identity and
    # joined into the wide frame by identity key.
    phones = CLEAN_PHONES if stripped else RAW_PHONES
    sc = showing_profile(t, cc_all, as_of, phones, exact)
    spec = dict(on=NAMES, left_phones=phones, left_combined="combined")
    sc = sc.withColumn("_group", M.identity_key(**spec))     # unique: the profile is grouped by it
    matches = M.identity_matches(cc, sc, **spec, right_id="_group", right_phones=phones,
                                 right_combined="combined", how="inner",
                                 blocked=blocked, right_prefix="sc_")
    x = x.withColumn("_lk", M.identity_key(**spec)).join(matches, "_lk", "left").drop("_lk")
    return _master_columns(x, a, pii, coalesce_fee)


def _master_columns(x: DataFrame, a: DataFrame, pii: str, coalesce_fee: bool = False) -> DataFrame:
    ad = F.col("approval_details")
    permanent = F.col("a_has_permanent_subsidy") if "a_has_permanent_subsidy" in a.columns \
        else F.lit(None).cast("boolean")
    desired_hist = F.col("prospect_desired_history") if "prospect_desired_history" in x.columns \
        else F.lit(None).cast("string")
    keep_stored = (desired_hist == "{}") | (permanent.cast("string").isin("true", "t"))
    keep_stored = F.coalesce(keep_stored, F.lit(False))

    def applicant(c: str) -> Column:
        return (F.col(f"a_{c}") if f"a_{c}" in a.columns else F.lit(None).cast("string")).alias(c)

    atype = F.lower(_a(a, "applicant_type"))
    ssn, dob = applicant("ssn_itin"), F.col("dob") if "dob" in x.columns else F.lit(None)
    if pii == "hash":
        ssn = F.sha2(_a(a, "ssn_itin").cast("string"), 256).alias("ssn_itin")
        dob = F.sha2(dob.cast("string"), 256)
    reason, first_reason = ad["approved_for_unit_reason"], F.col("first_approved_for_unit_reason")
    unit_name, bld_name = _px(x, "prospect_unit_name"), _px(x, "prospect_building_name")
    cols = [
        F.col("id"), _opt(x, "pw_id").alias("entity_id"),
        F.col("first_name_clean").alias("first_name"), F.col("last_name_clean").alias("last_name"),
        F.col("home_phone_clean").alias("home_phone"), F.col("mobile_phone_clean").alias("mobile_phone"),
        F.col("work_phone_clean").alias("work_phone"), "combined", dob.alias("dob"),
        _opt(x, "email").alias("email"), F.col("created_at").alias("created"),
        "prospect_id",
        *[_px(x, f"prospect_{c}").alias(f"prospect_{c}") for c in PROSPECT_COLUMNS],
        "desired_building_name", "desired_unit_name", "target_rent",
        "master_lead_provider", "sub_lead_provider", "desktop_or_mobile",
        D.to_day("created_at").alias("prospect_created_date"),
        D.month_end("created_at").alias("prospect_created_month"),
        D.quarter_of(D.month_end("created_at")).alias("prospect_created_quarter"),
        "subsidy_type", _px(x, "prospect_subsidy_voucher").alias("voucher_amount"), "updated_at",
        F.col("sc_total_showing").alias("total_showing_count"),
        F.col("sc_showing_missed").alias("missed_showing_count"),
        F.col("sc_showing_cancelled").alias("cancelled_showing_count"),
        F.col("sc_showing_rescheduled").alias("rescheduled_showing_count"),
        F.col("sc_showing_shown").alias("shown_showing_count"),
        F.col("sc_showing_pending").alias("pending_showing_count"),
        *[F.col(f"sc_{c}").alias(c) for c in (
            "showings_before_app", "showings_after_app", "avg_days_out_scheduled",
            "units_visited_count", "units_visited_list", "showing_set_by_count",
            "showing_set_by_list", "first_showing_created", "last_showing_created",
            "leasing_agents_shown_list")],
        "lease_signing_count", "ls_buildings_visited", "ls_units_visited", "first_signing_set",
        "applicant_id",
        F.when(F.col("applicant_id").isNull(), F.lit("N/A"))
         .when(F.col("applicant_id") == F.col("primary_applicant_id"), F.lit("Primary"))
         .when(F.col("applicant_id") == F.col("secondary_applicant_id"), F.lit("Secondary"))
         .alias("primary_or_secondary_applicant"),
        ssn, *[applicant(c) for c in APPLICANT_COLUMNS[1:]],
        (F.coalesce(_a(a, "monthly_income_amount"), F.lit(0))
         + F.coalesce(_a(a, "second_income_amount"), F.lit(0))).alias("monthly_income"),
        *[applicant(c) for c in APPLICANT_COLUMNS_2],
        F.coalesce(_a(a, "number_occupants_over_eighteen"), F.lit(0))
         .alias("number_occupants_over_eighteen"),
        *[applicant(c) for c in APPLICANT_COLUMNS_3],
        F.when((atype == "") | atype.like("%paper%"), F.lit("General"))
         .when(atype.like("%voice%"), F.lit("VA")).when(atype.like("%kiosk%"), F.lit("Kiosk"))
         .otherwise(F.lit("N/A")).alias("approval_type"),
        F.when(keep_stored, unit_name).otherwise(T.word_after(reason, "unit ")).alias("application_unit"),
        F.when(keep_stored, bld_name).otherwise(T.word_after(reason, "building ")).alias("application_building"),
        F.when(keep_stored, unit_name).otherwise(T.word_after(first_reason, "unit "))
         .alias("first_application_unit"),
        F.when(keep_stored, bld_name).otherwise(T.word_after(first_reason, "building "))
         .alias("first_application_building"),
        "application_submitted_on", ad["created_at"].alias("application_processed_on"),
        ad["underwriting_model_id"].alias("underwriting_model_id"),
        "error_count", "pending_count", "run_count", ad["decision"].alias("decision"),
        ad["score"].alias("score"), "application_id",
        F.coalesce("lp_tier", ad["tier"]).alias("tier"),
        F.coalesce("lp_amount", ad["amount"]).alias("max_rent"),
        (F.coalesce("lp_move_in_fee", ad["move_in_fee"]) if coalesce_fee
         else F.when(F.col("lp_move_in_fee").isNull(), ad["move_in_fee"])).alias("move_in_fee"),
        F.coalesce(F.col("_clv"), _a(a, "clv")).alias("clv_score"),
        *[F.col(c) for c in ("ev_count_total", "ev_count_0_1", "ev_count_1_3", "ev_count_3_5",
                             "ev_count_5_10", "ev_count_10_plus", "fel_count_total",
                             "fel_count_0_3", "fel_count_3_5", "fel_count_5_10",
                             "fel_count_10_plus", "misd_count_total", "misd_count_0_2",
                             "misd_count_2_plus", "so_count")],
        T.yes_no(F.col("_app_found")
                 & (T.char_after(F.col("_hash"), MANUAL_ENTRY_KEY) == '"')).alias("manual_entry"),
    ]
    return x.select(*cols)


def _a(a: DataFrame, c: str) -> Column:
    return F.col(f"a_{c}") if f"a_{c}" in a.columns else F.lit(None)


def _px(x: DataFrame, c: str) -> Column:
    return F.col(c) if c in x.columns else F.lit(None).cast("string")
