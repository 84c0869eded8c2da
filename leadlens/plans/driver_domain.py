"""The operational tables of the funnel, derived from the driver tables.

Lets the composite plans (PIPE1-PIPE6 prospect master, PIPE8 showing
attribution) run over whole driver tables at any scale. Every table below is
a projection or filter of a driver table, so its size grows with the data:

  customers                                       <- customer (every 13th twice)
  prospects, clv_reports                          <- customer (one each)
  applicants                                      <- customer (some of those twice)
  promos / customers_promos                       <- orders by priority
  applications, applicants_applications,
  applications_cosigners, approvals, legacy ...   <- orders
  lexis_nexis_reports / subscriptions             <- orders (F = EV, O = CM)
  lexis_nexis_items                               <- lineitem
  units / buildings                               <- part / supplier
  showings, activities, lease_signings            <- events (view, click, signup)
  applications_occupants                          <- customer (every 17th)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.plans.prospects import (APPLICANT_COLUMNS, APPLICANT_COLUMNS_2, APPLICANT_COLUMNS_3,
                                      PROSPECT_COLUMNS)

# Columns of the contract that no driver column stands for: derived from keys.
PROSPECT_FILLED = [c for c in PROSPECT_COLUMNS
                   if c not in ("desired_beds", "building_name", "unit_name", "desired_history")]
APPLICANT_FILLED = [*APPLICANT_COLUMNS[1:], *[c for c in APPLICANT_COLUMNS_2 if c != "has_permanent_subsidy"],
                    *APPLICANT_COLUMNS_3]

# The oracle SQL there reads the two lists above while this module is being imported.
from leadlens.plans.synthetic import AGAIN, LEASE_SHIFT_DAYS, people, report_items, table  # noqa: E402

# parts, suppliers and events stay in these proportions at every scale factor
EVENTS_PER_UNIT = 5
UNITS_PER_BUILDING = 20


def filled(key: Column, columns: list[str]) -> list[Column]:
    """A text for each column, another for (almost) each row, null in every tenth."""
    return [F.when((key + j) % 10 != 0, F.concat(F.lit(f"{c}-"), ((key * 7 + j) % 97).cast("string"))).alias(c)
            for j, c in enumerate(columns)]


def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``people`` as they registered: some without a first name, some under
    names that the showing query leaves out, and every 13th a second time."""
    k = F.col("id")
    p = people(spark, sf_dir).withColumns({
        "first_name": F.when(k % 37 == 0, F.lit("")).when(k % 29 == 0, F.concat(F.lit("Urist"), "first_name"))
                       .otherwise(F.col("first_name")),
        "last_name": F.when(k % 31 == 0, F.concat("last_name", F.lit(" Latest"))).otherwise(F.col("last_name"))})
    again = p.where(k % 13 == 0).withColumns({
        "id": k + AGAIN,
        "created_at": F.timestamp_add("DAY", F.when(k % 3 == 0, F.lit(-3)).otherwise(F.lit(3)), F.col("created_at"))})
    return p.unionByName(again)


def _shift(c, days: int = LEASE_SHIFT_DAYS):
    return F.timestamp_add("DAY", F.lit(days), F.col(c))


def domain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    everyone = registered(spark, sf_dir)
    p = people(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    e = table(spark, sf_dir, "events")
    k = F.col("id")

    customers = everyone.select(
        "id", (k + 100000).alias("pw_id"), "first_name", "last_name", "home_phone",
        "mobile_phone", "work_phone", "email",
        F.date_add(F.lit("1970-01-01").cast("date"), (k % 15000).cast("int")).alias("dob"),
        "created_at")

    ok, pri = F.col("o_orderkey"), F.col("o_orderpriority")
    promo_type = (F.when(pri == "1-URGENT", F.lit("master lead"))
                   .when(pri == "2-HIGH", F.lit("marketing"))
                   .when(pri == "5-LOW", F.lit("lead_source")))
    pr = o.select(ok.alias("id"), F.col("o_custkey").alias("customer_id"),
                  F.concat(F.lit("P"), F.col("o_orderstatus"), (ok % 7).cast("string")).alias("name"),
                  promo_type.alias("promo_type")).filter(F.col("promo_type").isNotNull())
    promos = pr.select("id", "name", "promo_type")
    customers_promos = pr.select("customer_id", F.col("id").alias("promo_id"))

    prospects = p.select(
        k.alias("id"), k.alias("customer_id"), k.alias("desired_unit"),
        F.when(k % 5 == 0, F.lit("{}")).otherwise(F.lit("[]")).alias("desired_history"),
        F.concat(F.lit("U"), F.floor(k / 3).cast("string")).alias("unit_name"),
        F.concat(F.lit("B"), F.floor(k / 15).cast("string")).alias("building_name"),
        (k % 4).alias("desired_beds"), F.timestamp_add("DAY", F.lit(1), F.col("created_at")).alias("updated_at"),
        F.when(k % 4 == 0, F.lit("S8")).alias("subsidy_type"))
    older = p.filter(k % 3 == 0).select(
        (k + 1_000_000_000).alias("id"), k.alias("customer_id"), k.alias("desired_unit"),
        F.lit(None).cast("string").alias("desired_history"), F.lit("U0").alias("unit_name"),
        F.lit("B0").alias("building_name"), F.lit(1).cast("long").alias("desired_beds"),
        F.col("created_at").alias("updated_at"), F.lit(None).cast("string").alias("subsidy_type"))
    prospects = prospects.unionByName(older).select("*", *filled(k, PROSPECT_FILLED))

    ck = F.col("c_custkey")
    applicants = c.filter(F.col("c_acctbal") < 5000).join(
        p.select(F.col("id").alias("c_custkey"), "created_at"), "c_custkey").select(
        ck.alias("id"), ck.alias("customer_id"), ck.alias("prospect_id"),
        F.timestamp_add("DAY", (ck % 30).cast("int"), F.col("created_at")).alias("created_at"),
        (F.col("c_acctbal") / 100).alias("clv"), F.lpad(ck.cast("string"), 9, "0").alias("ssn_itin"),
        F.when(ck % 3 == 0, F.lit("Kiosk")).when(ck % 3 == 1, F.lit("paper form"))
         .otherwise(F.lit("voice")).alias("applicant_type"),
        (ck % 11 == 0).alias("has_permanent_subsidy"),
        F.col("c_acctbal").alias("monthly_income_amount"),
        F.when(ck % 4 == 0, F.col("c_acctbal") / 10).alias("second_income_amount"),
        (ck % 3).cast("int").alias("number_occupants_over_eighteen"), *filled(ck, APPLICANT_FILLED))
    applicants = applicants.unionByName(applicants.where(k % 26 == 0).withColumns({
        "id": k + AGAIN, "customer_id": F.col("customer_id") + AGAIN, "prospect_id": F.lit(None).cast("long")}))

    apps_o = o.filter(pri == "4-NOT SPECIFIED")
    applications = apps_o.select(
        ok.alias("id"), _shift("o_orderdate").alias("created_at"),
        F.when(ok % 3 == 0, F.lit('{"evictions_0_to_1_years":"1"}'))
         .otherwise(F.lit('{"evictions_0_to_1_years":1}')).alias("cached_rendered_hash"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.lit("done")).alias("app_state"))
    app_ids = applicants.select(F.col("id").alias("applicant_id"))
    own = apps_o.select(F.col("o_custkey").alias("applicant_id"), ok.alias("application_id"))
    co = apps_o.filter(ok % 7 == 0).select(
        F.col("o_custkey").bitwiseXOR(F.lit(1)).alias("applicant_id"), ok.alias("application_id"))
    second = apps_o.filter(F.col("o_custkey") % 26 == 0).select(
        (F.col("o_custkey") + AGAIN).alias("applicant_id"), ok.alias("application_id"))
    applicants_applications = own.unionByName(co).unionByName(second).join(app_ids, "applicant_id", "left_semi")
    applications_cosigners = applicants_applications.filter(F.col("application_id") % 11 == 0)
    applications_occupants = c.filter(ck % 17 == 0).select(
        ck.alias("customer_id"), ck.alias("application_id"))

    def approval(id_col, offset_days):
        return apps_o.filter(F.col("o_orderstatus").isin("F", "P")).select(
            id_col.alias("id"), ok.alias("application_id"), (ok % 3).alias("underwriting_model_id"),
            F.when(ok % 4 == 0, F.lit("Approved")).when(ok % 4 == 1, F.lit("Approved - Pending Manager"))
             .when(ok % 4 == 2, F.lit("Error")).otherwise(F.lit("Denied")).alias("decision"),
            F.when(ok % 3 == 0, F.lit("failed")).otherwise(F.lit("underwritten")).alias("process_state"),
            F.concat(F.lit("approved for unit "), (ok % 40).cast("string"), F.lit("A building B"),
                     (ok % 9).cast("string"), F.lit(" ok")).alias("approved_for_unit_reason"),
            (F.col("o_totalprice") / 1000).alias("score"),
            F.concat(F.lit("T"), (ok % 4).cast("string")).alias("tier"),
            (F.col("o_totalprice") / 100).alias("amount"),
            (F.col("o_totalprice") / 1000).alias("move_in_fee"),
            _shift("o_orderdate", LEASE_SHIFT_DAYS + offset_days).alias("created_at"))
    approvals = approval(ok * 2, 1).unionByName(
        approval(ok * 2 + 1, 2).filter(F.col("application_id") % 5 == 0))
    legacy = approvals.filter(F.col("id") % 8 == 0).select(
        F.col("id").alias("approval_id"), F.lit("LT").alias("tier"),
        F.when(F.col("id") % 16 == 0, F.lit(None)).otherwise(F.col("amount") * 0.9).alias("amount"),
        F.lit(99.0).alias("move_in_fee"))

    reports = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        ok.alias("id"),
        F.when(ok % 10 == 0, F.lit("pending")).otherwise(F.lit("complete")).alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("EV")).otherwise(F.lit("CM")).alias("report_type"),
        _shift("o_orderdate").alias("created_at"), _shift("o_orderdate", LEASE_SHIFT_DAYS + 1).alias("updated_at"))
    subs_ln = o.filter(F.col("o_orderstatus").isin("F", "O")).select(
        F.col("o_custkey").alias("subscriber_id"), ok.alias("third_party_id"),
        F.lit("Applicant").alias("subscriber_type"),
        F.lit("ThirdParty::LexisNexisReport").alias("third_party_type"))
    subs_clv = c.filter(ck % 2 == 0).select(
        ck.alias("subscriber_id"), ck.alias("third_party_id"), F.lit("Applicant").alias("subscriber_type"),
        F.lit("ThirdParty::CLVReport").alias("third_party_type"))
    clv_reports = c.select(ck.alias("id"), (F.col("c_acctbal") / 1000).alias("clv"))
    items = report_items(spark, sf_dir).select(
        F.col("report_id").alias("lexis_nexis_report_id"), "item_type",
        F.to_date("date").alias("date"), "created_at")

    part = table(spark, sf_dir, "part")
    units = part.select(F.col("p_partkey").alias("id"), F.floor(F.col("p_partkey") / UNITS_PER_BUILDING).alias("building_id"),
                        F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string")).alias("name"),
                        F.col("p_retailprice").alias("target_rent"))
    buildings = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("Bld-"), F.col("s_suppkey").cast("string")).alias("name"))

    ek, et = F.col("event_id"), F.col("event_type")
    showings = e.filter(et == "view").select(
        ek.alias("id"), F.col("user_id").alias("prospect_id"), F.floor(ek / EVENTS_PER_UNIT).alias("unit_id"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("HOUR", -(ek % 72).cast("int"), F.col("ts")).alias("created_at"),
        F.when(ek % 5 == 0, F.lit("cancelled")).when(ek % 5 == 1, F.lit("rescheduled"))
         .when(ek % 5 == 2, F.lit("missed")).otherwise(F.lit("showing_set")).alias("showable_state"),
        F.when(ek % 23 == 0, F.lit("")).otherwise(F.concat(F.lit("agent"), (ek % 9).cast("string"))).alias("name"),
        F.when(ek % 5 == 0, F.lit("prospect")).alias("showable_canceled_by"),
        F.when(ek % 5 == 0, F.lit("schedule")).alias("showable_canceled_reason"))
    activities = e.filter(et == "click").select(
        (ek - 1).alias("record_id"), F.lit("showing").alias("record_type"),
        F.when(ek % 4 == 0, F.lit("updated")).otherwise(F.lit("created_showing")).alias("action"),
        F.concat(F.lit("u"), (ek % 13).cast("string")).alias("user"))
    lease_signings = e.filter(et == "signup").select(
        ek.alias("id"), F.col("user_id").alias("prospect_id"), F.floor(ek / EVENTS_PER_UNIT).alias("unit_id"),
        F.when(ek % 3 == 0, F.lit("cancelled")).otherwise(F.lit("lease_signing_set")).alias("showable_state"),
        F.col("ts").alias("start_time"), F.timestamp_add("DAY", F.lit(-1), F.col("ts")).alias("created_at"))

    return {
        "customers": customers, "promos": promos, "customers_promos": customers_promos,
        "prospects": prospects, "applicants": applicants,
        "applicants_applications": applicants_applications, "applications": applications,
        "applications_cosigners": applications_cosigners,
        "applications_occupants": applications_occupants, "approvals": approvals,
        "legacy_process_approval_reports": legacy, "units": units, "buildings": buildings,
        "showings": showings, "activities": activities, "lease_signings": lease_signings,
        "subscriptions": subs_ln.unionByName(subs_clv), "clv_reports": clv_reports,
        "lexis_nexis_reports": reports, "lexis_nexis_items": items,
    }
