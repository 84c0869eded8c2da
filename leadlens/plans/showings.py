"""Showing -> application attribution (PIPE8).

Showings are grouped by identity, start time and unit; each group is
attributed the earliest application among the applicants whose identity
matches by the containment rule (cosigned application first, else the
applicant's own first application). Flags then compare the showing with
that application's creation time:

* ``app_in_before_showing``  showing created before application + 60 days
* ``received_app_at_showing`` state showing_set and application strictly
  within one hour of the start
* ``received_app_within_8_hrs`` strictly between +1 h and +8 h
* ``last_showing`` / ``last_showing_to_convert`` newest showing_set of the
  prospect, and that with at least one lease signing set.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.functions import dates as D
from leadlens.functions import text as T
from leadlens.operators import match as M

Tables = Mapping[str, DataFrame]
PHONES = ["mobile_phone", "home_phone", "work_phone"]
NAMES = ["first_name_clean", "last_name_clean"]
# Test and placeholder accounts are dropped by these name patterns.
EXCLUDED_FIRST_PREFIX = "urist"
EXCLUDED_INFIX = "test"
APP_WINDOW = "60 days"


def showing_customers(t: Tables) -> DataFrame:
    """The showing query's customers CTE (raw phones in ``combined``)."""
    c = t["customers"]
    fn, ln = F.lower("first_name"), F.lower("last_name")
    keep = (~fn.startswith(EXCLUDED_FIRST_PREFIX) & ~fn.contains(EXCLUDED_INFIX)
            & ~ln.contains(EXCLUDED_INFIX) & T.not_blank("first_name") & T.not_blank("last_name"))
    return c.filter(keep).select(
        T.clean_name("first_name").alias("first_name_clean"),
        T.clean_name("last_name").alias("last_name_clean"),
        T.combine_phones("mobile_phone", "work_phone", "home_phone", strip=False).alias("combined"),
        "*")


def applicant_applications(t: Tables, cust: DataFrame) -> DataFrame:
    """Per applicant: identity and attributed application (cosigner first)."""
    first = t["applicants_applications"].groupBy("applicant_id") \
        .agg(F.min("application_id").alias("first_app"))
    apps = t["applications"].select(F.col("id").alias("first_app"), F.lit(True).alias("_found"))
    cos = t["applications_cosigners"].select(
        "applicant_id", F.col("application_id").alias("cosigned_app"), F.lit(True).alias("_cos"))
    a = t["applicants"].select(F.col("id").alias("applicant_id"), "customer_id", "applicant_type")
    ident = cust.select(F.col("id").alias("customer_id"), *NAMES, "combined", *PHONES)
    j = (a.join(ident, "customer_id", "left").join(first, "applicant_id", "left")
          .join(apps, "first_app", "left").join(cos, "applicant_id", "left")
          .filter(F.col("first_app").isNotNull() | F.col("_cos").isNotNull()))
    return j.select(*NAMES, "combined", *PHONES, "applicant_id", "applicant_type",
                    F.when(F.col("_cos").isNotNull(), F.col("cosigned_app"))
                     .when(F.col("_found").isNotNull(), F.col("first_app"))
                     .alias("application_id"))


def showing_attribution(t: Tables, *, blocked: bool = True) -> DataFrame:
    """PIPE8: one row per grouped showing (x applicants of the customer)."""
    cust = showing_customers(t)
    sh = t["showings"]
    pr = t["prospects"].select(F.col("id").alias("prospect_id"), "customer_id")
    ident = cust.select(F.col("id").alias("customer_id"), *NAMES, "combined", *PHONES)
    rows = (sh.select(F.col("id").alias("showing_id"), "prospect_id", "start_time", "unit_id")
              .join(pr, "prospect_id", "left").join(ident, "customer_id", "inner"))
    la = applicant_applications(t, cust).select(*NAMES, "combined", *PHONES, "application_id")
    # Only the smallest matched application id per showing group is used, and
    # the match depends on the customer identity only: compute that minimum
    # once per distinct identity, without materialising matching pairs.
    spec = dict(on=NAMES, left_phones=PHONES, left_combined="combined")
    if blocked:
        idents = ident.select(M.identity_key(**spec).alias("_lk"), *NAMES, "combined", *PHONES) \
                      .dropDuplicates(["_lk"])
        hits = M.containment_min(idents, la, **spec, left_id="_lk", right_phones=PHONES,
                                 right_combined="combined", value="application_id",
                                 out="la_application_id")
    else:
        hits = M.identity_matches(ident, la, **spec, right_id=None, right_phones=PHONES,
                                  right_combined="combined", how="inner", blocked=False,
                                  right_prefix="la_")
    matched = rows.withColumn("_lk", M.identity_key(**spec)).join(hits, "_lk", "left")
    grouped = matched.groupBy(*NAMES, "combined", "start_time", "unit_id").agg(
        F.max("showing_id").alias("showing_id"),
        F.min("la_application_id").alias("application_id"))

    full = sh.select(F.col("id").alias("showing_id"), "prospect_id", "unit_id",
                     F.col("created_at").alias("showing_set_on"),
                     F.col("start_time").alias("showing_date"),
                     F.col("showable_state").alias("showing_status"),
                     F.col("name").alias("leasing_agent"),
                     "showable_canceled_by", "showable_canceled_reason")
    cust_cols = cust.select(F.col("id").alias("customer_id"), "first_name", "last_name",
                            *PHONES, "combined", "email", "pw_id")
    units = t["units"].select(F.col("id").alias("unit_id"), F.col("name").alias("unit_name"),
                              "building_id")
    blds = t["buildings"].select(F.col("id").alias("building_id"),
                                 F.col("name").alias("building_name"))
    apps = t["applications"].select(F.col("id").alias("application_id"),
                                    F.col("created_at").alias("first_app_submitted_at"),
                                    "app_state", F.lit(True).alias("_app_row"))
    applicants = t["applicants"].select("customer_id")  # row multiplier (bag parity)
    last = sh.filter(F.col("showable_state") == "showing_set").groupBy("prospect_id") \
             .agg(F.max("id").alias("showing_id")).select("showing_id", F.lit(True).alias("_last"))
    signed = t["lease_signings"].filter(F.col("showable_state") == "lease_signing_set") \
        .groupBy("prospect_id").agg(F.count(F.lit(1)).alias("count_of"))
    occ = t["applications_occupants"].select("customer_id").distinct()

    j = (grouped.select("showing_id", "application_id")
         .join(full, "showing_id", "left")
         .join(pr, "prospect_id", "left")
         .join(cust_cols, "customer_id", "left")
         .join(occ, "customer_id", "left_anti")
         .join(units, "unit_id", "left").join(blds, "building_id", "left")
         .join(apps, "application_id", "left")
         .join(applicants, "customer_id", "left")
         .join(last, "showing_id", "left")
         .join(signed, "prospect_id", "left")
         .filter((F.col("leasing_agent") != "") & F.col("showing_date").isNotNull()))
    has_app = F.col("application_id").isNotNull()
    is_set = F.col("showing_status") == "showing_set"
    at, start = F.col("first_app_submitted_at"), F.col("showing_date")
    return j.select(
        "customer_id", "application_id", "showing_set_on", "first_app_submitted_at",
        "first_name", "last_name", "mobile_phone", "home_phone", "work_phone", "combined",
        "email", "pw_id", "showing_date", "showing_status", "leasing_agent", "building_name",
        "unit_name", "showable_canceled_by", "showable_canceled_reason",
        F.when(~has_app, F.lit("no app")).when(F.col("app_state").isNull(), F.lit("Paper"))
         .otherwise(F.lit("kiosk")).alias("applicant_type"),
        T.yes_no(has_app & (F.col("showing_set_on") < D.shift(at, APP_WINDOW)))
         .alias("app_in_before_showing"),
        T.yes_no(has_app & is_set & D.strictly_within(at, start, "-1 hour", "1 hour"))
         .alias("received_app_at_showing"),
        T.yes_no(has_app & is_set & D.strictly_within(at, start, "1 hour", "8 hours"))
         .alias("received_app_within_8_hrs"),
        T.yes_no(F.col("_last")).alias("last_showing"),
        T.yes_no(F.col("_last") & is_set & (F.col("count_of") > 0)).alias("last_showing_to_convert"))
