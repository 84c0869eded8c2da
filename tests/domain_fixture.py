"""Hand-made operational tables (<= 10 rows each) for the composite plans."""

import datetime as dt

T0 = dt.datetime(2014, 1, 2, 10, 0, 0)


def ts(days=0, hours=0, minutes=0):
    return T0 + dt.timedelta(days=days, hours=hours, minutes=minutes)


def tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    customers = df([
        (1, 101, "Ann;", "Lee", None, "(312) 555-0001", None, "ann@x", dt.date(1990, 1, 1), dt.datetime(2013, 5, 1)),
        (2, 102, "ann", "lee", None, "(312) 555-0001", None, "ann2@x", None, dt.datetime(2013, 6, 1)),
        (3, 103, "ann", "lee", None, "(312) 555-0001", None, "ann3@x", None, dt.datetime(2013, 7, 1)),
        (4, 104, "Bob", "Stone", "312 555 0003", "312-555-0002", None, "bob@x", None, dt.datetime(2013, 3, 1)),
        (5, 105, "Cara", "Diaz", None, "3125550004", None, "c@x", None, dt.datetime(2012, 12, 1)),
        (6, 106, "Dan", "Fox", None, "3125550005", "3125550006", "dan@x", None, dt.datetime(2014, 1, 1)),
        (7, 107, "Urist", "Test", None, "3125550007", None, "u@x", None, dt.datetime(2014, 1, 1)),
        (8, 108, "", "Nobody", None, "3125550008", None, "n@x", None, dt.datetime(2014, 1, 1)),
    ], "id long, pw_id long, first_name string, last_name string, home_phone string, "
       "mobile_phone string, work_phone string, email string, dob date, created_at timestamp")
    promos = df([(1, "ML-A", "master lead"), (2, "ML-B", "master lead"), (3, "MK-1", "marketing"),
                 (4, "MK-2", "marketing"), (5, "desktop", "lead_source")],
                "id long, name string, promo_type string")
    customers_promos = df([(1, 1), (1, 2), (1, 3), (1, 4), (6, 5)], "customer_id long, promo_id long")
    prospects = df([
        (11, 1, 501, "{}", "U1", "B1", ts(-3), "none"),
        (12, 2, 501, None, "U1", "B1", ts(-3), "none"),
        (16, 6, 502, "[x]", "U2", "B2", ts(-2), "voucher"),
        (17, 6, 502, "[x]", "U2", "B2", ts(-1), "voucher"),   # newer prospect of 6 wins
    ], "id long, customer_id long, desired_unit long, desired_history string, unit_name string, "
       "building_name string, updated_at timestamp, subsidy_type string")
    applicants = df([
        (21, 2, 12, ts(-5), 1.5, "111", "paper form", False, 1000.0, None, None),
        (26, 6, 17, ts(1), 2.5, "666", "Kiosk", False, 2000.0, 500.0, 2),
        (27, 6, 17, ts(2), 3.5, "667", "Voice", False, 100.0, None, None),  # latest applicant of 6
    ], "id long, customer_id long, prospect_id long, created_at timestamp, clv double, "
       "ssn_itin string, applicant_type string, has_permanent_subsidy boolean, "
       "monthly_income_amount double, second_income_amount double, "
       "number_occupants_over_eighteen int")
    applicants_applications = df([(21, 31), (26, 36), (27, 36), (27, 37)],
                                 "applicant_id long, application_id long")
    applications = df([(31, ts(-5), None, "done"),
                       (36, ts(1), '{"evictions_0_to_1_years":"2"}', "done"),
                       (37, ts(3), '{"evictions_0_to_1_years":2}', None)],
                      "id long, created_at timestamp, cached_rendered_hash string, app_state string")
    applications_cosigners = df([(27, 36)], "applicant_id long, application_id long")
    applications_occupants = df([(4, 36)], "customer_id long, application_id long")
    approvals = df([
        (41, 31, 1, "Approved", "underwritten", "unit 1A building B1", 700.0, "T1", 900.0, 50.0, ts(-4)),
        (42, 37, 1, "Error", "failed", None, None, "T2", 800.0, 40.0, ts(3)),
        (43, 37, 2, "Approved - Pending Manager", "underwritten", "granted unit 7C building B7 ok", 710.0, "T3", 1200.0, 60.0, ts(4)),
        (44, 36, 1, "Approved", "underwritten", "unit 2B building B2", 650.0, "T4", 1000.0, 30.0, ts(2)),
    ], "id long, application_id long, underwriting_model_id long, decision string, "
       "process_state string, approved_for_unit_reason string, score double, tier string, "
       "amount double, move_in_fee double, created_at timestamp")
    legacy = df([(43, "LT", None, 99.0)], "approval_id long, tier string, amount double, move_in_fee double")
    units = df([(501, 601, "U-1", 1000.0), (502, 602, "U-2", 1100.0), (503, 602, "U-3", 900.0)],
               "id long, building_id long, name string, target_rent double")
    buildings = df([(601, "Bld-1"), (602, "Bld-2")], "id long, name string")
    showings = df([
        (51, 17, 502, ts(0), ts(-1), "showing_set", "agent1", None, None),
        (52, 17, 503, ts(0, 5), ts(-1), "cancelled", "agent2", "me", "sick"),
        (53, 17, 502, ts(200), ts(-1), "showing_set", "agent3", None, None),
        (54, 12, 501, ts(-6), ts(-7), "missed", "", None, None),
    ], "id long, prospect_id long, unit_id long, start_time timestamp, created_at timestamp, "
       "showable_state string, name string, showable_canceled_by string, showable_canceled_reason string")
    activities = df([(51, "showing", "created_showing", "sam"), (51, "showing", "created_showing", "kim"),
                     (52, "showing", "updated", "x")],
                    "record_id long, record_type string, action string, user string")
    lease_signings = df([(61, 17, 502, "lease_signing_set", ts(5), ts(4)),
                         (62, 17, 503, "cancelled", ts(6), ts(4, 1))],
                        "id long, prospect_id long, unit_id long, showable_state string, "
                        "start_time timestamp, created_at timestamp")
    subscriptions = df([(26, 71, "Applicant", "ThirdParty::LexisNexisReport"),
                        (27, 72, "Applicant", "ThirdParty::LexisNexisReport"),
                        (27, 73, "Applicant", "ThirdParty::LexisNexisReport"),
                        (27, 81, "Applicant", "ThirdParty::CLVReport")],
                       "subscriber_id long, third_party_id long, subscriber_type string, third_party_type string")
    clv_reports = df([(81, 9.5)], "id long, clv double")
    reports = df([(72, "complete", "EV", ts(0), ts(0)), (73, "complete", "CM", ts(0), ts(0)),
                  (71, "complete", "EV", ts(-9), ts(-9))],
                 "id long, status string, report_type string, created_at timestamp, updated_at timestamp")
    d0 = dt.date(2014, 1, 2)

    def back(days):
        return d0 - dt.timedelta(days=days)
    items = df([
        (72, "eviction", back(365), ts(0)),        # exactly 1.0 year -> 0_1
        (72, "eviction", back(365 * 3), ts(0)),    # exactly 3.0 -> 1_3
        (72, "eviction", back(365 * 11), ts(0)),   # 10_plus
        (72, "eviction", None, ts(0)),             # NULL date: total only
        (73, "felony", back(365 * 4), ts(0)),      # 3_5
        (73, "misdemeanor", back(100), ts(0)),     # 0_2
        (73, "sex offense", back(100), ts(0)),
    ], "lexis_nexis_report_id long, item_type string, date date, created_at timestamp")
    return {
        "customers": customers, "promos": promos, "customers_promos": customers_promos,
        "prospects": prospects, "applicants": applicants,
        "applicants_applications": applicants_applications, "applications": applications,
        "applications_cosigners": applications_cosigners,
        "applications_occupants": applications_occupants, "approvals": approvals,
        "legacy_process_approval_reports": legacy, "units": units, "buildings": buildings,
        "showings": showings, "activities": activities, "lease_signings": lease_signings,
        "subscriptions": subscriptions, "clv_reports": clv_reports,
        "lexis_nexis_reports": reports, "lexis_nexis_items": items,
    }
