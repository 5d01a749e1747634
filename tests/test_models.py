"""Models, metrics, report and quality rules on hand-made rows that hold every fault."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kerbside.plans import anomalies, metrics, quality, report
from kerbside.plans.models import Models, stage, valid_amounts
from kerbside.schemas import RAW_COLUMNS, raw_schema
from kerbside.sources import raw as raw_source
from kerbside.sources.facts import FactTable
from kerbside.sources.sinks import export_closed_months, export_csv, pii_columns, restricted

DEFAULTS = {
    "partners": dict(partner_id="P1", partner_name="One", country=" br", tier=None, status="Active ", commission_rate=0.1, created_at="2020-01-01 00:00:00", updated_at=None, contact_email=" A@B.com"),
    "sessions": dict(session_id="s1", user_id="u1", started_at="2024-01-05 10:00:00", ended_at="2024-01-05 11:00:00", channel="Direct", device=" Mobile", country="br ", page_views=3, utm_source=None, utm_campaign=None, is_bot=False),
    "searches": dict(search_id="q1", session_id="s1", searched_at="2024-01-05 10:01:00", pickup_location=" A", dropoff_location="B", pickup_date="2024-02-01", dropoff_date="2024-02-03", car_category="SUV", num_results=3, partner_id_clicked=None, price_shown=1.5),
    "bookings": dict(booking_id="b1", session_id="s1", user_id="u1", partner_id="P1", booked_at="2024-01-05 10:30:00", pickup_date="2024-02-01", dropoff_date="2024-02-03", pickup_location="A", car_category="SUV ", daily_rate=10.0, total_amount=100.0, currency=" brl", status="Confirmed", payment_method="pix"),
    "cancellations": dict(cancellation_id="c1", booking_id="b1", cancelled_at="2024-01-06 00:00:00", reason="r", cancelled_by="user", refund_amount=50.0, refund_status="done", days_before_pickup=10),
}


def frame(spark, table, *changes):
    names = [n for n, _, _ in RAW_COLUMNS[table]]
    data = [tuple({**DEFAULTS[table], **c}[n] for n in names) for c in changes]
    return spark.createDataFrame(data, raw_schema(table))


def models(spark, **tables):
    filled = {t: frame(spark, t, *tables.get(t, [{}])) for t in DEFAULTS}
    return Models(filled)


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_staging_cleans_without_dropping(spark):
    row = models(spark)["stg_partners"].first()
    assert (row["country"], row["status"], row["contact_email"], row["updated_at"]) == ("BR", "active", "a@b.com", None)
    assert row["created_at"] == datetime(2020, 1, 1)
    assert stage(frame(spark, "bookings", {}, {}), "bookings").count() == 2


def test_partner_fallback_to_creation_time(spark):
    m = models(
        spark,
        partners=[
            dict(partner_name="old", created_at="2020-01-01 00:00:00", updated_at="2021-01-01 00:00:00"),
            dict(partner_name="new", created_at="2022-01-01 00:00:00", updated_at=None),
        ],
    )
    assert m["dim_partners"].first()["partner_name"] == "new"


def test_bots_are_left_out_before_the_latest_is_chosen(spark):
    m = models(
        spark,
        sessions=[
            dict(session_id="a", started_at="2024-01-01 00:00:00"),
            dict(session_id="a", started_at="2024-01-02 00:00:00", is_bot=True),
            dict(session_id="b", is_bot=None),
        ],
        searches=[dict(search_id="1", session_id="a"), dict(search_id="1", session_id="a"), dict(search_id="2", session_id="b"), dict(search_id="3", session_id=None)],
    )
    assert [(r["session_id"], r["started_at"].day) for r in m["int_sessions"].collect()] == [("a", 1)]
    assert ids(m["int_searches"], "search_id") == ["1"]


BOOKINGS = [
    dict(booking_id="ok"),
    dict(booking_id="zero", total_amount=0.0),
    dict(booking_id="null", total_amount=None),
    dict(booking_id="negative pending", total_amount=-5.0, status="pending"),
    dict(booking_id="null pending", total_amount=None, status="pending"),
    dict(booking_id="no status", status=None),
    dict(booking_id="no status, no amount", status=None, total_amount=None),
    dict(booking_id="inactive", partner_id="P2"),
    dict(booking_id="unknown partner", partner_id="P9"),
    dict(booking_id="went bad", booked_at="2024-01-05 00:00:00"),
    dict(booking_id="went bad", booked_at="2024-01-06 00:00:00", total_amount=0.0),
]
PARTNERS = [{}, {}, dict(partner_id="P2", status="inactive")]


def test_amount_rule_judges_the_latest_version(spark):
    m = models(spark, bookings=BOOKINGS, partners=PARTNERS)
    assert ids(m["int_bookings"], "booking_id") == ["negative pending", "no status", "null pending", "ok"]


def test_refund_rule(spark):
    m = models(
        spark,
        bookings=[dict(booking_id="b1"), dict(booking_id="b1"), dict(booking_id="b2", total_amount=None)],
        cancellations=[
            dict(cancellation_id="fits"),
            dict(cancellation_id="equal", refund_amount=100.0),
            dict(cancellation_id="over", refund_amount=100.01),
            dict(cancellation_id="no refund", refund_amount=None),
            dict(cancellation_id="no total", booking_id="b2", refund_amount=1.0),
            dict(cancellation_id="no total, no refund", booking_id="b2", refund_amount=None),
            dict(cancellation_id="no booking", booking_id="b3"),
            dict(cancellation_id="fits"),
        ],
    )
    assert ids(m["int_cancellations"], "cancellation_id") == ["equal", "fits", "no refund", "no total, no refund"]
    over = anomalies.refunds_over_total(m["stg_cancellations"], m["stg_bookings"]).collect()
    assert [(r["cancellation_id"], r["copies"]) for r in over] == [("over", 2)]


def test_users_without_a_session_have_no_first_sight(spark):
    m = models(spark, sessions=[{}, dict(session_id="s2", started_at="2024-01-01 00:00:00"), dict(session_id="s3", user_id=None)], bookings=[dict(user_id="u2"), dict(booking_id="b2", user_id=None)])
    got = {r["user_id"]: r["first_seen_at"] for r in m["dim_users"].collect()}
    assert got == {"u1": datetime(2024, 1, 1), "u2": None}


def test_funnel_counts_sessions_once_and_labels_blanks(spark):
    m = models(
        spark,
        sessions=[dict(session_id="a"), dict(session_id="b", country="  ", device=None), dict(session_id="c")],
        searches=[dict(search_id="1", session_id="a"), dict(search_id="2", session_id="a"), dict(search_id="3", session_id="c")],
        bookings=[dict(booking_id="1", session_id="a"), dict(booking_id="2", session_id="a"), dict(booking_id="3", session_id="c", status="pending"), dict(booking_id="4", session_id="gone")],
        cancellations=[dict(booking_id="1")],
    )
    inputs = [m[n] for n in ("int_sessions", "int_searches", "fct_bookings", "int_cancellations")]
    got = {(r["pais"], r["dispositivo"]): tuple(r)[2:] for r in metrics.funnel_by_segment(*inputs).collect()}
    assert got == {("BR", "mobile"): (2, 2, 2, 100.0, 100.0, 100.0), ("Não identificado", "Não identificado"): (1, 0, 0, 0.0, None, 0.0)}
    assert [tuple(r) for r in metrics.funnel_stages(*inputs).collect()] == [("Sessões", 1, 3), ("Buscas", 2, 2), ("Reservas", 3, 2)]
    strict = metrics.funnel_stages(*inputs, statuses=("confirmed",)).collect()
    assert strict[2]["valor"] == 1


def test_top_partners_window_ends_at_the_latest_booking_of_any_status(spark):
    m = models(
        spark,
        partners=[{}, dict(partner_id="P2", partner_name="Two")],
        bookings=[
            dict(booking_id="1", booked_at="2024-01-01 00:00:00"),
            dict(booking_id="2", booked_at="2024-03-01 00:00:00", partner_id="P2", currency="usd"),
            dict(booking_id="3", booked_at="2024-04-01 00:00:00", status="pending"),
        ],
        cancellations=[dict(booking_id="none")],
    )
    got = metrics.top_partners(m["fct_bookings"], m["int_cancellations"], m["dim_partners"]).collect()
    assert [(r["parceiro"], r["quantidade_reservas"], r["total_brl"], r["total_usd"]) for r in got] == [("Two", 1, 0.0, 100.0)]


def test_ltv_divides_by_everybody(spark):
    m = models(
        spark,
        sessions=[dict(session_id="1"), dict(session_id="2", user_id="u2"), dict(session_id="3", user_id="u3", started_at="2024-02-01 00:00:00")],
        bookings=[dict(booking_id="1"), dict(booking_id="2", user_id="u9")],
        cancellations=[dict(booking_id="none")],
    )
    got = [tuple(r)[:3] for r in metrics.ltv_cohort(m["fct_bookings"], m["int_cancellations"], m["dim_users"]).collect()]
    assert got == [("2024-01", 2, 50.0), ("2024-02", 1, 0.0)]


def test_cancellation_rate_may_exceed_a_hundred(spark):
    m = models(
        spark,
        bookings=[dict(booking_id="1"), dict(booking_id="2", status="pending")],
        cancellations=[dict(cancellation_id="1", booking_id="2"), dict(cancellation_id="2", booking_id="2"), dict(cancellation_id="3", booking_id="1")],
    )
    rate = metrics.cancellation_rates(m["fct_bookings"], m["int_cancellations"]).first()
    assert (rate["quantidade_reservas"], rate["quantidade_cancelamentos"], rate["taxa"]) == (1, 3, 300.0)
    same = metrics.cancellation_rates(m["fct_bookings"], m["int_cancellations"], same_population=True).first()
    assert same["taxa"] == 100.0


def test_a_dropped_refund_brings_its_booking_back(spark):
    m = models(spark, cancellations=[dict(refund_amount=500.0)])
    assert metrics.monthly_evolution(m["fct_bookings"], m["int_cancellations"]).first()["receita_brl"] == 100.0


def report_of(m):
    from kerbside.plans.models import active_bookings

    parts = report.monthly_parts(active_bookings(m["stg_bookings"], m["stg_partners"]), m["int_cancellations"])
    return parts, report.revenue_by_partner(parts, m["dim_partners"])


def test_contract_report(spark):
    m = models(
        spark,
        bookings=[
            dict(booking_id="1"),
            dict(booking_id="2", currency="usd", total_amount=7.5),
            dict(booking_id="3", total_amount=None),
            dict(booking_id="4", booked_at="2024-02-10 00:00:00", user_id="u5"),
            dict(booking_id="5", booked_at="2024-02-11 00:00:00", status="pending"),
            dict(booking_id="6", booked_at="2024-01-20 00:00:00"),
        ],
        cancellations=[dict(booking_id="6")],
    )
    parts, made = report_of(m)
    got = sorted(tuple(r)[2:] for r in report.check_contract(made).collect())
    assert [(str(a), b, float(c), *d) for a, b, c, *d in got] == [
        ("2024-01-01", "BRL", 100.0, 1, 1, 2, False),
        ("2024-01-01", "USD", 7.5, 1, 1, 2, False),
        ("2024-02-01", "BRL", 100.0, 1, 0, 0, True),
    ]
    index = {str(r["reference_month"]): (r["booking_count"], r["excluded_invalid_amount_count"], r["alert"]) for r in report.completeness_index(parts).collect()}
    assert index == {"2024-01-01": (2, 1, True), "2024-02-01": (1, 0, False)}
    change = metrics.revenue_change(made).filter("previous_amount is not null").collect()
    assert [(r["currency"], r["change_pct"]) for r in change] == [("BRL", 0.0)]


def test_a_foreign_currency_blocks_the_report(spark):
    m = models(spark, bookings=[dict(currency="EUR")], cancellations=[dict(booking_id="none")])
    _, made = report_of(m)
    with pytest.raises(report.ForeignCurrency):
        report.publishable(made)
    with pytest.raises(ValueError):
        report.check_contract(made.drop("currency"))


def test_net_revenue_counts_a_booking_once(spark):
    m = models(spark, cancellations=[dict(cancellation_id="1", refund_amount=30.0), dict(cancellation_id="2", refund_amount=20.0)])
    row = report.net_revenue(m["fct_bookings"], m["int_cancellations"]).first()
    assert (float(row["gross_amount"]), float(row["refund_amount"]), float(row["revenue_amount_net_of_refund"])) == (100.0, 50.0, 50.0)


def test_fx_takes_the_booking_day_or_the_month_close(spark):
    rates = spark.createDataFrame([("USD", date(2024, 1, 1), 5.0), ("USD", date(2024, 1, 20), 6.0)], "currency string, rate_date date, rate double")
    rates = rates.withColumn("rate", F.col("rate").cast("decimal(18,6)"))
    m = models(spark, bookings=[dict(currency="usd"), dict(booking_id="2", currency="COP")], cancellations=[dict(booking_id="none")])
    args = (m["fct_bookings"], m["int_cancellations"], rates)
    assert tuple(report.revenue_in_brl(*args).first())[1:] == (2, 500.0, 1)
    assert tuple(report.revenue_in_brl(*args, rate_date="month_close").first())[1:] == (2, 600.0, 1)


def test_burst_lists_every_staged_copy(spark):
    times = [f"2024-01-05 10:0{i}:00" for i in range(5)]
    m = models(
        spark,
        sessions=[{}, {}],
        searches=[dict(search_id=str(i), searched_at=t) for i, t in enumerate(times)],
    )
    got = anomalies.search_bursts(m["stg_searches"], m["stg_sessions"], threshold=4).collect()
    assert [(r["pico_buscas_5min"], r["status_deteccao"]) for r in got] == [(5, "escapou da flag is_bot")] * 2
    assert anomalies.search_bursts(m["stg_searches"], m["stg_sessions"], threshold=4, distinct=True).count() == 1
    assert anomalies.search_bursts(m["stg_searches"], m["stg_sessions"], threshold=5).count() == 0


def test_suite_size_and_severities():
    assert len(quality.SUITE) == 39
    layers = [sum(c.model.startswith(p) for c in quality.SUITE) for p in ("stg_", "int_", "dim_", "fct_")]
    assert layers == [16, 9, 6, 8]
    assert sum(c.severity == quality.WARN for c in quality.SUITE) == 12


def test_checks_count_rows_and_values(spark):
    m = models(
        spark,
        partners=[dict(commission_rate=0.31), dict(commission_rate=0.31)],
        searches=[dict(car_category="compact", partner_id_clicked="P9"), dict(search_id="2", car_category="Compact"), dict(search_id="3", car_category=None), dict(search_id="4", car_category="VAN", dropoff_date="2024-01-01")],
    )
    got = {(r["model"], r["check"], r["column"]): r for r in quality.run_suite(m).collect()}
    assert len(got) == 44
    category = got["stg_searches", "accepted_values", "car_category"]
    assert (category["failing_rows"], category["failing_values"], category["status"]) == (3, 2, "warn")
    copies = got["stg_partners", "unique", "partner_id"]
    assert (copies["failing_rows"], copies["failing_values"], copies["status"]) == (2, 1, "warn")
    assert got["dim_partners", "between", "commission_rate"]["status"] == "error"
    assert got["int_searches", "relationships", "partner_id_clicked"]["failing_rows"] == 1
    assert got["int_searches", "pair_greater", "dropoff_date"]["failing_rows"] == 1
    assert got["fct_bookings", "relationships", "user_id"]["status"] == "pass"


def test_trust_gate(spark):
    m = models(spark)
    as_of = F.lit("2024-01-05 12:00:00")
    fresh = quality.freshness(m["fct_bookings"], "booked_at", as_of)
    assert (fresh.first()["fresh"], fresh.first()["age_hours"]) == (True, 1.5)
    assert quality.freshness(m["fct_bookings"].limit(0), "booked_at", as_of).first()["fresh"] is False
    assert quality.freshness(m["fct_bookings"], "booked_at", F.lit("2024-01-06 10:30:01")).first()["fresh"] is False
    verdict = quality.trust_gate(quality.run_suite(m), quality.alert_limits(m), fresh).first()
    assert tuple(verdict) == (True, 0, 0, True)
    spoiled = models(spark, searches=[dict(num_results=0, partner_id_clicked="P1")])
    alerts = {r["finding"]: r["breached"] for r in quality.alert_limits(spoiled).collect() if r["segment"] is None}
    assert alerts["click_without_result"] is True and alerts["long_sessions"] is False


def test_null_rates_and_case_variants(spark):
    df = spark.createDataFrame([("BR", None), ("br ", 1), ("Br", 1), ("US", 1)], "c string, v int")
    rate = quality.null_rates(df, "t", {"v": 23.0}).first()
    assert (rate["null_pct"], rate["within_tolerance"]) == (25.0, True)
    assert quality.null_rates(df, "t", {"v": 20.0}).first()["within_tolerance"] is False
    assert [tuple(r)[2:] for r in quality.case_variants(df, "c", "t").collect()] == [("br", 3, 3)]


def test_personal_data_marks_follow_the_columns(spark):
    m = models(spark)
    assert pii_columns(m["dim_partners"]) == ["contact_email"]
    assert pii_columns(m["fct_bookings"]) == ["user_id"]
    assert "user_id" not in restricted(m["fct_sessions"], "drop").columns
    assert len(restricted(m["fct_sessions"]).first()["user_id"]) == 64


def test_csv_in_and_out(spark, tmp_path):
    path = tmp_path / "raw_partners.csv"
    path.write_text("partner_id,partner_name,country,tier,status,commission_rate,created_at,updated_at,contact_email\nP1,One,cl,,Active,0.18,2018-12-12 21:26:47,,\n")
    staged = stage(raw_source.read_csv(spark, str(path), "partners"), "partners").first()
    assert (staged["tier"], staged["commission_rate"], staged["updated_at"], staged["country"]) == (None, 0.18, None, "CL")
    export_csv(spark.range(1500), str(tmp_path / "out"), F.asc("id"))
    found = [line for p in sorted((tmp_path / "out").glob("*.csv")) for line in p.read_text().splitlines() if line != "id"]
    assert found == [str(i) for i in range(1500)]
    export_csv(spark.range(1500), str(tmp_path / "few"), F.asc("id"), cap=10)
    assert spark.read.csv(str(tmp_path / "few"), header=True).count() == 10


def test_month_close_leaves_the_open_month_out(spark, tmp_path):
    m = models(spark, bookings=[dict(booking_id="1"), dict(booking_id="2", booked_at="2024-02-01 00:00:00")], cancellations=[dict(booking_id="none")])
    export_closed_months(report_of(m)[1], str(tmp_path / "close"))
    assert [p.name for p in (tmp_path / "close").glob("reference_month=*")] == ["reference_month=2024-01-01"]


def test_models_can_be_written_read_and_queried(spark, tmp_path):
    m = models(spark)
    m.write(str(tmp_path), ("dim_partners", "fct_bookings"))
    tables = raw_source.read_tables(spark, str(tmp_path), ["dim_partners", "fct_bookings"])
    assert pii_columns(tables["dim_partners"]) == ["contact_email"]
    m.register_views(("fct_bookings", "dim_partners"))
    assert spark.sql("SELECT count(*) AS n FROM fct_bookings JOIN dim_partners USING (partner_id)").first()["n"] == 1


def test_freshness_of_a_fact_table(spark, tmp_path):
    m = models(spark)
    fact = FactTable(spark, str(tmp_path / "fact"), "booking_id", "booked_at")
    fact.load(m["fct_bookings"])
    soon, late = (F.current_timestamp() + F.expr(f"interval {h} hours") for h in (1, 30))
    assert quality.freshness(fact.loads(), "loaded_at", soon).first()["fresh"] is True
    assert quality.freshness(fact.loads(), "loaded_at", late).first()["fresh"] is False


def test_valid_amounts_with_missing_status(spark):
    df = spark.createDataFrame([(None, None), (None, 1.0), ("pending", None)], "status string, total_amount double")
    assert valid_amounts(df).count() == 2


def test_all_exports_are_written_in_order(spark, tmp_path):
    from kerbside.plans.exports import EXPORTS, export_results

    m = models(spark, cancellations=[dict(booking_id="none")])
    export_results(m, str(tmp_path))
    found = {p.parent.name: p.read_text(encoding="utf-8").splitlines() for p in tmp_path.glob("*/*.csv")}
    assert set(found) == set(EXPORTS)
    assert found["funnel_stages"] == ["etapa,ordem,valor", "Sessões,1,1", "Buscas,2,1", "Reservas,3,1"]
    assert found["monthly_evolution"][1] == "2024-01,1,100.0,0.0,0.0,0.0,0.0"


def test_sql_functions(spark):
    from kerbside.functions.sql import register_functions

    register_functions(spark)
    row = spark.sql(
        """SELECT strftime(t, '%Y-%m') AS m, time_bucket(interval 5 minute, t) AS b,
        time_bucket(interval 7 day, t) AS w, hour_boundaries(t, t + interval 1 hour) AS h, round2(1.005D) AS r
        FROM (SELECT TIMESTAMP_NTZ '2024-01-04 10:07:30' AS t)"""
    ).first()
    assert tuple(map(str, row)) == ("2024-01", "2024-01-04 10:05:00", "2024-01-01 00:00:00", "1", "1.0")


def test_strftime_keeps_literals_and_rejects_unknown_directives(spark):
    from kerbside.functions.sql import register_functions

    register_functions(spark)
    made = spark.sql("SELECT strftime(TIMESTAMP_NTZ '2024-01-04 10:07:30', 'day %d of %Y, 100%%') AS t").first()["t"]
    assert made == "day 04 of 2024, 100%"
    with pytest.raises(Exception, match="unknown directive"):
        spark.sql("SELECT strftime(TIMESTAMP_NTZ '2024-01-04 10:07:30', '%j') AS t").collect()


def test_a_report_with_nulls_or_a_repeated_grain_is_not_published(spark):
    m = models(spark, bookings=[dict(booking_id="1"), dict(booking_id="2")], cancellations=[dict(booking_id="none")])
    made = report.revenue_by_partner(report.monthly_parts(m["active_bookings"], m["int_cancellations"]), m["dim_partners"])
    assert report.enforced(made).count() == made.count() > 0
    with pytest.raises(report.ContractBroken, match="unique"):
        report.enforced(made.unionByName(made))
    with pytest.raises(report.ContractBroken, match="partner_name"):
        report.enforced(made.withColumn("partner_name", F.lit(None).cast("string")))


def test_month_close_keeps_other_months(spark, tmp_path):
    bookings = [dict(booking_id=str(i), booked_at=f"2024-0{i}-01 00:00:00") for i in (1, 2, 3)]
    made = report_of(models(spark, bookings=bookings, cancellations=[dict(booking_id="none")]))[1]
    export_closed_months(made, str(tmp_path / "close"))
    export_closed_months(made.filter("reference_month = DATE'2024-01-01'"), str(tmp_path / "close"))
    assert sorted(p.name for p in (tmp_path / "close").glob("reference_month=*")) == ["reference_month=2024-01-01", "reference_month=2024-02-01"]


def test_keyed_masks_differ_from_plain_ones(spark):
    m = models(spark)
    plain, keyed = (restricted(m["fct_sessions"], key=k).first()["user_id"] for k in (None, "secret"))
    assert plain != keyed and len(keyed) == 64
