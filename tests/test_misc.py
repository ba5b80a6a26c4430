"""Small operators: message check (D7), customer lookup (E3), CTAS and
count/preview (B13, B14), dimension checks (K21), calendar (K9-K10, L8)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.rules_profile import customer_lookup, profile_alerts
from ledgerloom.operators.validate import message_ok
from ledgerloom.plans.dims import dim_date, dimension_checks
from ledgerloom.sources.tables import count_and_preview, create_table_as_select


def test_message_ok(spark):
    df = spark.createDataFrame([('{"file_url": "u", "file_name": "a.csv"}',), ('{"file_url": "u"}',),
                                ("not json",), ('{"file_url": "", "file_name": "b"}',)], "body string")
    assert [r.ok for r in df.select(message_ok(F.col("body")).alias("ok")).collect()] == [True, False, False, False]


def test_customer_lookup_feeds_income_rule(spark):
    profiles = spark.createDataFrame(
        [("B", "C1", (500.0,)), ("A", "C1", (10.0,)), ("Z", "C2", None)],
        "id string, CustomerID string, Customer struct<AnnualIncome:double>")
    look = customer_lookup(profiles).select("CustomerID", F.col("Customer.AnnualIncome").alias("AnnualIncome"))
    assert sorted(tuple(r) for r in look.collect()) == [("C1", 10.0)]
    acc = spark.createDataFrame([("AC1", "C1", "1000"), ("AC2", "C2", "1000")],
                                "AccountNumber string, CustomerID string, Balance string")
    acc = acc.withColumns({c: F.lit(None).cast("string") for c in
                           ("KYC_Done", "KYC_DocumentVerificationStatus", "AccountStatus", "AccountOpenDate")})
    hits = {r.alert_id for r in profile_alerts(acc, look).collect()}
    assert hits == {"ALERT_BALANCE_INCOME_MISMATCH_AC1"}   # C2 has no customer document


def test_ctas_and_preview(spark, scratch):
    df = spark.range(30).withColumn("Month", (F.col("id") % 3).cast("int"))
    t = create_table_as_select(spark, "ledgerloom_ctas_test", df, ["Month"], path=f"{scratch}/ctas")
    rows, preview = count_and_preview(t, 20)
    assert rows.first().rows == 30 and preview.count() == 20
    spark.sql("drop table if exists ledgerloom_ctas_test")


def test_dim_date_and_checks(spark):
    txn = spark.createDataFrame([(dt.date(2024, 3, 30),), (dt.date(2024, 4, 2),)], "Transaction_Date date")
    d = {r.Date: r for r in dim_date(txn).collect()}
    assert len(d) == 4
    apr1 = d[dt.date(2024, 4, 1)]
    assert (apr1.DateKey, apr1.DayName, apr1.ShortMonthName, apr1.DayOfWeek, apr1.QuarterName) == \
        (20240401, "Monday", "Apr", 2, "Q2")
    assert (apr1.FiscalYear, apr1.FiscalQuarter, apr1.FiscalMonth) == (2024, 1, 1)
    assert d[dt.date(2024, 3, 31)].FiscalYear == 2023
    dim = spark.createDataFrame([(1, True), (2, False)], "SK int, CurrentFlag boolean")
    c = dimension_checks(dim).first()
    assert (c.total_rows, c.active_rows) == (2, 1)
