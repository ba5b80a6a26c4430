import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import columns as C


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first().r


def test_to_float_cases(spark):
    cases = {
        "1,234.50": 1234.5, " 12 ": 12.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "-5": -5.0,
        "+7": 7.0, "1_000": 1000.0, "abc": None, "": None, None: None, "nan": None, "inf": None,
        "-Infinity": None, "1.0d": None, "1__0": None, "12abc": None,
    }
    for text, want in cases.items():
        assert one(spark, C.to_float, text) == want, text


def test_to_bool_and_strip(spark):
    for text, want in {"yes": True, " Y ": True, "1": True, "TRUE": True, "no": False, "n": False,
                       "0": False, "maybe": None, None: None}.items():
        assert one(spark, C.to_bool, text) is want, text
    assert one(spark, C.strip, " \t a b \n") == "a b"
    assert one(spark, C.blank_to_null, "   ") is None


def test_parse_ts_formats(spark):
    want = dt.datetime(2024, 3, 5, 7, 8, 9)
    for text in ["2024-03-05 07:08:09", "2024-03-05T07:08:09", "2024-03-05T07:08:09Z",
                 "2024-03-05T12:38:09+05:30", "03/05/2024 07:08:09", " 2024/03/05 07:08:09 "]:
        assert one(spark, C.parse_ts, text) == want, text
    assert one(spark, C.parse_ts, "31-12-2024") == dt.datetime(2024, 12, 31)
    assert one(spark, C.parse_ts, "01-02-2024") == dt.datetime(2024, 1, 2)  # month first
    assert one(spark, C.parse_ts, "20240105") == dt.datetime(2024, 1, 5)
    for bad in ["not a date", "", None, "2024-13-45"]:
        assert one(spark, C.parse_ts, bad) is None, bad


def test_iso_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7),), (dt.datetime(2024, 1, 1, 0, 0, 7, 5000),)],
                               "t timestamp")
    got = [r.s for r in df.select(C.iso_utc("t").alias("s")).collect()]
    assert got == ["2024-01-01T00:00:07+00:00", "2024-01-01T00:00:07.005000+00:00"]


def test_source_routing_order(spark):
    names = {"ATM_2024.csv": "ATM", "upi.csv": "UPI", "account_master.csv": "ACCOUNT",
             "customer_account.csv": "ACCOUNT", "Customer.csv": "CUSTOMER", "login.csv": "UNKNOWN",
             "atm_upi.csv": "ATM"}
    for name, want in names.items():
        assert one(spark, C.source_type, name) == want, name
    assert one(spark, C.is_csv_name, "a.CSV") is False
    assert one(spark, C.file_name_of, "https://x/container/dir/f.csv") == "f.csv"


def test_silver_helpers(spark):
    assert one(spark, C.severity, "Balance mismatch found") == "HIGH"
    assert one(spark, C.severity, "UNVERIFIED doc") == "MEDIUM"
    assert one(spark, C.severity, None) == "LOW"
    assert one(spark, C.truthy_status, None) is False
    assert one(spark, C.truthy_status, "Verified") is True
    assert one(spark, lambda c: C.geo_part(c, 1), "12.5") is None
    assert one(spark, lambda c: C.validity(c.cast("date"), "2024-01-31"), "2024-01-31") == "VALID"
    assert one(spark, lambda c: C.validity(c.cast("date"), "2024-01-31"), "2024-01-30") == "EXPIRED"
    # leap-day birthday: whole years by months_between
    assert one(spark, lambda c: C.age_years(c.cast("date"), "2024-02-28"), "2000-02-29") == 23
    assert one(spark, lambda c: C.age_years(c.cast("date"), "2024-02-29"), "2000-02-29") == 24


def test_float_text_like_python(spark):
    vals = [0.5, 12.0, 1234.5, 9999999.0, 12500000.0, 1e15, 123456789.0, -20000000.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.t for r in df.select(C.float_text("v").alias("t")).collect()]
    assert got == [str(v) for v in vals]
