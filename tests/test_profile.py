"""G1-G7 on hand-made accounts, including the 5-year boundary."""

from ledgerloom.operators.rules_profile import profile_alerts

S = ("AccountNumber string, CustomerID string, KYC_Done string, KYC_DocumentVerificationStatus string, "
     "AccountStatus string, Balance string, AccountOpenDate string, AnnualIncome string")


def test_profile_rules(spark):
    rows = [
        ("A1", "C1", "n", "failed", "Dormant", "1,000", "2019-02-01", "50"),     # 1825 days, bal >= 100
        ("A2", "C2", "Yes", None, "closed", "99", "2019-02-01", None),           # stale (1825 days)
        ("A3", "C3", None, "ok", "active", "50", "2019-02-02", "0"),             # 1824 days: not stale
    ]
    df = spark.createDataFrame(rows, S)
    got = sorted((r.alert_id, r.reason) for r in profile_alerts(df, as_of="2024-01-31 00:00:00").collect())
    assert got == sorted([
        ("ALERT_KYC_NOT_DONE_A1", "KYC is not completed"),
        ("ALERT_KYC_VERIFICATION_FAILED_A1", "KYC verification failed"),
        ("ALERT_ACCOUNT_DORMANT_A1", "Account is dormant or inactive"),
        ("ALERT_BALANCE_INCOME_MISMATCH_A1", "Balance 1000.0 greatly exceeds declared income 50.0"),
        ("ALERT_ACCOUNT_CLOSED_A2", "Account is closed"),
        ("ALERT_STALE_ACCOUNT_A2", "Account is very old and balance is too low"),
    ])
