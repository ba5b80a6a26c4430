"""Balance drain with amounts of any size: the metric is their sum."""
import datetime as dt

import pytest

from ledgerloom.operators import rules_txn as R

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "file_name string, TransactionID string, AccountNumber string, CustomerID string, Amount double, Timestamp timestamp, Location string"


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_large_amounts_are_not_cut(spark, hot_rows):
    amounts = {"A": [10.0, 2e15], "B": [3e300], "C": [5.5, 1e15 + 0.5, 1.0], "D": [4e15] * 3, "E": [60000.25, 50000.5]}
    rows = [("f.csv", f"{k}{0 if k == 'D' else i}", k, k, a, T0 + dt.timedelta(seconds=0 if k == "D" else i), "L")
            for k, v in amounts.items() for i, a in enumerate(v)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.CustomerID: r.metric for r in R.balance_drain(df, 100000.0, 60, hot_rows=hot_rows).collect()}
    assert got == {"A": 2e15 + 10, "B": 3e300, "C": 1e15 + 6, "D": 4e15, "E": 110000.75}
    high = {r.CustomerID: r.metric for r in R.balance_drain(df, 7e15, 60, hot_rows=hot_rows).collect()}
    assert high == {"B": 3e300, "D": 8e15}
