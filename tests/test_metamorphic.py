"""Same results for 1 and 50 shuffle partitions."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from ledgerloom.checks import canon

from conftest import SF_SMALL

NAMES = ["customer360", "alerts_velocity", "alerts_geo_switch", "alerts_balance_drain",
         "flag_alerts", "fact_transactions", "scd2_second_load", "global_row_number"]


def rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(canon(r[c]) for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_does_not_change_results(spark, name):
    q = entry.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = rows(q(spark, SF_SMALL))
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        many = rows(q(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many
