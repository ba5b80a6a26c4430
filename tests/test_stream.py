"""Arrival-driven ingestion processes each file once; stream = batch."""

import os

from ledgerloom.plans.ingest import ingest_transactions
from ledgerloom.sources.files import read_delimited
from ledgerloom.streaming.file_stream import read_audit, start_ingest_stream

HEADER = "TransactionID,AccountNumber,CustomerID,TransactionAmount,TransactionTime,Location\n"


def land(path, lines):
    with open(path, "w") as f:
        f.write(HEADER + "".join(lines))


def test_two_runs_equal_one_batch(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    land(f"{inbox}/atm_a.csv", ["T1,A1,C1,\"60,000\",2024-01-01 00:00:00,L1\n",
                                ",A1,C1,5,2024-01-01 00:00:10,L1\n"])
    land(f"{inbox}/notes.txt", ["x\n"])
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    land(f"{inbox}/upi_b.csv", ["U1,A2,,abc,2024-01-01 00:00:00,L2\n", "U2,A2,,10,2024-01-01 00:00:05,L1\n"])
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()  # nothing new
    audit = {r.file_name: r for r in read_audit(spark, out).collect()}
    assert set(audit) == {"atm_a.csv", "upi_b.csv", "notes.txt"}
    assert audit["notes.txt"].status == "REJECTED_EXTENSION"
    assert (audit["atm_a.csv"].rows_parsed, audit["atm_a.csv"].valid, audit["atm_a.csv"].alerts_generated) == (2, 1, 1)
    assert (audit["upi_b.csv"].valid, audit["upi_b.csv"].invalid) == (1, 1)
    batch = ingest_transactions(read_delimited(spark, [f"{inbox}/atm_a.csv", f"{inbox}/upi_b.csv"]))
    assert batch["valid"].count() == 2
    assert spark.read.parquet(f"{out}/quarantine").count() == 2
    assert [d for d in os.listdir(f"{out}/atm") if d.startswith("day=")] == ["day=2024-01-01"]
    assert spark.read.parquet(f"{out}/alerts").count() >= 1


def test_account_alerts_use_stored_customers(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    with open(f"{inbox}/customer_master.csv", "w") as f:
        f.write("CustomerID,DOB,AnnualIncome\nC1,1990-01-01,100\n")
    with open(f"{inbox}/account_a.csv", "w") as f:
        f.write("AccountNumber,CustomerID,Balance,AccountOpenDate\nA1,C1,5000,2020-01-01\n")
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    # first batch: account before any customer document -> no income rule
    with open(f"{inbox}/account_b.csv", "w") as f:
        f.write("AccountNumber,CustomerID,Balance,AccountOpenDate\nA2,C1,5000,2020-01-01\n")
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    ids = {r.alert_id for r in spark.read.parquet(f"{out}/profile_alerts").collect()}
    assert "ALERT_BALANCE_INCOME_MISMATCH_A2" in ids and "ALERT_BALANCE_INCOME_MISMATCH_A1" not in ids
    prof = {r.id: r for r in spark.read.parquet(f"{out}/profiles").collect()}
    # A1 got its customer part when the customer file came; a new account
    # document carries none until customers are ingested again.
    assert prof["A1"].Customer.AnnualIncome == 100.0 and prof["A2"].Customer is None


def test_customers_before_any_account(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    with open(f"{inbox}/customer_master.csv", "w") as f:
        f.write("CustomerID,DOB,AnnualIncome,FirstName\nC9,1990-01-01,7,Ann\n")
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    with open(f"{inbox}/account_x.csv", "w") as f:
        f.write("AccountNumber,CustomerID,Balance,AccountOpenDate\nA9,C9,1,2020-01-01\n")
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    prof = {r.id: r for r in spark.read.parquet(f"{out}/profiles").collect()}
    assert set(prof) == {"CUSTOMER_C9", "A9"}
    assert prof["CUSTOMER_C9"].Customer.FirstName == "Ann" and prof["A9"].Account.Balance == 1.0


def test_failed_step_is_audited_and_stream_goes_on(spark, scratch, monkeypatch):
    from ledgerloom.streaming import file_stream

    def boom(*a, **k):
        raise RuntimeError("processor broke")
    monkeypatch.setattr(file_stream, "ingest_accounts", boom)
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    with open(f"{inbox}/account_bad.csv", "w") as f:
        f.write("AccountNumber,CustomerID,Balance,AccountOpenDate\nA1,C1,5,2020-01-01\n")
    land(f"{inbox}/upi_ok.csv", ["U1,A2,,10,2024-01-01 00:00:05,L1\n"])
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    audit = {r.file_name: r for r in read_audit(spark, out).collect()}
    assert audit["account_bad.csv"].status == "PROCESSOR_FAILED"
    assert "processor broke" in audit["account_bad.csv"].error
    assert audit["upi_ok.csv"].status == "COMPLETED" and audit["upi_ok.csv"].valid == 1


def test_line_breaks_inside_quotes(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    land(f"{inbox}/atm_q.csv", ["T1,A1,C1,5,2024-01-01 00:00:00,\"First\nfloor\"\n", "T2,A1,C1,6,2024-01-01 00:00:01,L\n"])
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    audit, = read_audit(spark, out).collect()
    assert (audit.rows_parsed, audit.valid, audit.invalid) == (2, 2, 0)
    assert {r.TransactionID: r.Location for r in spark.read.parquet(f"{out}/atm").collect()} == {"T1": "First\nfloor", "T2": "L"}


def test_bad_files_are_found_by_halving(spark):
    """One bad file of 200 takes about 2 log2(200) probes; several are all found."""
    from types import SimpleNamespace

    from ledgerloom.streaming.file_stream import IngestSink

    def tried(bad, n=200):
        calls = []

        def process(files):
            calls.append(list(files))

            def collect():
                wrong = sorted(set(files) & bad)
                if wrong:
                    raise RuntimeError("cannot read " + wrong[0])
                return list(files)
            return {"counters": SimpleNamespace(collect=collect)}
        _, counters, errors = IngestSink._processed([f"f{i:03d}" for i in range(n)], process, [])
        assert set(errors) == bad and all(str(e) == f"cannot read {f}" for f, e in errors.items())
        assert counters == [f"f{i:03d}" for i in range(n) if f"f{i:03d}" not in bad]
        return len(calls)
    assert tried({"f123"}) <= 2 * 8 + 2
    assert tried({"f000", "f001", "f199"}) <= 3 * 2 * 8 + 2
    assert tried(set()) == 1
    tried({f"f{i:03d}" for i in range(5)}, 5)
    tried({"f000"}, 1)


def test_a_bad_file_among_many(spark, scratch):
    inbox, out = f"{scratch}/inbox", f"{scratch}/out"
    os.makedirs(inbox)
    for i in range(6):
        land(f"{inbox}/upi_{i}.csv", [f"U{i},A{i},,10,2024-01-01 00:00:05,L1\n"])
    with open(f"{inbox}/upi_bad.csv", "w") as f:
        f.write("TransactionID,AccountNumber,AccountNumber,TransactionAmount\nT,A,A,1\n")
    start_ingest_stream(spark, inbox, out, f"{scratch}/ckpt", as_of="2024-01-31").awaitTermination()
    status = {r.file_name: (r.status, r.valid) for r in read_audit(spark, out).collect()}
    assert status == {"upi_bad.csv": ("PROCESSOR_FAILED", None), **{f"upi_{i}.csv": ("COMPLETED", 1) for i in range(6)}}
    assert spark.read.parquet(f"{out}/upi").count() == 6


def test_unreadable_store_replays_the_batch(spark, scratch):
    """An error of the profile store marks no file: the batch fails and is done
    again once the store can be read."""
    import glob

    import pytest
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    os.makedirs(inbox)
    with open(f"{inbox}/customer_master.csv", "w") as f:
        f.write("CustomerID,DOB,AnnualIncome\nC1,1990-01-01,100\n")
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    held = {p: open(p, "rb").read()
            for end in ("*.parquet", ".*.crc") for p in glob.glob(f"{out}/profiles/**/{end}", recursive=True)}
    for p in held:
        with open(p, "wb") as f:
            f.write(b"unreadable")
    with open(f"{inbox}/account_a.csv", "w") as f:
        f.write("AccountNumber,CustomerID,Balance,AccountOpenDate\nA1,C1,5000,2020-01-01\n")
    with pytest.raises(Exception, match="profiles could not be read"):
        start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    assert {r.file_name for r in read_audit(spark, out).collect()} == {"customer_master.csv"}
    for p, data in held.items():
        with open(p, "wb") as f:
            f.write(data)
    start_ingest_stream(spark, inbox, out, ckpt, as_of="2024-01-31").awaitTermination()
    audit = {r.file_name: r.status for r in read_audit(spark, out).collect()}
    assert audit == {"customer_master.csv": "COMPLETED", "account_a.csv": "COMPLETED"}
    ids = {r.alert_id for r in spark.read.parquet(f"{out}/profile_alerts").collect()}
    assert "ALERT_BALANCE_INCOME_MISMATCH_A1" in ids
