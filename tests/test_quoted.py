"""Line breaks inside quotes: files in many splits against a whole-file parse."""
import csv
import io
import random

import pytest

from ledgerloom.sources.files import read_delimited

FIELDS = ["plain", "", "with,comma", "two\nlines", "crlf\r\nline", 'say ""hi""'.replace('""', '"'), "three\n\n\nbreaks", "é" * 30,
          'ends with quote"', "\nstarts", "5 inch"]


def written(path, rows, end):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["a", "b", "c"])
    w.writerows(rows)
    with open(path, "w", newline="") as f:
        f.write(out.getvalue())


@pytest.mark.parametrize("split", [150, 1000, 10_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_give_whole_records(spark, scratch, split, end):
    rng = random.Random(split)
    rows = [[f"k{i}", rng.choice(FIELDS), rng.choice(FIELDS)] for i in range(250)]
    written(f"{scratch}/x.csv", rows, end)
    written(f"{scratch}/y.csv", [["y1", "no", "breaks"], ["y2", "a,b", ""]], end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = read_delimited(spark, [f"{scratch}/x.csv", f"file:{scratch}/y.csv"], multiline=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.a, r.b or "", r.c or "") for r in got if r.file_name == "x.csv") == sorted(map(tuple, rows))
    assert sorted((r.a, r.b, r.c) for r in got if r.file_name == "y.csv") == [("y1", "no", "breaks"), ("y2", "a,b", None)]
    assert all(r._corrupt_record is None for r in got)


def test_stray_quotes_and_surplus_fields(spark, scratch):
    with open(f"{scratch}/x.csv", "w", newline="") as f:
        f.write('a,b,c\n1,5" pipe,x\n2,"two\nlines",y\n3,it"s,z\n4,"p\nq",r,surplus\n\n5,last,"one\n two"\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20)
    try:
        got = {r.a: r for r in read_delimited(spark, [f"{scratch}/x.csv"], multiline=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: (r.b, r.c) for k, r in got.items()} == {
        "1": ('5" pipe', "x"), "2": ("two\nlines", "y"), "3": ('it"s', "z"), "4": ("p\nq", "r"), "5": ("last", "one\n two")}
    assert [k for k, r in got.items() if r._corrupt_record] == ["4"]
