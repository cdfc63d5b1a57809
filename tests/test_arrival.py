"""Line order over many files, and lines parsed from elsewhere."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import records
from tidemark.sources.access_log import parse_access_log, read_access_log, rejected_lines
from tidemark.sources.records import parse_records, read_records, render_records


def write(path, lines):
    path.write_text("".join(f"{x}\n" for x in lines))


def test_files_of_all_sizes_and_splits_keep_file_then_line_order(spark, tmp_path):
    sizes = {"a.csv": 3, "b.csv": 20_000, "c.csv": 1, "d.csv": 7_000, "e.csv": 2}
    want, n = [], 0
    for name, size in sizes.items():
        write(tmp_path / name, [f"{n + i},ip,fail,{n + i}" for i in range(size)])
        want += range(n, n + size)
        n += size
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_records(spark, str(tmp_path), "login")
        assert df.rdd.getNumPartitions() > 1
        got = df.select("seq", "user_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["user_id"] for r in sorted(got, key=lambda r: r["seq"])] == want
    assert sorted(r["seq"] for r in got) == list(range(n))


def test_quotes_are_characters(spark, tmp_path):
    write(tmp_path / "x.csv", ['1,"ip,fail,5', '2,i"p,success,6'])
    got = read_records(spark, str(tmp_path), "login").orderBy("seq").collect()
    assert [(r["user_id"], r["ip"]) for r in got] == [(1, '"ip'), (2, 'i"p')]


def test_parse_records(spark):
    lines = spark.createDataFrame([("1,create,,10",), ("2,pay,tx\",11",)], "value string")
    got = parse_records(lines, "order").orderBy("order_id").collect()
    assert [(r["order_id"], r["event_type"], r["tx_id"], r["timestamp"]) for r in got] == [
        (1, "create", "", 10), (2, "pay", 'tx"', 11)]
    bad = spark.createDataFrame([("1,create,,10",), ("x,pay,t,11",), ("short",)], "value string")
    with pytest.raises(Exception):
        parse_records(bad, "order").collect()
    lenient = parse_records(bad, "order", mode="PERMISSIVE")
    assert sorted(r["_corrupt"] for r in lenient.filter("_corrupt is not null").collect()) == ["short", "x,pay,t,11"]
    assert lenient.filter("_corrupt is null").count() == 1


def test_render_and_parse_are_inverse(spark):
    df = spark.createDataFrame([(1, None, "c", 5)], records.BY_NAME["login"])
    assert render_records(df, "login").first()["value"] == "1,,c,5"
    assert parse_records(render_records(df, "login"), "login").first()["timestamp"] == 5


def test_lenient_access_log(spark, tmp_path):
    good = "1.2.3.4 - - 17/05/2015:10:05:03 +0000 GET /a"
    lines = [good, "1.2.3.4 - -", "", "1.2.3.4 - - notatime +0000 GET /b", good.replace("/a", "/c d")]
    df = spark.createDataFrame([(x, i) for i, x in enumerate([*lines, None])], "value string, seq int")
    got = parse_access_log(df, strict=False).orderBy("seq").collect()
    assert [(r["url"], r["seq"]) for r in got] == [("/a", 0), ("/c", 4)]
    assert [r["seq"] for r in rejected_lines(df).orderBy("seq").collect()] == [1, 2, 3, 5]
    write(tmp_path / "log", lines)
    assert read_access_log(spark, str(tmp_path / "log"), strict=False).count() == 2
    with pytest.raises(Exception):
        read_access_log(spark, str(tmp_path / "log")).select(F.sum("timestamp")).collect()
