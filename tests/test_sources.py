"""How the order tables are read, and how much of them is written and shuffled."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalogue import inputs, queries
from fareloom.sources import bookings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_items_are_shuffled_by_part_and_order_alone(spark, monkeypatch):
    """Large tables: customers meet the orders and not the items."""
    rows = sorted(map(str, bookings.bookings(spark, SF).collect()))
    monkeypatch.setattr(bookings, "ORDER_BYTES", 0)
    assert sorted(map(str, bookings.bookings(spark, SF).collect())) == rows
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bookings.bookings(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = re.findall(r"Join Inner, \((\w+?)#\d+L? = (\w+?)#", plan)
    assert [set(j) for j in joins] == [
        {"l_orderkey", "o_orderkey"}, {"l_partkey", "p_partkey"}, {"l_suppkey", "s_suppkey"}, {"o_custkey", "c_custkey"},
    ]


def test_dealt_partitions_grow_with_the_files(spark):
    one = spark.range(10).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert bookings.spread_scan(one, "id").rdd.getNumPartitions() == cores
    assert bookings.spread_scan(one, "id", 100 * bookings.DEALT_BYTES).rdd.getNumPartitions() == 100


def test_silver_alone_writes_no_validated_table(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    direct = sorted(inputs.silver(spark, SF).select("id", "route").collect())
    assert [key[2] for key in inputs._written] == ["silver"]
    monkeypatch.setattr(inputs, "_written", {})
    inputs.validated(spark, SF)
    assert sorted(inputs.silver(spark, SF).select("id", "route").collect()) == direct


def test_extracts_for_the_stream_are_dropped_in_files_by_size(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "DROP_BYTES", 1 << 13)
    monkeypatch.setattr(queries.ingest, "announce", lambda spark, drop, name: seen.append(len(list(Path(drop, name).glob("part-*")))))
    monkeypatch.setattr(queries.ingest, "stream_ingest", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        entry.queries()["stream_ingest"](spark, SF)
    assert len(seen) == 2 and min(seen) > 3


def test_texts_of_a_small_part_table_are_not_shuffled_by_order(spark, monkeypatch):
    monkeypatch.setattr(bookings, "ORDER_BYTES", 0)
    plan = bookings.bookings(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \((\w+?)#\d+L? = (\w+?)#", plan)
    assert [set(j) for j in joins[:3]] == [{"l_suppkey", "s_suppkey"}, {"l_partkey", "p_partkey"}, {"l_orderkey", "o_orderkey"}]


def test_a_single_pass_writes_no_table_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    direct = entry.queries()["load_stats"](spark, SF).collect()
    assert not inputs._written
    inputs.validated(spark, SF)
    assert entry.queries()["load_stats"](spark, SF).collect() == direct and direct


def test_tables_of_all_rows_are_compact(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    assert all(".zstd." in name for name in inputs.validated(spark, SF).inputFiles())


def test_appends_keep_the_columns_in_use_alone(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    names = ("sink_append", "sink_overwrite")
    direct = [sorted(entry.queries()[name](spark, SF).collect()) for name in names]
    (kept,) = inputs._written.values()
    assert not {"is_valid", "source_name", "aircraft_type"} & set(kept.columns)
    monkeypatch.setattr(inputs, "_written", {})
    inputs.validated(spark, SF)
    assert [sorted(entry.queries()[name](spark, SF).collect()) for name in names] == direct and all(direct)
    assert len(inputs._written) == 1


def test_a_csv_file_alone_writes_no_validated_table(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_written", {})
    rows = entry.queries()["dataset_metadata"](spark, SF).collect()
    assert not inputs._written and [r["id"] for r in rows] == [1, 2] and rows[0]["row_count"] == rows[1]["row_count"] > 0
