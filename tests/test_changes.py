"""Incremental load, type-2 history, the load run and the stream."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from catalogue import inputs, queries
from fareloom.functions import fixed
from fareloom.operators import audit, incremental, scd
from fareloom.operators.validate import validate_rows
from fareloom.plans import load as load_plan
from fareloom.session import discard, materialize, new_path, path_size
from fareloom.sources import files, tables
from fareloom.sources import ledger as ledger_module
from fareloom.sources.ledger import CommitExists, Ledger
from fareloom.streaming import ingest

T0, T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00"


def fares(make, *values):
    return incremental.with_hash(make(*[{"id": f"{i}", "base_fare_bdt": float(v)} for i, v in enumerate(values)]))


def bronze(make, *values):
    return incremental.apply_full(fares(make, *values), T0)


def stats(make, new, old):
    return incremental.change_stats(fares(make, *new), bronze(make, *old)).first()


def test_modes(make):
    first = incremental.change_stats(fares(make, 1, 2), bronze(make, 1).limit(0)).first()
    assert (first["load_type"], first["change_percentage"], first["records_inserted"]) == ("FULL", 100.0, 2)
    empty = incremental.change_stats(fares(make, 1).limit(0), bronze(make, 1)).first()
    assert (empty["load_type"], empty["change_percentage"]) == ("NONE", 0.0)
    same = stats(make, [1, 2], [1, 2])
    assert (same["load_type"], same["records_unchanged"], same["change_percentage"]) == ("INCREMENTAL", 2, 0.0)
    half = stats(make, [1, 2, 3, 4], [1, 2, 3, 9])  # one new, one deleted of four
    assert (half["change_percentage"], half["load_type"]) == (50.0, "INCREMENTAL")
    more = stats(make, [1, 2, 3, 4], [1, 2, 8, 9])
    assert more["load_type"] == "FULL"


def test_copies_move_together(make):
    s = stats(make, [1, 1, 2], [1, 3, 3])
    assert (s["records_inserted"], s["records_deleted"], s["records_unchanged"]) == (1, 2, 2)


def test_fields_outside_the_hash(make):
    a, b = make({"tax_surcharge_bdt": 1.0}, {"tax_surcharge_bdt": 2.0}).transform(incremental.with_hash).collect()
    assert a["record_hash"] == b["record_hash"]
    wide = incremental.with_hash(make({}, {"tax_surcharge_bdt": 2.0}), (*fixed.HASH_FIELDS, "tax_surcharge_bdt"))
    assert wide.select("record_hash").distinct().count() == 2
    n, m = incremental.with_hash(make({"airline": None}, {"airline": "None"})).collect()
    assert n["record_hash"] == m["record_hash"]


def test_apply_incremental_keeps_history_and_is_idempotent(make):
    incoming = fares(make, 1, 2, 4)
    once = incremental.apply_incremental(incoming, bronze(make, 1, 2, 3), T1)
    rows = {(r["base_fare_bdt"], r["is_active"]) for r in once.collect()}
    assert rows == {(1.0, True), (2.0, True), (3.0, False), (4.0, True)}
    twice = incremental.apply_incremental(incoming, once, T2)
    assert sorted(map(str, twice.select(*once.columns).collect())) == sorted(map(str, once.collect()))
    back = incremental.apply_incremental(fares(make, 3), once, T2)  # a vanished record comes back
    assert back.where("base_fare_bdt = 3 AND is_active").count() == 1
    assert back.where("is_active").count() == 1 and back.count() == 5


def test_gates(spark):
    def gate(kind, pct, ins, dele):
        df = spark.createDataFrame([(kind, pct, ins, dele)], "load_type string, change_percentage double, records_inserted bigint, records_deleted bigint")
        return df, incremental.process_gate(df).first()

    assert gate("NONE", 0.0, 0, 0)[1]["should_process"] is False
    assert gate("INCREMENTAL", 0.05, 1200, 300)[1]["reason"] == "1,500 records changed"
    assert gate("INCREMENTAL", 0.1, 1, 0)[1]["reason"] == "Data changed by 0.10%"
    model = spark.createDataFrame([("2024-12-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("training_timestamp"))
    load = gate("FULL", 60.0, 2000, 0)[0]
    got = incremental.retrain_gate(load, model, T0).first()
    assert got["decision"] == "retrain"
    assert got["reasons"] == "Data changed by 60.00%; 2,000 new records; Model is 31 days old; Full data reload"
    quiet = gate("INCREMENTAL", 1.0, 10, 0)[0]
    assert incremental.retrain_gate(quiet, model, "2024-12-30 00:00:00").first()["decision"] == "skip"
    assert incremental.retrain_gate(quiet, model.limit(0), T0).first()["reasons"] == "No existing model"


COLUMNS = "k string, a double, note string"


def versions(df):
    return sorted((r["k"], str(r["a"]), str(r["valid_from"])[:7], str(r["valid_to"])[:7]) for r in df.collect())


def test_scd_merge(spark):
    start = scd.scd2_start(spark.createDataFrame([("same", 1.0, "x"), ("moved", 1.0, "x"), ("gone", 1.0, "x"), ("filled", None, "x")], COLUMNS), "k", T0)
    incoming = spark.createDataFrame([("same", 1.0, "other"), ("moved", 2.0, "x"), ("new", 5.0, "x"), ("filled", 3.0, "x")], COLUMNS)
    kept = scd.scd2_merge(start, incoming, "k", ["a"], T1)
    assert versions(kept) == sorted([
        ("same", "1.0", "2025-01", "None"), ("moved", "1.0", "2025-01", "2025-02"), ("moved", "2.0", "2025-02", "None"),
        ("gone", "1.0", "2025-01", "None"), ("new", "5.0", "2025-02", "None"), ("filled", "None", "2025-01", "2025-02"),
        ("filled", "3.0", "2025-02", "None"),
    ])
    assert kept.where("k = 'same'").first()["note"] == "x"  # only check columns count
    strict = scd.scd2_merge(start, incoming, "k", ["a"], T1, hard_deletes=True)
    assert ("gone", "1.0", "2025-01", "2025-02") in versions(strict)
    again = scd.scd2_merge(strict, spark.createDataFrame([("gone", 1.0, "x")], COLUMNS), "k", ["a"], T2, True)
    assert ("gone", "1.0", "2025-03", "None") in versions(again)
    assert again.where("valid_to IS NULL").groupBy("k").count().where("count > 1").isEmpty()
    assert again.select("scd_id").distinct().count() == again.count()


def test_scd_repeated_key_fails(spark):
    start = scd.scd2_start(spark.createDataFrame([("a", 1.0, "x")], COLUMNS), "k", T0)
    twice = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y")], COLUMNS)
    with pytest.raises(Exception, match="repeated k: a"):
        scd.scd2_merge(start, twice, "k", ["a"], T1).collect()


def test_store_versions(spark):
    store = tables.Store(spark, new_path(spark, "store"))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.overwrite("t", spark.range(5))
    current = store.read("t")
    store.overwrite("t", current.where("id > 2"))  # reads the version it replaces
    assert store.read("t").count() == 2 and store.read("t", 1).count() == 5
    store.overwrite("t", spark.range(9), version=2)  # complete already: nothing happens
    assert store.read("t").count() == 2
    store.append("log", spark.range(1))
    assert store.append("log", spark.range(1).withColumn("extra", F.lit("x"))).columns == ["id", "extra"]


def write_csv(df, path, files_of=1, **columns):
    headers = {field: header for header, field in fixed.CSV_HEADERS.items()}
    df = df.drop("id").withColumnsRenamed(headers)
    for name, value in columns.items():
        df = df.withColumn(name, F.lit(value))
    df.repartition(files_of).write.mode("append").options(
        header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def test_files_of_one_folder_may_order_their_columns_differently(spark, tmp_path):
    for name, text in (("a", "Airline,Source\nx,DAC\n"), ("b", "Source,Airline\nCXB,y\n"), ("c", "Source,Airline,Extra\nJSR,z,1\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    got = files.scan_csv(spark, str(tmp_path)).select("Airline", "Source", "Extra").collect()
    assert sorted(map(tuple, got), key=str) == [("x", "DAC", None), ("y", "CXB", None), ("z", "JSR", "1")]


def test_values_that_storage_types_cannot_hold_are_kept(spark):
    known = spark.createDataFrame([(1,)], "a int")
    incoming = spark.createDataFrame([(2, "123456789012"), (3, None)], "a int, big string")
    out, added = files.schema_evolve(known, incoming)
    assert added == [("big", "VARCHAR(255)")] and {r.big for r in out.collect()} == {"123456789012", None}


def test_large_amounts(spark):
    from fareloom.functions.numbers import round_to, sql_round
    from fareloom.functions.text import number_text

    df = spark.createDataFrame([(1.005,), (2e19,), (-3e25,), (float("nan"),), (None,)], "x double")
    rows = df.select(round_to("x", 2).alias("a"), F.expr(sql_round("x")).alias("b"), number_text(F.when(F.abs("x") < 1e30, F.col("x"))).alias("t")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == [1.01, 2e19, -3e25, None, None]
    assert rows[1].t == "20000000000000000000.00"


def test_catalogue_sizes_whole_tables(spark):
    store = tables.Store(spark, new_path(spark, "sizes"))
    table = store.overwrite("t", spark.range(100).withColumn("p", F.col("id") % 5), partition_by=["p"])
    row = tables.layer_catalog(spark, {("silver", "t"): table}).first()
    assert row["size_bytes"] == path_size(spark, f"{store.root}/t/version=1")


def test_csv(spark, make, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.scan_csv(spark, str(tmp_path / "none.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        files.scan_csv(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "a.csv").write_text(
        "Airline,Total Fare (BDT),Departure Date & Time,Days Before Departure,Loyalty Tier (new)\n"
        'x,12.5,2025-01-02 03:04:05,3.0,1\n"y, z",n/a,never,many,2\nNA,abc,,,\n'
    )
    df = files.coerce_types(files.rename_columns(files.scan_csv(spark, str(tmp_path / "a.csv"))).drop(files.CORRUPT))
    assert df.columns == ["airline", "total_fare_bdt", "departure_datetime", "days_before_departure", "loyalty_tier_new"]
    rows = [tuple(r) for r in df.collect()]
    assert rows[0][1] == 12.5 and rows[0][3] == 3 and str(rows[0][2]) == "2025-01-02 03:04:05"
    assert rows[1] == ("y, z", None, None, None, "2") and rows[2] == (None,) * 5
    assert files.null_row_count(df).first().asDict() == {"rows_with_nulls": 2, "total_rows": 3}


def test_snake_names(spark):
    df = spark.createDataFrame([(0, 1, 2, 3, 4, 5)], ["Unnamed: 0", "index", " Total Fare (BDT)", "Tax & Surcharge (BDT)", "Source", "Source Name"])
    assert files.rename_snake(df).columns == ["total_fare_bdt", "tax_surcharge", "source_city"]


def test_schema_evolution(spark):
    known = spark.createDataFrame([(1,)], "id int")
    wide = spark.createDataFrame([(2, "7", "1.5", "True", "x", 1.5)], "id int, whole string, part string, flag string, word string, number double")
    merged, added = files.schema_evolve(known, wide)
    assert dict(added) == {"whole": "BIGINT", "part": "DECIMAL(12, 2)", "flag": "BOOLEAN", "word": "VARCHAR(255)", "number": "DECIMAL(12, 2)"}
    assert merged.where("id = 1").first()["word"] is None and merged.where("id = 2").first()["whole"] == 7


def test_load_run_end_to_end(spark, make):
    root = new_path(spark, "run")
    good = [{"id": str(i), "base_fare_bdt": 100.0 + i} for i in range(10)]
    first = write_csv(make(*good, {"airline": None}), new_path(spark, "csv"))
    out = load_plan.load_run(spark, root, first, T0)
    assert (out["load_type"], out["records_inserted"], out["processed"]) == ("FULL", 10, True)
    same = load_plan.load_run(spark, root, first, T1)
    assert (same["load_type"], same["records_unchanged"], same["processed"]) == ("INCREMENTAL", 10, False)
    # one booking gone, one new; the source has a new column by now
    second = write_csv(make(*good[1:], {"base_fare_bdt": 500.0}), new_path(spark, "csv"), **{"Loyalty Tier": "gold"})
    out = load_plan.load_run(spark, root, second, T2)
    assert (out["load_type"], out["records_inserted"], out["records_deleted"]) == ("INCREMENTAL", 1, 1)
    store = Ledger(spark, root)
    assert store.read(load_plan.BRONZE).count() == 11 and store.read(load_plan.SILVER).count() == 10
    assert "loyalty_tier" in store.read(load_plan.SILVER).columns
    assert store.read("gold_avg_fare_by_airline").first()["total_bookings"] == 10
    assert store.read("flight_fare_snapshot").where("valid_to IS NULL").count() == 1
    assert store.read("data_quality_checks").agg(F.sum("failures")).first()[0] == 0
    assert store.read(load_plan.LOG).count() == 3
    tasks = store.read(load_plan.AUDIT).orderBy("id").collect()
    assert [r["status"] for r in tasks[:2]] == ["started", "completed"] and {r["task_id"] for r in tasks} == {"load", "build"}
    assert len({r["id"] for r in tasks}) == len(tasks)
    assert store.read(load_plan.LOG).where("execution_time_seconds < 1 OR source_file IS NULL").isEmpty()


def test_new_columns_get_types_that_widen(spark, make):
    """Points come as integers, then with decimals, then as words; a metadata row a file says what was new."""
    root = new_path(spark, "wide")
    base = [{"base_fare_bdt": 100.0 + i} for i in range(6)]
    ledger = Ledger(spark, root)
    kinds, steps = [], [{}, {"Points": "7", "Tier Name": "gold"}, {"Points": "7.25"}, {"Points": "many"}]
    for n, more in enumerate(steps):
        path = write_csv(make(*base, {"base_fare_bdt": 500.0 + n}), new_path(spark, "csv"), **more)
        assert load_plan.load_run(spark, root, path, f"2025-0{n + 1}-01 00:00:00")["records_inserted"] == (7 if n == 0 else 1)
        bronze = ledger.read(load_plan.BRONZE)
        kinds.append(dict(bronze.dtypes).get("points"))
        assert bronze.count() == 7 + n and bronze.where("is_active").count() == 7
    assert kinds == [None, "bigint", "decimal(21,2)", "string"]
    points = {(r["base_fare_bdt"], r["points"]) for r in ledger.read(load_plan.BRONZE).collect() if r["base_fare_bdt"] >= 500}
    assert points == {(500.0, None), (501.0, "7"), (502.0, "7.25"), (503.0, "many")}
    held = [n for n in ledger.commits() if load_plan.BRONZE in ledger.state(n)["tables"]]
    older = next(df for df in (ledger.read(load_plan.BRONZE, commit=n) for n in held) if "points" in df.columns)
    assert older.where("points = 7").count() == 1 and dict(older.dtypes)["points"] == "bigint"
    assert dict(ledger.read(load_plan.SILVER).dtypes)["points"] == "string" and "tier_name" in ledger.read(load_plan.SILVER).columns
    notes = ledger.read(load_plan.METADATA).orderBy("id").collect()
    assert [(r["id"], r["previous_metadata_id"], r["schema_changed"], r["new_columns_added"]) for r in notes] == [
        (1, None, False, None), (2, 1, True, "points, tier_name"), (3, 2, False, None), (4, 3, False, None),
    ]
    seen = {r["column_name"]: r for r in load_plan.bronze_profile(ledger).collect()}  # four loads, each sketched alone
    assert (seen["base_fare_bdt"]["row_count"], seen["base_fare_bdt"]["unique_values"], seen["base_fare_bdt"]["greatest"]) == (10, 10, 503.0)
    assert (seen["points"]["row_count"], seen["points"]["null_count"]) == (3, 0)
    assert all(r["row_count"] == 7 and r["file_size_bytes"] > 0 for r in notes) and notes[0]["schema_hash"] != notes[1]["schema_hash"]


def test_stream_equals_batch(spark, make):
    drop = new_path(spark, "drop")
    extracts = [make(*[{"base_fare_bdt": float(v)} for v in values]) for values in ([1, 2, 3, 4], [2, 3, 4, 5])]
    batch = Ledger(spark, new_path(spark, "batch"))
    for n, (extract, at) in enumerate(zip(extracts, (T0, T1)), start=1):
        load_plan.load(batch, files.scan_csv(spark, write_csv(extract, new_path(spark, "csv"))), at, ("stream", n))
        write_csv(extract, f"{drop}/extract-{n}", files_of=3)  # an extract of several part files is one load
        ingest.announce(spark, drop, f"extract-{n}")
    stream = Ledger(spark, new_path(spark, "stream"))
    state = new_path(spark, "state")
    for _ in range(2):  # a restart finds nothing left to do
        ingest.stream_ingest(spark, drop, stream, state, lambda i: (T0, T1)[i]).awaitTermination()
    columns = ["record_hash", "is_active", "ingestion_timestamp"]
    want = sorted(map(str, batch.read(load_plan.BRONZE).select(*columns).collect()))
    assert sorted(map(str, stream.read(load_plan.BRONZE).select(*columns).collect())) == want
    before = stream.state()
    replay = load_plan.load(stream, extracts[0].drop("id"), T2, token=("stream", 1))
    assert replay["load_type"] == "NONE" and stream.state() == before
    assert [r["source_file"] for r in stream.read(load_plan.LOG).orderBy("load_id").collect()] == ["extract-1", "extract-2"]


def test_a_load_that_dies_leaves_nothing_and_its_replay_finishes(spark, make, monkeypatch):
    """The second of two extracts of one batch fails as its log row is written: bronze must not show it before the replay."""
    drop, state = new_path(spark, "drop"), new_path(spark, "state")
    for n, values in enumerate(([1, 2, 3, 4, 5], [2, 3, 4, 5, 6], [3, 4, 5, 6, 7]), start=1):
        write_csv(make(*[{"base_fare_bdt": float(v)} for v in values]), f"{drop}/extract-{n}")
        ingest.announce(spark, drop, f"extract-{n}")
    ledger, stamps, fail = Ledger(spark, new_path(spark, "stream")), lambda i: (T0, T1, T2)[i], [True]
    row = incremental.load_log_row

    def dies(stats, *rest):
        if fail and ledger.exists(load_plan.LOG):
            raise OSError("the log cannot be written")
        return row(stats, *rest)

    monkeypatch.setattr(load_plan.incremental, "load_log_row", dies)
    with pytest.raises(Exception, match="log cannot be written"):
        ingest.stream_ingest(spark, drop, ledger, state, stamps).awaitTermination()
    assert ledger.read(load_plan.LOG).count() == 1 and ledger.read(load_plan.STAGING).count() == 5
    assert {(r["base_fare_bdt"], r["is_active"]) for r in ledger.read(load_plan.BRONZE).collect()} == {(float(v), True) for v in range(1, 6)}
    fail.clear()
    ingest.stream_ingest(spark, drop, ledger, state, stamps).awaitTermination()
    assert [r["source_file"] for r in ledger.read(load_plan.LOG).orderBy("load_id").collect()] == ["extract-1", "extract-2", "extract-3"]
    rows = {(r["base_fare_bdt"], r["is_active"]) for r in ledger.read(load_plan.BRONZE).collect()}
    assert rows == {(1.0, False), (2.0, False), *((float(v), True) for v in range(3, 8))}


def loaded(ledger, name, incoming, at, mode=None):
    commit = ledger.begin()
    stats = incremental.load_into(commit, name, incoming, at, mode)
    commit.finish()
    return stats


def files_of(ledger, name):
    """Each bucket of the active rows with the files that hold them."""
    out = {}
    for p in ledger.state()["tables"][name]["parts"]:
        out.setdefault((p["split"], p["bucket"]), set()).add(p["path"])
    return out


def test_a_load_writes_only_the_buckets_it_changes(spark, make):
    ledger = Ledger(spark, new_path(spark, "buckets"))
    loaded(ledger, "bronze", fares(make, *range(200)), T0)
    before = files_of(ledger, "bronze")
    assert len(before) == 8
    stats = loaded(ledger, "bronze", fares(make, *range(1, 201)), T1)  # one row goes, one comes
    assert (stats["records_inserted"], stats["records_deleted"], stats["load_type"]) == (1, 1, "INCREMENTAL")
    after = files_of(ledger, "bronze")
    kept = [k for k in before if before[k] <= after[k]]
    assert len(kept) == 7 and sum(k[0] == incremental.PAST for k in after) == 1
    want = incremental.apply_incremental(fares(make, *range(1, 201)), incremental.apply_full(fares(make, *range(200)), T0), T1)
    columns = ["record_hash", "is_active", "ingestion_timestamp", "base_fare_bdt"]
    assert sorted(map(str, ledger.read("bronze").select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    same = loaded(ledger, "bronze", fares(make, *range(1, 201)), T2)
    assert same["records_unchanged"] == 200 and {k: v for k, v in files_of(ledger, "bronze").items() if k[0] == "past"} == {k: v for k, v in after.items() if k[0] == "past"}
    assert ledger.read("bronze", commit=1).count() == 200  # an older commit still reads
    gone = ledger.expire(keep=1)
    assert gone and ledger.commits() == [3] and ledger.read("bronze").count() == 201
    assert ledger.expire(keep=1) == []


def test_many_small_loads_are_merged(spark, make, monkeypatch):
    monkeypatch.setattr(ledger_module, "MAX_PARTS", 2)
    ledger = Ledger(spark, new_path(spark, "small"))
    for n in range(1, 6):
        loaded(ledger, "bronze", fares(make, *range(40 * n)), f"2025-01-0{n} 00:00:00", "INCREMENTAL")
        assert max(map(len, files_of(ledger, "bronze").values())) <= 4
    assert ledger.read("bronze").count() == 200


def test_two_writers_cannot_make_one_commit(spark):
    ledger = Ledger(spark, new_path(spark, "two"))
    first, second = ledger.begin(), ledger.begin()
    first.overwrite("a", spark.range(3))
    second.overwrite("b", spark.range(4))
    first.finish()
    with pytest.raises(CommitExists):
        second.finish()
    assert ledger.exists("a") and not ledger.exists("b") and ledger.commits() == [1]


def test_a_history_writes_only_what_moves(spark):
    kind = "k string, avg_base_fare double, avg_total_fare double, booking_count bigint"
    checks = ["avg_base_fare"]

    def summary(*rows):
        return spark.createDataFrame([(k, v, v, 1) for k, v in rows], kind)

    base = [(f"key-{i}", float(i)) for i in range(100)] + [(None, 5.0)]
    second = [(k, v + (k == "key-7")) for k, v in base if k != "key-9"] + [("new", 1.0)]
    for hard in (True, False):
        ledger = Ledger(spark, new_path(spark, "history"))
        commit = ledger.begin()
        scd.merge_into(commit, "h", summary(*base), "k", checks, T0)
        commit.finish()
        before = files_of(ledger, "h")
        commit = ledger.begin()
        scd.merge_into(commit, "h", summary(*second), "k", checks, T1, hard)
        commit.finish()
        after = files_of(ledger, "h")
        want = scd.scd2_merge(scd.scd2_start(summary(*base), "k", T0), summary(*second), "k", checks, T1, hard)
        assert sorted(map(str, ledger.read("h").select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert sum(before[k] <= after[k] for k in before) >= len(before) - 3


def test_audit(spark):
    rows = [("started", T0), ("completed", "2025-01-01 00:00:30")]
    log = None
    for i, (status, at) in enumerate(rows):
        import datetime as dt

        row = audit.audit_row(spark, i, "d", "r", "t", status, dt.datetime.fromisoformat(at), rows=5, metadata={"n": 1})
        log = row if log is None else log.unionByName(row)
    assert audit.audit_avg_duration(log).first()["avg_seconds"] == 30.0
    assert audit.audit_recent(log).first()["id"] == 1


def test_metadata(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    first = tables.dataset_metadata(df, "f.csv", 10, [], None, T0).first()
    import hashlib

    assert first["schema_hash"] == hashlib.sha256(b"a,b").hexdigest()
    assert (first["id"], first["previous_metadata_id"], first["schema_changed"]) == (1, None, False)


def test_a_load_into_an_empty_table_compares_no_hashes(spark, make, monkeypatch):
    want = incremental.change_stats(fares(make, 1, 1, 2), fares(make, 1).limit(0).withColumn("is_active", F.lit(True))).first().asDict()
    monkeypatch.setattr(incremental, "hash_status", lambda *_: 1 / 0)
    ledger = Ledger(spark, new_path(spark, "empty"))
    assert loaded(ledger, "none", fares(make, 1).limit(0), T0)["load_type"] == "NONE"
    assert loaded(ledger, "bronze", fares(make, 1, 1, 2), T0) == want and want["load_type"] == "FULL"
    assert ledger.read("bronze").count() == 3


def test_rows_that_stay_in_their_buckets_are_not_shuffled(spark, make, monkeypatch):
    dealt, append = {}, ledger_module.Commit.append

    def noted(self, name, df, split="", deal=True):
        dealt.setdefault(split, []).append(deal)
        return append(self, name, df, split, deal)

    monkeypatch.setattr(ledger_module.Commit, "append", noted)
    ledgers = [Ledger(spark, new_path(spark, "stay")) for _ in range(3)]
    rows = []
    for ledger, most, parts in zip(ledgers, (100, 0, 100), (16, 16, 0), strict=True):
        dealt.clear()
        loaded(ledger, "bronze", fares(make, *range(60), 5), T0)
        assert dealt.pop("active") == [True]
        monkeypatch.setattr(incremental, "LOOKUP_ROWS", most)
        monkeypatch.setattr(ledger_module, "MAX_PARTS", parts)
        loaded(ledger, "bronze", fares(make, *range(6, 64)), T1, "INCREMENTAL")
        assert dealt["active"] == [most == 0 or parts == 0, True] and dealt["past"] == [True]
        rows.append(sorted(map(str, ledger.read("bronze").select("record_hash", "is_active", "ingestion_timestamp", "base_fare_bdt").collect())))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 65


def test_headers_are_found_without_a_pass_over_the_lines(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text("Airline,Source\nx,DAC\n")
    (tmp_path / "b 1.csv").write_text("﻿Airline,Source\r\ny,DAC\r\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(b"Source,Airline\nCXB,z\n"))
    groups = files._by_header(spark, str(tmp_path), {})
    slow = files._by_header(spark, str(tmp_path), {"lineSep": "\n"})  # the pass over all lines keeps the CR of a line
    assert [[f.rsplit("/", 1)[1] for f in g] for g in groups] == [["a.csv", "b 1.csv"], ["c.csv.gz"]]
    assert sum(map(len, slow)) == sum(map(len, groups)) == 3
    context = spark.sparkContext
    context.setJobGroup("headers", "headers")
    try:
        files._by_header(spark, str(tmp_path), {})
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup("headers")
    assert sorted(r["Airline"] for r in files.scan_csv(spark, str(tmp_path)).collect()) == ["x", "y", "z"]


def test_the_rows_of_a_file_are_counted_once(spark, make):
    counted = spark.createDataFrame([(7,)], "row_count bigint")
    first = tables.dataset_metadata(fares(make, 1), "f.csv", 10, [], None, T0, counted)
    assert first.first()["row_count"] == 7
    assert tables.dataset_metadata(fares(make, 1), "f.csv", 10, [], first, T1).select("id", "row_count").first() == (2, 1)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = materialize(spark.range(1000).repartition(3, "id"), "shuffled")
    Ledger(spark, new_path(spark, "freed")).overwrite("a", spark.range(1000).repartition(3, "id"))
    until = time.monotonic() + 20  # the files go in the background
    while shuffle_files(spark) > before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    discard(rows)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|not exist"):
        rows.collect()


def test_rows_of_a_few_gb_are_not_shuffled_by_bucket(spark, make, monkeypatch):
    extracts = [materialize(fares(make, *keys), "extract") for keys in ((*range(60), 5), range(6, 64))]
    rows, dealt, frame = [], [], type(extracts[0])
    monkeypatch.setattr(frame, "hint", lambda self, name, *a, hint=frame.hint: (dealt.append(name), hint(self, name, *a))[1])
    for size in (ledger_module.TASK_BYTES, 1, 0):  # too small, a few GB, too large
        monkeypatch.setattr(ledger_module, "TASK_BYTES", size)
        ledger = Ledger(spark, new_path(spark, "undealt"))
        dealt.clear()
        monkeypatch.setattr(ledger_module, "MAX_TASKS", 1 << 30 if size else 0)
        loaded(ledger, "bronze", extracts[0], T0)
        loaded(ledger, "bronze", extracts[1], T1, "INCREMENTAL")
        assert ("rebalance" in dealt) == (size != 1)
        rows.append(sorted(map(str, ledger.read("bronze").select("record_hash", "is_active", "ingestion_timestamp", "base_fare_bdt").collect())))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 65


def test_a_load_removes_its_table_of_hashes(spark, make, monkeypatch):
    made = []
    monkeypatch.setattr(incremental, "materialize", lambda df, name: made.append(materialize(df, name)) or made[-1])
    ledger = Ledger(spark, new_path(spark, "hashes"))
    loaded(ledger, "bronze", fares(make, 1, 2), T0)
    assert loaded(ledger, "bronze", fares(make, 2, 3), T1, "INCREMENTAL")["records_unchanged"] == 1
    paths = [spark._jvm.org.apache.hadoop.fs.Path(root) for df in made for root in tables.table_roots(df)]
    assert len(paths) == 1 and not paths[0].getFileSystem(spark._jsc.hadoopConfiguration()).exists(paths[0])


def test_dropped_extracts_are_compressed_and_need_the_valid_rows_alone(spark, make, monkeypatch):
    seen, when = [], dt.datetime(1999, 3, 4, 10)
    rows = make(*[{"id": f"{i}", "base_fare_bdt": 100.0 + i, "departure_datetime": when, "arrival_datetime": when} for i in range(40)])
    monkeypatch.setattr(inputs, "checked", lambda *_: validate_rows(rows))
    monkeypatch.setattr(queries.ingest, "announce", lambda spark, drop, extract, f=queries.ingest.announce: (seen.append(f"{drop}/{extract}"), f(spark, drop, extract)))
    monkeypatch.setattr(inputs, "validated", lambda *_: 1 / 0)
    assert queries.QUERIES["stream_ingest"](spark, "rows of the test").count() == 40
    files = [f for path in seen for f in spark.read.text(path).inputFiles()]
    assert len(seen) == 2 and len(files) >= 6 and all(f.endswith(".csv.gz") for f in files)
