"""Percentiles, ranks and modes against brute force; gold branches."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareloom.operators import gold, order_stats, profile
from fareloom.operators.incremental import to_bronze
from fareloom.operators.joins import hot_keys, salted_join
from fareloom.operators.silver import silver_clean
from fareloom.operators.validate import validate_rows

WANTED = {"p10": 0.1, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def check(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in order_stats.percentiles(df, ["k"], "v", WANTED).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in WANTED.items():
            assert got[k][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-9, abs=1e-9)


def skewed(n=3000):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", round(rng.lognormvariate(8, 2), 2)) for _ in range(n)]
    return [*rows, (None, 1.0), (None, 4.0), ("k1", None), ("neg", -5.0), ("neg", -0.1), ("neg", 0.0), ("same", 2.0), ("same", 2.0)]


def test_percentiles(spark):
    check(spark, skewed())


def test_percentiles_with_many_groups(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "TARGET_ROWS", 0)  # too many for a broadcast
    check(spark, skewed())


@pytest.mark.parametrize("most", [1, 200_000])
def test_a_bucket_of_very_many_values_is_split(spark, monkeypatch, most):
    """10^6 distinct doubles within one bucket of 0.1 %, another group beside it, and equal values in the middle."""
    monkeypatch.setattr(order_stats, "TARGET_ROWS", most)
    monkeypatch.setattr(order_stats, "BUCKET_ROWS", 5000)
    n = 1_000_000
    close = spark.range(n).selectExpr("'a' AS k", "1000D + (id * 7919 % 1000000) * 1e-9 AS v")
    df = close.unionByName(spark.range(50_000).selectExpr("'a' AS k", "1000.0005D AS v")).unionByName(spark.range(9).selectExpr("'b' AS k", "CAST(id AS double) AS v"))
    got = {r["k"]: r for r in order_stats.percentiles(df, ["k"], "v", WANTED).collect()}
    a = np.concatenate((1000 + np.arange(n) * 1e-9, np.full(50_000, 1000.0005)))
    for name, p in WANTED.items():
        assert got["a"][name] == pytest.approx(np.percentile(a, p * 100), rel=1e-14)
        assert got["b"][name] == np.percentile(np.arange(9), p * 100)


def test_ranks_within_a_bucket_of_very_many_values(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "TARGET_ROWS", 1)
    monkeypatch.setattr(order_stats, "BUCKET_ROWS", 500)
    n = 100_000
    df = spark.range(n).selectExpr("id", "1000D + (id * 7919 % 100000) div 2 * 1e-8 AS v").unionByName(spark.range(5).selectExpr("-1 - id AS id", "-2000D - id AS v"))
    got = order_stats.with_rank(df, "v", "r", "average")
    place = "(id * 7919 % 100000) div 2"
    assert got.where(f"id >= 0 AND r <> 100000 - 2 * ({place}) - 0.5").isEmpty()
    assert sorted(r["r"] for r in got.where("id < 0").collect()) == [n + k for k in range(1, 6)]
    assert order_stats.rank_table(df, "v").agg(F.max("dense")).first()[0] == n // 2 + 5


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_percentiles_of_any_values(spark, values):
    check(spark, [("a", float(v)) for v in values])


def test_ranks(spark):
    values = [5.0, 5.0, 9.0, -1.0, 0.0, 0.0, 0.0, 2.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    expected_min = {v: 1 + sum(x > v for x in values) for v in values}
    expected_avg = {v: expected_min[v] + (values.count(v) - 1) / 2 for v in values}
    for r in order_stats.with_rank(df, "v", "r").collect():
        assert r["r"] == expected_min[r["v"]]
    for r in order_stats.with_rank(df, "v", "r", "average").collect():
        assert r["r"] == expected_avg[r["v"]]
    counts = df.select("id", F.col("v").cast("bigint").alias("v"))
    got = order_stats.with_rank(counts, "v", "r", counts=True).where("id = 7").first()
    assert got["r"] == 1 + sum(int(x) > 2 for x in values)


def test_bucket_order_and_limit(spark):
    values = sorted([-1e300, -5.5, -5.4999, -1e-9, 0.0, 1e-12, 0.5, 3.0, 3.0000001, 1e12, 1.7e308])
    df = spark.createDataFrame([(v,) for v in values], "v double").selectExpr("v", f"{order_stats.order_bucket('v')} AS b")
    buckets = [r["b"] for r in df.orderBy("v").collect()]
    assert buckets == sorted(buckets)
    assert max(buckets) - min(buckets) < order_stats.bucket_limit()


def test_mode_tie(spark):
    df = spark.createDataFrame([("r", "b"), ("r", "a"), ("r", "b"), ("r", "a"), ("r", None), ("r", None), ("r", None)], "k string, v string")
    assert order_stats.modes(df, ["k"], "v", "m").first()["m"] == "a"


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 90) END AS k")
    right = spark.range(40).selectExpr("concat('k', id) AS k", "id * 2 AS w").unionByName(spark.range(1).selectExpr("'hot' AS k", "7L AS w"))
    if how in ("left_semi", "left_anti"):
        right = right.select("k")
    want = sorted(map(str, left.join(right, "k", how).select(*(["id", "k"] if "left_" in how else ["id", "k", "w"])).collect()))
    out = salted_join(left, right, "k", "id", how)
    got = sorted(map(str, out.select(*(["id", "k"] if "left_" in how else ["id", "k", "w"])).collect()))
    assert got == want
    assert hot_keys(left, "k").count() <= 1000


def silver(make, *rows):
    return silver_clean(to_bronze(validate_rows(make(*rows)), "2025-01-01 00:00:00"), loaded_at="2025-01-01 00:00:00")


def test_gold_single_row_group(make):
    row = gold.gold_avg_fare_by_airline(silver(make, {})).first()
    assert row["fare_std_dev"] is None and row["peak_premium_pct"] is None
    assert row["market_share_pct"] == 100.0 and row["off_peak_bookings"] == 1


def test_seasonal_without_and_with_two_regulars(make):
    only_peak = gold.gold_seasonal_fare_analysis(silver(make, {"seasonality": "Eid"})).collect()
    assert len(only_peak) == 1 and only_peak[0]["pct_diff_from_regular"] is None
    rows = silver(
        make, {"seasonality": "REGULAR", "total_fare_bdt": 1000.0}, {"seasonality": "Regular", "total_fare_bdt": 2000.0},
        {"seasonality": "Eid", "total_fare_bdt": 1500.0},
    )
    got = {r["seasonality"]: r["pct_diff_from_regular"] for r in gold.gold_seasonal_fare_analysis(rows).collect()}
    assert got == {"REGULAR": 0.0, "Regular": 100.0, "Eid": 50.0}


def test_routes_mode_and_rank_ties(make):
    rows = silver(
        make, {"airline": "b"}, {"airline": "a"}, {"source_code": "ABC", "airline": "z"}, {"source_code": "ABC", "airline": "y"},
        {"source_code": "XYZ"},
    )
    got = {r["route"]: r for r in gold.gold_popular_routes(rows).collect()}
    assert got["DAC-CXB"]["most_common_airline"] == "A" and got["ABC-CXB"]["most_common_airline"] == "Y"
    assert [got[r]["popularity_rank"] for r in ("DAC-CXB", "ABC-CXB", "XYZ-CXB")] == [1, 1, 3]


def test_impute_and_histogram(spark):
    df = spark.createDataFrame([(1.0, "a", None), (None, None, None), (4.0, "b", None), (2.0, "b", None)], "x double, c string, e double")
    filled = profile.impute_mode(profile.impute_median(df, ["x", "e"]), ["c"]).collect()
    assert [r["x"] for r in filled] == [1.0, 2.0, 4.0, 2.0]
    assert {r["e"] for r in filled} == {0.0} and filled[1]["c"] == "b"
    flat = profile.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert sum(r["n"] for r in flat) == 2 and len(flat) == 4
    exact = {r["column_name"]: r["unique_values"] for r in profile.profile_columns(df).collect()}
    about = {r["column_name"]: r["unique_values"] for r in profile.profile_columns(df, approximate=True).collect()}
    assert exact == about == {"x": 3, "c": 2, "e": 0}


def test_top_n_is_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("CAST(id % 9 AS string) AS c")
    plan = profile.value_counts_topn(df, ["c"], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_sketches_of_parts_are_those_of_the_whole(spark):
    from fareloom.operators import sketches

    df = spark.range(200_000).selectExpr(
        "id", "id * 7919 % 50021 AS many", "CAST(id % 7 AS string) AS few", "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 101 = 0 THEN CAST('NaN' AS double) ELSE exp(id % 1000 / 100D) END AS skewed",
        "CAST(NULL AS double) AS nothing",
    )
    parts = [df.where(f"id % 3 = {k}") for k in range(3)]
    whole, merged = ({r["column_name"]: r for r in sketches.profile(s).collect()} for s in (sketches.sketch(df), sketches.merged(*map(sketches.sketch, parts))))
    exact = {"id": 200_000, "many": 50_021, "few": 7, "nothing": 0}
    for name in df.columns:
        a, b = whole[name], merged[name]
        for part in ("row_count", "null_count", "null_pct", "least", "greatest"):
            assert a[part] == b[part]
        assert a["unique_values"] == b["unique_values"] == pytest.approx(exact.get(name, a["unique_values"]), rel=0.04)
    assert merged["nothing"]["q50"] is None and merged["few"]["q50"] is None and merged["skewed"]["null_count"] == 50_000
    values = np.sort([r["skewed"] for r in df.where("skewed IS NOT NULL AND NOT isnan(skewed)").select("skewed").collect()])
    for name, p in sketches.QUARTILES.items():
        for got in (whole, merged):
            low, high = np.searchsorted(values, got["skewed"][name], "left") / len(values), np.searchsorted(values, got["skewed"][name], "right") / len(values)
            assert low - 2 * sketches.RANK_ERROR <= p <= high + 2 * sketches.RANK_ERROR
