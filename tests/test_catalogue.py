"""The registered queries against their SQL twins, and the plan of a scan."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalogue import queries
from fareloom.operators import models
from tools.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = (
    "validate_rows", "silver_clean", "gold_avg_fare_by_airline", "gold_popular_routes", "dq_report",
    "apply_incremental", "scd2_merge", "profile_columns", "rank_avg", "apply_full", "detect_changes", "route_history",
    "profile_increments", "train_test_split", "agg_percentile", "label_encode", "feature_matrix", "rename_snake",
)


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
def test_scan_is_pruned_and_filtered(spark):
    plan = entry.queries()["scan_table"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(total_fare_bdt,100000.0)" in plan
    assert "ReadSchema: struct<id:string,airline:string,route:string,total_fare_bdt:double>" in plan


def test_the_queries_fit_the_full_forest_and_boosting(spark, monkeypatch):
    """What the queries hand to Spark ML; the fits themselves are in the bench."""
    asked = {}

    class Asked(Exception):
        pass

    def fit(self, data, params=None):
        asked[type(self).__name__] = self
        raise Asked

    for kind in (models.RandomForestRegressor, models.GBTRegressor):
        monkeypatch.setattr(kind, "fit", fit)
    monkeypatch.setattr(queries, "_fitted", {})
    monkeypatch.setattr(queries, "_data", lambda spark, sf_dir: (spark.sql("SELECT 1D AS label, false AS is_test"), ["a"]))
    for name in ("train_rf", "train_gbt"):
        with pytest.raises(Asked):
            entry.queries()[name](spark, SF)
    forest, boosted = asked["RandomForestRegressor"], asked["GBTRegressor"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), boosted.getMaxIter(), boosted.getMaxDepth()) == (200, 15, 200, 5)
