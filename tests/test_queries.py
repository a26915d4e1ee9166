"""A spread of registered queries against DuckDB at the smallest scale factor.

``python -m checks.compare --sf 0.01`` runs all of them.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = ["silver_casts", "stg_piezo_stations", "stg_hydrometry_obs_elab", "piezo_chroniques_rejected",
          "hourly_to_daily", "nearest_cell_any_distance", "smallest_polygon", "entity_match",
          "percentile_vectors", "rolling_and_lagged", "replace_range_partition",
          "incremental_staging", "merge_best_entities", "stream_keep_best", "stream_late_rows",
          "fct_era5_monthly_grid", "glo_fit", "code_lists", "key_batches", "check_relationships"]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_registry_is_consistent():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(registry.QUERIES) <= set(oracles)
    assert len(queries) > 120


def test_flagship(spark):
    df = entry.entry(spark)
    assert "niveau_moy_mobile_12m" in df.columns and df.count() > 0


def test_contract_parsing():
    assert registry.parse("s a b; f x; l n") == [("a", "s"), ("b", "s"), ("x", "f"), ("n", "l")]
