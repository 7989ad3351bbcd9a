"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from hazardloom.plans import compare
from hazardloom.plans.catalog import CATALOG

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
NAMES = ["survival_table", "km_by_stratum", "hazard_overall", "stratified_incidence", "horizon_targets", "carve_validation",
         "cox_fit_ridge", "cause_specific_fits", "fine_gray_weighted", "fine_gray_subdistribution", "andersen_gill_fit",
         "stratified_metrics", "calibration", "landmark_dynamic", "current_ltv", "macro_panel", "duration_convexity", "total_loss", "fitted_rate_response",
         "fitted_covariate_shock", "fitted_scenario_summary"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    q = CATALOG[name]
    assert compare.difference(q.run(spark, FOLDER).toArrow(), db.sql(q.sql).to_arrow_table(), tol=1.1e-6) is None


def test_registry_is_consistent():
    import __spark_entry__ as entry

    # the optional corpus queries come on top of the catalog
    assert set(CATALOG) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(n == "pipeline" or n.startswith("op") for n in set(entry.queries()) - set(CATALOG))


def test_labels_on_panel_reads_all_labels():
    assert "loan_key %" not in CATALOG["labels_on_panel"].sql
