"""Every registered query with SQL gives the same rows as DuckDB; the others give rows."""

import pytest

from checks.catalog import QUERIES
from checks.compare import connect, differences
from checks.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_only_model_fits_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {
        "ar_forecast", "arma_forecast", "arma_kept", "gbt_forecast", "feature_importance", "predict_next"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, db, name):
    mine, theirs, diff = differences(spark, db, name, SF_DIR)
    assert diff == 0 and mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
