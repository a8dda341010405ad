"""Every registered query against its SQL twin, on the smallest tables."""

import os
import sys

import pytest

import __spark_entry__ as driver

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import difference, open_tables  # noqa: E402
from venuerank.operators import recommend  # noqa: E402
from venuerank.plans.gold import gold  # noqa: E402
from venuerank.plans.oracles import ORACLES  # noqa: E402
from venuerank.plans.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# their rows are made by the driver from a fitted model's figures
PLANLESS = {"als_rank_sweep", "als_grid_search"}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_registry():
    assert set(QUERIES) <= set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    """Rows equal SQL's; the plan holds no Python and no products."""
    found = driver.queries()[name](spark, FOLDER)
    if name not in PLANLESS:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not [n for n in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval") if n in plan]
    ours = found.toPandas()
    assert len(ours) > 0
    assert difference(ours, tables.execute(driver.oracle_sql()[name]).df()) is None


def test_figures_of_the_model(spark):
    tables = gold(spark, FOLDER)
    assert 0 < recommend.rmse_table(tables.test_predictions, "stars", "prediction").first()["rmse"] < 2.5
    ranks = tables.model_recommendations.toPandas().groupby("user_id")["rank"]
    assert ranks.apply(lambda r: sorted(r) == list(range(1, 11))).all()
