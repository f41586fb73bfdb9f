import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from cityviews import schemas as S
from cityviews.operators.shape import explode_entities
from cityviews.plans import table_feeds as feeds
from cityviews.plans.driver_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_on_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_every_event_reports_two_stations(spark, sf):
    events = feeds.events(spark, f"/root/testdata/sf{sf}")
    found = explode_entities(feeds.status_feed(events), "data.stations", ["station_id"])
    assert found.count() == 2 * events.count()


def test_the_slices_of_a_vector_reach_its_last_number():
    starts = [feeds.metric_start(j) for j in range(len(S.WEATHER_HOURLY_METRICS))]
    assert {x for s in starts for x in range(s, s + 24)} == set(range(1, 65))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
