"""Stored sketches, SQL table functions, tables stored by key."""
import tempfile

from pyspark.sql import functions as F

from tramline import registry
from tramline.plans.warehouse import Warehouse

from .conftest import SF_SMALL


def test_sketches_merge_to_any_range_of_dates(spark):
    from tramline.plans import sketches as S
    fact = Warehouse.from_fixture(spark, SF_SMALL).fct_without_events
    path = f"{tempfile.mkdtemp(prefix='tramline-sk-')}/days"
    S.store(fact.where("event_ts < '2024-01-20'"), path)
    S.store(fact.where("event_ts >= '2024-01-15' AND event_ts < '2024-01-25'"), path)  # replaces its own dates only
    qs = {"median_delay_seconds": 0.5, "p95_delay_seconds": 0.95}
    got = S.merged(spark, path, "2024-01-10", "2024-01-22", qs)
    part = fact.where("event_ts >= '2024-01-10' AND event_ts < '2024-01-23'")
    errors = S.errors(got, part, qs).collect()
    assert len(errors) == part.select("route_id", "route_mode").distinct().count() > 0
    for r in errors:
        assert r.sketched == r.observations and r.trips_error <= S.DISTINCT_ERROR
        assert max(r.median_delay_seconds_rank_error, r.p95_delay_seconds_rank_error) <= S.RANK_ERROR


def test_lists_bind_their_limit(spark):
    from tramline.functions.tables import register_lists
    mart = Warehouse.from_fixture(spark, SF_SMALL).mart_delay_trends
    register_lists(spark, {"mart_delay_trends": mart}, ["latest_trends"])
    for n in (3, 7):
        rows = spark.sql("SELECT * FROM latest_trends(:n) ORDER BY position", args={"n": n}).collect()
        assert [r.position for r in rows] == list(range(1, n + 1))
        assert [(r.service_date, r.hour_of_day) for r in rows] == sorted(((r.service_date, r.hour_of_day) for r in rows), reverse=True)
    assert spark.sql("SELECT count(*) FROM latest_trends(5) WHERE observations > 0").first()[0] == 5


def test_city_functions_know_the_catalog_only(spark):
    from tramline.functions.tables import register_city_functions
    catalog = spark.createDataFrame([("Here", 52.5, 13.4)], "name string, lat double, lon double")
    positions = spark.createDataFrame([("V1", "R", 52.5, 13.4), ("V2", "R", 52.6, 13.4), ("V3", "R", None, 13.4)],
                                      "vehicle_id string, route_id string, lat double, lon double").withColumn("event_ts", F.current_timestamp())
    register_city_functions(spark, catalog, positions)
    asked = lambda city, km: [r.vehicle_id for r in spark.sql(
        "SELECT * FROM positions_of_city(:c, :r) ORDER BY vehicle_id", args={"c": city, "r": km}).collect()]
    assert asked("Here", 5.0) == ["V1"] and asked("Here", 20.0) == ["V1", "V2"] and asked("Atlantis", 20.0) == []


def test_bucketed_tables_are_not_shuffled_on_the_trip(spark):
    """Neither the semi-join of trips nor the window over a trip's stops moves rows by trip_id."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if both tables were large; counted hints stay
    try:
        for df in registry._bucketed_city(spark, SF_SMALL):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan
            assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "trip_id" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
