"""Quality rules on injected violations, suite JSON round trip, ledger."""
import datetime as dt
import tempfile

from tramline.operators import quality as Q
from tramline.operators.cleaning import silver_with_summary

TS = dt.datetime(2024, 1, 1, 8)


def _tu(spark):
    return spark.createDataFrame([
        ("T1", "S1", 30.0, "ON_TIME"), ("T2", None, 40000.0, "LATE"), (None, "S3", None, None),
        ("T4", "S4", -4000.0, "EARLY")], "trip_id string, stop_id string, delay_seconds double, status string")


def test_rules_count_violations_in_one_pass(spark):
    res = {r["rule_index"]: r for r in Q.validate(_tu(spark), "trip_updates", Q.silver_suites()["trip_updates"]).collect()}
    assert [res[i]["unexpected_count"] for i in range(5)] == [1, 1, 1, 2, 1]
    assert all(res[i]["element_count"] == 4 for i in range(5))
    assert not any(res[i]["success"] for i in range(5))


def test_schema_rules(spark):
    df = spark.createDataFrame([(1.0, "x")], "lat double, b string")
    rules = [Q.Rule(Q.ORDERED, {"column_list": ["lat", "b"]}), Q.Rule(Q.ORDERED, {"column_list": ["b", "lat"]}),
             Q.Rule(Q.OF_TYPE, {"column": "lat", "type_": "float64"}), Q.Rule(Q.OF_TYPE, {"column": "b", "type_": "float64"})]
    got = [r["success"] for r in Q.validate(df, "t", rules).orderBy("rule_index").collect()]
    assert got == [True, False, True, False]


def test_suite_json_round_trip():
    rules = Q.silver_suites()["transport_positions"]
    name, back = Q.suite_from_json(Q.suite_to_json("transport_positions", rules))
    assert name == "transport_positions" and [(r.type, r.kwargs) for r in back] == [(r.type, r.kwargs) for r in rules]


def test_summary_and_ledger(spark):
    res = Q.validate(_tu(spark), "trip_updates", Q.silver_suites()["trip_updates"])
    s = Q.summarize(res, run_at=TS).first()
    assert (s["success"], s["expectations_passed"], s["expectations_total"], s["row_count"]) == (False, 0, 5, 4)
    assert len(s["failed_expectations"]) == 5
    path = tempfile.mkdtemp(prefix="tramline-ledger-") + "/runs"
    Q.append_runs(Q.summarize(res, run_at=TS), path)
    Q.append_runs(Q.summarize(res, run_at=TS + dt.timedelta(hours=1)), path)
    last = Q.last_runs(spark, path, 1).collect()
    assert len(last) == 1 and last[0]["run_at_utc"] == TS + dt.timedelta(hours=1)


def test_greater_or_equal_zero_and_accepted_values(spark):
    df = spark.createDataFrame([(-1.0, 25), (3.0, 5), (None, None)], "p double, h int")
    rules = [Q.Rule(Q.GE_ZERO, {"column": "p"}), Q.Rule(Q.ACCEPTED, {"column": "h", "values": list(range(24))})]
    got = [r["unexpected_count"] for r in Q.validate(df, "m", rules).orderBy("rule_index").collect()]
    assert got == [1, 1]


def test_silver_summary_observed_in_one_pass(spark):
    from tramline.sources.fixtures import Fixture
    fx = Fixture(spark, "/root/testdata/sf0.001")
    bronze = fx.trip_updates()
    out, obs_in, obs_out = silver_with_summary("trip_updates", bronze)
    out.write.format("noop").mode("overwrite").save()
    n_in, got = bronze.count(), obs_out.get
    assert obs_in.get["rows_in"] == n_in
    assert got["rows_out"] == n_in  # keys are unique in the fixture, trip ids never NULL
    assert got["rows_valid"] == out.where("dqr_valid").count()
