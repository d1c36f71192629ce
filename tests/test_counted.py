"""The feature build before its copies and tied airports are written out: same rows, and work that does not grow with them."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contrail.operators import airports as ap
from contrail.operators import classify as ML
from contrail.operators import reports as RP
from contrail.operators.features import (build_features, counted_features, restore_ties, rolling_features, temporal_features)

AIRPORT = "airport_icao string, airport_name string, airport_country string, airport_lat double, airport_lon double"


@pytest.fixture(scope="module")
def airports(spark):
    rows = [(f"A{i:02d}", f"n{i}", "c", 0.0, 1.0) for i in range(20)] + [(f"B{i}", "n", "c", 0.0, -1.0) for i in range(4)]
    return spark.createDataFrame(rows, AIRPORT)


@pytest.fixture(scope="module")
def clean(spark):
    rows = [("t", 10 * i, 0.0, 0.0 if i % 3 else 1.0, i % 2 == 0, float(100 * i * i), 7.0 * i) for i in range(12)]
    rows += [("t", 33, 0.0, 0.0, True, 50.0, 3.0)] * 3 + [("t", 55, 0.0, 1.0, True, 70.0, 3.0)] * 9 + [("u", 1, 5.0, 5.0, False, None, None)]
    return (spark.createDataFrame(rows, "icao24 string, t long, latitude float, longitude float, on_ground boolean, "
                                        "altitude_meters float, velocity_kmh double")
            .select(F.timestamp_seconds("t").alias("event_timestamp"), "icao24", F.lit("C").alias("callsign"),
                    F.lit("X").alias("origin_country"), "longitude", "latitude", "velocity_kmh", "altitude_meters", "on_ground",
                    F.lit(1).alias("category")))


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_weights_count_every_row(clean, airports):
    counted = counted_features(clean, airports)
    assert counted.rows.count() < build_features(clean, airports).count() == counted.rows.agg(F.sum(counted.weight())).first()[0]


def test_a_change_before_the_rows_are_written_out(clean, airports):
    counted = counted_features(clean, airports)
    change = lambda d: d.withColumn("rolling_avg_altitude", F.round("rolling_avg_altitude", 2))
    want = _rows(change(build_features(clean, airports)))
    assert _rows(counted.each(change).restored()) == want == _rows(counted.each(change).staged().restored())


def test_partitions_grow_with_the_rows(spark, clean, airports):
    """A task sorts a bounded number of rows: beyond what the cores take, the partitions are counted from the input."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = counted_features(clean, airports, task_rows=3).rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    dealt = re.findall(r"Exchange hashpartitioning\(icao24#\d+, _chunk#\d+L, (\d+)\)", many)
    assert set(dealt) == {"9"} and ", 9), REPARTITION_BY_NUM" in many  # 25 rows; no join deals them again
    assert _rows(counted_features(clean, airports, task_rows=3).restored()) == _rows(build_features(clean, airports))


def test_weighted_reports(clean, airports):
    counted = counted_features(clean, airports).staged()
    every = build_features(clean, airports)
    columns = ("altitude_meters", "velocity_kmh", "altitude_change", "rolling_avg_altitude")
    near = lambda df: {tuple(r)[:-1]: r[-1] for r in df.collect()}
    got, want = near(RP.correlation_matrix(counted.rows, columns, counted.weight())), near(RP.correlation_matrix(every, columns))
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 16
    got = RP.density(counted.rows, "altitude_meters", weight=counted.weight()).select("point", "x", "density")
    want = RP.density(every, "altitude_meters").select("point", "x", "density")
    assert near(got.drop("x")) == pytest.approx(near(want.drop("x")), rel=1e-9) and got.count() == 200


def test_density_of_equal_values_is_empty(spark):
    assert RP.density(spark.range(5).select(F.lit(0.1).alias("v")), "v").count() == 0


def test_rolling_over_the_first_airports(clean, airports):
    """Further airports of an observation join after the windows; the rows are those of the plain steps."""
    temporal = temporal_features(clean).drop("_chunk")
    columns = ("icao24", "event_timestamp", "airport_icao", "rolling_avg_altitude", "rolling_std_altitude", "rolling_avg_velocity")
    want = _rows(rolling_features(ap.enrich_ground(temporal, airports)).select(*columns))
    for bound in (ap.BROADCAST_MAX_CELLS, 0):
        heads, ranked, small = ap.enrich_ground_heads(temporal, airports, bound)
        assert heads.count() < sum(want.values())
        assert _rows(restore_ties(rolling_features(heads).select(*columns, "_rest"), ranked, small)) == want


def test_metrics_of_counted_pairs(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    pairs = spark.createDataFrame([(0.0, 0.0)] * 7 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 4 + [(2.0, 0.0)], "label double, prediction double")
    got = ML.evaluate(pairs).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert (got.accuracy, got.f1) == pytest.approx((ev.evaluate(pairs, {ev.metricName: "accuracy"}), ev.evaluate(pairs, {ev.metricName: "f1"})))


def test_event_properties_are_parsed_once(spark, tmp_dir):
    """Filters on the altitude do not parse the properties' text again."""
    from contrail.plans.registry import clean as cleaned

    spark.createDataFrame([(1, 1, "error", 2.0, '{"k": 9}'), (2, 1, "view", 3.0, None), (3, 1, "view", 3.0, '{"k": 50}')],
                          "event_id long, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.lit("2024-01-01 00:00:01").cast("timestamp_ntz")).write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_dir}/nation.parquet")
    out = cleaned(spark, tmp_dir)
    assert [r.altitude_meters for r in out.collect()] == [840.0]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def test_aircraft_that_are_not_cut(spark, clean, airports):
    """Only aircraft above a number of rows are cut; any number gives the same rows, and with none cut nothing is put in front of chunks."""
    want = _rows(build_features(clean, airports))
    for whole_rows in (1, 10, 1000):        # both cut but the single row; one cut; none
        assert _rows(build_features(clean, airports, chunk="20 seconds", whole_rows=whole_rows)) == want
    plan = lambda n: counted_features(clean, airports, whole_rows=n).rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_back" in plan(0) and "_back" in plan(10) and "_back" not in plan(1000)


def test_aircraft_that_are_not_cut_go_on_from_carried_state(spark, clean, airports):
    from contrail.operators.carry import next_carry

    early, late = clean.filter("event_timestamp < timestamp_seconds(50)"), clean.filter("event_timestamp >= timestamp_seconds(50)")
    first = counted_features(early, airports, whole_rows=1000).staged()
    carry = next_carry(early, first.rows).cache()
    want = _rows(build_features(clean, airports).filter("event_timestamp >= timestamp_seconds(50)"))
    for whole_rows in (0, 1, 1000):
        assert _rows(build_features(late, airports, chunk="20 seconds", carry=carry, whole_rows=whole_rows)) == want


def test_too_many_cut_aircraft_are_not_broadcast(clean, airports, monkeypatch):
    from contrail.operators import features

    monkeypatch.setattr(features, "BROADCAST_MAX_CUT", 0)
    assert _rows(build_features(clean, airports, whole_rows=10)) == _rows(build_features(clean, airports))


def test_weighted_gold(spark, clean, airports):
    from contrail.operators import gold

    counted = counted_features(clean, airports).staged()
    some = counted.rows.withColumn("rows", counted.weight())
    every = build_features(clean, airports)
    assert some.count() < every.count()
    for table, params in ((gold.phase_stats, {}), (gold.country_stats, {"window": "20 seconds"}),
                          (gold.country_anomalies, {"window": "30 seconds", "slide": "10 seconds"})):
        got, want = (sorted(map(tuple, d.collect()), key=lambda r: str(r[:3])) for d in (table(some, weight="rows", **params), table(every, **params)))
        assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) > 1
        for g, w in zip(got, want):
            assert [v is None for v in g] == [v is None for v in w]
            assert [v or 0 for v in g[3:]] == pytest.approx([v or 0 for v in w[3:]], rel=1e-12)


def test_weighted_deviation(spark):
    """Of equal values exactly 0, of one row NULL, of no values NULL."""
    from contrail.operators import gold

    rows = spark.createDataFrame([("a", 812.37, 2.0, 30), ("a", 812.37, None, 7), ("b", 812.37, None, 1), ("c", 0.1, 1.0, 2), ("c", 0.2, None, 1)],
                                 "origin_country string, velocity_kmh double, altitude_meters float, rows long")
    out = gold.country_anomalies(rows.withColumn("event_timestamp", F.timestamp_seconds(F.lit(30))), "1 minute", "1 minute", weight="rows")
    got = {r.origin_country: (r.total_observations, r.stddev_velocity, r.stddev_altitude) for r in out.collect()}
    assert got["a"] == (37, 0.0, 0.0) and got["b"] == (1, None, None) and got["c"][::2] == (3, 0.0)
    assert got["c"][1] == pytest.approx((0.02 / 6) ** 0.5, rel=1e-9)


def test_gold_streams_read_counted_rows(spark, tmp_dir, monkeypatch):
    """The stream of a Gold query has one row for all copies of an observation from the 7th on, and the table counts them all."""
    from contrail.plans import registry

    events = spark.range(40).selectExpr("0L as event_id", "1L as user_id", "'click' as event_type", "2.0D as value", """'{"k": 9}' as props""",
                                        "timestamp_ntz'2024-01-01 00:00:01' as ts")
    last = spark.sql("""select 1L as event_id, 1L as user_id, 'click' as event_type, 2.0D as value, '{"k": 9}' as props, timestamp_ntz'2024-01-01 01:00:01' as ts""")
    events.withColumn("event_id", F.lit(1).cast("long")).unionByName(last).write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{tmp_dir}/nation.parquet")
    spark.createDataFrame([(1, "S", 1, 9000.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_dir}/supplier.parquet")
    seen, run = [], registry._run_stream
    monkeypatch.setattr(registry, "_run_stream", lambda s, source, *a: (seen.append(source.count()), run(s, source, *a))[1])
    got = {name: registry.QUERIES[name](spark, tmp_dir).collect() for name in ("stream_phase_stats", "stream_country_stats", "stream_country_anomalies")}
    assert seen == [7, 7, 7]
    assert [r.flight_count for r in got["stream_phase_stats"]] == [r.flight_count for r in got["stream_country_stats"]] == [40]
    assert [r.total_observations for r in got["stream_country_anomalies"]] == [40] * 5
