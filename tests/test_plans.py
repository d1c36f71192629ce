"""Plan-shape checks: the scale properties the design relies on."""

import re

import pytest

from contrail.operators import airports as ap
from contrail.operators import gold, reports
from contrail.operators.features import build_features
from contrail.operators.silver import clean_ranges, to_silver
from contrail.session import materialize
from contrail.sources import testdata

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return to_silver(materialize(testdata.bronze(spark, SF), "bronze"))


def test_filters_and_columns_reach_the_scan(silver):
    p = plan(reports.country_stats_top(silver))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", p).group(1)
    for f in ("IsNotNull(icao24)", "IsNotNull(latitude)", "IsNotNull(longitude)", "IsNotNull(origin_country)"):
        assert f in pushed
    read = re.search(r"FileScan parquet \[([^\]]*)\]", p).group(1)
    assert "callsign" not in read and "squawk" not in read           # pruned columns
    assert "TakeOrderedAndProject" in p                                # top-k, not a full sort


def static_plan(spark, build) -> str:
    """The plan without run-time re-planning, in which reused exchanges are written out."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_feature_build_has_one_exchange_by_aircraft_and_chunk(spark, silver):
    p = static_plan(spark, lambda: build_features(clean_ranges(silver), testdata.airports(spark, SF)))
    by_chunk = [line for line in p.splitlines() if re.search(r"(?<!Reused)Exchange hashpartitioning\(icao24#\d+, _chunk", line) and "ReusedExchange" not in line]
    # the data, once; the halo rows; the other branches read the first again
    assert len(by_chunk) == 2 and len(re.findall(r"ReusedExchange .*hashpartitioning\(icao24#\d+, _chunk", p)) == 2
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_copies_are_counted_before_any_exchange(spark, silver):
    """Copies of a row leave a task as one row with a count: the exchange above the scan is fed by a partial count over all columns."""
    p = static_plan(spark, lambda: build_features(clean_ranges(silver), testdata.airports(spark, SF)))
    lines = p.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    above = [re.sub(r"^[\s:+\-*()\d]+", "", line) for line in lines[:scan]]
    first = max(i for i, line in enumerate(above) if line.startswith("Exchange"))
    assert any(line.startswith("HashAggregate") and "partial_count(1)" in line and "event_timestamp" in line for line in above[first:])


def test_many_copies_of_one_observation(spark, silver):
    """200 000 copies: every one is in the result, none but a few went through the windows."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from contrail.operators.features import count_copies

    clean = clean_ranges(silver).filter("icao24 in (select min(icao24) from values ('1') as t(icao24))")
    one = clean.orderBy("event_timestamp").limit(1)
    copied = clean.unionByName(one.crossJoin(spark.range(200_000)).drop("id"))
    airports = testdata.airports(spark, SF)
    out = build_features(copied, airports)
    assert out.count() == build_features(clean, airports).count() + 200_000
    assert count_copies(copied).count() <= clean.count() + 6
    few = clean.unionByName(one.crossJoin(spark.range(9)).drop("id"))
    order = ["event_timestamp", *[c for c in few.columns if c not in ("icao24", "event_timestamp")]]
    w = Window.partitionBy("icao24").orderBy(*order)
    want = few.select("event_timestamp", F.lag("altitude_meters").over(w).alias("prev_altitude"), F.row_number().over(w).alias("observation_rank"))
    got = build_features(few, airports, chunk="1 hour").select("event_timestamp", "prev_altitude", "observation_rank").distinct()
    assert sorted(got.collect(), key=str) == sorted(want.distinct().collect(), key=str)


def test_date_layout_prunes_partitions(spark, silver, tmp_dir):
    from datetime import datetime

    from contrail.sources.tables import read_gold, read_silver, write_dated

    write_dated(silver, f"{tmp_dir}/silver")
    p = plan(read_silver(spark, f"{tmp_dir}/silver", since=datetime(2024, 1, 20), until=datetime(2024, 1, 22)))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ >= 2024-01-20[^\]]*event_date#\d+ <= 2024-01-22", p)
    stats = gold.country_stats(clean_ranges(silver))
    write_dated(stats, f"{tmp_dir}/gold")
    recent = read_gold(spark, f"{tmp_dir}/gold", since=datetime(2024, 1, 20))
    assert re.search(r"PartitionFilters: \[[^\]]*window_date#\d+ >= 2024-01-20", plan(recent))
    assert recent.columns == stats.columns
    assert recent.count() == stats.filter("window_start >= timestamp'2024-01-20'").count() > 0


def test_overwrite_replaces_only_its_dates(spark, silver, tmp_dir):
    from contrail.sources.tables import read_silver, write_dated

    write_dated(silver, tmp_dir + "/t")
    day = silver.filter("to_date(event_timestamp) = date'2024-01-05'")
    write_dated(day.limit(1), tmp_dir + "/t", mode="overwrite")
    assert read_silver(spark, tmp_dir + "/t").count() == silver.count() - day.count() + 1


def test_nearest_airport_has_no_cross_product(spark, silver):
    p = plan(ap.nearest_airport(clean_ranges(silver), testdata.airports(spark, SF)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_gold_aggregates_partially_before_the_shuffle(silver):
    p = plan(gold.country_anomalies(clean_ranges(silver).withColumn("flight_phase", silver["icao24"])))
    assert "partial_count" in p and "partial_stddev" in p
    assert "Expand" in p                                               # sliding window expansion


def test_rank_in_country_is_not_a_window_over_rows(silver):
    p = plan(reports.velocity_rank_in_country(silver))
    # the only window runs over the per-(country, speed) aggregate
    assert "partial_count" in p and p.count("Window [") == 1


def test_airborne_rows_stay_out_of_the_shuffle_form_of_the_join(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = static_plan(spark, lambda: build_features(clean_ranges(silver), testdata.airports(spark, SF), broadcast_max_cells=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = p.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin [_cx" in line]
    assert joins
    for i in joins:  # below the join's left side, rows not on the ground are filtered out
        assert any(re.search(r"Filter .*on_ground#\d+", line) and "NOT on_ground" not in line for line in lines[i:i + 12])


def test_standalone_enrichment_aggregates_ground_rows_only(spark, silver):
    p = static_plan(spark, lambda: ap.enrich_ground(clean_ranges(silver), testdata.airports(spark, SF)))
    assert "partial_min(_rmin" in p and "Window" not in p.split("Union")[1].split("partial_min")[0]
