"""Grid nearest-airport search against brute force (ties, duplicate keys,
points off the globe, sparse and dense airports)."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.operators import airports as ap
from contrail.operators.features import build_features


def _f32(x):
    return float(np.float32(x))


def _brute(obs, airports):
    out = Counter()
    groups = {}
    for o in obs:
        if o[4] is True:
            groups.setdefault((o[0], o[1]), []).append(o)
    for key, rows in groups.items():
        per = []
        for o in rows:
            d = [(math.sqrt((_f32(o[2]) - a[3]) * (_f32(o[2]) - a[3]) + (_f32(o[3]) - a[4]) * (_f32(o[3]) - a[4])), a[0])
                 for a in airports]
            per.append((o, min(x[0] for x in d) if d else None, d))
        if not airports:
            continue
        gmin = min(p[1] for p in per)
        for o, rmin, d in per:
            if rmin == gmin:
                for dist, name in d:
                    if dist == gmin:
                        out[(o[0], o[1], _f32(o[2]), _f32(o[3]), name)] += 1
    return out


def _case(seed, n_airports, spread):
    rnd = random.Random(seed)
    q = lambda lo, hi: rnd.randrange(int(lo * 4), int(hi * 4)) / 4.0  # quarter degrees -> exact ties
    airports = [(f"A{i}", f"Name{i}", "XX", q(-spread / 2, spread / 2), q(-spread, spread)) for i in range(n_airports)]
    obs = []
    for i in range(300):
        lat, lon = q(-90, 90), q(-180, 180)
        if rnd.random() < 0.1 and airports:                       # right at / next to an airport
            a = rnd.choice(airports)
            lat, lon = a[3] + rnd.choice([0, 0.25, -0.25]), a[4] + rnd.choice([0, 0.25])
        if rnd.random() < 0.02:                                   # off the globe
            lon = lon + 400
        obs.append((f"x{i % 40}", 1000 + i, lat, lon, rnd.random() < 0.7))
    # duplicate (icao24, time) at another position
    obs += [(o[0], o[1], o[2] + 1.0, o[3] - 2.0, True) for o in obs[:15]]
    # symmetric airports -> ties
    airports += [("T1", "Tie1", "YY", 10.0, 10.0), ("T2", "Tie2", "YY", 10.0, 12.0)]
    obs += [("tie", 1, 10.0, 11.0, True)]
    return obs, airports


@pytest.mark.parametrize("seed,n_airports,spread", [(1, 40, 180), (2, 400, 60), (3, 3, 20), (4, 150, 360)])
def test_grid_equals_brute_force(spark, seed, n_airports, spread):
    obs, airports = _case(seed, n_airports, spread)
    odf = spark.createDataFrame(obs, "icao24 string, t long, latitude float, longitude float, on_ground boolean") \
        .withColumn("event_timestamp", F.timestamp_seconds("t"))
    adf = spark.createDataFrame(airports, "airport_icao string, airport_name string, airport_country string, "
                                          "airport_lat double, airport_lon double")
    got = Counter((r.icao24, r.t, float(r.latitude), float(r.longitude), r.airport_icao)
                  for r in ap.nearest_airport(odf, adf).collect())
    assert got == _brute(obs, airports)


def test_enrich_ground_split_semantics(spark):
    obs = [("a", 1, 0.0, 0.0, True), ("a", 2, 5.0, 5.0, False), ("a", 3, 1.0, 1.0, None)]
    odf = spark.createDataFrame(obs, "icao24 string, t long, latitude float, longitude float, on_ground boolean") \
        .withColumn("event_timestamp", F.timestamp_seconds("t"))
    adf = spark.createDataFrame([("P", "p", "c", 0.5, 0.0)], "airport_icao string, airport_name string, "
                                "airport_country string, airport_lat double, airport_lon double")
    got = sorted((r.t, r.airport_icao) for r in ap.enrich_ground(odf, adf).collect())
    assert got == [(1, "P"), (2, None)]          # NULL on_ground row is not kept


def _silver_rows(spark, rows):
    return (spark.createDataFrame(rows, "icao24 string, t long, latitude float, longitude float, on_ground boolean, "
                                        "altitude_meters float, velocity_kmh double")
            .withColumn("event_timestamp", F.timestamp_seconds("t"))
            .withColumn("callsign", F.lit("C")).withColumn("origin_country", F.lit("X"))
            .withColumn("category", F.lit(1)))


def test_features_all_air_and_no_airports(spark):
    rows = [("a", i, 1.0, 1.0, False, float(1000 + 100 * i), 500.0) for i in range(8)]
    adf = spark.createDataFrame([("P", "p", "c", 0.5, 0.0)], "airport_icao string, airport_name string, "
                                "airport_country string, airport_lat double, airport_lon double")
    out = build_features(_silver_rows(spark, rows), adf).collect()
    assert len(out) == 8 and all(r.airport_icao is None for r in out)
    assert sorted(r.flight_phase for r in out) == ["TAKEOFF"] * 7 + ["TRANSITION"]
    # ground rows with an empty airport table disappear (inner product with nothing)
    ground = [("g", 1, 1.0, 1.0, True, 0.0, 0.0), ("g", 2, 1.0, 1.0, False, 10.0, 10.0)]
    empty = adf.limit(0)
    got = build_features(_silver_rows(spark, ground), empty).collect()
    assert [(r.observation_rank, r.on_ground) for r in got] == [(2, False)]


def test_shuffle_join_fallback_equals_brute_force(spark):
    obs, airports = _case(7, 60, 120)
    odf = spark.createDataFrame(obs, "icao24 string, t long, latitude float, longitude float, on_ground boolean") \
        .withColumn("event_timestamp", F.timestamp_seconds("t"))
    adf = spark.createDataFrame(airports, "airport_icao string, airport_name string, airport_country string, "
                                          "airport_lat double, airport_lon double")
    got = Counter((r.icao24, r.t, float(r.latitude), float(r.longitude), r.airport_icao)
                  for r in ap.nearest_airport(odf, adf, broadcast_max_cells=0).collect())
    assert got == _brute(obs, airports)


def test_feature_paths_agree_on_test_tables(spark):
    """Days, hours as chunks and the shuffle-join
    fallback give identical rows on the shared tables."""
    from contrail.operators.silver import clean_ranges, to_silver
    from contrail.sources import testdata

    sf = "/root/testdata/sf0.001"
    clean = clean_ranges(to_silver(testdata.bronze(spark, sf)))
    airports = testdata.airports(spark, sf)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    base = sorted(build_features(clean, airports).collect(), key=key)
    chunked = sorted(build_features(clean, airports, chunk="1 hour").collect(), key=key)
    fallback = sorted(build_features(clean, airports, broadcast_max_cells=0).collect(), key=key)
    from contrail.operators.features import features_reference_order
    steps = sorted(features_reference_order(clean, airports).collect(), key=key)
    assert base == chunked == fallback == steps and len(base) > 0


def test_many_airports_at_one_place(spark):
    """Airports that share a place, two places at the same distance, copies of observations and codes that occur twice: the
    build, which joins further airports after the windows, gives what the plain steps give."""
    from contrail.operators.features import features_reference_order

    airports = [(f"A{i % 17:02d}", f"n{i}", "c", 0.0, 1.0) for i in range(20)] + [(f"B{i}", "n", "c", 0.0, -1.0) for i in range(4)]
    airports += [("Z", "z", "c", 5.0, 5.0), ("N", None, None, 5.0, 5.25)]
    adf = spark.createDataFrame(airports, "airport_icao string, airport_name string, airport_country string, "
                                          "airport_lat double, airport_lon double")
    rows = [("t", 10 * i, 0.0, 0.0 if i % 3 else 1.0, i % 2 == 0, float(100 * i * i), 7.0 * i) for i in range(12)]
    rows += [("t", 33, 0.0, 0.0, True, 50.0, 3.0)] * 3 + [("t", 55, 0.0, 1.0, True, 70.0, 3.0)] * 9 + [("u", 1, 5.0, 5.0, True, None, None)]
    clean = _silver_rows(spark, rows)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    # codes that occur twice leave the order of their rows open; without them all columns are fixed
    once = adf.filter("airport_name not in ('n17', 'n18', 'n19') or airport_name is null")
    want = sorted(features_reference_order(clean, once).collect(), key=key)
    for bound in (ap.BROADCAST_MAX_CELLS, 0):
        got = sorted(build_features(clean, once, broadcast_max_cells=bound).collect(), key=key)
        assert got == want and len(got) > 200
    names = lambda df: Counter((r.icao24, r.event_timestamp, r.airport_icao, r.airport_name, r.observation_rank) for r in df.collect())
    assert names(build_features(clean, adf)) == names(features_reference_order(clean, adf))


def test_tied_airports_do_not_go_through_the_windows(spark):
    """Rows out of the airport step are bounded by 6 per observation, and a cell's candidates by 6 airports per place."""
    adf = spark.createDataFrame([(f"A{i:03d}", "n", "c", 0.0, 0.0) for i in range(300)],
                                "airport_icao string, airport_name string, airport_country string, airport_lat double, airport_lon double")
    rows = _silver_rows(spark, [("t", i, 0.0, 0.0, True, 1.0, 1.0) for i in range(5)])
    cells = ap.with_cell(rows, when=F.col("on_ground"))
    k, small = ap.materialize_candidates(cells.select("_cx", "_cy"), adf)
    assert ap.apply_enrichment(cells, k, small).count() == 30
    assert build_features(rows, adf).count() == 1500
