"""Column functions on literal rows, every boundary of the rules."""

import pytest
from pyspark.sql import functions as F

from contrail.functions import (altitude_anomaly, altitude_bucket, flight_phase, in_clean_ranges,
                                percent_text, planar_distance, to_kmh, velocity_anomaly)

PHASE_CASES = [
    # on_ground, change, altitude, expected
    (True, 100.0, 1000.0, "GROUND"),
    (False, 50.1, 2999.0, "TAKEOFF"),
    (False, 50.0, 2999.0, "CLIMB"),          # change 50 is not > 50
    (False, 60.0, 3000.0, "CLIMB"),          # altitude 3000 is not < 3000
    (False, 20.0, 9000.0, "CRUISE"),         # change 20 is not > 20, in [-20, 20]
    (False, 20.5, 9000.0, "CLIMB"),
    (False, -20.0, 8000.5, "CRUISE"),
    (False, -20.0, 8000.0, "TRANSITION"),    # altitude 8000 is not > 8000
    (False, -20.5, 8000.0, "DESCENT"),
    (False, 0.0, 5000.0, "TRANSITION"),
    (False, None, 9000.0, "TRANSITION"),     # first observation
    (None, None, 100.0, "TRANSITION"),       # NULL on_ground falls through
    (None, -30.0, 100.0, "DESCENT"),
]


def test_flight_phase(spark):
    df = spark.createDataFrame(PHASE_CASES, "g boolean, d double, a double, want string")
    got = df.select(flight_phase("g", "d", "a").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


@pytest.mark.parametrize("alt,want", [(None, "NULL"), (-600.0, "0-1000m"), (999.9, "0-1000m"),
                                      (1000.0, "1000-5000m"), (4999.0, "1000-5000m"), (5000.0, "5000-10000m"),
                                      (10000.0, "10000m+"), (20000.0, "10000m+")])
def test_altitude_bucket(spark, alt, want):
    df = spark.createDataFrame([(alt,)], "a double")
    assert df.select(altitude_bucket("a")).first()[0] == want


def test_anomaly_flags(spark):
    rows = [(12000.0, 1000.0, 0, 0), (12000.5, 999.0, 1, 0), (-100.0, 0.0, 0, 0), (-100.5, -0.1, 1, 1),
            (None, None, 0, 0), (5000.0, 1000.01, 0, 1)]
    df = spark.createDataFrame(rows, "a double, v double, wa int, wv int")
    for r in df.select(altitude_anomaly("a").alias("ga"), velocity_anomaly("v").alias("gv"), "wa", "wv").collect():
        assert (r.ga, r.gv) == (r.wa, r.wv)


def test_clean_ranges_inclusive(spark):
    rows = [(-500.0, 0.0, True), (15000.0, 1200.0, True), (-500.1, 10.0, False), (15000.1, 10.0, False),
            (100.0, -0.01, False), (100.0, 1200.01, False), (None, 10.0, None)]
    df = spark.createDataFrame(rows, "a double, v double, want boolean")
    for r in df.select(in_clean_ranges("a", "v").alias("got"), "want").collect():
        assert r.got == r.want


def test_kmh_and_percent_and_distance(spark):
    df = spark.createDataFrame([(10.0, 0.125, 0.0, 0.0, 3.0, 4.0)], "v double, r double, a double, b double, "
                                                                  "c double, d double")
    r = df.select(to_kmh("v").alias("k"), percent_text("r").alias("p"),
                  planar_distance("a", "b", "c", "d").alias("dist")).first()
    assert r.k == 36.0 and r.p == "12.5%" and r.dist == 5.0
    assert spark.range(1).select(percent_text(F.lit(0.1)).alias("p")).first().p == "10.0%"


def test_epoch_out_of_range_is_null(spark):
    from contrail.functions.flight import epoch_to_timestamp

    df = spark.createDataFrame([(0,), (1_700_000_000_000_000,), (10 ** 15 * 3,), (None,)], "s long")
    got = [r[0] for r in df.select(epoch_to_timestamp("s").cast("string")).collect()]
    assert got == ["1970-01-01 00:00:00", None, None, None]


def test_sample_reads_the_whole_table(spark):
    from contrail.operators.reports import sample_rows

    df = spark.range(0, 200_000, numPartitions=8).select(
        F.concat(F.lit("a"), F.col("id")).alias("icao24"), F.timestamp_seconds("id").alias("event_timestamp"), "id")
    out = sample_rows(df)
    assert abs(out.count() - 20_000) < 1_000 and out.agg(F.max("id")).first()[0] > 199_000
    assert sorted(sample_rows(df.repartition(3)).collect()) == sorted(out.collect())
    assert sample_rows(df, cap=10).count() == 10


def test_density_matches_the_direct_sum(spark):
    import math
    import random

    from contrail.operators import reports

    rng = random.Random(3)
    values = [rng.gauss(100, 20) for _ in range(400)] + [100.0] * 50
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    mean = sum(values) / len(values)
    bw = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)) * len(values) ** -0.2
    for cut in (0.0, 3.0):
        rows = sorted(reports.density(df, "v", gridsize=40, cut=cut).collect())
        assert len(rows) == 40 and math.isclose(rows[0].x, min(values) - cut * bw) and math.isclose(rows[-1].x, max(values) + cut * bw)
        for r in rows:
            direct = sum(math.exp(-0.5 * ((r.x - v) / bw) ** 2) for v in values) / (len(values) * bw * math.sqrt(2 * math.pi))
            assert abs(r.density - direct) < 1e-6 + 1e-4 * direct
            assert math.isclose(r.count_scale, r.density * len(values) * (max(values) - min(values)) / 50)
    assert reports.density(df.filter("v = 100"), "v").collect() == reports.density(df.limit(0), "v").collect() == []


def test_density_is_not_binned(spark):
    """One far value makes evenly spaced cells wide; every row still adds its kernel at its own place."""
    import math

    from contrail.operators import reports

    values = [i / 7 for i in range(300)] + [0.5] * 20 + [5e5]
    rows = sorted(reports.density(spark.createDataFrame([(v,) for v in values], "v double"), "v", gridsize=50).collect())
    mean = math.fsum(values) / len(values)
    bw = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1)) * len(values) ** -0.2
    for r in rows:
        direct = math.fsum(math.exp(-0.5 * ((r.x - v) / bw) ** 2) for v in values) / (len(values) * bw * math.sqrt(2 * math.pi))
        assert math.isclose(r.density, direct, rel_tol=1e-9, abs_tol=1e-18)


def test_correlation_with_nulls_and_large_means(spark):
    import random

    import pandas as pd

    from contrail.operators import reports

    rng = random.Random(5)
    rows = [(1e9 + rng.random(), rng.random() * 3 if rng.random() < 0.8 else None, 7.0, rng.gauss(0, 1) if rng.random() < 0.5 else None) for _ in range(300)]
    rows = [(a, b, c, None if d is None else d + a - 1e9) for a, b, c, d in rows]
    names = ["a", "b", "c", "d"]
    got = {(r.feature_x, r.feature_y): r.corr for r in reports.correlation_matrix(
        spark.createDataFrame(rows, "a double, b double, c double, d double"), names).collect()}
    want = pd.DataFrame(rows, columns=names).corr()
    assert len(got) == 16
    for (x, y), r in got.items():
        if "c" in (x, y):
            assert r is None                      # a constant column
        else:
            assert abs(r - want[x][y]) < 1e-6
    empty = reports.correlation_matrix(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r.corr is None for r in empty)


def test_heatmap_wide_equals_long(spark):
    from datetime import datetime

    from contrail.operators import serving

    rows = [("A", datetime(2024, 1, d, h, 0), 0.1 * d + h) for d in (1, 2) for h in (0, 5)] + [("B", datetime(2024, 1, 1, 5, 0), 9.0), (None, datetime(2024, 1, 1, 7, 0), 1.0)]
    df = spark.createDataFrame(rows, "origin_country string, window_start timestamp, anomaly_rate double")
    wide = {r.origin_country: r.asDict() for r in serving.anomaly_heatmap_wide(df).collect()}
    long = {(r.origin_country, r.hour): r.anomaly_rate for r in serving.anomaly_heatmap(df).collect()}
    assert set(wide) == {"A", "B"} and list(wide["A"])[1:] == ["00:00", "05:00", "07:00"]
    assert long == {(c, h): v for c, r in wide.items() for h, v in r.items() if h != "origin_country"}


def test_forest_nodes_give_the_importances(spark):
    from contrail.operators import classify, forest_nodes

    rows = [(float(i % 90), float(i * 7 % 50), 0.0, 0.0, float(i % 13), 1.0, 2.0, "A" if i % 90 > 40 else "B" if i % 13 > 5 else "C") for i in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in classify.FEATURES) + ", flight_phase string")
    model = classify.train(df, trees=7, depth=4)
    nodes = forest_nodes.node_table(spark, model)
    got = {classify.FEATURES[r.feature]: r.importance for r in forest_nodes.importances(nodes).collect()}
    want = {r.feature: r.importance for r in classify.feature_importance(model).collect() if r.importance > 0}
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in got)
    scored = classify.score(model, df.withColumn("_id", F.monotonically_increasing_id()))
    walked = {r["_id"]: r.walked for r in forest_nodes.walk(nodes, scored, ["_id"], 4).collect()}
    assert walked == {r["_id"]: r.prediction for r in scored.select("_id", "prediction").collect()}
