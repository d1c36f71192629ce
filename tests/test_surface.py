"""Remaining API surface: stream control, Gold reader, model persistence,
serving on an empty Gold table, SQL-text reports."""

import os

from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import classify as ML
from contrail.operators import serving as SV
from contrail.sources.tables import flatten_window, read_gold, read_table_stream, write_table
from contrail.streaming import jobs


def test_query_status_and_stop(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "out", "ckpt"))
    spark.createDataFrame([(1, "a")], "time long, icao24 string").write.parquet(src)
    q = jobs.start_silver(read_table_stream(spark, src, schemas.WIRE), out, ckpt, name="silver_status")
    q.processAllAvailable()
    st = jobs.query_status([q])[0]
    assert st["name"] == "silver_status" and st["active"]
    jobs.stop_all([q])
    assert not q.isActive


def test_read_gold_flattens_window(spark, tmp_dir):
    path = os.path.join(tmp_dir, "gold")
    df = spark.createDataFrame([("2024-01-01 00:00:00", "CLIMB", 3)], "ts string, flight_phase string, n long") \
        .select(F.window(F.col("ts").cast("timestamp"), "1 minute").alias("window"), "flight_phase", "n")
    write_table(df, path, mode="overwrite")
    g = read_gold(spark, path, since="2024-01-01 00:00:00")
    assert g.columns[:2] == ["window_start", "window_end"] and g.count() == 1
    assert flatten_window(g).columns == g.columns


def test_serving_on_empty_gold(spark):
    phase = spark.createDataFrame([], "window_start timestamp, window_end timestamp, flight_phase string, "
                                      "flight_count long, avg_altitude double, avg_velocity double")
    anoms = spark.createDataFrame([], ", ".join(f"{c} double" if c not in ("window_start", "window_end",
                                  "origin_country") else (f"{c} string" if c == "origin_country" else
                                  f"{c} timestamp") for c in schemas.COUNTRY_ANOMALY_COLUMNS))
    k = SV.kpis(phase, anoms).first()
    assert (k.total_flights, k.avg_altitude, k.avg_velocity, k.anomaly_rate_pct) == (0, 0.0, 0.0, 0.0)
    assert SV.recent_alerts(anoms).count() == 0 and SV.anomaly_heatmap(anoms).count() == 0


def test_model_save_load_and_decode(spark, tmp_dir):
    rows = []
    for i in range(120):
        phase = ["CLIMB", "DESCENT", "GROUND"][i % 3]
        change = {"CLIMB": 40.0, "DESCENT": -40.0, "GROUND": 0.0}[phase]
        rows.append((phase, 1000.0 + i, 300.0, change, 1.0, 1000.0, 5.0, 300.0))
    df = spark.createDataFrame(rows, "flight_phase string, altitude_meters double, velocity_kmh double, "
                                     "altitude_change double, velocity_change double, rolling_avg_altitude double, "
                                     "rolling_std_altitude double, rolling_avg_velocity double")
    model = ML.train(df, trees=30, depth=4)
    path = os.path.join(tmp_dir, "model")
    ML.save_model(model, path)
    again = ML.load_model(path)
    a = ML.score(model, df).select("predicted_label").collect()
    b = ML.score(again, df).select("predicted_label").collect()
    assert a == b
    pred = ML.score(again, df)
    acc = ML.evaluate(pred).first().accuracy
    same = pred.filter(F.col("flight_phase") == F.col("predicted_label")).count() / pred.count()
    assert abs(acc - same) < 1e-12 and acc > 0.9            # decoded names agree with label indexes
    assert ML.confusion_matrix(pred).count() == 3
    assert [r.feature for r in ML.feature_importance(again).collect()][0] == "altitude_change"


def test_rocksdb_state_for_windows(spark, tmp_dir):
    """Window state in RocksDB gives the same closed windows."""
    from contrail.operators import gold
    from contrail.session import ROCKSDB_PROVIDER

    src, out, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "out", "ckpt"))
    rows = [("a", f"2024-01-01 00:0{i}:10", "CLIMB", 1000.0, 500.0) for i in range(6)]
    df = spark.createDataFrame(rows, "icao24 string, ts string, flight_phase string, altitude_meters float, "
                                     "velocity_kmh double").withColumn("event_timestamp", F.col("ts").cast("timestamp"))
    for f in schemas.SILVER_ML.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df.select(*schemas.SILVER_ML_COLUMNS).write.parquet(src)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    try:
        q = jobs.start_gold(read_table_stream(spark, src, schemas.SILVER_ML), "phase_stats", out, ckpt,
                            trigger=jobs.AVAILABLE_NOW)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    got = sorted(r.window_start.strftime("%H:%M") for r in spark.read.parquet(out).collect())
    assert got == ["00:00", "00:01", "00:02"]     # ends <= watermark 00:03:10; later windows open


def test_equal_vectors_go_down_the_trees_once(spark):
    """A thousand rows of one vector are one walk; every row has its result. Rows of a negative and a positive zero, too."""
    from contrail.operators.forest_nodes import node_table, walk

    base = spark.range(60).select(*[(F.col("id") * (i + 1) % 11).cast("double").alias(f) for i, f in enumerate(ML.FEATURES)],
                                  F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("flight_phase"))
    zeros = base.limit(1).withColumn(ML.FEATURES[0], F.lit(-0.0))
    rows = base.unionByName(base.limit(1).crossJoin(spark.range(1000)).drop("id")).unionByName(zeros)
    model = ML.train(base, trees=5, depth=3)
    scored = ML.score(model, rows.withColumn("_id", F.monotonically_increasing_id()))
    nodes = node_table(spark, model)
    out = walk(nodes, scored, ["_id"], 3)
    walked = {r["_id"]: r.walked for r in out.collect()}
    assert walked == {r["_id"]: r.prediction for r in scored.select("_id", "prediction").collect()} and len(walked) == 1061
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the vectors alone are multiplied by the trees, not the rows with their keys
    assert all("_id" not in line for line in plan.splitlines() if "Generate explode" in line)
