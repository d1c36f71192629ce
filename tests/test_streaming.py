"""Streaming: closed-window emission, late rows, restart, replay."""

import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import gold
from contrail.sources.tables import read_table_stream, write_stream
from contrail.streaming import jobs


def _ml_rows(spark, rows):
    """rows: (icao24, 'YYYY-mm-dd HH:MM:SS', phase, altitude, velocity)"""
    data = []
    for icao, ts, phase, alt, vel in rows:
        t = datetime.strptime(ts, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
        data.append((icao, t, phase, float(alt), float(vel)))
    df = spark.createDataFrame(data, "icao24 string, event_timestamp timestamp, flight_phase string, "
                                     "altitude_meters float, velocity_kmh double")
    for f in schemas.SILVER_ML.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*schemas.SILVER_ML_COLUMNS)


def test_watermark_drops_late_rows(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "out", "ckpt"))
    batches = [
        [("a", "2024-01-01 00:00:10", "CLIMB", 1000, 500)],
        [("a", "2024-01-01 00:05:10", "CLIMB", 1000, 500)],
        [("a", "2024-01-01 00:10:10", "CLIMB", 1000, 500)],
        [("a", "2024-01-01 00:00:30", "CLIMB", 1000, 500)],     # late: watermark is 00:08:10
        [("a", "2024-01-01 00:20:10", "CLIMB", 1000, 500)],     # closes earlier windows
    ]
    os.makedirs(src)
    stream = read_table_stream(spark, src, schemas.SILVER_ML, max_files_per_trigger=1)
    q = write_stream(gold.phase_stats(stream), out, ckpt)
    dropped = 0
    try:
        for i, b in enumerate(batches):
            _ml_rows(spark, b).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
            dropped += sum(p.get("numRowsDroppedByWatermark", 0) for p in (q.lastProgress or {}).get(
                "stateOperators", []))
    finally:
        q.stop()
    got = {(r.window_start.strftime("%H:%M"), r.flight_count) for r in spark.read.parquet(out).collect()}
    assert ("00:00", 1) in got                         # the late row did not raise the count
    assert ("00:20", 1) not in got                     # still open: watermark 00:18:10
    assert {"00:00", "00:05", "00:10"} <= {w for w, _ in got}
    assert dropped >= 1


def test_restart_from_checkpoint_and_replay(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, p) for p in ("src", "out", "ckpt"))
    first = _ml_rows(spark, [("a", "2024-01-01 00:00:10", "CLIMB", 1, 1), ("b", "2024-01-01 00:00:20", "CLIMB", 1, 1)])
    first.write.mode("append").parquet(src)
    run = lambda: jobs.start_silver(  # stateless job: each input row once per output
        read_table_stream(spark, src, schemas.SILVER_ML).select(
            F.unix_seconds("event_timestamp").alias("time"), "icao24", "callsign", "origin_country",
            "longitude", "latitude", F.lit(1.0).cast("float").alias("velocity"),
            F.col("altitude_meters").alias("baro_altitude"), "on_ground", "category")
        .withColumn("longitude", F.lit(1.0).cast("float")).withColumn("latitude", F.lit(1.0).cast("float")),
        out, ckpt, trigger=jobs.AVAILABLE_NOW)
    q = run(); q.awaitTermination()
    _ml_rows(spark, [("c", "2024-01-01 00:01:10", "CLIMB", 1, 1)]).write.mode("append").parquet(src)
    q = run(); q.awaitTermination()
    assert sorted(r.icao24 for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def _bronze(spark, times, on_ground=lambda i: i % 2 == 0):
    return spark.createDataFrame(
        [(1700000000 + i, "a", "CS", "X", None, None, 1.0, 1.0, float(100 * (i % 50)), on_ground(i), 100.0 + i % 50,
          None, None, None, None, None, None, 1) for i in times], schemas.WIRE)


AIRPORT = [("P", "p", "c", 0.0, 0.0)]


def test_feature_batch_replay_adds_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "ml")
    airports = spark.createDataFrame(AIRPORT, schemas.AIRPORTS)
    process = jobs.feature_batch_writer(airports, out, query_id="q")
    files = lambda: sorted(os.path.join(d, f) for d, _, names in os.walk(f"{out}/query_id=q") for f in names)
    process(_bronze(spark, range(5)), 0)
    first = files()
    process(_bronze(spark, range(5)), 0)      # replay: readers of the folder see no new file
    assert files() == first
    process(_bronze(spark, range(5, 9)), 1)
    df = spark.read.parquet(out)
    assert df.count() == 9 and df.filter("batch_id = 0").count() == 5


def test_replay_after_a_crash_between_the_steps(spark, tmp_dir):
    """Rows published but not recorded are kept, and the steps that are missing run."""
    from contrail.streaming.ledger import BatchLedger

    out = os.path.join(tmp_dir, "ml")
    process = jobs.feature_batch_writer(spark.createDataFrame(AIRPORT, schemas.AIRPORTS), out, query_id="q")
    process(_bronze(spark, range(5)), 0)
    process(_bronze(spark, range(5, 9)), 1)
    whole = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    ledger = BatchLedger(spark, out, "q")
    state = sorted(map(tuple, ledger.carry_before(2).collect()), key=str)
    os.remove(f"{out}/_ledger/q/1")           # the crash: no record, no carried state
    for name in os.listdir(f"{out}/_carry/q/batch_id=1"):
        os.remove(f"{out}/_carry/q/batch_id=1/{name}")
    os.rmdir(f"{out}/_carry/q/batch_id=1")
    assert ledger.committed(1) is None
    process(_bronze(spark, range(5, 9)), 1)
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == whole
    assert ledger.committed(1) is not None and sorted(map(tuple, ledger.carry_before(2).collect()), key=str) == state


def test_new_checkpoint_loses_nothing(spark, tmp_dir):
    """A second query on the same output starts at batch 0 again; its rows are added, not skipped."""
    airports = spark.createDataFrame(AIRPORT, schemas.AIRPORTS)
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "ml")
    run = lambda source, ckpt: jobs.start_features(read_table_stream(spark, source, schemas.WIRE), airports, out, os.path.join(tmp_dir, ckpt),
                                                   trigger=jobs.AVAILABLE_NOW).awaitTermination()
    _bronze(spark, range(5)).write.parquet(src)
    run(src, "ckpt1")
    _bronze(spark, range(100, 130)).write.parquet(src + "2")
    run(src + "2", "ckpt2")
    run(src + "2", "ckpt2")                   # nothing new: nothing written
    df = spark.read.parquet(out)
    assert df.count() == 35 and df.select("query_id").distinct().count() == 2


def test_carry_over_equals_one_batch(spark, tmp_dir):
    """Windows go on over batches, whole copies of the state in between included; without carry-over they restart."""
    import random

    from contrail.operators.features import build_features
    from contrail.operators.silver import clean_ranges, to_silver
    from contrail.streaming import ledger

    rng = random.Random(4)
    airports = spark.createDataFrame(AIRPORT + [("Q", "q", "c", 2.0, 2.0)], schemas.AIRPORTS)  # equally near: two rows per ground row
    rows = [(1700000000 + i, f"p{rng.randrange(4)}", "CS", "X", None, None, 1.0, 1.0, rng.choice((None, float(rng.randrange(9000)))),
             rng.choice((True, False, False, None)), float(rng.randrange(300)), None, None, None, None, None, None, 1) for i in range(60)]
    frame = lambda part: spark.createDataFrame(part, schemas.WIRE)
    cols = [c for c in schemas.SILVER_ML_COLUMNS]
    key = lambda df: sorted(map(tuple, df.select(*cols).collect()), key=str)
    want = key(build_features(clean_ranges(to_silver(frame(rows))), airports))
    old, ledger.FULL_EVERY = ledger.FULL_EVERY, 2
    try:
        process = jobs.feature_batch_writer(airports, f"{tmp_dir}/on", query_id="q")
        for n in range(6):
            process(frame(rows[n * 10:n * 10 + 10]), n)
    finally:
        ledger.FULL_EVERY = old
    assert key(spark.read.parquet(f"{tmp_dir}/on")) == want
    assert not os.path.exists(f"{tmp_dir}/on/_carry/q/batch_id=0")        # older than the whole copies that a replay can need
    process = jobs.feature_batch_writer(airports, f"{tmp_dir}/off", query_id="q", carry_over=False)
    for n in range(2):
        process(frame(rows[n * 30:n * 30 + 30]), n)
    restarted = spark.read.parquet(f"{tmp_dir}/off").filter("batch_id = 1")
    assert restarted.agg(F.min("observation_rank")).first()[0] == 1 and key(spark.read.parquet(f"{tmp_dir}/off")) != want


def test_running_chain_with_monitor(spark, tmp_dir):
    """All queries at once under the query manager; the late row is counted as dropped, not as data."""
    import time

    from contrail.sources import wire
    from contrail.streaming.chain import Chain
    from contrail.streaming.monitor import QueryMonitor

    src = os.path.join(tmp_dir, "wire")
    os.makedirs(src)
    chain = Chain(spark, tmp_dir, lambda: read_table_stream(spark, src, "value string"),
                  spark.createDataFrame(AIRPORT, schemas.AIRPORTS), {"phase_stats": {}})
    monitor = QueryMonitor()
    spark.streams.addListener(monitor)
    queries = chain.start()
    try:
        assert {q.name for q in queries} == {"bronze", "silver", "silver_ml", "phase_stats"} <= {q.name for q in spark.streams.active}
        for t in (0, 300, 600, 30, 1200):     # 30: late, the watermark is at 480
            wire.to_wire_json(_bronze(spark, [t], lambda i: True)).select(F.col("value").cast("string")).coalesce(1).write.mode("append").parquet(src)
            for q in queries:
                q.processAllAvailable()
        status = {s["name"]: s for s in jobs.query_status(queries)}
        assert all(s["active"] for s in status.values()) and status["phase_stats"]["watermark"] is not None
    finally:
        jobs.stop_all(queries)
        deadline = time.time() + 30
        while time.time() < deadline and any(t["ended"] < t["runs"] for t in monitor.totals().values()):
            time.sleep(0.2)
        spark.streams.removeListener(monitor)
    totals = monitor.totals()
    assert totals["phase_stats"]["dropped_rows"] == 1 and totals["bronze"]["input_rows"] == 5
    assert all(t["error"] is None and t["ended"] == 1 for t in totals.values())
    assert spark.read.parquet(chain.table("silver_ml")).count() == 5
    rows = spark.read.parquet(chain.table("phase_stats"))
    assert rows.agg(F.sum("flight_count")).first()[0] == 3   # three closed windows; the fourth is still open


def test_airport_index_reuse_matches_fresh_search(spark, tmp_dir):
    from contrail.operators.airports import AirportIndex, with_cell
    from contrail.operators.features import build_features
    from contrail.operators.silver import clean_ranges, to_silver
    from contrail.sources import testdata

    sf = "/root/testdata/sf0.001"
    bronze = testdata.bronze(spark, sf)
    airports = testdata.airports(spark, sf)
    index = AirportIndex(airports, os.path.join(tmp_dir, "index"))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    sizes = []
    for part in (bronze.filter("time % 2 = 0"), bronze.filter("time % 2 = 1"), bronze):
        clean = clean_ranges(to_silver(part))
        fresh = sorted(build_features(clean, airports).collect(), key=key)
        reused = sorted(build_features(clean, airports, index=index).collect(), key=key)
        assert fresh == reused
        sizes.append(spark.read.parquet(index.path).count())
    cells = with_cell(clean_ranges(to_silver(bronze)).filter("on_ground")).select("_cx", "_cy").distinct().count()
    assert sizes[2] == sizes[1] == cells          # the third batch saw no new cell


def test_changed_airports_get_their_own_index(spark, tmp_dir):
    from contrail.operators.airports import AirportIndex

    path = os.path.join(tmp_dir, "index")
    old, new, again = (AirportIndex(spark.createDataFrame([(code, code, "c", place, place)], schemas.AIRPORTS), path).path
                       for code, place in (("FAR", 9.0), ("NEAR", 0.0), ("FAR", 9.0)))
    assert old == again != new and old.startswith(path) and new.startswith(path)


def test_unreadable_index_is_an_error_not_an_empty_one(spark, tmp_dir):
    import pytest

    from contrail.operators.airports import AirportIndex

    airports = spark.createDataFrame([("P", "p", "c", 0.0, 0.0)], schemas.AIRPORTS)
    index = AirportIndex(airports, os.path.join(tmp_dir, "index"))
    os.makedirs(index.path)
    open(os.path.join(index.path, "_SUCCESS"), "w").close()  # committed, but without readable files
    with pytest.raises(Exception):
        index.candidates(spark.createDataFrame([(0, 0)], "_cx long, _cy long"))
