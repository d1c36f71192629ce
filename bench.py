"""Benchmark: the medallion pipeline on the shared test tables.

Layers are tables, as in production: each step reads the previous layer's
Parquet output and writes (or collects) its own. Prints ONE JSON line:
{"metric": "pipeline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from contrail.session import create_session

    spark = create_session("contrail-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                           log_level="ERROR", extra_conf={"spark.driver.memory": "16g",
                                                          "spark.ui.enabled": "false"})
    if spark.sparkContext.getCheckpointDir() is None and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-bench-ckpt-"))

    from contrail.operators import classify as ML
    from contrail.operators import gold as G
    from contrail.operators import reports as RP
    from contrail.operators import serving as SV
    from contrail.operators.features import build_features
    from contrail.operators.silver import clean_ranges, to_silver
    from contrail.schemas import SILVER_ML
    from contrail.session import scratch_path
    from contrail.sources import testdata, wire
    from contrail.sources.tables import read_table_stream
    from contrail.streaming import jobs

    root = scratch_path(spark, "bench")
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def write(name, df):
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def collect(name, df):
        df.write.format("noop").mode("overwrite").save()  # computes every row, brings none to the driver

    # warm-up: JVM + parquet readers (not timed)
    testdata.table(spark, sf_dir, "events").limit(10).collect()

    wire_in = write("wire", wire.to_wire_json(testdata.bronze(spark, sf_dir)))
    bronze = timed("bronze_parse", lambda: write("bronze", wire.parse_wire(wire_in)))
    silver = timed("silver", lambda: write("silver", to_silver(bronze)))
    airports = testdata.airports(spark, sf_dir)
    ml = timed("features", lambda: write("silver_ml", build_features(clean_ranges(silver), airports)))
    phase = timed("gold_phase_stats", lambda: write("phase_stats", G.phase_stats(ml)))
    country = timed("gold_country_stats", lambda: write("country_stats", G.country_stats(ml)))
    anoms = timed("gold_country_anomalies", lambda: write("anomalies", G.country_anomalies(ml)))
    rows.update(silver_ml=ml.count(), phase_stats=phase.count(), country_stats=country.count(),
                anomalies=anoms.count())

    def stream_gold():
        base = f"{root}/stream"
        q = jobs.start_gold(read_table_stream(spark, f"{root}/silver_ml", SILVER_ML), "country_anomalies",
                            f"{base}/out", f"{base}/ckpt", trigger=jobs.AVAILABLE_NOW)
        q.awaitTermination()
        return spark.read.parquet(f"{base}/out").count()

    rows["stream_anomalies"] = timed("stream_country_anomalies", stream_gold)

    reports = {
        "country_stats_top": lambda: RP.country_stats_top(silver),
        "ground_vs_air": lambda: RP.ground_vs_air(silver),
        "altitude_distribution": lambda: RP.altitude_distribution(silver),
        "flight_evolution": lambda: RP.flight_evolution(silver),
        "velocity_rank": lambda: RP.velocity_rank_in_country(silver),
        "correlation_matrix": lambda: RP.correlation_matrix(ml),
        "altitude_histogram": lambda: RP.histogram(ml, "altitude_meters"),
        "traffic_per_minute": lambda: RP.traffic_per_minute(ml),
        "kpis": lambda: SV.kpis(phase, anoms),
        "phase_totals": lambda: SV.phase_totals(phase),
        "latest_anomaly_by_country": lambda: SV.latest_anomaly_by_country(anoms),
        "recent_alerts": lambda: SV.recent_alerts(anoms),
        "anomaly_heatmap": lambda: SV.anomaly_heatmap(anoms),
    }
    for name, build in reports.items():
        timed(name, lambda b=build, n=name: collect(n, b()))

    def classifier():
        data = write("ml_input", ML.ml_input(ml))
        train_df, test_df = ML.split(data)
        model = ML.train(train_df)
        return ML.evaluate(ML.score(model, test_df)).collect()[0]

    metrics = timed("rf_train_evaluate", classifier)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "pipeline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "rows": rows, "rf_accuracy": round(metrics["accuracy"], 4), "rf_f1": round(metrics["f1"], 4),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
