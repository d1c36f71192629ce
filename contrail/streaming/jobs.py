"""Structured Streaming jobs: wire -> Bronze -> Silver / Silver_ML -> Gold.

Every job is an ordinary DataFrame function from ``contrail.operators``
applied to a streaming source; each query has its own checkpoint folder and
can be restarted from it. Triggers are a parameter: default micro-batches,
``{"availableNow": True}`` to drain what is there and stop (tests, backfills).

Feature job (``start_features``): window features need whole history per
aircraft and Spark refuses LAG over a stream, so they run per micro-batch in
``foreachBatch``. What a batch leaves behind per aircraft (its count and last rows) is
carried into the next one, so the windows go on across batches; a batch's rows count as
later than those of the batches before it, whatever their event times.
``carry_over=False`` restarts them in every batch, as the original job does. A batch is
committed under (query id, batch id), see ``streaming.ledger``: a replay adds nothing, and a
new checkpoint is a new query.

Silver, Silver_ML and Gold are partitioned by date (``tables.dated``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from contrail import schemas
from contrail.operators import gold
from contrail.operators.airports import AirportIndex
from contrail.operators.carry import next_carry
from contrail.operators.features import WHOLE_ROWS, counted_features
from contrail.operators.silver import clean_ranges, to_silver
from contrail.sources.tables import dated, read_table_stream, write_stream
from contrail.sources.wire import parse_wire
from contrail.streaming.ledger import BatchLedger

AVAILABLE_NOW = {"availableNow": True}


def start_bronze(raw: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: Mapping | None = None, name: str | None = None) -> StreamingQuery:
    """Wire JSON (``value``) stream -> typed Bronze records, append."""
    return write_stream(parse_wire(raw), path, checkpoint, fmt=fmt, trigger=trigger, query_name=name)


def start_silver(bronze_stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: Mapping | None = None, name: str | None = None) -> StreamingQuery:
    """Bronze stream -> Silver (stateless filter + projection), append, by event date."""
    return write_stream(dated(to_silver(bronze_stream)), path, checkpoint, fmt=fmt, trigger=trigger,
                        query_name=name, merge_schema=(fmt == "delta"), partition_by=["event_date"])


def feature_batch_writer(airports: DataFrame, path: str, fmt: str = "parquet", index_path: str | None = None,
                         carry_over: bool = True, query_id: str | None = None):
    """``foreachBatch`` function: one Bronze micro-batch -> Silver_ML rows below
    ``path/query_id=<id>/batch_id=<n>``, committed in the ledger.

    ``index_path``: folder of the airport-candidate index shared by the
    batches (default: next to the output), so a batch only searches cells
    that no earlier batch has seen. ``query_id``: default is the running query's own."""
    index = AirportIndex(airports, index_path or path.rstrip("/") + "_airport_index")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        ledger = BatchLedger(spark, path, query)
        if ledger.committed(batch_id) is not None:
            return
        batch.persist()  # read by the cell search, the feature plan and the carried state
        try:
            clean = clean_ranges(to_silver(batch))
            carry = ledger.carry_before(batch_id) if carry_over else None
            # staged: the rows of a batch and what it leaves behind both come from here
            counted = counted_features(clean, airports, index=index, carry=carry, whole_rows=WHOLE_ROWS).staged()
            ml = dated(counted.restored().select(*schemas.SILVER_ML_COLUMNS))
            if fmt == "delta":  # the table's own log keeps (query, batch) as transaction id
                (ml.withColumns({"query_id": F.lit(query), "batch_id": F.lit(batch_id).cast("long")})
                 .write.format("delta").mode("append").partitionBy("event_date")
                 .option("txnAppId", query).option("txnVersion", batch_id).save(path))
            else:
                ledger.publish(ml, batch_id, ["event_date"])
            # at most 6 rows of a copy or an airport are there, and the windows look back on 5
            full = ledger.write_carry(batch_id, next_carry(clean, counted.rows, carry), carry) if carry_over else 0
            ledger.commit(batch_id, full=full)
            if full == batch_id:
                ledger.forget(full)
        finally:
            batch.unpersist()

    return process


def start_features(bronze_stream: DataFrame, airports: DataFrame, path: str, checkpoint: str,
                   fmt: str = "parquet", trigger: Mapping | None = None,
                   name: str | None = None, carry_over: bool = True) -> StreamingQuery:
    w = bronze_stream.writeStream.foreachBatch(feature_batch_writer(airports, path, fmt, carry_over=carry_over)).option(
        "checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_gold(silver_ml_stream: DataFrame, table: str, path: str, checkpoint: str, fmt: str = "parquet",
               trigger: Mapping | None = None, name: str | None = None, **params) -> StreamingQuery:
    """One Gold table from a Silver_ML stream, append mode (closed windows).

    ``table``: ``phase_stats`` (tumbling by phase), ``country_stats``
    (tumbling by country) or ``country_anomalies`` (sliding by country); ``params`` as in ``operators.gold``."""
    builders = {"phase_stats": gold.phase_stats, "country_stats": gold.country_stats,
                "country_anomalies": gold.country_anomalies}
    return write_stream(dated(builders[table](silver_ml_stream, **params)), path, checkpoint, fmt=fmt,
                        trigger=trigger, query_name=name, partition_by=["window_date"])


def silver_ml_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver_ML folder as a stream (the partition columns are kept)."""
    schema = StructType(schemas.SILVER_ML.fields + [
        StructField("query_id", StringType()), StructField("batch_id", LongType()), StructField("event_date", DateType())])
    return read_table_stream(spark, path, schema if fmt == "parquet" else None, fmt)


# ---------------------------------------------------------------- control

def start_all(starters: Iterable) -> list[StreamingQuery]:
    """Start independent queries (each callable returns a StreamingQuery)."""
    return [s() for s in starters]


def query_status(queries: Iterable[StreamingQuery]) -> list[dict]:
    """Name, id, activity, status message and last progress of each query."""
    out = []
    for q in queries:
        last = q.lastProgress or {}
        out.append({
            "name": q.name, "id": str(q.id), "active": q.isActive,
            "message": q.status.get("message"), "input_rows": last.get("numInputRows"),
            "batch_id": last.get("batchId"), "watermark": (last.get("eventTime") or {}).get("watermark"),
        })
    return out


def await_all(queries: Iterable[StreamingQuery], timeout: float | None = None) -> None:
    for q in queries:
        q.awaitTermination(timeout) if timeout is not None else q.awaitTermination()


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()

