"""Wire codec: poll payloads, JSON records, Kafka rows.

* ``normalize_states``: one poll payload ``{"time": t, "states": [[...], ...]}``
  -> one typed record per state vector (positional fields, index 12 not
  carried, ``category`` NULL when the vector has 17 fields, callsign trimmed
  with '' -> NULL, ``states`` NULL -> no rows).
* ``to_wire_json``: records -> JSON text per row, NULL fields kept.
* ``parse_wire``: JSON text (string or Kafka binary) -> typed records with a
  declared schema; malformed JSON gives a row of NULLs, wrong types NULL
  fields, unknown fields are ignored.

All of it is native expressions (``from_json`` / ``explode`` / ``try_cast``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail import schemas

_WIRE_TYPES = {f.name: f.dataType for f in schemas.WIRE.fields}


def _trim_ws(c: Column) -> Column:
    """Python-style strip of ASCII whitespace; '' -> NULL first."""
    stripped = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(c.isNull() | (c == F.lit("")), F.lit(None).cast("string")).otherwise(stripped)


def normalize_states(payloads: DataFrame, value_col: str = "value") -> DataFrame:
    """Poll payload JSON -> wire records (``schemas.WIRE`` column order)."""
    parsed = payloads.select(F.from_json(F.col(value_col).cast("string"), schemas.PAYLOAD).alias("p"))
    vectors = parsed.select(F.col("p.time").alias("time"), F.explode("p.states").alias("s"))
    cols = {"time": F.col("time")}
    for idx, name in schemas.STATE_VECTOR_FIELDS:
        raw = F.get(F.col("s"), idx)
        if name == "callsign":
            cols[name] = _trim_ws(raw)
        else:
            cols[name] = raw.try_cast(_WIRE_TYPES[name])
    return vectors.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in schemas.WIRE.fields])


def to_wire_json(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records -> ``value`` (UTF-8 JSON text, NULL fields written as null)
    and an optional ``key`` column, the shape a Kafka sink expects."""
    value = F.to_json(F.struct(*[F.col(f.name) for f in schemas.WIRE.fields]),
                      {"ignoreNullFields": "false"}).alias("value")
    if key is None:
        return records.select(value)
    return records.select(F.col(key).cast("string").alias("key"), value)


def parse_wire(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text or Kafka ``value`` bytes -> typed wire records."""
    return df.select(F.from_json(F.col(value_col).cast("string"), schemas.WIRE).alias("data")).select("data.*")


def _json_scalar(c: Column) -> Column:
    """JSON text of one value ('null' for NULL), keeping its JSON type:
    the element of a one-element JSON array."""
    arr = F.to_json(F.array(c))
    return arr.substr(F.lit(2), F.length(arr) - F.lit(2))


def payload_json(records: DataFrame, callsign_width: int = 8) -> DataFrame:
    """Records -> one single-vector poll payload per record (JSON text).

    The positional vector keeps JSON types (numbers, booleans, strings, null)
    and pads the callsign to ``callsign_width`` like the upstream feed."""
    elems = []
    by_index = dict(schemas.STATE_VECTOR_FIELDS)
    for idx in range(18):
        name = by_index.get(idx)
        if name is None:
            elems.append(F.lit("null"))
            continue
        c = F.col(name)
        if name == "callsign":
            c = F.rpad(c, callsign_width, " ")
        elems.append(_json_scalar(c))
    vector = F.concat(F.lit("["), F.concat_ws(",", *elems), F.lit("]"))
    text = F.concat(F.lit('{"time":'), F.coalesce(F.col("time").cast("string"), F.lit("null")),
                    F.lit(',"states":['), vector, F.lit("]}"))
    return records.select(text.alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``to_wire_json`` rows to a Kafka topic (needs the
    spark-sql-kafka package on the classpath)."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def read_kafka_stream(spark, servers: str, topic: str, starting_offsets: str = "earliest",
                      fail_on_data_loss: bool = False) -> DataFrame:
    """Kafka topic as a stream of ``value`` bytes."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower()).load())


__all__ = ["normalize_states", "to_wire_json", "parse_wire", "payload_json", "write_kafka",
           "read_kafka_stream"]
