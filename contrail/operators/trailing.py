"""Per-key ordered windows that never put one key into one task.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to a single
task: one busy aircraft (or a replayed feed) can then hold a large share of
all rows. Here every key's rows are cut into time chunks and Spark's own
window frames run per (key, chunk). What a chunk needs from before its start
comes from two small side tables:

* :func:`chunk_starts` — per chunk, how many rows of the key came before and the
  last of them (for LAG and ROW_NUMBER): one row per (key, chunk);
* :func:`halo_rows` — per chunk, copies of the ``preceding`` rows before it. They
  are put in front of the chunk's own rows (:data:`AT` orders them), take part in
  the frames, and are filtered out afterwards.

Both take what an earlier run left behind (``carry``, see ``operators.carry``) as
the rows before a key's first chunk, so a stream continues where its last batch ended.

Plan: one hash exchange of the data on (key, chunk), read by the side tables and by
the windows alike; the halo rows are dealt on the same columns, so the union keeps
the partitioning and the windows need no further exchange. The side tables'
per-key windows are bounded by the time span, not by the number of rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_COL = "_chunk"
AT = "_at"
_NULL_CHUNK = -(2 ** 62)  # NULL event times sort first, as Spark sorts NULLs first under ASC
_CARRIED = _NULL_CHUNK - 1  # what an earlier run left behind

_UNIT_MICROS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """'1 hour' -> 3600000000."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNIT_MICROS:
        raise ValueError(f"unsupported interval: {text!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def with_chunk(df: DataFrame, ts: str, chunk: str) -> DataFrame:
    """Add the time-chunk id used as the second partition key."""
    if CHUNK_COL in df.columns:
        return df
    size = interval_micros(chunk)
    cid = F.floor(F.unix_micros(F.col(ts)) / F.lit(size))
    return df.withColumn(CHUNK_COL, F.coalesce(cid, F.lit(_NULL_CHUNK).cast("long")))


def deal(rows: DataFrame, partitions: int | None, *by: str) -> DataFrame:
    """Rows dealt by the columns ``by``, over a given number of partitions or one that Spark chooses."""
    return rows.repartition(*by) if partitions is None else rows.repartition(partitions, *by)


def chunk_starts(rows: DataFrame, key: str, order: Sequence[str], fields: Sequence[str],
                 weight: Column | None = None, carry: DataFrame | None = None) -> DataFrame:
    """(key, chunk, ``_before``, ``_prev``): the number of the key's rows before each
    chunk (``weight`` rows each) and the ``fields`` of the last of them."""
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    ends = rows.groupBy(key, CHUNK_COL).agg(
        count.alias("_n"), F.max_by(F.struct(*fields), F.struct(*order)).alias("_last"))
    if carry is not None:
        ends = ends.unionByName(carry.select(
            key, F.lit(_CARRIED).cast("long").alias(CHUNK_COL), F.col("observations").alias("_n"), F.col("last").alias("_last")))
    w = Window.partitionBy(key).orderBy(CHUNK_COL)
    return ends.select(key, CHUNK_COL, F.lag("_last").over(w).alias("_prev"),
                       F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))


def halo_rows(rows: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], preceding: int,
              carry: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """(key, chunk, ``fields``, AT): for each chunk the up to ``preceding`` rows of its
    key before it, numbered by AT from 0 in order; dealt by (key, chunk)."""
    latest = Window.partitionBy(key, CHUNK_COL).orderBy(*[F.col(c).desc() for c in order])
    ends = rows.select(key, CHUNK_COL, *fields, F.row_number().over(latest).alias("_back")).filter(F.col("_back") <= preceding)
    if carry is not None:
        left = carry.select(key, F.lit(_CARRIED).cast("long").alias(CHUNK_COL), F.posexplode(F.reverse("tail")).alias("_p", "_r"))
        ends = ends.unionByName(left.select(key, CHUNK_COL, *[F.col(f"_r.{f}").alias(f) for f in fields], (F.col("_p") + 1).alias("_back")))
    w = Window.partitionBy(key).orderBy(CHUNK_COL, F.col("_back").desc())
    ends = ends.select(
        key, "_back", F.collect_list(F.struct(*fields)).over(w.rowsBetween(-(preceding - 1), 0)).alias("_rows"),
        F.lead(CHUNK_COL).over(w).alias("_next")).filter((F.col("_back") == 1) & F.col("_next").isNotNull())
    halo = ends.select(key, F.col("_next").alias(CHUNK_COL), F.posexplode("_rows").alias(AT, "_r")).select(
        key, CHUNK_COL, *[F.col(f"_r.{f}").alias(f) for f in fields], AT)
    return deal(halo, partitions, key, CHUNK_COL)


def trailing_windows(rows: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], preceding: int,
                     columns: dict[str, Column], carry: DataFrame | None = None, partitions: int | None = None,
                     whole: bool = False) -> DataFrame:
    """Add ``columns`` (aggregates of ``fields``) over each row and the ``preceding`` rows of its key before it.

    ``rows`` has a chunk column (:func:`with_chunk`); ``partitions``: over how many it has been dealt, if that was given;
    ``whole``: every key is one chunk, which needs nothing in front of it but ``carry``."""
    if preceding < 1:
        raise ValueError("preceding must be >= 1")
    if whole and carry is None:
        frame = Window.partitionBy(key, CHUNK_COL).orderBy(*order).rowsBetween(-preceding, 0)
        return rows.withColumns({name: c.over(frame) for name, c in columns.items()})
    halo = halo_rows(rows, key, order, fields, preceding, carry, partitions)
    frame = Window.partitionBy(key, CHUNK_COL).orderBy(AT, *order).rowsBetween(-preceding, 0)
    both = rows.withColumn(AT, F.lit(preceding)).unionByName(halo, allowMissingColumns=True)
    return both.withColumns({name: c.over(frame) for name, c in columns.items()}).filter(F.col(AT) == preceding).drop(AT)
