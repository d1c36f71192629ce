"""Silver -> Silver_ML features.

Semantics (kept from the original job):

1. temporal features over the cleaned rows, per aircraft in time order:
   previous altitude / speed, their changes, observation rank;
2. rows with NULL ``on_ground`` leave; ground rows get their nearest
   airport(s) (ties and duplicate timestamps as in ``airports``), airborne
   rows NULL airports;
3. rolling mean / sample stddev of altitude and mean speed over the current
   row and the 5 before it, per aircraft, over the rows of step 2;
4. the flight-phase label.

Physical plan: exact copies of a row are counted first (a partial aggregation
before the first exchange), so however often a feed repeats an observation, it
crosses the network once per task. Then every aircraft is cut into time chunks
(see ``trailing``) and steps 1-3 share one hash exchange on (icao24, chunk): the
temporal window, the airport attach (broadcast of the checked candidate table),
the group minimum and the rolling frames all run on that partitioning. There is one
path, whatever the size of an aircraft; with ``whole_rows``, an aircraft of no more rows than that is one chunk, because
chunks of a few rows each would be outnumbered by the rows copied in front of them. At the end the counted copies come back:
from the 7th on, copies differ in nothing but their observation rank, because their
frames hold copies only. The same holds for an observation's rows per airport: the first
6 go through the frames, and the rows for further airports at the same distance are joined at the
end, in the task that holds the observation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail import schemas
from contrail.functions import flight_phase
from contrail.operators import airports as ap
from contrail.operators.trailing import CHUNK_COL, chunk_starts, deal, trailing_windows, with_chunk
from contrail.session import materialize

KEY = "icao24"
TS = "event_timestamp"
FIELDS = ("altitude_meters", "velocity_kmh")
DEFAULT_CHUNK = "1 day"
# Order of an aircraft's rows: time, then all other columns, so that only fully equal rows tie and no
# value depends on how the input is laid out. NULLs first.
ORDER = (TS, "callsign", "origin_country", "longitude", "latitude", "velocity_kmh", "altitude_meters",
         "on_ground", "category")
# of a counted row: number of this copy, and how many further copies stand behind it
_COPY, _MORE = "_copy", "_more"
# Observations that one task of the build sorts (about 1.2 kB each with all of a task's sorts). Up to that many a
# core Spark chooses the partitions; beyond, their number grows with the input, so a task's memory does not.
TASK_ROWS = 250_000
# Aircraft of up to that many rows need not be cut (``whole_rows``): a fifth of what a task sorts.
WHOLE_ROWS = 50_000
# The aircraft above that are broadcast if they are at most so many; if they are more, all aircraft are cut.
BROADCAST_MAX_CUT = 1_000_000


def _order(df: DataFrame, *more: str) -> list[str]:
    # (the last two keep a copy's place; with them all branches of the build read the same columns, and so one exchange)
    return [c for c in (*ORDER, *more, _COPY, _MORE) if c in df.columns]


def count_copies(clean: DataFrame, preceding: int = K.ROLLING_PRECEDING) -> DataFrame:
    """Silver columns, every distinct row at most ``preceding`` + 1 times; the last of these says how many more there are."""
    most = preceding + 1
    counted = clean.groupBy(*schemas.SILVER_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.withColumn(_COPY, F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(most)).cast("int"))))
    return numbered.withColumn(_MORE, F.when(F.col(_COPY) == most, F.col("_n") - most).otherwise(F.lit(0))).drop("_n")


def restore_copies(features: DataFrame) -> DataFrame:
    """Every counted copy as a row of its own, with its own observation rank."""
    out = features.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col(_MORE))))
    if "observation_rank" in out.columns:
        out = out.withColumn("observation_rank", (F.col("observation_rank") + F.col("_k")).cast("int"))
    return out.drop("_k", _MORE)


def restore_ties(features: DataFrame, airports: DataFrame, small: bool) -> DataFrame:
    """A row for every further airport of an observation (``_rest`` of ``airports.apply_enrichment``): they stand behind
    the 6th row of the observation and differ from it in nothing but the airport."""
    itself = F.array(F.lit(None).cast(features.schema["_rest"].dataType.elementType))
    out = features.withColumn("_site", F.explode(F.when(F.size("_rest") > 0, F.concat(itself, "_rest")).otherwise(itself))).drop("_rest")
    out = ap.join_sites(out, "_site", airports, small, "left", F.col("_site.taken"))
    given = F.col("_site").isNull()
    out = out.withColumns({c: F.when(given, F.col(c)).otherwise(F.col(f"_{c}")) for c in ap.AIRPORT_NAMES if c in features.columns})
    return out.drop("_site", *[f"_{c}" for c in ap.AIRPORT_NAMES])


@dataclass(frozen=True)
class Counted:
    """Silver_ML rows whose further copies and further airports are still counted (``_more``, ``_rest``).

    What is the same for all rows that a row stands for is done here, once: ``restored`` writes them out, ``weight``
    says how many they are. Their number grows with the airports at one place, the rows here do not."""

    rows: DataFrame
    airports: DataFrame
    small: bool

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Counted:
        """``change`` acts row by row, reads neither airport nor rank, and keeps ``_more`` and ``_rest``."""
        return replace(self, rows=change(self.rows))

    def select(self, *columns: str) -> Counted:
        return self.each(lambda rows: rows.select(*columns, _MORE, "_rest"))

    def staged(self) -> Counted:
        """Written once, for several passes."""
        return self.each(lambda rows: materialize(rows, "counted"))

    def restored(self) -> DataFrame:
        """Every row. Copies cross no shuffle: they come before a broadcast join with the airports and after a shuffle join."""
        if self.small:
            return restore_ties(restore_copies(self.rows), self.airports, True)
        return restore_copies(restore_ties(self.rows, self.airports, False))

    def weight(self) -> Column:
        """How many rows a row stands for (long)."""
        further = F.aggregate("_rest", F.lit(0).cast("long"), lambda n, r: n + r["n"] - r["taken"])
        return (F.col(_MORE) + 1).cast("long") * (F.coalesce(further, F.lit(0).cast("long")) + 1)


def chunk_of_cut(rows: DataFrame, chunk: str, cut: DataFrame) -> DataFrame:
    """Add the time chunk to the rows of the aircraft in ``cut`` (few, broadcast); all rows of another are in one chunk."""
    flagged = cut.select(F.col(KEY).alias("_cut_key"), F.lit(True).alias("_cut"))
    out = with_chunk(rows.join(F.broadcast(flagged), F.col(KEY).eqNullSafe(F.col("_cut_key")), "left"), TS, chunk)
    return out.withColumn(CHUNK_COL, F.when(F.col("_cut"), F.col(CHUNK_COL)).otherwise(F.lit(0).cast("long"))).drop("_cut", "_cut_key")


def chunk_by_size(rows: DataFrame, sizes: DataFrame, chunk: str = DEFAULT_CHUNK, whole_rows: int = WHOLE_ROWS) -> tuple[DataFrame, bool]:
    """Rows with a chunk column in which only aircraft of more than ``whole_rows`` rows are cut, and whether none is.

    ``sizes``: rows per aircraft (``_rows``), read twice."""
    cut = sizes.filter(F.col("_rows") > whole_rows).select(KEY)
    n = cut.count()
    if n > BROADCAST_MAX_CUT:
        return with_chunk(rows, TS, chunk), False
    return (chunk_of_cut(rows, chunk, cut), False) if n else (rows.withColumn(CHUNK_COL, F.lit(0).cast("long")), True)


def temporal_features(df: DataFrame, chunk: str = DEFAULT_CHUNK, carry: DataFrame | None = None,
                      keep_chunk: bool = False, whole: bool = False) -> DataFrame:
    """prev_altitude, prev_velocity, altitude_change, velocity_change, observation_rank.

    ``chunk``: length of the time chunks (any length gives the same values). ``carry``: what
    came before, per aircraft (``operators.carry``). ``keep_chunk`` leaves the chunk column in,
    for windows on the same partitioning. ``whole``: every aircraft is one chunk, so nothing comes before a chunk but ``carry``."""
    rows = with_chunk(df, TS, chunk)
    order = _order(df)
    counted = _MORE in df.columns
    w = Window.partitionBy(KEY, CHUNK_COL).orderBy(*order)
    number = F.row_number().over(w)
    rank = number
    if counted:
        rank = rank + F.coalesce(F.sum(_MORE).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = {field: F.lag(field).over(w) for field in FIELDS}
    if not whole or carry is not None:
        starts = chunk_starts(rows, KEY, order, FIELDS, F.col(_MORE) + 1 if counted else None, carry)
        rows = rows.join(starts, [KEY, CHUNK_COL], "left")
        rank = F.coalesce("_before", F.lit(0)) + rank
        before = {field: F.when(number == 1, F.col(f"_prev.{field}")).otherwise(lag) for field, lag in before.items()}
    out = rows.withColumns({
        "prev_altitude": before["altitude_meters"],
        "prev_velocity": before["velocity_kmh"],
        "observation_rank": rank.cast("int"),
    }).drop("_prev", "_before", *([] if keep_chunk else [CHUNK_COL]))
    return (out.withColumn("altitude_change", F.col("altitude_meters") - F.col("prev_altitude"))
            .withColumn("velocity_change", F.col("velocity_kmh") - F.col("prev_velocity")))


def rolling_features(df: DataFrame, chunk: str = DEFAULT_CHUNK, preceding: int = K.ROLLING_PRECEDING,
                     carry: DataFrame | None = None, partitions: int | None = None, whole: bool = False) -> DataFrame:
    """rolling_avg_altitude, rolling_std_altitude, rolling_avg_velocity over
    the current row and ``preceding`` rows before it (``chunk``, ``carry``, ``whole`` as above; ``partitions``: of ``df``, if
    it has been dealt over a given number)."""
    # Rows sharing a timestamp (an observation kept once per equidistant
    # airport) are ordered by airport, so each copy gets the same window in
    # every run and engine. The temporal features come last: they order nothing more, but make the halo rows
    # need the same columns as the data, so that both read one exchange.
    order = _order(df, "airport_icao") + [c for c in ("observation_rank", "prev_altitude") if c in df.columns]
    return trailing_windows(with_chunk(df, TS, chunk), KEY, order, FIELDS, preceding, {
        "rolling_avg_altitude": F.avg("altitude_meters"),
        "rolling_std_altitude": F.stddev("altitude_meters"),
        "rolling_avg_velocity": F.avg("velocity_kmh"),
    }, carry, partitions, whole).drop(CHUNK_COL)


def with_phase(df: DataFrame) -> DataFrame:
    return df.withColumn("flight_phase", flight_phase())


def _partitions(spark: SparkSession, rows: int, task_rows: int) -> int | None:
    """Number of partitions where Spark's own choice could make one of more than ``task_rows`` rows, else None. Never below
    the session's: a join would deal the rows again."""
    needed = -(-rows // task_rows)
    if needed <= spark.sparkContext.defaultParallelism:
        return None
    return max(needed, int(spark.conf.get("spark.sql.shuffle.partitions")))


def counted_features(clean: DataFrame, airports: DataFrame, chunk: str = DEFAULT_CHUNK,
                     broadcast_max_cells: int = ap.BROADCAST_MAX_CELLS,
                     index: ap.AirportIndex | None = None, carry: DataFrame | None = None,
                     task_rows: int = TASK_ROWS, whole_rows: int = 0) -> Counted:
    """Cleaned silver rows -> Silver_ML columns (see module doc), copies and airports still counted.

    ``index``: airport candidates kept between calls (streams); ``carry``: what
    earlier rows left behind per aircraft; the rows of ``clean`` come after them. ``whole_rows``: aircraft of up to that
    many rows are not cut into time chunks (0: all are)."""
    # one scan gives the occupied cells, the number of rows, and that of every aircraft
    located = ap.with_cell(clean, when=F.col("on_ground"))
    sets = [["_cx", "_cy"], [KEY]] if whole_rows else [["_cx", "_cy"]]
    groups = materialize(located.groupingSets(sets, "_cx", "_cy", KEY).agg(
        F.count(F.lit(1)).alias("_rows"), (F.grouping(KEY) == 1).alias("_in_cell")), "cells")
    at = groups.filter("_in_cell")
    cells = at.filter(F.col("_cx").isNotNull() & F.col("_cy").isNotNull()).select("_cx", "_cy")
    partitions = _partitions(clean.sparkSession, at.agg(F.sum("_rows")).first()[0] or 0, task_rows)
    if index is not None:       # streams: reuse the cells earlier batches searched
        ranked = index.ranked()
        k, small = index.candidates(cells)
    else:
        ranked = ap.rank_airports(airports)
        k, small = ap.materialize_candidates(cells, ranked, broadcast_max_cells)
    rows, whole = count_copies(clean), False
    if whole_rows:
        rows, whole = chunk_by_size(rows, groups.filter(~F.col("_in_cell")), chunk, whole_rows)
    rows = deal(with_chunk(rows, TS, chunk), partitions, KEY, *([] if whole else [CHUNK_COL]))
    temporal = temporal_features(rows, carry=carry, keep_chunk=True, whole=whole)
    kept = temporal.filter(F.col("on_ground").isNotNull())
    enriched = ap.apply_enrichment(ap.with_cell(kept, when=F.col("on_ground")), k, small, group_keys=(KEY, CHUNK_COL, TS))
    rolling = rolling_features(enriched, carry=carry, partitions=partitions, whole=whole)
    return Counted(with_phase(rolling), ranked, ranked.count() <= broadcast_max_cells).select(*schemas.SILVER_ML_COLUMNS)


def build_features(clean: DataFrame, airports: DataFrame, chunk: str = DEFAULT_CHUNK,
                   broadcast_max_cells: int = ap.BROADCAST_MAX_CELLS,
                   index: ap.AirportIndex | None = None, carry: DataFrame | None = None, whole_rows: int = 0) -> DataFrame:
    """Every row of :func:`counted_features`."""
    return counted_features(clean, airports, chunk, broadcast_max_cells, index, carry, whole_rows=whole_rows).restored().select(*schemas.SILVER_ML_COLUMNS)


def features_reference_order(clean: DataFrame, airports: DataFrame, chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """Same result as ``build_features`` composed from the public steps
    (each step plans its own exchange); kept for tests and reuse."""
    temporal = temporal_features(clean, chunk)
    enriched = ap.enrich_ground(temporal, airports)
    return with_phase(rolling_features(enriched, chunk)).select(*schemas.SILVER_ML_COLUMNS)


def phase_distribution(features: DataFrame) -> DataFrame:
    """Rows per flight phase, most frequent first."""
    return features.groupBy("flight_phase").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc(), F.col("flight_phase").asc())
