"""Nearest airport for aircraft on the ground, without a cross join.

Distance is planar, in degrees: sqrt(dlat^2 + dlon^2). Every observation
keeps *all* airports at its minimum distance, and the minimum is taken over
all observations sharing (icao24, event_timestamp), as the original job does.

Exact grid search
-----------------
Airports at the same place are searched as one *site* (:func:`rank_airports`
numbers the airports of a place); a site has its number of airports and the
first ``HEAD`` of them, whatever that number is.

Observations are placed in fine cells of ``FINE`` degrees. For every
*occupied* cell C (a set bounded by the globe, not by the data volume) we
build the candidate list K(C): all sites whose distance to the rectangle
C is <= U(C), where U(C) is the smallest "farthest distance" from C to a found
site. Any point of C then finds all of its nearest sites in K(C), and its
airports by a join with them at the end.

K(C) is searched level by level on coarser grids (side ``FINE * m``): a cell
looks at the 3x3 coarse blocks around it; it is settled as soon as U(C) is
below the coarse side (nothing outside the block can be closer). Unsettled
cells go to the next level; at the last level every coordinate (clamped to
the globe) falls into two adjacent coarse cells, so the block holds every
airport and the search always ends. Work is (occupied cells) x (airports in
a neighbourhood); observations then join K on their cell: an equi-join.

The occupied cells and every level's result are written to the checkpoint
folder (one small job per level, the search stops when no cell is open).
K has one row per occupied cell; it is broadcast only when its (cell,
airport) entries (at most ``HEAD`` airports of a site) are at most ``broadcast_max_cells``, beyond that the join is a shuffle join whose
skewed cells (a hub airport) AQE splits. The airport dimension is broadcast
to the level probes only under ``broadcast_max_airports`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.functions import planar_distance
from contrail.session import folder_exists, materialize

FINE = 0.25
LEVELS = (1, 4, 16, 64, 256, 1024, 4096)      # coarse side = FINE * m degrees
LON_CELLS = (-720, 720)                        # fine cell indexes of [-180, 180]
LAT_CELLS = (-360, 360)                        # fine cell indexes of [-90, 90]
# Broadcast bound of the candidate table, in (cell, airport) entries:
# ~100 bytes each in memory, so 1M entries stay near 100 MB per executor.
BROADCAST_MAX_CELLS = 1_000_000
BROADCAST_MAX_AIRPORTS = 200_000

AIRPORT_NAMES = ("airport_icao", "airport_name", "airport_country")
AIRPORT_FIELDS = (*AIRPORT_NAMES, "airport_lat", "airport_lon")
# airports of a site that go with every observation; from the 6th copy of an observation on, the rolling frames
# hold copies only, so the further airports can be joined after them (features.restore_ties)
HEAD = K.ROLLING_PRECEDING + 1
SITE_FIELDS = ("airport_lat", "airport_lon", "_n", "_head")


def _cell(coord: Column) -> Column:
    return F.floor(coord.cast("double") / F.lit(FINE)).cast("long")


def _clamp(c: Column, bounds) -> Column:
    return F.least(F.greatest(c, F.lit(bounds[0])), F.lit(bounds[1]))


def with_cell(df: DataFrame, lat: str = "latitude", lon: str = "longitude", when: Column | None = None) -> DataFrame:
    """Add the fine cell (``_cx``, ``_cy``); NULL where ``when`` is false."""
    cx, cy = _cell(F.col(lon)), _cell(F.col(lat))
    if when is not None:
        cx, cy = F.when(when, cx), F.when(when, cy)
    return df.withColumn("_cx", cx).withColumn("_cy", cy)


def _rect_distances(cx: Column, cy: Column, alon: Column, alat: Column) -> tuple[Column, Column]:
    """(min, max) planar distance from the closed fine cell (cx, cy) to a point."""
    x0, x1 = cx * F.lit(FINE), (cx + 1) * F.lit(FINE)
    y0, y1 = cy * F.lit(FINE), (cy + 1) * F.lit(FINE)
    zero = F.lit(0.0)
    nx = F.greatest(x0 - alon, zero, alon - x1)
    ny = F.greatest(y0 - alat, zero, alat - y1)
    fx = F.greatest(F.abs(alon - x0), F.abs(alon - x1))
    fy = F.greatest(F.abs(alat - y0), F.abs(alat - y1))
    return F.sqrt(nx * nx + ny * ny), F.sqrt(fx * fx + fy * fy)


def first_level(n_airports: int) -> int:
    """Index of the first search level: the one whose 3x3 block is about as
    wide as the mean airport spacing. Any start gives the same (exact) result;
    this only saves levels that could not settle a cell."""
    if n_airports <= 0:
        return len(LEVELS) - 1
    spacing = (360.0 * 180.0 / n_airports) ** 0.5
    for i, m in enumerate(LEVELS):
        if 3 * FINE * m >= spacing:
            return i
    return len(LEVELS) - 1


def rank_airports(airports: DataFrame) -> DataFrame:
    """The airports with coordinates, numbered at their place from 1 by code, name and country; written once."""
    if "_rank" in airports.columns:
        return airports
    at = Window.partitionBy("airport_lat", "airport_lon").orderBy(*AIRPORT_NAMES)
    known = airports.filter(F.col("airport_lat").isNotNull() & F.col("airport_lon").isNotNull()).select(*AIRPORT_FIELDS)
    return materialize(known.withColumn("_rank", F.row_number().over(at)), "airports")


def candidate_airports(cells: DataFrame, airports: DataFrame,
                       broadcast_max_airports: int = BROADCAST_MAX_AIRPORTS, distinct: bool = True,
                       with_entries: bool = False):
    """Occupied cells (``_cx``, ``_cy``) -> ``_cands`` array of candidate sites (SITE_FIELDS).

    One small job per level: a level writes the candidates of the cells it
    settles and the cells still open, and the search stops when none is open.
    """
    ap = (
        rank_airports(airports).groupBy("airport_lat", "airport_lon").agg(
            F.count(F.lit(1)).alias("_n"),
            F.sort_array(F.collect_list(F.when(F.col("_rank") <= HEAD, F.struct(*AIRPORT_NAMES)))).alias("_head"))
        .withColumn("_ax", _clamp(_cell(F.col("airport_lon")), LON_CELLS))
        .withColumn("_ay", _clamp(_cell(F.col("airport_lat")), LAT_CELLS))
        .cache())   # small dimension, read by every level; released below
    # The dimension is broadcast to the probes only behind a row-count check.
    n_airports = ap.count()
    small_ap = n_airports <= broadcast_max_airports
    start = first_level(n_airports)
    # Occupied cells are computed once (one scan of the observations).
    occupied = cells.select("_cx", "_cy")
    if distinct:
        occupied = materialize(occupied.distinct(), "cells")
    remaining = occupied.withColumn("_inbox", F.col("_cx").between(*LON_CELLS) & F.col("_cy").between(*LAT_CELLS))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    by_cell = Window.partitionBy("_cx", "_cy")
    found = []
    for i, m in enumerate(LEVELS):
        if i < start:
            continue
        last = i == len(LEVELS) - 1
        side = FINE * m
        probes = (
            remaining.withColumn("_o", F.explode(offsets))
            .withColumn("_px", F.floor(_clamp(F.col("_cx"), LON_CELLS) / F.lit(m)) + F.col("_o.dx"))
            .withColumn("_py", F.floor(_clamp(F.col("_cy"), LAT_CELLS) / F.lit(m)) + F.col("_o.dy"))
            .drop("_o")
        )
        level_ap = (ap.withColumn("_px", F.floor(F.col("_ax") / F.lit(m)))
                    .withColumn("_py", F.floor(F.col("_ay") / F.lit(m)))
                    .withColumn("_hit", F.lit(True)))
        # Left join: a cell without any airport in its block stays open.
        cand = probes.join(F.broadcast(level_ap) if small_ap else level_ap, on=["_px", "_py"], how="left")
        dmin, dmax = _rect_distances(F.col("_cx"), F.col("_cy"), F.col("airport_lon"), F.col("airport_lat"))
        cand = (cand.withColumn("_dmin", dmin).withColumn("_dmax", dmax)
                .withColumn("_u", F.min("_dmax").over(by_cell)))
        # (a cell with no airport at all in its block has _u NULL: open)
        settled = F.lit(True) if last else F.coalesce(F.col("_inbox") & (F.col("_u") < F.lit(side)), F.lit(False))
        keep = settled & (F.col("_dmin") <= F.col("_u"))
        level = materialize(
            cand.withColumn("_open", ~settled)
            .withColumn("_first", F.row_number().over(by_cell.orderBy("_px", "_py", "airport_lat", "airport_lon")) == 1)
            .filter(keep | (F.col("_open") & F.col("_first")))
            .select("_cx", "_cy", "_inbox", "_open", *SITE_FIELDS),
            "level")
        found.append(level.filter(~F.col("_open")).select("_cx", "_cy", *SITE_FIELDS))
        remaining = level.filter("_open").select("_cx", "_cy", "_inbox").distinct()
        if last or remaining.isEmpty():
            break
    ap.unpersist()
    allc = found[0]
    for part in found[1:]:
        allc = allc.unionByName(part)
    k = allc.groupBy("_cx", "_cy").agg(F.collect_list(F.struct(*SITE_FIELDS)).alias("_cands"))
    return (k, allc) if with_entries else k


def materialize_candidates(cells: DataFrame, airports: DataFrame,
                           broadcast_max_cells: int = BROADCAST_MAX_CELLS) -> tuple[DataFrame, bool]:
    """K over written level parts, and whether it may be broadcast: its
    (cell, airport) entries are counted on the written parts (one small job)
    and compared with ``broadcast_max_cells``."""
    occupied = materialize(cells.select("_cx", "_cy").distinct(), "cells")
    k, entries = candidate_airports(occupied, airports, distinct=False, with_entries=True)
    return k, (entries.select(F.sum(F.size("_head"))).first()[0] or 0) <= broadcast_max_cells


def attach_candidates(df: DataFrame, k: DataFrame, small: bool) -> DataFrame:
    """Join K on the fine cell; add ``_rmin``, the distance to the row's nearest sites, and these as ``_cands``.

    Rows with a NULL cell get NULLs; give them to the broadcast form only (``small``), in the shuffle form they
    would all hash alike."""
    out = df.join(F.broadcast(k) if small else k, on=["_cx", "_cy"], how="left")
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")

    def dist(c):
        return planar_distance(lat, lon, c["airport_lat"], c["airport_lon"])

    out = out.withColumn("_rmin", F.array_min(F.transform("_cands", dist)))
    return out.withColumn("_cands", F.filter("_cands", lambda c: dist(c) == F.col("_rmin")))


def join_sites(df: DataFrame, site: str, airports: DataFrame, small: bool, how: str = "inner", after: Column | None = None) -> DataFrame:
    """Add the ranked airports at the place of the struct column ``site``, as ``_a`` (those of a rank above ``after``).

    ``how`` "left" keeps rows without a site; in the shuffle form these are dealt over places that no airport has."""
    lat, lon = F.col(f"{site}.airport_lat"), F.col(f"{site}.airport_lon")
    if how == "left" and not small:
        lat = F.coalesce(lat, F.lit(1000.0) + F.pmod(F.xxhash64(*[c for c in df.columns if c != site]), F.lit(1 << 20)))
    right = airports.select(F.col("airport_lat").alias("_alat"), F.col("airport_lon").alias("_alon"),
                            F.col("_rank").alias("_arank"), *[F.col(c).alias(f"_{c}") for c in AIRPORT_NAMES])
    left = df.withColumns({"_slat": lat, "_slon": F.coalesce(lon, F.lit(0.0))})
    on = (F.col("_slat") == F.col("_alat")) & (F.col("_slon") == F.col("_alon"))
    if after is not None:
        on = on & (F.col("_arank") > after)
    return left.join(F.broadcast(right) if small else right, on, how).drop("_slat", "_slon", "_alat", "_alon", "_arank")


def _nearest_of_group(df: DataFrame, group_keys) -> DataFrame:
    """Ground rows whose own minimum equals the group minimum.

    The group minimum is a partial aggregate joined back null-safely, so many
    copies of one (aircraft, time) are not gathered in one task (AQE splits a
    skewed join key)."""
    gmin = df.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(group_keys)]).agg(
        F.min("_rmin").alias("_gmin"))
    cond = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(group_keys)]
    return df.join(gmin, on=cond, how="inner").filter(F.col("_rmin") == F.col("_gmin")).drop(
        "_gmin", *[f"_g{i}" for i in range(len(group_keys))])


def nearest_rows(df: DataFrame, airports: DataFrame, small: bool, group_keys=("icao24", "event_timestamp")) -> DataFrame:
    """Keep ground rows whose own minimum equals the group minimum; one row per
    airport at that distance. Needs ``_cands``/``_rmin`` from ``attach_candidates``, and the ranked airports
    (``small``: they may be broadcast)."""
    rows = (_nearest_of_group(df, group_keys)
            .withColumn("_site", F.explode(F.transform("_cands", lambda c: F.struct(c["airport_lat"].alias("airport_lat"), c["airport_lon"].alias("airport_lon")))))
            .drop("_cands", "_rmin", "_cx", "_cy"))
    return join_sites(rows, "_site", airports, small).drop("_site").withColumnsRenamed({f"_{c}": c for c in AIRPORT_NAMES})


def nearest_airport(obs: DataFrame, airports: DataFrame,
                    broadcast_max_cells: int = BROADCAST_MAX_CELLS) -> DataFrame:
    """Ground observations (``on_ground`` true) with their nearest airport(s)."""
    ground = with_cell(obs.filter(F.col("on_ground") == F.lit(True)))
    ranked = rank_airports(airports)
    k, small = materialize_candidates(ground, ranked, broadcast_max_cells)
    return nearest_rows(attach_candidates(ground, k, small), ranked, ranked.count() <= broadcast_max_cells)


def _airborne(obs: DataFrame) -> DataFrame:
    """The rows that are not on the ground, with NULL airports."""
    none = {c: F.lit(None).cast("string") for c in ("airport_icao", "airport_name", "airport_country")}
    return obs.filter(~F.col("on_ground")).withColumns(none)


def enrich_ground(obs: DataFrame, airports: DataFrame,
                  broadcast_max_cells: int = BROADCAST_MAX_CELLS) -> DataFrame:
    """Ground rows get their nearest airport(s), airborne rows NULL airport
    columns; rows with NULL ``on_ground`` are not kept (split semantics).

    Airborne rows take part in no join; the minimum per (aircraft, time) is an aggregate of the ground rows."""
    ground = nearest_airport(obs, airports, broadcast_max_cells)
    return ground.unionByName(_airborne(obs))


def enrich_ground_heads(obs: DataFrame, airports: DataFrame,
                        broadcast_max_cells: int = BROADCAST_MAX_CELLS) -> tuple[DataFrame, DataFrame, bool]:
    """``enrich_ground`` with the first ``HEAD`` airports of a row and the places of the further ones in ``_rest``, for
    ``features.restore_ties``; also the ranked airports, and whether these may be broadcast."""
    ground = with_cell(obs.filter(F.col("on_ground") == F.lit(True)))
    ranked = rank_airports(airports)
    k, small = materialize_candidates(ground, ranked, broadcast_max_cells)
    near = head_airports(_nearest_of_group(attach_candidates(ground, k, small), ("icao24", "event_timestamp")))
    return near.unionByName(_airborne(obs), allowMissingColumns=True), ranked, ranked.count() <= broadcast_max_cells


def apply_enrichment(cells_df: DataFrame, k: DataFrame, small: bool,
                     group_keys=("icao24", "event_timestamp")) -> DataFrame:
    """Row-local airport attachment followed by the group-minimum filter and
    explode; airborne rows pass with NULL airports. Input must have cells.

    A row comes out once for each of its first ``HEAD`` airports by code; ``_rest`` of the last of these has the
    places with further ones (``airport_lat``, ``airport_lon``, ``taken``: how many have come out), for
    ``features.restore_ties``.

    For rows that are partitioned by some of ``group_keys`` and whose exact copies have been counted (the feature
    build): the minimum is then a window on that partitioning. Where the candidates are too many to broadcast,
    only ground rows go into the join."""
    ground = F.col("on_ground")
    if small:
        out = attach_candidates(cells_df, k, True)
    else:
        out = attach_candidates(cells_df.filter(ground), k, False).unionByName(
            cells_df.filter(~ground), allowMissingColumns=True)
    g = Window.partitionBy(*group_keys)
    out = out.withColumn("_gmin", F.when(ground, F.min(F.when(ground, F.col("_rmin"))).over(g)))
    return head_airports(out.filter(~ground | (F.col("_rmin") == F.col("_gmin"))))


def head_airports(out: DataFrame) -> DataFrame:
    """Rows with their nearest sites (``_cands``): one for each of the first ``HEAD`` airports, and ``_rest``."""
    ground = F.col("on_ground")
    # the airports of all its sites by code, each with the number of its site
    heads = F.flatten(F.transform("_cands", lambda c, i: F.transform(c["_head"], lambda a: F.struct(
        *[a[n].alias(n) for n in AIRPORT_NAMES], i.alias("at")))))
    out = out.withColumn("_heads", F.when(ground, F.slice(F.sort_array(heads), 1, HEAD)))
    taken = F.transform("_cands", lambda c, i: F.struct(
        c["airport_lat"].alias("airport_lat"), c["airport_lon"].alias("airport_lon"),
        F.size(F.filter("_heads", lambda a: a["at"] == i)).alias("taken"), c["_n"].alias("n")))
    out = out.withColumn("_rest", F.when(ground & (F.size("_heads") == HEAD), F.filter(taken, lambda r: r["taken"] < r["n"])))
    out = out.select(*[c for c in out.columns if c not in ("_heads", "_gmin", "_cands", "_rmin", "_cx", "_cy")],
                     F.posexplode_outer("_heads").alias("_p", "_a"))
    return (
        out.withColumns({n: F.col(f"_a.{n}") for n in AIRPORT_NAMES})
        .withColumn("_rest", F.when(F.col("_p") == HEAD - 1, F.col("_rest")))
        .drop("_p", "_a")
    )


class AirportIndex:
    """Candidate airports per occupied cell, grown as new cells appear.

    For streams: a micro-batch only searches the cells no earlier batch has
    seen; the index is a Parquet folder (``path``, normally inside the
    stream's own folder, so it survives restarts). Each version of the airport
    table has its own subfolder, named by a fingerprint of its rows."""

    def __init__(self, airports: DataFrame, path: str, broadcast_max_cells: int = BROADCAST_MAX_CELLS):
        self.airports = airports
        rows = airports.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*airports.columns).cast("decimal(38,0)")).alias("h")).first()
        self.path = f"{path.rstrip('/')}/sites-{rows['n']}-{rows['h'] or 0}"
        self.broadcast_max_cells = broadcast_max_cells
        self._ranked = None

    def ranked(self) -> DataFrame:
        """The airports, ranked at their places; written once."""
        if self._ranked is None:
            self._ranked = rank_airports(self.airports)
        return self._ranked

    def _known(self, spark):
        if not folder_exists(spark, f"{self.path}/_SUCCESS"):
            return None  # no index written yet; any other failure to read it is an error
        # two queries that share the folder may both have added a cell
        return spark.read.parquet(self.path).dropDuplicates(["_cx", "_cy"])

    def candidates(self, cells: DataFrame) -> tuple[DataFrame, bool]:
        spark = cells.sparkSession
        occupied = materialize(cells.select("_cx", "_cy").distinct(), "cells")
        known = self._known(spark)
        new = occupied if known is None else occupied.join(known.select("_cx", "_cy"), ["_cx", "_cy"], "left_anti")
        if not new.isEmpty():
            k_new = candidate_airports(new, self.ranked(), distinct=False)
            k_new.write.mode("append").parquet(self.path)
            known = self._known(spark)
        if known is None:  # no ground rows at all so far
            return candidate_airports(occupied, self.ranked(), distinct=False), True
        k = known.join(occupied, ["_cx", "_cy"], "left_semi")
        entries = k.select(F.sum(F.aggregate("_cands", F.lit(0), lambda n, c: n + F.size(c["_head"])))).first()[0] or 0
        return k, entries <= self.broadcast_max_cells
