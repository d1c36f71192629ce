"""Exploration reports over Silver / Silver_ML, and the numbers behind the
exploration plots. Every report runs over whole tables; top-k reports end in
ORDER BY ... LIMIT (per-task top-k, then one small merge) and break ties on
a key so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.session import materialize
from contrail.functions import altitude_bucket, row_score
from contrail.operators.features import FIELDS, ORDER, temporal_features
from contrail.operators.trailing import trailing_windows

# --------------------------------------------------------------- SQL reports


def country_stats_top(silver: DataFrame, n: int = K.TOP_COUNTRIES_REPORT) -> DataFrame:
    """Observations, mean altitude and speed (2 dp) per country; top n by count."""
    return (
        silver.filter(F.col("origin_country").isNotNull())
        .groupBy("origin_country")
        .agg(F.count(F.lit(1)).alias("nb_observations"),
             F.round(F.avg("altitude_meters"), 2).alias("avg_altitude"),
             F.round(F.avg("velocity_kmh"), 2).alias("avg_velocity"))
        .orderBy(F.col("nb_observations").desc(), F.col("origin_country").asc())
        .limit(n)
    )


def ground_vs_air(silver: DataFrame) -> DataFrame:
    return silver.groupBy("on_ground").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("velocity_kmh"), 2).alias("avg_velocity"))


def altitude_distribution(silver: DataFrame) -> DataFrame:
    return (silver.groupBy(altitude_bucket().alias("altitude_range"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("altitude_range").asc()))


def _speed_ranks(silver: DataFrame) -> DataFrame:
    """(origin_country, velocity_kmh, velocity_rank_in_country): counts are pre-aggregated per
    (country, speed) — bounded by the distinct speeds, not the rows — and summed up in rank order."""
    per_speed = silver.groupBy("origin_country", "velocity_kmh").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("origin_country").orderBy(F.col("velocity_kmh").desc_nulls_last())
    return per_speed.withColumn(
        "velocity_rank_in_country",
        (F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).cast("long"),
    ).drop("_n")


def velocity_rank_in_country(silver: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY origin_country ORDER BY velocity_kmh DESC),
    without sending a country's rows to one task.

    rank = 1 + rows of the same country with a strictly higher speed (NULL
    speeds sort last); :func:`_speed_ranks` joined back on (country, speed). ``ranked``: the
    rows to return, if not all of ``silver``.
    """
    rows = silver if ranked is None else ranked
    ranks = _speed_ranks(silver).select(F.col("origin_country").alias("_c"), F.col("velocity_kmh").alias("_v"), "velocity_rank_in_country")
    on = [F.col("origin_country").eqNullSafe(F.col("_c")), F.col("velocity_kmh").eqNullSafe(F.col("_v"))]
    return rows.join(ranks, on=on, how="left").drop("_c", "_v")


def flight_evolution(silver: DataFrame, n: int | None = K.EVOLUTION_LIMIT) -> DataFrame:
    """Per-aircraft evolution report: previous altitude, change, rounded
    6-row rolling mean and speed rank in country, in the order of (icao24, event_timestamp, all
    other columns); the first ``n`` rows, or all.

    The first n rows contain every earlier row of their aircraft, so with ``n`` the windows run on
    those rows only. Windows are cut into time chunks and the rank is a join with the ranks of the
    distinct speeds, so neither an aircraft nor a country becomes one task.
    """
    base = silver.filter(F.col("icao24").isNotNull() & F.col("altitude_meters").isNotNull())
    order = [F.col(c).asc() for c in ("icao24", *ORDER)]
    rows = base if n is None else materialize(base.orderBy(*order).limit(n), "evolution")  # the windows read it twice
    rolled = trailing_windows(temporal_features(rows, keep_chunk=True), "icao24", ORDER, FIELDS, K.ROLLING_PRECEDING,
                              {"rolling_avg_altitude": F.avg("altitude_meters")})
    out = velocity_rank_in_country(base, rolled.withColumn("rolling_avg_altitude", F.round("rolling_avg_altitude", 2)))
    return out.orderBy(*order).select(
        "icao24", "callsign", "origin_country", "event_timestamp", "altitude_meters",
        "prev_altitude", "altitude_change", "rolling_avg_altitude", "velocity_rank_in_country")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count (one global count each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------- plot numbers

def sample_rows(df: DataFrame, fraction: float = K.SAMPLE_FRACTION, seed: int = K.SAMPLE_SEED,
                cap: int | None = None) -> DataFrame:
    """Seeded sample of the whole table: rows whose hash of (seed, aircraft, time, airport) is in the
    lowest ``fraction``. The same rows for any layout. ``cap``, if given, keeps the smallest hashes."""
    score = row_score(df, seed)
    out = df.where(score < F.lit(f"{min(int(fraction * 2 ** 32), 2 ** 32 - 1):08x}"))
    return out if cap is None else out.orderBy(score).limit(cap)


def phase_share(ml: DataFrame) -> DataFrame:
    """Rows per phase and their percentage of all rows."""
    counts = ml.groupBy("flight_phase").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))  # a row per phase
    return counts.withColumn("share_pct", F.round(F.col("count") * F.lit(100.0) / total, 4))


def country_speed_top(ml: DataFrame, n: int = K.TOP_COUNTRIES_SPEED) -> DataFrame:
    return (ml.filter(F.col("origin_country").isNotNull()).groupBy("origin_country")
            .agg(F.avg("velocity_kmh").alias("avg_velocity"))
            .orderBy(F.col("avg_velocity").desc_nulls_last(), F.col("origin_country").asc())
            .limit(n))


def histogram(df: DataFrame, column: str, bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram between the column's min and max; the last bin is
    closed. Empty bins are kept (count 0); a constant column gets the range
    +-0.5. The bounds are one aggregate row fetched first (two numbers), so
    the counting job uses them as literals."""
    x = F.col(column).cast("double")
    lo0, hi0 = df.agg(F.min(x), F.max(x)).first()
    if lo0 is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    if lo0 == hi0:
        lo0, hi0 = lo0 - 0.5, hi0 + 0.5
    lo, hi = F.lit(float(lo0)), F.lit(float(hi0))
    idx = F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return (spine.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = (
        "altitude_meters", "velocity_kmh", "latitude", "longitude",
        "altitude_change", "velocity_change", "rolling_avg_altitude"), weight: Column | None = None) -> DataFrame:
    """Pearson correlation of every column pair (pairwise complete rows), long
    form (feature_x, feature_y, corr). ``weight``: how many rows a row stands for (1 if not given).

    One pass: rows are grouped by which columns are NULL, and each group has its count, its sums and its sums of
    products — shared by all pairs, and added up over the groups where both columns of a pair are
    there. Values are taken relative to one row's, so that large means do not cancel the spread. A pair without
    two rows, or with a constant column, gives NULL."""
    cols = list(columns)
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)],
                        (F.lit(1) if weight is None else weight).cast("long").alias("w"))
    origin = doubles.first() or [None] * len(cols)
    moved = [F.col(f"c{i}") - F.lit(float(origin[i] or 0.0)) for i in range(len(cols))]
    known = [F.col(f"c{i}").isNotNull() for i in range(len(cols))]
    pattern = sum((k.cast("int") * (1 << i) for i, k in enumerate(known)), F.lit(0))
    products = [F.sum(F.col("w") * moved[i] * moved[j]).alias(f"p{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))]
    groups = doubles.groupBy(pattern.alias("known")).agg(
        F.sum("w").alias("n"), *[F.sum(F.col("w") * m).alias(f"s{i}") for i, m in enumerate(moved)], *products)
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols))]
    rows = groups.select("*", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs])).alias("_e")).select(
        F.col("_e.i"), F.col("_e.j"), "known", "n",
        F.array(*[F.col(f"s{i}") for i in range(len(cols))]).alias("s"),
        F.array(*[F.col(f"p{min(i, j)}_{max(i, j)}") for i, j in pairs]).alias("p"))
    at = lambda a, k: F.get(a, k.cast("int"))
    i, j, width = F.col("i"), F.col("j"), len(cols)
    both = rows.filter(F.expr("known & shiftleft(1, i) != 0 and known & shiftleft(1, j) != 0")).groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(at("s", i)).alias("x"), F.sum(at("s", j)).alias("y"), F.sum(at("p", i * width + j)).alias("xy"),
        F.sum(at("p", i * width + i)).alias("xx"), F.sum(at("p", j * width + j)).alias("yy"))
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    vx, vy = n * F.col("xx") - x * x, n * F.col("yy") - y * y
    r = F.when((vx > 0) & (vy > 0), (n * F.col("xy") - x * y) / F.sqrt(F.abs(vx)) / F.sqrt(F.abs(vy)))
    name = F.array(*[F.lit(c) for c in cols])
    every = df.sparkSession.createDataFrame(pairs, "i int, j int")
    return every.join(both, ["i", "j"], "left").select(
        at(name, i).alias("feature_x"), at(name, j).alias("feature_y"), F.when(i == j, F.when(vx > 0, F.lit(1.0))).otherwise(r).alias("corr"))


def traffic_per_minute(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Observations per minute from the first to the last minute, gaps as 0.

    The minute spine is built in two steps — days from the bounds, then
    minutes within each day after a repartition — so no single task emits
    the whole range."""
    minute = F.date_trunc("minute", F.col(ts))
    counts = df.filter(F.col(ts).isNotNull()).groupBy(minute.alias("minute")).agg(
        F.count(F.lit(1)).alias("nb_flights"))
    bounds = counts.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"), "hi")
    spine = days.repartition("day").select(F.explode(F.sequence(
        "day", F.least(F.col("day") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MINUTE"), F.col("hi")),
        F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    return spine.join(counts, "minute", "left").select(
        "minute", F.coalesce("nb_flights", F.lit(0)).cast("long").alias("nb_flights"))


def density(df: DataFrame, column: str, gridsize: int = 200, cut: float = 0.0,
            bins: int = K.HISTOGRAM_BINS, weight: Column | None = None) -> DataFrame:
    """point, x, density, count_scale: Gaussian kernel density of ``column`` on an evenly spaced grid
    (Scott's bandwidth: sample std x n^(-1/5); grid from min - cut*bw to
    max + cut*bw), and the same curve on the scale of a histogram of counts with ``bins`` bins.

    Exact: every row adds its kernel to every grid point. Equal values are counted first (a partial aggregation; ``weight``:
    how many rows a row stands for, 1 if not given), written once, and a value adds its kernel as often as it occurs."""
    x = F.col(column).cast("double")
    ones = F.lit(1) if weight is None else weight
    counted = materialize(df.filter(x.isNotNull()).groupBy(x.alias("_x")).agg(F.sum(ones.cast("long")).alias("_w")), "density")
    # two aggregate rows (five numbers) fetched first; the density job uses literals
    n0, mean, lo0, hi0 = counted.agg(F.sum("_w"), F.sum(F.col("_w") * F.col("_x")) / F.sum("_w"), F.min("_x"), F.max("_x")).first()
    sd0 = 0.0
    if n0 and lo0 != hi0:
        gap = F.col("_x") - F.lit(float(mean))
        sd0 = (counted.agg(F.sum(F.col("_w") * gap * gap)).first()[0] / (n0 - 1)) ** 0.5
    if sd0 == 0:
        return df.sparkSession.createDataFrame([], "point int, x double, density double, count_scale double")
    n, lo, hi = F.lit(float(n0)), F.lit(float(lo0)), F.lit(float(hi0))
    bw = F.lit(float(sd0)) * F.pow(n, F.lit(-0.2))
    start = lo - F.lit(cut) * bw
    step = ((hi + F.lit(cut) * bw) - start) / F.lit(float(gridsize - 1))
    grid_x = start + F.col("_i") * step
    z = (grid_x - F.col("_x")) / bw
    sums = (counted.select("_x", "_w", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("_i"))
            .groupBy("_i").agg(F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z)).alias("_s")))
    curve = F.col("_s") / (bw * F.lit((2 * 3.141592653589793) ** 0.5))
    return sums.select(F.col("_i").alias("point"), grid_x.alias("x"), (curve / n).alias("density"),
                       (curve * (hi - lo) / F.lit(float(bins))).alias("count_scale"))


def top_airports(ground: DataFrame, n: int = K.TOP_AIRPORTS) -> DataFrame:
    """Airports by the number of ground rows enriched with them; top n, ties by code."""
    return (ground.filter(F.col("on_ground")).groupBy("airport_icao", "airport_name", "airport_country")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("airport_icao").asc_nulls_last()).limit(n))
