"""What a run of the feature build leaves behind for the rows that come after it.

One row per aircraft: how many observations it has had, the last one's altitude and
speed (for LAG), and the last 5 feature rows' altitude and speed (for the rolling
frames). A later build that is given this table continues the windows as if all rows
had been in one table, as long as its rows come later than those it carries from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail import constants as K
from contrail.operators.features import FIELDS, KEY, ORDER

_ROW = "struct<altitude_meters:float,velocity_kmh:double>"
CARRY = f"{KEY} string, observations long, last {_ROW}, tail array<{_ROW}>"


def next_carry(clean: DataFrame, features: DataFrame, carry: DataFrame | None = None,
               preceding: int = K.ROLLING_PRECEDING) -> DataFrame:
    """The carry rows of the aircraft in ``clean``, after ``clean`` and the ``features`` built from it with ``carry``."""
    seen = clean.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"), F.max_by(F.struct(*FIELDS), F.struct(*ORDER)).alias("last"))
    # rows that differ in neither of ORDER's columns (one per airport) have the same values: counted first
    latest = Window.partitionBy(KEY).orderBy(*[F.col(c).desc() for c in ORDER])
    counted = features.groupBy(KEY, *ORDER).agg(F.least(F.count(F.lit(1)), F.lit(preceding)).cast("int").alias("_n"))
    last = counted.select("*", F.row_number().over(latest).alias("_d")).filter(F.col("_d") <= preceding)
    copies = last.select(KEY, *FIELDS, "_d", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_c"))
    ends = copies.select(KEY, *FIELDS, F.row_number().over(Window.partitionBy(KEY).orderBy("_d", "_c")).alias("_back")).filter(
        F.col("_back") <= preceding)
    tails = ends.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), *FIELDS))).alias("_new")).select(
        KEY, F.transform("_new", lambda r: F.struct(*[r[f].alias(f) for f in FIELDS])).alias("_new"))
    out = seen.join(tails, KEY, "left")
    none = F.array().cast(f"array<{_ROW}>")
    if carry is None:
        out = out.withColumns({"observations": F.lit(0).cast("long"), "tail": none})
    else:
        out = out.join(carry.select(KEY, "observations", "tail"), KEY, "left")
    both = F.concat(F.coalesce("tail", none), F.coalesce("_new", none))
    return out.select(
        KEY, (F.coalesce("observations", F.lit(0)) + F.col("_n")).cast("long").alias("observations"),
        F.col("last").cast(_ROW).alias("last"),
        F.slice(both, F.greatest(F.size(both) - (preceding - 1), F.lit(1)), preceding).cast(f"array<{_ROW}>").alias("tail"))
