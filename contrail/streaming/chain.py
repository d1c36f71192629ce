"""The whole chain below one root folder: wire -> Bronze -> Silver and Silver_ML -> Gold.

Every query has its own table folder and its own checkpoint, and reads the table of the
one before it, so each can be stopped, restarted and backfilled by itself. Silver and
Silver_ML both read Bronze; the Gold tables all read Silver_ML.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from contrail import schemas
from contrail.sources.tables import read_table_stream
from contrail.streaming import jobs

GOLD = ("phase_stats", "country_anomalies")


class Chain:
    """``raw``: a function that opens the stream of wire records (column ``value``); ``gold``: the Gold tables and
    their window parameters."""

    def __init__(self, spark: SparkSession, root: str, raw: Callable[[], DataFrame], airports: DataFrame,
                 gold: Mapping[str, Mapping] | None = None):
        self.spark, self.root, self.raw, self.airports = spark, root.rstrip("/"), raw, airports
        self.gold = dict(gold) if gold is not None else {table: {} for table in GOLD}

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _source(self, name: str) -> str:
        """The folder of a table that a query reads; it must be there, even if nothing has been written yet."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.table(name))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        return self.table(name)

    def levels(self, trigger: Mapping | None = None) -> list[list[Callable[[], StreamingQuery]]]:
        """Starters of all queries; those of a level only read tables of earlier levels."""
        def bronze():
            return read_table_stream(self.spark, self._source("bronze"), schemas.WIRE)

        def to(name: str) -> dict:
            return {"path": self.table(name), "checkpoint": self.checkpoint(name), "trigger": trigger, "name": name}

        def gold(table: str, params: Mapping):
            return lambda: jobs.start_gold(jobs.silver_ml_stream(self.spark, self._source("silver_ml")), table, **to(table), **params)

        return [
            [lambda: jobs.start_bronze(self.raw(), **to("bronze"))],
            [lambda: jobs.start_silver(bronze(), **to("silver")),
             lambda: jobs.start_features(bronze(), self.airports, **to("silver_ml"))],
            [gold(table, params) for table, params in self.gold.items()],
        ]

    def start(self, trigger: Mapping | None = None) -> list[StreamingQuery]:
        """Start all queries, to run until they are stopped."""
        return jobs.start_all(starter for level in self.levels(trigger) for starter in level)

    def drain(self) -> None:
        """Take in what has arrived, level by level, and stop (backfills; a scheduled run)."""
        for level in self.levels(jobs.AVAILABLE_NOW):
            queries = jobs.start_all(level)
            jobs.await_all(queries)
            for q in queries:
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))
