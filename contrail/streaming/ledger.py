"""Commit record of a ``foreachBatch`` sink, and the carried state of its batches.

A batch of a streaming query is identified by (query id, batch id): Spark replays a
batch under the same pair, and a new checkpoint gets a new query id, so its batch 0 is
nobody's replay. The steps of a batch are

1. its rows are written to a hidden folder and *renamed* to
   ``<path>/query_id=<id>/batch_id=<n>`` — readers see all of them or none;
2. the carry rows of its aircraft are written to ``<path>/_carry/<id>/batch_id=<n>``;
3. the record ``<path>/_ledger/<id>/<n>`` is created.

After a crash the batch is replayed: with the record nothing is done; without it, rows
that were renamed already are kept (the rename is atomic, so they are whole) and only
the missing steps run. This needs a file system with atomic folder renames; on an object
store use ``fmt="delta"``, whose log takes the same pair as its transaction id.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.carry import CARRY
from contrail.operators.features import KEY
from contrail.session import folder_exists

#: a whole copy of the carried state is written every so many batches; in between, a batch writes its own aircraft only
FULL_EVERY = 16


class BatchLedger:
    """Records and tables below ``path`` of one streaming query."""

    def __init__(self, spark: SparkSession, path: str, query_id: str):
        self.spark, self.path, self.query_id = spark, path.rstrip("/"), query_id

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------- records

    def _record(self, batch_id: int) -> str:
        return f"{self.path}/_ledger/{self.query_id}/{batch_id}"

    def committed(self, batch_id: int) -> dict | None:
        """The record of a committed batch, or None."""
        if not folder_exists(self.spark, self._record(batch_id)):
            return None
        file, files = self._files(self._record(batch_id))
        stream = files.open(file)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, batch_id: int, **record) -> None:
        part, files = self._files(f"{self._record(batch_id)}.{uuid.uuid4().hex}")
        stream = files.create(part)
        stream.writeBytes(json.dumps(record))
        stream.close()
        files.rename(part, self._files(self._record(batch_id))[0])

    # --------------------------------------------------------------- rows

    def rows_path(self, batch_id: int) -> str:
        return f"{self.path}/query_id={self.query_id}/batch_id={batch_id}"

    def publish(self, rows: DataFrame, batch_id: int, partition_by: list[str]) -> None:
        """Make the rows of a batch visible at once; nothing if they already are."""
        if folder_exists(self.spark, self.rows_path(batch_id)):
            return
        hidden = f"{self.path}/_staging/{uuid.uuid4().hex}"
        rows.write.partitionBy(*partition_by).parquet(hidden)
        source, files = self._files(hidden)
        target, _ = self._files(self.rows_path(batch_id))
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise RuntimeError(f"could not publish batch {batch_id} at {target}")

    # --------------------------------------------------------- carried state

    def _carry_path(self, batch_id: int) -> str:
        return f"{self.path}/_carry/{self.query_id}/batch_id={batch_id}"

    def carry_before(self, batch_id: int) -> DataFrame | None:
        """The carried state of all aircraft before a batch: the last whole copy and the batches after it."""
        if batch_id == 0:
            return None
        since = (self.committed(batch_id - 1) or {}).get("full", 0)
        paths = [p for n in range(since, batch_id) if folder_exists(self.spark, p := self._carry_path(n))]
        if not paths:
            return None
        state = self.spark.read.schema(f"{CARRY}, batch_id long").option(
            "basePath", f"{self.path}/_carry/{self.query_id}").parquet(*paths)
        return state.groupBy(KEY).agg(F.max_by(F.struct("observations", "last", "tail"), "batch_id").alias("_s")).select(KEY, "_s.*")

    def write_carry(self, batch_id: int, new: DataFrame, before: DataFrame | None) -> int:
        """Write the state after a batch; returns the batch of the last whole copy."""
        since = (self.committed(batch_id - 1) or {}).get("full", 0) if batch_id else 0
        if batch_id - since >= FULL_EVERY and before is not None:
            new, since = new.unionByName(before.join(new.select(KEY), KEY, "left_anti")), batch_id
        new.write.mode("overwrite").parquet(self._carry_path(batch_id))
        return since

    def forget(self, full: int) -> None:
        """Delete carried state that no replay can need: what is older than the whole copy before the last one."""
        for n in range(max(0, full - 2 * FULL_EVERY - 1), full - FULL_EVERY):
            folder, files = self._files(self._carry_path(n))
            files.delete(folder, True)
