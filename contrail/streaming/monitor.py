"""What the running queries have done, collected from their progress events."""

from __future__ import annotations

from collections import defaultdict
from threading import Lock

from pyspark.sql.streaming import StreamingQueryListener


class QueryMonitor(StreamingQueryListener):
    """Totals per query name: batches, input rows, rows dropped behind the watermark, the last watermark, failures.

    ``spark.streams.addListener(monitor)``; events arrive a little after the batch they tell of.
    """

    def __init__(self):
        self._lock = Lock()
        self._totals: dict = defaultdict(lambda: {"batches": 0, "input_rows": 0, "dropped_rows": 0, "state_rows": 0,
                                                  "watermark": None, "runs": 0, "ended": 0, "error": None})
        self._names: dict = {}

    def onQueryStarted(self, event):
        with self._lock:
            self._names[str(event.runId)] = event.name or str(event.id)
            self._totals[event.name or str(event.id)]["runs"] += 1

    def onQueryProgress(self, event):
        p = event.progress
        with self._lock:
            t = self._totals[p.name or str(p.id)]
            t["batches"] += 1
            t["input_rows"] += p.numInputRows
            t["dropped_rows"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            t["state_rows"] = sum(s.numRowsTotal for s in p.stateOperators)
            t["watermark"] = (p.eventTime or {}).get("watermark", t["watermark"])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            t = self._totals[self._names.get(str(event.runId), str(event.id))]
            t["ended"] += 1
            t["error"] = event.exception or t["error"]

    def totals(self) -> dict[str, dict]:
        with self._lock:
            return {name: dict(t) for name, t in self._totals.items()}
