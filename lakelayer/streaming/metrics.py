"""Rule counters of a stream, stored per micro-batch by a streaming listener.

``watch`` adds the counters to a stream's plan (one metric set a batch, no further job); the listener takes them from the
progress of the query and a writer thread appends them to a folder, so neither the stream nor the listener waits
for a write. A batch that runs again reports again under its number; ``read`` keeps one report of each.
"""

from __future__ import annotations

import queue
import threading
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lakelayer.operators.quality import _passes
from lakelayer.session import missing_path

ROW = "query string, batch long, rule string, rows long, failed long"


class RuleMetrics(StreamingQueryListener):
    """Use as a context: the listener is registered on entry; on exit it waits for the reports of ended queries."""

    def __init__(self, spark: SparkSession, path: str, wait_s: float = 60.0):
        self.spark, self.path, self.wait_s = spark, path, wait_s
        self.name = f"rules_{uuid.uuid4().hex[:12]}"
        self.rules: dict[str, str] = {}
        self.todo: queue.Queue = queue.Queue()
        self.running = 0
        self.ended = threading.Condition()

    def watch(self, stream: DataFrame, rules: Mapping[str, str]) -> DataFrame:
        """The same rows, with a count of rows and of each rule's failures (a NULL predicate fails)."""
        self.rules = {f"failed_{i}": n for i, n in enumerate(rules)}
        failed = [F.count_if(~_passes(p)).alias(f"failed_{i}") for i, p in enumerate(rules.values())]
        return stream.observe(self.name, F.count(F.lit(1)).alias("rows"), *failed)

    def onQueryStarted(self, event) -> None:
        with self.ended:
            self.running += 1

    def onQueryProgress(self, event) -> None:
        p = event.progress
        got = p.observedMetrics.get(self.name)
        if got is not None:
            seen = got.asDict()
            self.todo.put([(str(p.id), int(p.batchId), rule, int(seen["rows"]), int(seen[c])) for c, rule in self.rules.items()])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            self.running -= 1
            self.ended.notify_all()

    def _write(self) -> None:
        while (rows := self.todo.get()) is not None:
            while not self.todo.empty() and self.todo.queue[0] is not None:
                rows = rows + self.todo.get()
            self.spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").json(self.path)

    def __enter__(self) -> RuleMetrics:
        self.writer = threading.Thread(target=self._write, daemon=True)
        self.writer.start()
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        with self.ended:                     # a query's end is reported after its batches
            self.ended.wait_for(lambda: self.running <= 0, self.wait_s)
        self.spark.streams.removeListener(self)
        self.todo.put(None)
        self.writer.join()

    def read(self) -> DataFrame:
        """One row per query, batch and rule."""
        try:
            rows = self.spark.read.schema(ROW).json(self.path)
        except AnalysisException as exc:
            if not missing_path(exc):
                raise
            rows = self.spark.createDataFrame([], ROW)
        return rows.groupBy("query", "batch", "rule").agg(F.max("rows").alias("rows"), F.max("failed").alias("failed"))
