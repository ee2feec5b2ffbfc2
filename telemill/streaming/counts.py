"""Observed counts of a streaming query, stored batch by batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .store import Files

COLUMNS = ["messages_received", "messages_written", "parse_errors", "ignored"]


class _Listener(StreamingQueryListener):
    def __init__(self, owner: BatchCounts):
        self.owner = owner

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.owner.name)
        if row is not None:
            self.owner.store(event.progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.owner.ended.add(str(event.runId))
        self.owner.news.set()


class BatchCounts:
    """Keeps what ``observe(name)`` counted as one small file per batch under ``folder/_counts``; a repeated batch replaces its own."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder, self.name = spark, f"{folder}/_counts", name
        self.files, self.ended, self.news = Files(spark, folder), set(), threading.Event()
        self.listener = _Listener(self)

    def store(self, batch_id: int, counts: dict) -> None:
        self.files.replace(f"{self.folder}/batch-{batch_id:012d}.json", json.dumps({"batch_id": batch_id, **counts}))

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self.listener)
        return self

    def follow(self, query: StreamingQuery, seconds: float = 60) -> StreamingQuery:
        """Wait until the events of an ended query have arrived."""
        while str(query.runId) not in self.ended and self.news.wait(seconds):
            self.news.clear()
        return query

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self.listener)


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """batch_id and the counts of each batch."""
    schema = ", ".join(f"{c} long" for c in ["batch_id", *COLUMNS])
    return spark.read.schema(schema).json(f"{folder}/_counts")
