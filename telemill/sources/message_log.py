"""Messages from log files that are still being written, as a streaming source.

A log folder holds one folder per log (say, one per bridge), and in it segments in name order. Only the last
segment of a log grows, and a new one sorts after all there are; lines are never changed. The offset of a stream is a segment and a byte position per log, so it
does not grow with the files, and a restart resumes at the very byte. A line is read once its newline is there, the
last line of an older segment even without one. Empty lines are no messages.

A segment may be removed once a later one of its log has been read from; a stream whose next segment is gone fails.
Segments are cut into ranges of ``SPLIT`` bytes; a line belongs to the range it begins in. Paths may be those of any
file system pyarrow knows, and must mean the same on all nodes.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "message_log"
SCHEMA = "log string, segment string, position long, value string"
SPLIT = 64 << 20
BLOCK = 4 << 20
LINE_SCHEMA = "topic STRING, payload STRING, arrival_us LONG, _corrupt STRING"


@dataclass
class Range(InputPartition):
    """Lines of a segment that begin in ``lo``..``hi``; none reaches beyond ``end``. ``cut``: ``lo`` may be inside a line."""

    log: str
    segment: str
    lo: int
    hi: int
    end: int
    cut: bool


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def _segments(self) -> dict[str, list[tuple[str, int]]]:
        """Segments and sizes of each log, in name order."""
        files, root = _opened(self.path)
        out: dict[str, list[tuple[str, int]]] = {}
        for log in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if log.type == fs.FileType.Directory and not _hidden(log.base_name):
                own = [(f.base_name, f.size) for f in files.get_file_info(fs.FileSelector(log.path))
                       if f.type == fs.FileType.File and not _hidden(f.base_name)]
                if own:
                    out[log.base_name] = sorted(own)
        return out

    def _whole_lines(self, log: str, segment: str, size: int) -> int:
        """Where the last complete line ends."""
        files, root = _opened(self.path)
        with files.open_input_file(f"{root}/{log}/{segment}") as f:
            while size:
                lo = max(size - BLOCK, 0)
                at = f.read_at(size - lo, lo).rfind(b"\n")
                if at >= 0:
                    return lo + at + 1
                size = lo
        return 0

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {log: [own[-1][0], self._whole_lines(log, *own[-1])] for log, own in self._segments().items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        there = self._segments()
        out = []
        for log, (last, until) in end.items():
            first, begin = start.get(log, ("", 0))
            sizes = {s: n for s, n in there.get(log, []) if first <= s <= last}
            if last not in sizes or first and first not in sizes:
                raise FileNotFoundError(f"{self.path}/{log}: a segment from {first or 'the first'} to {last} that was not read is gone")
            for segment, size in sizes.items():
                lo, hi = begin if segment == first else 0, until if segment == last else size
                out += [Range(log, segment, at, min(at + self.split, hi), hi, at > lo) for at in range(lo, hi, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        p = partition
        files, root = _opened(self.path)
        with files.open_input_file(f"{root}/{p.log}/{p.segment}") as f:
            at, rest = p.lo, b""
            if p.cut:  # the line that the byte before belongs to is the range's before
                at -= 1
                while at < p.hi:
                    found = f.read_at(min(BLOCK, p.end - at), at).find(b"\n")
                    if found >= 0:
                        at += found + 1
                        break
                    at += BLOCK
            f.seek(min(at, p.end))
            while at < p.hi:
                block = f.read(min(max(BLOCK, len(rest)), p.end - at - len(rest)))
                lines = (rest + block).split(b"\n")
                rest = lines.pop() if block else b""
                size = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
                places = at + np.concatenate([[0], np.cumsum(size)])
                own = [(int(x), line.decode("utf-8", "replace")) for x, line in zip(places, lines) if line and x < p.hi]
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p.log] * len(own)), pa.array([p.segment] * len(own)), pa.array([x for x, _ in own], pa.int64()),
                         pa.array([v for _, v in own])], ["log", "segment", "position", "value"])
                if not block:
                    break
                at = int(places[-1])

    def commit(self, end: dict) -> None:
        pass


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options["path"].rstrip("/"), int(self.options.get("split", SPLIT)))


def log_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """log, segment, position, value: the stream of lines."""
    spark.dataSource.register(MessageLog)
    return spark.readStream.format(NAME).options(**options).load(path)


def log_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """The messages of a log: each line a JSON object with topic, payload and arrival_us (microseconds).

    A line that is none has no topic, itself as payload and the epoch as arrival: decoding makes a dead letter of it.
    """
    parsed = F.from_json("value", LINE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    lines = log_lines(spark, path, **options).select("value", F.explode(F.array(parsed)).alias("m"))
    good = F.col("m._corrupt").isNull() & F.col("m.topic").isNotNull() & F.col("m.arrival_us").isNotNull()
    return lines.select(
        F.when(good, F.col("m.topic")).alias("topic"), F.when(good, F.col("m.payload")).otherwise(F.col("value")).alias("payload"),
        F.timestamp_micros(F.when(good, F.col("m.arrival_us")).otherwise(F.lit(0))).alias("arrival_ts"))


def write_log(messages: DataFrame, path: str, logs: int = 4) -> None:
    """Append messages to a log folder, while no stream reads it: every task adds a segment to each log, spread by topic.

    Segments are named after the time of the call, so that they sort after those of earlier calls.
    """
    line = F.to_json(F.struct("topic", "payload", F.unix_micros(F.col("arrival_ts").cast("timestamp")).alias("arrival_us")))
    rows = messages.select(line.alias("value"), F.pmod(F.xxhash64("topic"), F.lit(logs)).alias("log"))
    rows.write.mode("append").partitionBy("log").options(
        **{"compression": "none", "mapreduce.output.basename": f"{time.time_ns():020d}"}).text(path)
