"""Own detectors as table functions: called by name from SQL on any table, and members of the consensus.

A detector scores the readings of one group in order. It is made anew for each group (``PARTITION BY``), sees one reading at a time
and keeps what it wants to remember, so no group is ever held in memory. As a group is one task's work, partition a busy
device by time as well: the default is a device's day.

    SELECT * FROM jump(TABLE(readings) PARTITION BY (device_id, to_date(timestamp)) ORDER BY (timestamp, id))

returns the columns of the table, whichever they are, with ``jump_score`` and ``jump_anomaly``. A column of the input that
has such a name already is an error. Readings that are null, NaN or infinite have no score and are no anomaly.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

GROUPS = "PARTITION BY (device_id, to_date(timestamp)) ORDER BY (timestamp, id)"


class Scorer(Protocol):
    #: Columns that must be there.
    features: tuple[str, ...]
    #: Scores above it are anomalies.
    limit: float

    def score(self, row: Row) -> float | None: ...


class Jump:
    """Distance of a reading from the one before it in its group; missing readings are passed over."""

    def __init__(self, feature: str = "temperature_c", limit: float = 30.0):
        self.features, self.limit, self.before = (feature,), limit, None

    def score(self, row: Row) -> float | None:
        value = row[self.features[0]]
        if value is None or not math.isfinite(value):
            return None
        before, self.before = self.before, value
        return None if before is None else abs(value - before)


def _function(name: str, make: Callable[[], Scorer]) -> type:
    """The table function's class for one detector."""

    class Function:
        def __init__(self):
            self.scorer = make()

        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError(f"{name} takes a table")
            fields = list(rows.dataType.fields)
            there = [f.name for f in fields]
            absent = [c for c in make().features if c not in there]
            clash = [c for c in (f"{name}_score", f"{name}_anomaly") if c in there]
            if absent or clash:
                raise ValueError(f"{name}: columns missing: {absent}, already there: {clash}")
            return AnalyzeResult(StructType([
                *fields, StructField(f"{name}_score", DoubleType()), StructField(f"{name}_anomaly", BooleanType(), False)]))

        def eval(self, row: Row):
            score = self.scorer.score(row)
            yield (*row, score, score is not None and score > self.scorer.limit)

    return Function


def register(spark: SparkSession, name: str, make: Callable[[], Scorer], groups: str = GROUPS) -> Callable[[DataFrame], DataFrame]:
    """Make a detector callable from SQL under ``name``; returns the step that ``anomaly.detect`` takes."""
    spark.udtf.register(name, udtf(_function(name, make)))
    return step(name, groups)


def step(name: str, groups: str = GROUPS) -> Callable[[DataFrame], DataFrame]:
    """A registered detector, by its SQL name, as a step of the consensus."""
    def run(readings: DataFrame) -> DataFrame:
        return readings.sparkSession.sql(f"SELECT * FROM {name}(TABLE(SELECT * FROM {{readings}}) {groups})", readings=readings)
    return run
