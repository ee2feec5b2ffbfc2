"""Jobs that keep state per key in Spark's state store (RocksDB) and let event time expire it.

The watermark column is tracked and then dropped before the stateful step, so Spark advances the
watermark and fires timers by it but does not discard what comes late: late rows reach the processor, which
sends them to an output of their own. A device clock that runs ahead moves the watermark no further than the present.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
HOUR_MS = 3_600_000


def use_rocksdb(spark: SparkSession) -> None:
    """State beyond the executors' memory; needed by processors with timers and map state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def _clocked(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """Track a watermark over ``time`` and keep the column itself as a plain one, ``time_us``."""
    clock = rows.withColumn("_clock", F.least(F.col(time), F.current_timestamp())).withWatermark("_clock", delay)
    return clock.withColumn("time_us", F.unix_micros(time)).drop("_clock", time)


class KeySeen(StatefulProcessor):
    """Tells first rows of a key from repeated and late ones; adds ``outcome``.

    State: per day a string of 16-byte key digests. A day's digests expire when the watermark has passed
    its end; from then on its rows are ``late``, for nobody can tell whether they came before.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "digests binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        frame = pd.concat(list(rows), ignore_index=True)
        frame = frame.sort_values(["digest", "rank"], kind="stable").reset_index(drop=True)
        late = frame["time_us"] < limit
        outcome = pd.Series("first", frame.index)
        outcome[frame["digest"].duplicated()] = "repeat"
        outcome[late] = "late"
        fresh = frame[~late]
        new_group = not self.days.exists()
        first_day = None
        for day, own in fresh.groupby(fresh["time_us"] // (DAY_MS * 1000)):
            day = int(day)
            known = None if new_group else self.days.getValue((day,))
            seen = bytes(known[0]) if known else b""
            if seen:
                old = {seen[i:i + 16] for i in range(0, len(seen), 16)}
                outcome[own.index[own["digest"].map(lambda d: bytes(d) in old)]] = "repeat"
            else:
                first_day = day if first_day is None else min(first_day, day)
            new = own["digest"][outcome[own.index] == "first"]
            if len(new):
                self.days.updateValue((day,), (seen + b"".join(map(bytes, new)),))
        if first_day is not None:  # a timer for the earliest new day; when it fires it sets the next one
            self.handle.registerTimer((first_day + 1) * DAY_MS)
        yield frame.drop(columns=["digest", "rank", "part"]).assign(outcome=outcome)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = timerValues.getCurrentWatermarkInMs() // DAY_MS
        held = [int(d[0]) for d in self.days.keys()]
        for day in held:
            if day < over:
                self.days.removeKey((day,))
        left = [d for d in held if d >= over]
        if left:
            self.handle.registerTimer((min(left) + 1) * DAY_MS)
        return iter(())

    def close(self) -> None:
        pass


def deduplicated(points: DataFrame, keys: list[str], time: str, group: str, horizon: str, parts: int) -> DataFrame:
    """Rows with ``outcome``: first, repeat, or late (older than the newest time by more than ``horizon``).

    State is kept per ``group`` column and ``parts`` slices of it, so that one hot device is spread.
    """
    use_rocksdb(points.sparkSession)
    columns = points.columns
    digest = F.unhex(F.md5(F.to_json(F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(k) for k in keys]))))
    marked = points.withColumns({
        "digest": digest, "part": F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"),
        "rank": F.xxhash64(*columns)})
    ready = _clocked(marked, time, horizon)
    kept = [c for c in ready.columns if c not in ("digest", "rank", "part")]
    schema = ", ".join(f"`{c}` {ready.schema[c].dataType.simpleString()}" for c in kept)
    told = ready.groupBy(group, "part").transformWithStateInPandas(
        KeySeen(), f"{schema}, outcome string", "append", "eventTime")
    return told.withColumn(time, F.timestamp_micros("time_us")).select(*columns, "outcome")


SUMS = ["readings", "cpu", "cpu_n", "temp", "temp_n", "cpu_max", "anomalies"]
SUMS_SCHEMA = "readings long, cpu decimal(38,0), cpu_n long, temp decimal(38,0), temp_n long, cpu_max double, anomalies long"


class HourSums(StatefulProcessor):
    """Sums of an hour until the watermark closes it; what comes later goes out as a correction."""

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS_SCHEMA)

    @staticmethod
    def _row(key, sums: tuple, outcome: str) -> pd.DataFrame:
        return pd.DataFrame([(int(key[0]), *sums, outcome)], columns=["hour_us", *SUMS, "outcome"]).astype(
            {"cpu": object, "temp": object})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[0]) // 1000 + HOUR_MS
        frame = pd.concat(list(rows), ignore_index=True)
        most = frame["cpu_max"].max()
        now = tuple(sum(int(x) for x in frame[c]) for c in SUMS[:5]) + (
            None if pd.isna(most) else float(most), int(frame["anomalies"].sum()))
        old = self.sums.get() if self.sums.exists() else None
        if old is None and end <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, _decimals(now), "correction")
            return
        if old is None:
            self.handle.registerTimer(end)
        else:
            both = [x for x in (old[5], now[5]) if x is not None]
            now = tuple(int(a) + b for a, b in zip(old[:5], now[:5])) + (max(both) if both else None, old[6] + now[6])
        self.sums.update(_decimals(now))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            closed = self.sums.get()
            self.sums.clear()
            yield self._row(key, tuple(closed), "closed")

    def close(self) -> None:
        pass


def _decimals(sums: tuple) -> tuple:
    return (sums[0], Decimal(sums[1]), sums[2], Decimal(sums[3]), *sums[4:])


def _parts(batches):
    """Sums of each hour in one task's rows, so that a busy hour sends a row per task and not one per message."""
    for batch in batches:
        if batch.num_rows:
            out = pa.Table.from_batches([batch]).group_by("hour_us").aggregate(
                [("clock", "max"), ("cpu", "count"), ("cpu", "sum"), ("temp", "count"), ("temp", "sum"), ("cpu_max", "max"),
                 ("anomaly", "sum"), ("one", "sum")])
            whole = pa.decimal128(38, 0)
            yield from pa.table({
                "hour_us": out["hour_us"], "clock": out["clock_max"], "readings": out["one_sum"].cast(pa.int64()),
                "cpu": pc.fill_null(out["cpu_sum"].cast(whole), 0), "cpu_n": out["cpu_count"],
                "temp": pc.fill_null(out["temp_sum"].cast(whole), 0), "temp_n": out["temp_count"],
                "cpu_max": out["cpu_max_max"], "anomalies": out["anomaly_sum"].cast(pa.int64())}).to_batches()


def hourly(points: DataFrame, cpu_units: Column, temp_units: Column, delay: str) -> DataFrame:
    """hour_start, sums, outcome: an hour once when it closes, and corrections for rows after that."""
    use_rocksdb(points.sparkSession)
    narrow = points.select(
        F.unix_micros(F.date_trunc("hour", "time")).alias("hour_us"), F.col("time").alias("clock"),
        cpu_units.alias("cpu"), temp_units.alias("temp"), F.col("cpu_percent").alias("cpu_max"),
        (F.col("anomaly") == "True").cast("int").alias("anomaly"), F.lit(1).alias("one"))
    parts = narrow.mapInArrow(_parts, f"hour_us long, clock timestamp, {SUMS_SCHEMA}")
    told = _clocked(parts, "clock", delay).drop("time_us").groupBy("hour_us").transformWithStateInPandas(
        HourSums(), f"hour_us long, {SUMS_SCHEMA}, outcome string", "append", "eventTime")
    return told.select(F.timestamp_micros("hour_us").alias("hour_start"), *SUMS, "outcome")


def open_hours(spark: SparkSession, progress: str) -> DataFrame:
    """hour_start and sums of the hours that are still open, read from the state store as last committed."""
    state = spark.read.format("statestore").option("path", progress).option("stateVarName", "sums").load()
    return state.select(F.timestamp_micros("key.hour_us").alias("hour_start"), *[F.col(f"value.{c}").alias(c) for c in SUMS])
