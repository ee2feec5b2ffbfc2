"""Structured Streaming jobs over device messages.

A file source feeds them here and in tests; ``kafka_messages`` is the source of
a live deployment. Decoding and classes are the batch functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import derive
from ..functions.numeric import count_true, known, mean_of, rnd, units
from ..session import new_folder
from ..sources import messages as M
from ..sources.bindings import latest_per_device
from . import stateful
from .counts import BatchCounts
from .store import KeyedTable, Kind

TELEMETRY_FIELDS = (*M.TELEMETRY_REQUIRED, "publish_count")
POINTS = {
    "telemetry": Kind(tuple(M.POINT_KEYS["telemetry"]), TELEMETRY_FIELDS, ("batch_id", "arrival_ts")),
    "status": Kind(tuple(M.POINT_KEYS["status"]), (*M.STATUS_COUNTERS, "is_connected"), ("batch_id", "arrival_ts")),
    "events": Kind(tuple(M.POINT_KEYS["events"]), ("firmware_version", "event_count"), ("batch_id", "arrival_ts")),
    "dead_letter": Kind((), ("topic", "payload", "arrival_ts"), ()),
}
STATUS_FIELDS = ("device_type", "location", *M.STATUS_COUNTERS, "is_connected", "time")
LATEST = {"latest": Kind(("device_id",), STATUS_FIELDS, ("time",))}
#: Parts of the latest statuses: each is compacted on its own.
SHARDS = 16
#: How long a device may hold messages back and still have them told from resends.
HORIZON = "30 days"
#: How long an hour stays open for messages that come late.
HOUR_DELAY = "6 hours"
#: Slices of a device whose state is kept apart, so that a busy one is spread; fixed once a checkpoint exists.
SLICES = 4


def file_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as they arrive; the schema comes from the files already there."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def kafka_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages bridged into one Kafka topic, keyed by their device topic (needs the Kafka connector)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.col("key").cast("string").alias("topic"), F.col("value").cast("string").alias("payload"),
                      F.col("timestamp").alias("arrival_ts"))


def _run(df: DataFrame, folder: str, mode: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there, then stop; a restart goes on from the stream's checkpoint."""
    query = (
        df.writeStream.outputMode(mode).foreachBatch(sink)
        .option("checkpointLocation", f"{folder}/_progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _append_batches(path: str, partitions: list[str]) -> Callable[[DataFrame, int], None]:
    """Write each batch under its own number: a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions, "batch_id").parquet(path)
        )
    return write


def all_points(classified: DataFrame) -> DataFrame:
    """Every message that becomes a point or a dead letter, in one wide row format.

    One wide frame means one write per batch: each message is parsed once.
    """
    parsed = classified.filter(F.col("outcome").isin("written", "parse_error"))
    sink = F.when(F.col("outcome") == "parse_error", "dead_letter").otherwise(F.col("kind"))
    number = {n: M._number(n, k) for n, k in M.TELEMETRY_REQUIRED.items()}
    counters = [c for c in M.STATUS_COUNTERS if c not in number]
    connected = F.lower("d.is_connected")
    as_int = F.when(connected == "true", 1).when(connected == "false", 0).otherwise(M._counter("is_connected"))
    dead = F.col("sink") == "dead_letter"
    uptime = F.when(F.col("sink") == "status", M._counter("uptime_s")).otherwise(number["uptime_s"])
    return parsed.withColumn("sink", sink).withColumn("time", M._event_time()).select(
        "sink", F.to_date("time").alias("date"), "time", F.col("arrival_ts").cast("timestamp").alias("arrival_ts"),
        "device_id", M._tag("device_type").alias("device_type"), M._tag("location").alias("location"),
        F.initcap(F.coalesce(F.col("d.anomaly"), F.lit("false"))).alias("anomaly"), M._tag("event").alias("event"),
        *[(uptime if n == "uptime_s" else c).alias(n) for n, c in number.items()],
        *[M._counter(c).alias(c) for c in counters], as_int.cast("bigint").alias("is_connected"),
        M._tag("firmware_version").alias("firmware_version"), F.lit(1).cast("bigint").alias("event_count"),
        F.when(dead, F.col("topic")).alias("topic"), F.when(dead, F.col("payload")).alias("payload"))


def observed(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """Count what becomes of the messages on the fly; ``BatchCounts`` stores the counts of each batch."""
    outcome = F.col("outcome")
    return classified.observe(
        name, count_true("subscribed").alias("messages_received"), count_true(outcome == "written").alias("messages_written"),
        count_true(outcome == "parse_error").alias("parse_errors"), count_true(outcome.startswith("ignored")).alias("ignored"))


def point_table(spark: SparkSession, folder: str, **options) -> KeyedTable:
    """Points and dead letters of a stream, by kind and date."""
    return KeyedTable(spark, f"{folder}/points", POINTS, **options)


def ingest(messages: DataFrame, folder: str, **options) -> StreamingQuery:
    """Decode the stream into the keyed table under ``folder/points`` and store the counts of each batch."""
    spark = messages.sparkSession
    table = point_table(spark, folder, **options)

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed("sink", "kind").withColumn("part", F.col("date").cast("string")).drop("date")
        table.commit(rows.withColumn("batch_id", F.lit(batch_id).cast("long")), "ingest", batch_id)

    with BatchCounts(spark, folder, "ingest") as counts:
        return counts.follow(_run(all_points(observed(M.classified(messages))), folder, "append", commit))


def read_points(spark: SparkSession, folder: str, kind: str, hours: int | None = None, as_of: int | None = None) -> DataFrame:
    """Points of one kind; of points with the same key the last one written counts.

    ``hours`` asks for the time before ``as_of`` (microseconds; the newest point, as the manifest knows it): only
    dates that reach into it are read.
    """
    table = point_table(spark, folder)
    if hours is None:
        return table.read(kind)
    as_of = table.newest(kind) if as_of is None else as_of
    return table.read(kind, since=None if as_of is None else as_of - hours * 3_600_000_000)


def read_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    return point_table(spark, folder).read("dead_letter")


def points_of(messages: DataFrame, kind: str) -> DataFrame:
    return {"telemetry": M.telemetry_points, "status": M.status_points, "events": M.event_points}[kind](M.classified(messages))


def stream_dedup(messages: DataFrame, folder: str, kind: str = "telemetry", horizon: str = HORIZON,
                 slices: int = SLICES) -> StreamingQuery:
    """First points of each key, repeats and late ones, each to an output of its own.

    The keys of the last ``horizon`` are kept in the state store. A point older than that is late: its key
    may have expired, so it is neither passed on nor lost, see ``settled``.
    """
    told = stateful.deduplicated(points_of(messages, kind), M.POINT_KEYS[kind], "time", "device_id", horizon, slices)
    return _run(told, folder, "append", _append_batches(f"{folder}/out", ["outcome"]))


def _outcome(spark: SparkSession, folder: str, outcome: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out").filter(F.col("outcome") == outcome).drop("outcome", "batch_id")


def read_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One point per key, as written: nothing is grouped again."""
    return _outcome(spark, folder, "first")


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """Points that came when their keys had expired."""
    return _outcome(spark, folder, "late")


def dedup_counts(spark: SparkSession, folder: str) -> DataFrame:
    """outcome, points."""
    return spark.read.parquet(f"{folder}/out").groupBy("outcome").agg(F.count(F.lit(1)).alias("points"))


def settled(spark: SparkSession, folder: str, kind: str = "telemetry") -> DataFrame:
    """Late points compared with all that was ever passed on: those that are new, once each. The other late ones are resends."""
    keys = M.POINT_KEYS[kind]
    late = read_late(spark, folder).dropDuplicates(keys)
    return late.join(read_dedup(spark, folder).select(*keys), keys, "left_anti")


def derived(points: DataFrame) -> DataFrame:
    """Telemetry points under table names with time parts and reading classes."""
    named = points.withColumnsRenamed({"cpu_percent": "cpu_pct", "ram_percent": "ram_pct", "time": "timestamp"})
    named = named.withColumn("is_anomaly", derive.flag_text(F.col("anomaly"))).drop("anomaly")
    return derive.time_parts(derive.with_reading_classes(named))


def stream_derive(messages: DataFrame, folder: str) -> StreamingQuery:
    points = M.telemetry_points(M.classified(messages))
    return _run(derived(points), folder, "append", _append_batches(f"{folder}/out", ["date"]))


def status_table(spark: SparkSession, folder: str, **options) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/latest", LATEST, **options)


def stream_latest_status(messages: DataFrame, folder: str, **options) -> StreamingQuery:
    """Latest status per device: a snapshot, and a log of the devices that each batch changed.

    The table is the state: a newer status replaces an older one whenever it comes, so nothing is kept elsewhere, and a
    lost checkpoint costs a replay but no result.
    """
    spark = messages.sparkSession
    table = status_table(spark, folder, **options)

    def commit(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_device(batch, "time")
        part = F.pmod(F.xxhash64("device_id"), F.lit(SHARDS)).cast("string")
        table.commit(newest.withColumns({"kind": F.lit("latest"), "part": part}), "status", batch_id)

    return _run(points_of(messages, "status"), folder, "append", commit)


def read_latest_status(spark: SparkSession, folder: str) -> DataFrame:
    return derive.with_status_classes(status_table(spark, folder).read("latest"))


def stream_hourly(messages: DataFrame, folder: str, delay: str = HOUR_DELAY) -> StreamingQuery:
    """Hourly sums, without deduplication: closed hours are written once, rows that come after that as corrections."""
    sums = stateful.hourly(points_of(messages, "telemetry"), units(known("cpu_percent")), units(known("temperature_c")), delay)
    return _run(sums, folder, "append", _append_batches(f"{folder}/out", ["outcome"]))


def hour_sums(spark: SparkSession, folder: str) -> DataFrame:
    """hour_start, sums, outcome: ``closed``, ``correction``, or ``open`` for hours whose sums are still in the state store."""
    schema = f"hour_start timestamp, {stateful.SUMS_SCHEMA}, outcome string, batch_id long"
    done = spark.read.schema(schema).parquet(f"{folder}/out").drop("batch_id")
    return done.unionByName(stateful.open_hours(spark, f"{folder}/_progress").withColumn("outcome", F.lit("open")))


def read_hourly(spark: SparkSession, folder: str, closed_only: bool = False) -> DataFrame:
    """Calendar-hour patterns over all messages so far, open hours included unless only closed ones are wanted."""
    sums = hour_sums(spark, folder)
    if closed_only:
        sums = sums.filter("outcome = 'closed'")
    hours = sums.groupBy("hour_start").agg(
        *[F.sum(c).alias(c) for c in stateful.SUMS if c != "cpu_max"], F.max("cpu_max").alias("cpu_max"))
    return hours.select(
        "hour_start", F.col("readings").alias("reading_count"), rnd(mean_of("cpu", "cpu_n"), 1).alias("avg_cpu_pct"),
        rnd(mean_of("temp", "temp_n"), 1).alias("avg_temp_c"), rnd("cpu_max", 1).alias("peak_cpu_pct"),
        F.col("anomalies").alias("anomaly_count"))


def results(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/out").drop("batch_id")


def run_on_tables(spark: SparkSession, messages: DataFrame, job: Callable, name: str) -> str:
    """Run a job in a fresh folder below the shared one and return the folder."""
    folder = new_folder(spark, name)
    job(messages, folder)
    return folder
