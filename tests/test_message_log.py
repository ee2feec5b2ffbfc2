"""The log source: growing segments, ranges, restarts, bad lines."""

import json
import os
import random

import pytest

from telemill.session import new_folder
from telemill.sources.message_log import LogReader, log_lines, log_messages, write_log
from telemill.streaming import ingest as S
from telemill.streaming.counts import read_counts
from test_messages import FULL, frame


def put(folder, log, segment, data):
    os.makedirs(f"{folder}/{log}", exist_ok=True)
    with open(f"{folder}/{log}/{segment}", "ab") as f:
        f.write(data)


def line(payload, second=0, topic="fleet/a/telemetry"):
    return json.dumps({"topic": topic, "payload": payload, "arrival_us": 1_700_000_000_000_000 + second * 1_000_000}).encode() + b"\n"


def read(reader, start, end):
    out = []
    for p in reader.partitions(start, end):
        out += [row for batch in reader.read(p) for row in zip(*(c.to_pylist() for c in batch.columns))]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_every_line_is_read_once_wherever_ranges_and_blocks_end(spark, monkeypatch, block):
    monkeypatch.setattr("telemill.sources.message_log.BLOCK", block)
    rng = random.Random(block)
    for split in (1, 2, 5, 16, 1000):
        folder = new_folder(spark, "log")
        reader, want, got, start = LogReader(folder, split), [], [], {}
        assert reader.latestOffset() == {}
        for step in range(6):
            for log in ("x", "y"):
                segment = f"{step // 2:04d}"
                path = f"{folder}/{log}/{segment}"
                for _ in range(rng.randint(0, 4)):
                    text = "".join(rng.choice("abé ") for _ in range(rng.randint(0, 9)))
                    at = os.path.getsize(path) if os.path.exists(path) else 0
                    put(folder, log, segment, text.encode() + b"\n")
                    want += [(log, segment, at, text)] * bool(text)
            end = reader.latestOffset()
            got += read(reader, start, end)
            start = end
        assert sorted(got) == sorted(want)
        assert read(reader, {}, start) == sorted(want)


def test_open_lines_wait_and_closed_segments_end(spark):
    folder = new_folder(spark, "log")
    reader = LogReader(folder, 4)
    put(folder, "x", "1", b"one\ntw")
    first = reader.latestOffset()
    assert first == {"x": ["1", 4]} and [r[3] for r in read(reader, {}, first)] == ["one"]
    put(folder, "x", "1", b"o and more")
    assert reader.latestOffset() == first
    put(folder, "x", "2", b"three\n")
    put(folder, "x", "_part", b"hidden\n")
    second = reader.latestOffset()
    assert [r[3] for r in read(reader, first, second)] == ["two and more", "three"]
    assert read(reader, second, second) == []
    put(folder, "x", "3", b"\xff\n")
    third = reader.latestOffset()
    os.remove(f"{folder}/x/1")
    assert [r[3] for r in read(reader, second, third)] == ["�"]
    with pytest.raises(FileNotFoundError):
        reader.partitions(first, third)


def test_a_restart_resumes_at_its_offset_and_bad_lines_are_dead_letters(spark):
    logs, folder = new_folder(spark, "logs"), new_folder(spark, "ingest")
    run = lambda: S.ingest(log_messages(spark, logs, split=64), folder)
    put(logs, "x", "1", line(json.dumps(FULL)) + b"no json\n" + b"[1]\n" + b'{"topic": 3}\n\n' + line(json.dumps(FULL), 1)[:20])
    run()
    brought = lambda: S.point_table(spark, folder).brought()
    assert brought() == {"telemetry": 1, "dead_letter": 3}
    put(logs, "x", "1", line(json.dumps(FULL), 1)[20:])
    put(logs, "y", "1", line("{", 2) + line("{}", 3, "elsewhere/a/telemetry"))
    run()
    run()
    assert brought() == {"telemetry": 2, "dead_letter": 4}
    assert sorted(r["payload"] for r in S.read_dead_letters(spark, folder).collect()) == ["[1]", "no json", "{", '{"topic": 3}']
    counts = read_counts(spark, folder).groupBy().sum("messages_received", "messages_written", "parse_errors", "ignored").first()
    assert tuple(counts) == (6, 2, 4, 0)  # the message of another topic is not subscribed to


def test_long_lines(spark):
    logs = new_folder(spark, "logs")
    put(logs, "x", "1", b"a" * 9_000_000 + b"\nb\n")
    rows = []
    query = log_lines(spark, logs, split=1_000_000).selectExpr("position", "length(value) AS n").writeStream.foreachBatch(
        lambda df, _: rows.extend(df.collect())).option("checkpointLocation", new_folder(spark, "at")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["position"], r["n"]) for r in rows) == [(0, 9_000_000), (9_000_001, 1)]


def test_segments_written_later_sort_later(spark):
    logs = new_folder(spark, "logs")
    reader, start, seen = LogReader(logs, 100), {}, 0
    for n in range(3):
        write_log(frame(spark, [(f"fleet/d{i}/telemetry", FULL, i + 100 * n) for i in range(20)]).repartition(3 - n), logs, 2)
        end = reader.latestOffset()
        seen += len(read(reader, start, end))
        start = end
        assert seen == 20 * (n + 1)
