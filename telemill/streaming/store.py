"""Keyed tables on shared storage: batches arrive as deltas, a manifest switches versions at once.

A table holds rows of several kinds, cut into parts (a date, a shard). A batch is written once, as a delta of
every part it touches; then one new manifest names all files of the next version, and only with it do they
count. A part with ``merge_every`` deltas is compacted into one row per key, again by a new manifest. So

- a reader works on one version from start to end, whatever is written meanwhile;
- a read touches each part's compacted files and fewer than ``merge_every`` deltas, however many batches there were;
- a job that dies between writing and switching leaves files nobody names: the stream repeats its batch, and a batch
  whose number the manifest has is not applied again. Nothing is lost or counted twice.

The manifest has a line per part with its row count and its earliest and latest time, so ranges of time are read
from the parts they touch, and the latest time is known without reading any. It grows with the number of parts only.
One stream writes a table; any number of jobs may read it. Times may be null; such rows are in every range without bounds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

MERGE_EVERY = 8
#: Versions that stay readable after newer ones came.
KEEP = 5


@dataclass(frozen=True)
class Kind:
    """``keys``: one row per key counts (none: all rows do); ``order``: of rows with one key the greatest counts."""

    keys: tuple[str, ...]
    fields: tuple[str, ...]
    order: tuple[str, ...]


class Files:
    """The few file operations a manifest needs, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(folder).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Whole or not at all; an error if the file is there."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(draft, self.path(name)):
            raise FileExistsError(name)

    def replace(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class KeyedTable:
    """Rows with the columns ``kind`` and ``part`` (text) besides their own."""

    def __init__(self, spark: SparkSession, folder: str, kinds: dict[str, Kind], time: str = "time",
                 merge_every: int = MERGE_EVERY, keep: int = KEEP):
        self.spark, self.folder, self.kinds, self.time = spark, folder.rstrip("/"), kinds, time
        self.merge_every, self.keep = merge_every, keep
        self.files = Files(spark, folder)

    # versions

    def _versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.files.names(f"{self.folder}/manifest") if n.startswith("v") and n.endswith(".json"))

    def _name(self, version: int) -> str:
        return f"{self.folder}/manifest/v{version:012d}.json"

    def manifest(self) -> dict:
        """The current version: ``batches`` (stream to last batch), ``schema``, ``parts``."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "batches": {}, "schema": None, "parts": []}
        return json.loads(self.files.read(self._name(versions[-1])))

    def _switch(self, manifest: dict) -> None:
        manifest["version"] += 1
        self.files.put(self._name(manifest["version"]), json.dumps(manifest))
        self._tidy()

    def _tidy(self) -> None:
        """Drop versions beyond the last ``keep`` and the files that only they name."""
        versions = self._versions()
        old = versions[:-self.keep]
        if not old:
            return
        kept = {f for v in versions[-self.keep:] for f in self._named(json.loads(self.files.read(self._name(v))))}
        for v in old:
            for f in self._named(json.loads(self.files.read(self._name(v)))) - kept:
                self.files.remove(f)
            self.files.remove(self._name(v))

    @staticmethod
    def _named(manifest: dict) -> set[str]:
        return {f for p in manifest["parts"] for f in [*p["base"], *p["deltas"]]}

    # writing

    def _written(self, rows: DataFrame, name: str) -> dict[tuple, dict]:
        """Write rows under a new folder; per (kind, part): path, rows, low, high."""
        root = f"{self.folder}/data/{name}-{uuid.uuid4().hex}"
        rows.withColumns({"_kind": F.col("kind"), "_part": F.col("part")}).write.partitionBy("_kind", "_part").parquet(root)
        if not any(n.startswith("_kind=") for n in self.files.names(root)):
            return {}
        there = self.spark.read.schema(rows.schema).parquet(root)
        micros = F.unix_micros(self.time)
        counts = there.groupBy("kind", "part").agg(
            F.count(F.lit(1)).alias("n"), F.min(micros).alias("low"), F.max(micros).alias("high")).collect()
        found = {}
        for r in counts:
            part = "__HIVE_DEFAULT_PARTITION__" if r["part"] is None else r["part"]
            found[(r["kind"], r["part"])] = {"path": f"{root}/_kind={r['kind']}/_part={part}", "rows": r["n"], "low": r["low"], "high": r["high"]}
        return found

    def commit(self, batch: DataFrame, stream: str, batch_id: int) -> bool:
        """Add a batch; False if this version has it already."""
        now = self.manifest()
        if now["batches"].get(stream, -1) >= batch_id:
            return False
        parts = {(p["kind"], p["part"]): p for p in now["parts"]}
        for (kind, part), new in self._written(batch, f"batch-{batch_id}").items():
            p = parts.setdefault((kind, part), {
                "kind": kind, "part": part, "base": [], "deltas": [], "rows": 0, "brought": 0, "low": None, "high": None})
            p["deltas"].append(new["path"])
            p["rows"] += new["rows"]
            p["brought"] += new["rows"]
            p["low"] = min((x for x in (p["low"], new["low"]) if x is not None), default=None)
            p["high"] = max((x for x in (p["high"], new["high"]) if x is not None), default=None)
        now["schema"] = now["schema"] or batch.schema.json()
        now["parts"] = list(parts.values())
        now["batches"][stream] = batch_id
        self._switch(now)
        if any(len(p["deltas"]) >= self.merge_every for p in now["parts"]):
            self.compact(self.merge_every)
        return True

    def compact(self, least: int = 1) -> None:
        """Merge all parts with ``least`` deltas and more, all in one new version."""
        now = self.manifest()
        due = [p for p in now["parts"] if len(p["deltas"]) >= least]
        for kind in sorted({p["kind"] for p in due}):
            own = [p for p in due if p["kind"] == kind]
            merged = self._merged(self._load(now, [f for p in own for f in [*p["base"], *p["deltas"]]]), kind)
            done = self._written(merged, "merged")
            for p in own:
                new = done[(kind, p["part"])]
                p.update(base=[new["path"]], deltas=[], rows=new["rows"])
        if due:
            self._switch(now)

    # reading

    def _load(self, manifest: dict, paths: Iterable[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        paths = sorted(paths)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _merged(self, rows: DataFrame, kind: str) -> DataFrame:
        """One row per key, the greatest in the kind's order; equal ones by their other columns."""
        k = self.kinds[kind]
        if not k.keys:
            return rows
        rest = [c for c in rows.columns if c not in (*k.keys, "kind", "part")]
        ranked = [*k.order, *[c for c in rest if c not in k.order]]
        best = F.max_by(F.struct(*rest), F.struct(*ranked)).alias("best")
        return rows.groupBy("kind", "part", *k.keys).agg(best).select(
            *[F.col(c) if c in ("kind", "part", *k.keys) else F.col(f"best.{c}").alias(c) for c in rows.columns])

    def read(self, kind: str, since: int | None = None, until: int | None = None) -> DataFrame:
        """The rows of one kind, one per key, of the current version; times (microseconds) from ``since`` to ``until``.

        Only parts that reach into the range are opened, and only those with deltas are grouped.
        """
        now = self.manifest()
        k = self.kinds[kind]
        if now["schema"] is None:
            raise FileNotFoundError(f"{self.folder} has no version yet")
        own = [p for p in now["parts"] if p["kind"] == kind and (since is None or (p["high"] is not None and p["high"] >= since))
               and (until is None or (p["low"] is not None and p["low"] <= until))]
        whole = self._load(now, [f for p in own if not p["deltas"] for f in p["base"]])
        open_parts = [f for p in own if p["deltas"] for f in [*p["base"], *p["deltas"]]]
        rows = whole.unionByName(self._merged(self._load(now, open_parts), kind)) if open_parts else whole
        at = F.unix_micros(self.time)
        if since is not None:
            rows = rows.filter(at >= since)
        if until is not None:
            rows = rows.filter(at <= until)
        return rows.select(*k.keys, *k.fields)

    def newest(self, kind: str) -> int | None:
        """Latest time of a kind in microseconds, from the manifest alone."""
        return max((p["high"] for p in self.manifest()["parts"] if p["kind"] == kind and p["high"] is not None), default=None)

    def brought(self) -> dict[str, int]:
        """Rows that batches have brought per kind, before repeated keys replaced each other."""
        out: dict[str, int] = {}
        for p in self.manifest()["parts"]:
            out[p["kind"]] = out.get(p["kind"], 0) + p["brought"]
        return out
