"""Keyed result tables on plain Parquet, published all-or-nothing.

Layout under one root folder on a file system that can publish a file without
overwriting one (HDFS and local paths; others are refused)::

    <root>/<table>/v=<version>/part-*.parquet   one folder per written version
    <root>/_commits/<seq>.json                   {"tables": {table: version}, ...}

A partitioned table (``stage_upsert_partitions``) is published as a map from
partition value to the version folder that holds it,
``{"column": c, "parts": {value: version}}``: an upsert rewrites only the
partitions its source touches (e.g. the gameweeks of this run) and every other
partition keeps pointing at its old folder.  ``compact`` rewrites all parts into
one version.

A write never touches the folder it reads from: every change writes a new
version folder (a complete Spark job, so a lost executor only retries tasks),
then one small commit file names the versions of *all* tables changed by the
run.  Readers resolve the newest commit file, so they see either the old or the
new state of every table of the run — the single commit of the original
scripts.  A run that dies before its commit leaves only an unreferenced folder.
Commit files are created under a temporary name and put in place in one atomic step
that fails if the sequence number is taken (HDFS: a rename that never overwrites;
local paths: a hard link), so two concurrent runs cannot both commit the same step.
Object stores copy and delete instead of renaming: a store there is refused.  Concurrency is optimistic and per table: a staged
upsert remembers the version it read, and the commit fails (``CommitConflict``)
if another run has published that table since — the run is redone on the new
state, never merged onto a stale one.  A lost rename race where only other
tables changed is retried on the fresh state.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as MG

COMMITS = "_commits"
#: Partitions that one run may write.
MAX_PARTITIONS = 100_000


class CommitConflict(RuntimeError):
    pass


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._read_versions: dict[str, object] = {}   # table -> version a staged write read
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._jvm = jvm
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._scheme = self._fs.getUri().getScheme()
        self._check_scheme(self._scheme)

    @staticmethod
    def _check_scheme(scheme: str) -> None:
        if scheme not in ("file", "hdfs"):
            raise ValueError(f"a table store on {scheme} can't commit atomically: use hdfs or a local path")

    # ----------------------------------------------------------- commits ---

    def _commit_dir(self):
        return self._Path(f"{self.root}/{COMMITS}")

    def _latest_seq(self) -> int:
        d = self._commit_dir()
        if not self._fs.exists(d):
            return 0
        seqs = [int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(d)
                if s.getPath().getName().endswith(".json")]
        return max(seqs, default=0)

    def _read_text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            while (line := reader.readLine()) is not None:
                lines.append(line)
            return "\n".join(lines)
        finally:
            stream.close()

    def state(self) -> dict:
        """The newest commit: {"seq": n, "tables": {...}, "meta": {...}}."""
        seq = self._latest_seq()
        if seq == 0:
            return {"seq": 0, "tables": {}, "meta": {}}
        doc = json.loads(self._read_text(f"{self.root}/{COMMITS}/{seq:020d}.json"))
        doc["seq"] = seq
        return doc

    def commit(self, versions: dict[str, str], meta: dict | None = None,
               base_seq: int | None = None) -> int:
        """Publish new versions of some tables (others keep theirs) in one step."""
        while True:  # a lost race means that another run has committed
            state = self.state()
            if base_seq is not None and state["seq"] != base_seq:
                raise CommitConflict(f"store moved from commit {base_seq} to {state['seq']}")
            for table in versions:
                if table in self._read_versions and \
                        state["tables"].get(table) != self._read_versions[table]:
                    raise CommitConflict(f"{table} was published by another run")
            try:
                seq = self._commit_once(state, versions, meta)
            except CommitConflict:
                if base_seq is not None:
                    raise
                continue
            for table in versions:
                self._read_versions.pop(table, None)
            return seq

    def _commit_once(self, state: dict, versions: dict, meta: dict | None) -> int:
        doc = {"tables": {**state["tables"], **versions},
               "meta": {**state.get("meta", {}), **(meta or {})},
               "committed_at": time.time()}
        seq = state["seq"] + 1
        self._fs.mkdirs(self._commit_dir())
        tmp = self._Path(f"{self.root}/{COMMITS}/.{seq:020d}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(doc).encode("utf-8")))
        finally:
            out.close()
        final = self._Path(f"{self.root}/{COMMITS}/{seq:020d}.json")
        if not self._put(tmp, final):
            raise CommitConflict(f"commit {seq} was taken by another run")
        return seq

    def _put(self, tmp, final) -> bool:
        """Publish ``tmp`` as ``final`` unless that exists, in one atomic step."""
        try:
            if self._scheme == "hdfs":
                return self._fs.rename(tmp, final)
            os.link(tmp.toUri().getPath(), final.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            if self._fs.exists(tmp):
                self._fs.delete(tmp, False)

    # ------------------------------------------------------------ tables ---

    def path(self, table: str, version: str) -> str:
        return f"{self.root}/{table}/v={version}"

    def version(self, table: str) -> str | None:
        return self.state()["tables"].get(table)

    def read(self, table: str, schema: T.StructType | None = None,
             only_parts: list[str] | None = None) -> DataFrame:
        v = self.version(table)
        if v is None:
            if schema is None:
                raise KeyError(f"no table {table} in {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        if isinstance(v, str):
            return reader.parquet(self.path(table, v))
        # partitioned: one pruned scan per version folder, unioned
        col, parts = v["column"], v["parts"]
        if only_parts is not None:
            parts = {p: parts[p] for p in only_parts if p in parts}
        by_version: dict[str, list[str]] = {}
        for value, ver in parts.items():
            by_version.setdefault(ver, []).append(value)
        frames = [reader.parquet(self.path(table, ver))
                  .filter(F.col(col).cast("string").isin(values))
                  for ver, values in sorted(by_version.items())]
        if not frames:
            if schema is None:
                raise KeyError(f"no partitions of {table} in {self.root}")
            return self.spark.createDataFrame([], schema)
        return reduce(lambda a, b: a.unionByName(b), frames)

    def stage(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write ``df`` as a new, not yet visible version of ``table``."""
        version = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(table, version))
        return version

    def stage_upsert(self, table: str, source: DataFrame, keys: list[str],
                     schema: T.StructType, partition_by: list[str] | None = None,
                     **merge_options) -> str:
        self._read_versions[table] = self.version(table)
        merged = MG.upsert(self.read(table, schema), source, keys, **merge_options)
        return self.stage(table, merged, partition_by)

    def stage_upsert_partitions(self, table: str, source: DataFrame, keys: list[str],
                                schema: T.StructType, column: str, **merge_options) -> dict:
        """Upsert that rewrites only the partitions (values of ``column``) the
        source touches.  ``column`` must be part of the key, so a key never
        moves between partitions."""
        if column not in keys:
            raise ValueError(f"partition column {column} must be a key column")
        # one value per folder that the run writes
        touched = [r[0] for r in source.select(F.col(column).cast("string")).distinct().limit(MAX_PARTITIONS + 1).collect()]
        if len(touched) > MAX_PARTITIONS:
            raise ValueError(f"{column} has over {MAX_PARTITIONS} values: not a partition column")
        if None in touched:
            raise ValueError(f"rows without {column}: a partition of {table} needs a value")
        current = self.version(table)
        if isinstance(current, str):
            raise ValueError(f"{table} is not partitioned")
        self._read_versions[table] = current
        parts = dict(current["parts"]) if current else {}
        target = self.read(table, schema, only_parts=touched)
        merged = MG.upsert(target, source, keys, **merge_options)
        version = self.stage(table, merged, [column])
        parts.update({t: version for t in touched})
        return {"column": column, "parts": parts}

    def version_count(self, table: str) -> int:
        """Folders a read of ``table`` has to scan (1 for an unpartitioned table)."""
        v = self.version(table)
        return len(set(v["parts"].values())) if isinstance(v, dict) else int(v is not None)

    def compact_if_needed(self, table: str, schema: T.StructType | None = None,
                          max_versions: int = 32) -> int | None:
        """Compact a partitioned table once its parts span more than ``max_versions``
        folders (each run adds one), so reads stay a handful of scans."""
        if self.version_count(table) > max_versions:
            return self.compact(table, schema)
        return None

    def compact(self, table: str, schema: T.StructType | None = None) -> int:
        """Rewrite a partitioned table into a single version folder."""
        current = self.version(table)
        if not isinstance(current, dict):
            return self.state()["seq"]
        self._read_versions[table] = current      # a concurrent upsert wins over compaction
        col = current["column"]
        version = self.stage(table, self.read(table, schema), [col])
        return self.commit({table: {"column": col,
                                    "parts": {p: version for p in current["parts"]}}})

    def stage_refresh(self, table: str, source: DataFrame, schema: T.StructType,
                      partition_by: list[str] | None = None) -> str:
        return self.stage(table, MG.conform_to(schema, source), partition_by)

    def upsert(self, table: str, source: DataFrame, keys: list[str], schema: T.StructType,
               **merge_options) -> int:
        return self.commit({table: self.stage_upsert(table, source, keys, schema, **merge_options)})

    def refresh(self, table: str, source: DataFrame, schema: T.StructType) -> int:
        return self.commit({table: self.stage_refresh(table, source, schema)})
