"""Versions of a table that appear at once or not at all.

Data go to a folder of their own first; then one small marker with the version's number is created.  Creating a file that
exists fails, so of two writers of one version one is refused, and what a killed writer left has no marker and is never
read.  Paths may be of any file system that Spark knows."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer was first."""


class Commits:
    """The markers below a path: `_commits/00000001.json`, ... each with what its writer says."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def all(self) -> list[tuple[int, dict]]:
        """(version, what was said) of all markers in order; a marker that was torn while it was written does not count."""
        folder = self._path("_commits")
        if not self.fs.exists(folder):
            return []
        out = []
        for name in sorted(s.getPath().getName() for s in self.fs.listStatus(folder) if s.getPath().getName().endswith(".json")):
            stream = self.fs.open(self._path(f"_commits/{name}"))
            try:
                text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                out.append((int(name[:-5]), json.loads(text)))
            except ValueError:
                continue
        return out

    def last(self) -> int:
        """The largest number that any marker has, torn ones too: a version is never given twice."""
        folder = self._path("_commits")
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def commit(self, version: int, said: dict) -> None:
        try:
            stream = self.fs.create(self._path(f"_commits/{version:08d}.json"), False)
        except Exception as e:
            if "already exists" in str(e):
                raise Conflict(f"version {version} of {self.path} was written by another") from None
            raise
        stream.write(bytearray(json.dumps(said).encode()))
        stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def folders(self, name: str) -> list[str]:
        folder = self._path(name)
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []


class PageCache:
    """A cache of texts by key: batches are appended, the last text of a key counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.log = spark, path.rstrip("/"), Commits(spark, path)

    def _live(self) -> list[tuple[int, str]]:
        """(version, folder) of the batches that count: a compacted one stands for all before it."""
        batches = [(v, x["folder"]) for v, x in self.log.all()]
        start = max((i for i, (_, x) in enumerate(self.log.all()) if x.get("compacted")), default=0)
        return batches[start:]

    def append(self, rows: DataFrame) -> int:
        """Add rows (key, value) as the next version; returns its number.  A batch that comes while another does is the later one."""
        folder = f"batch-{uuid.uuid4().hex}"
        rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).write.parquet(f"{self.path}/data/{folder}")
        while True:
            version = self.log.last() + 1
            try:
                self.log.commit(version, {"folder": folder})
                return version
            except Conflict:
                continue

    def read(self) -> DataFrame:
        """key, value, version: of each key the last text (of one batch the largest)."""
        live = self._live()
        if not live:
            return self.spark.createDataFrame([], "key string, value string, version bigint")
        versions = F.create_map(*[F.lit(x) for v, folder in live for x in (folder, v)])
        rows = self.spark.read.schema("key string, value string").parquet(*[f"{self.path}/data/{folder}" for _, folder in live])
        rows = rows.withColumn("version", versions[F.regexp_extract(F.input_file_name(), r"/data/(batch-[0-9a-f]+)/", 1)].cast("long"))
        return rows.groupBy("key").agg(F.max(F.struct("version", "value")).alias("x")).select("key", "x.value", "x.version")

    def compact(self) -> int:
        """One batch with the last text of every key in place of all before it; a writer that commits meanwhile is not lost, compaction is refused."""
        version = self.log.last() + 1
        folder = f"batch-{uuid.uuid4().hex}"
        self.read().select("key", "value").write.parquet(f"{self.path}/data/{folder}")
        self.log.commit(version, {"folder": folder, "compacted": True})
        return version

    def clean(self) -> list[str]:
        """Delete data that no marker names or that compaction replaced; call it while nobody writes."""
        live = {folder for _, folder in self._live()}
        gone = [f for f in self.log.folders("data") if f not in live]
        for folder in gone:
            self.log.delete(f"data/{folder}")
        return sorted(gone)


class TestOutputs:
    """One JSON text for each test.  A run replaces the tests it names, all at once; readers see the state before or after."""

    __test__ = False  # not for pytest

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.log = spark, path.rstrip("/"), Commits(spark, path)

    def version(self) -> int:
        return self.log.last()

    def publish(self, maps: DataFrame, removed: DataFrame | None = None, base: int | None = None) -> int:
        """maps: test_id, json; tests of `removed` (test_id) go.  `base` is the version that the run started from (the
        present one without it): if another has published since then, Conflict is raised and nothing changes."""
        base = self.version() if base is None else base
        folder = f"run-{uuid.uuid4().hex}"
        gone = maps.select("test_id", "json")
        if removed is not None:
            gone = gone.unionByName(removed.select("test_id", F.lit(None).cast("string").alias("json")))
        gone.write.parquet(f"{self.path}/data/{folder}")
        self.log.commit(base + 1, {"folder": folder})
        return base + 1

    def read(self) -> DataFrame:
        """test_id, json of the present version: of each test the last run's word, none where that removed it."""
        runs = [(v, x["folder"]) for v, x in self.log.all()]
        if not runs:
            return self.spark.createDataFrame([], "test_id string, json string")
        versions = F.create_map(*[F.lit(x) for v, folder in runs for x in (folder, v)])
        rows = self.spark.read.schema("test_id string, json string").parquet(*[f"{self.path}/data/{folder}" for _, folder in runs])
        rows = rows.withColumn("__v", versions[F.regexp_extract(F.input_file_name(), r"/data/(run-[0-9a-f]+)/", 1)])
        last = F.row_number().over(Window.partitionBy("test_id").orderBy(F.desc("__v"), F.desc("json")))
        return rows.withColumn("__n", last).where("__n = 1 AND json IS NOT NULL").select("test_id", "json")

    def clean(self) -> list[str]:
        """Delete what no marker names; call it while nobody writes."""
        live = {x["folder"] for _, x in self.log.all()}
        gone = [f for f in self.log.folders("data") if f not in live]
        for folder in gone:
            self.log.delete(f"data/{folder}")
        return sorted(gone)
