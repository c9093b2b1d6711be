"""Writing results: line-delimited JSON, versioned tables swapped atomically, and chunked delivery to services."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str, compression: str = "bzip2") -> None:
    """One JSON object a line, in compressed part files."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def request_lines(requests: DataFrame, body: Column, key: str = "id") -> DataFrame:
    """Batch requests as JSON lines that carry the record's id, so answers can be matched whatever their order."""
    return requests.select(F.to_json(F.struct(body.alias("request"), F.struct(F.col(key).alias("job_id")).alias("metadata"))).alias("value"))


class VersionedTable:
    """A table kept as whole versions in a folder; a small pointer file names the current one.

    A version is written beside the current one and then named: readers see the old or the new state,
    never a mixture, and a failed writer leaves the old one in place.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self):
        return self._hadoop.Path(f"{self.path}/CURRENT")

    def version(self) -> str | None:
        if not self._fs.exists(self._pointer()):
            return None
        stream = self._fs.open(self._pointer())
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["version"]
        finally:
            stream.close()

    def read(self) -> DataFrame | None:
        """The current version; None before the first."""
        v = self.version()
        return None if v is None else self.spark.read.parquet(f"{self.path}/{v}")

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        """Write a new version and make it current."""
        v = f"v-{uuid.uuid4().hex}"
        w = df.write.option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.path}/{v}")
        self._point(v)
        return v

    def _point(self, v: str) -> None:
        temporary = self._hadoop.Path(f"{self.path}/.CURRENT-{uuid.uuid4().hex}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps({"version": v}).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(temporary.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(context.makeQualified(temporary), context.makeQualified(self._pointer()), options)

    def update(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Bring rows in: ``merge`` gets the stored rows and them, and returns the new ones; only the current version stays."""
        old = self.read()
        self.write(rows if old is None else merge(old, rows))
        self.vacuum()

    def vacuum(self) -> None:
        """Delete all versions but the current one."""
        v = self.version()
        for status in self._fs.listStatus(self._hadoop.Path(self.path)):
            name = status.getPath().getName()
            if name.startswith("v-") and name != v:
                self._fs.delete(status.getPath(), True)


class PartedTable(VersionedTable):
    """A versioned table dealt to parts by key: an update rewrites the parts that it touches, the pointer names each part's version.

    Parts that nothing names any more are deleted once the pointer is moved, so the folder holds one copy of the state.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], parts: int = 64) -> None:
        super().__init__(spark, path)
        self.keys, self.parts = keys, parts

    def _named(self) -> dict[str, str]:
        return json.loads(self.version() or "{}")

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The current rows, of some parts or all; None while there are none."""
        paths = [f"{self.path}/{v}/part={p}" for p, v in self._named().items() if only is None or int(p) in only]
        return self.spark.read.parquet(*paths) if paths else None

    def update(self, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Bring rows in: ``merge`` gets the stored rows of their parts and them, and returns the parts' new rows."""
        touched = sorted(r[0] for r in rows.select(self.part_of().alias("p")).distinct().collect())  # as many as there are parts at most
        if not touched:
            return
        old = self.read(touched)
        new = rows if old is None else merge(old, rows)
        version, before = f"v-{uuid.uuid4().hex}", self._named()
        new.withColumn("part", self.part_of()).repartition("part").write.option("compression", "zstd").partitionBy("part").parquet(f"{self.path}/{version}")
        written = {s.getPath().getName().partition("=")[2] for s in self._fs.listStatus(self._hadoop.Path(f"{self.path}/{version}")) if s.isDirectory()}
        kept = {p: v for p, v in before.items() if int(p) not in touched}
        self._point(json.dumps(kept | {p: version for p in written}))
        for p, v in before.items():
            if int(p) in touched:
                self._fs.delete(self._hadoop.Path(f"{self.path}/{v}/part={p}"), True)


def deliver(df: DataFrame, send: Callable[[list[dict]], None], chunk: int = 1000, tries: int = 3, pause: float = 0.5) -> None:
    """Hand rows to a service in chunks, from the workers.

    ``send`` takes a list of rows as dicts and must be idempotent: a chunk may be sent again after a failure of
    it or of its task.  A chunk that fails ``tries`` times fails the job.
    """

    def part(rows) -> None:
        import time

        def push(batch: list[dict]) -> None:
            for attempt in range(tries):
                try:
                    return send(batch)
                except Exception:
                    if attempt == tries - 1:
                        raise
                    time.sleep(pause * 2**attempt)

        held: list[dict] = []
        for r in rows:
            held.append(r.asDict(recursive=True))
            if len(held) == chunk:
                push(held)
                held = []
        if held:
            push(held)

    df.foreachPartition(part)


def index_changes(current: DataFrame, documents: DataFrame, key: str = "id", version: str = "version") -> tuple[DataFrame, DataFrame]:
    """(documents to send, keys to delete) that bring an index from its current (key, version) to the documents."""
    known = current.select(key, F.col(version).alias("_v"))
    send = documents.join(known, key, "left").filter(~F.col("_v").eqNullSafe(F.col(version))).drop("_v")
    return send, current.select(key).join(documents.select(key), key, "left_anti")
