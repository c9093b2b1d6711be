"""Shared scratch tables: how operators cut lineage.

Tables go to the folder that the cluster names in ``spark.checkpoint.dir``, which all executors
share, so a lost executor loses none of them.  Only a local session may fall back to a folder of
its own.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if shared is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, shared, True)
        _ROOTS[app] = f"{shared.rstrip('/')}/millrace-{app}-{uuid.uuid4().hex[:8]}"
    return _ROOTS[app]


def place(spark: SparkSession, name: str = "table") -> str:
    """A path below the scratch folder that nothing uses yet."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """The same rows, written to the shared folder and read again."""
    path = place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, where: str) -> None:
    """Delete a table that nothing will read again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` made and that nothing will read again."""
    for t in tables:
        for where in {file.rpartition("/")[0] for file in t.inputFiles()}:
            remove(t.sparkSession, where)


def drop(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; frames that still read them become unusable."""
    root = _ROOTS.pop(spark.sparkContext.applicationId, None)
    if root is not None:
        remove(spark, root)


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Whatever operators write within is deleted at the end: frames made within must be used up by then."""
    outer = _ROOTS.pop(spark.sparkContext.applicationId, None)
    try:
        yield
    finally:
        drop(spark)
        if outer is not None:
            _ROOTS[spark.sparkContext.applicationId] = outer
