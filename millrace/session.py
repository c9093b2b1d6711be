"""Session settings the engine relies on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Needed for right results, wherever the session came from.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.chunkBase64String.enabled": "false",
}


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the workers, once for each application: Arrow functions import it there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="millrace-ship-")) / "millrace.zip"
    atexit.register(shutil.rmtree, target.parent, True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings that results depend on."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    _ship(spark)
    return spark


def local_session(cpus: int | None = None, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ready(spark)
