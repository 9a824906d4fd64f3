"""Session defaults and the shared working folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings only: nothing here overrides cluster sizing.  The time zone is
# part of the result (timestamps are compared and printed in UTC); the skew
# setting lets AQE split a hot join key even when that costs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Of a key that a JSON object repeats, the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Partitions that the text feeds are dealt into, for tables in fewer row groups than there
#: are cores.  Not set: as the files are cut, which is right for tables of many row groups.
LANES = "spark.millrace.lanes"

# Fixed when a session starts.  No call-site capture per column function: building a
# large plan then takes far fewer calls into the JVM.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RUNTIME_CONF, **START_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built, and give its workers this package."""
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers once, so that no worker depends on the driver's path."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="millrace-")) / "millrace_package.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._millrace_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster
    a missing setting is an error, because executors elsewhere could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = _local_dir()
    return named.rstrip("/")


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder, so runs never read each other's files."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
