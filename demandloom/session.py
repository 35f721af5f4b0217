"""Session-level helpers: settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the jobs rely on. All of them are runtime SQL settings, so they can
# be applied to a session somebody else created.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_SHIPPED_TO: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings and make the package known to the Python workers."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package's source to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED_TO:
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="demandloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED_TO.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="demandloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing exists there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose tables live below the shared folder; it goes when the program ends before its session."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, label)}'")

    def drop() -> None:
        try:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        except Exception:  # noqa: BLE001 - the session has ended; the folder is scratch
            pass

    atexit.register(drop)
    return name


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query run inside go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
