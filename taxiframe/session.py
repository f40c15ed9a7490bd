"""Spark session settings the package relies on, and the shared scratch folder.

Every timestamp in the trip files is wall-clock text that the warehouse reads
as UTC, so the session time zone must be UTC. ANSI mode stays on (Spark's
default): all parsing goes through ``try_*`` functions instead.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, ExitStack, contextmanager

from pyspark.sql import SparkSession

#: Settings applied by :func:`configure`. Only AQE and the time zone matter for
#: results; the rest is plan quality at scale.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet is the staging and model format; keep nested-field pruning on so
    # ``amount_details.tip`` reads a single leaf column.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM interprets methods above this size: a larger stage runs as
    # generated projections, whose methods are split and compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A re-run of a load replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task that writes by folder has one file open: open files hold their rows
    # in memory, also where the rows come sorted. See :func:`open_files`.
    "spark.sql.maxConcurrentOutputFileWriters": "0",
    # Listing thousands of folders or files is one job of so many tasks, not
    # one task for each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Rows that go to a Python worker at once: long texts stay in its memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SESSION_DEFAULTS` to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of a scan that a task of a trip query takes: some 400,000 lines, whose
#: parsing and sorting stay a matter of seconds and of memory.
SCAN_BYTES = ("spark.sql.files.maxPartitionBytes", "16m")
_SCAN_BEFORE: dict[str, str] = {}


def narrow_scans(spark: SparkSession, narrow: bool) -> None:
    """Scans by tasks of ``SCAN_BYTES``, or by those that the session had."""
    key, size = SCAN_BYTES
    app = spark.sparkContext.applicationId
    if narrow:
        if app not in _SCAN_BEFORE:
            _SCAN_BEFORE[app] = spark.conf.get(key)
        spark.conf.set(key, size)
    elif app in _SCAN_BEFORE:
        spark.conf.set(key, _SCAN_BEFORE.pop(app))


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Writes of stored tables: a denser codec than the default one, and shuffle files
#: that go when their write ends, not when the driver's JVM next collects garbage.
STORING = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def storing(spark: SparkSession) -> Iterator[None]:
    """For writes of stored tables (:data:`STORING`). A frame that was executed
    inside is not to be executed again: its shuffle files are gone."""
    with ExitStack() as settings:
        for key, value in STORING.items():
            settings.enter_context(_set(spark, key, value))
        yield


def all_partitions(spark: SparkSession) -> AbstractContextManager[None]:
    """For a write by folders after a rebalance: the number of files doesn't
    depend on the number of tasks, so small partitions are not merged (large
    ones are still split)."""
    return _set(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false")


def open_files(spark: SparkSession, n: int) -> AbstractContextManager[None]:
    """For a write into ``n`` folders: their files stay open side by side, and
    wide rows are not sorted by the folder (a task sorts once it reaches the limit)."""
    return _set(spark, "spark.sql.maxConcurrentOutputFileWriters", str(n + 1))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as
    ``--py-files`` would: they need not find it on their own path."""
    sc = spark.sparkContext
    if _SHIPPED.get("application") == sc.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="taxiframe-code-"), "taxiframe.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                zf.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED["application"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "taxiframe") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TAXIFRAME_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a local
    session (all tasks in this process) gets a fresh folder; any other session
    is refused, as its executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="taxiframe-ckpt-")
    sc.setCheckpointDir(path)
    # The context suffixes the folder with a uuid; use what it holds.
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under :func:`shared_dir` for one run of ``name``,
    which is removed when the driver's Python ends."""
    place = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(remove_scratch)
    _SCRATCH.append((spark._jvm.org.apache.hadoop.fs.Path(place), spark._jsc.hadoopConfiguration()))
    return place


#: Locations handed out, with the settings of their file system.
_SCRATCH: list = []


def remove_scratch() -> int:
    """Remove all locations that :func:`scratch_path` handed out; returns how many
    there were. Frames that read them can't be used any more."""
    n = len(_SCRATCH)
    while _SCRATCH:
        place, conf = _SCRATCH.pop()
        try:
            place.getFileSystem(conf).delete(place, True)
        except Exception:  # noqa: BLE001  # the JVM is gone, nothing can be removed from here
            _SCRATCH.clear()
    return n
