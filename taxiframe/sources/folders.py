"""Files of the shared store through Hadoop's file system, which reaches every
store that Spark reads. Only names, sizes and markers pass here, never rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def store(spark: SparkSession, name: str):
    return path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    return store(spark, name).exists(path(spark, name))


def mark(spark: SparkSession, name: str) -> None:
    """An empty file."""
    store(spark, name).create(path(spark, name), True).close()


def claim(spark: SparkSession, folder: str) -> bool:
    """Make ``folder`` with a ``_CLAIMED`` file; false if another run has it.
    The file is created without overwriting, which only one writer can do."""
    try:
        store(spark, folder).create(path(spark, f"{folder}/_CLAIMED"), False).close()
    except Exception as failed:
        if "FileAlreadyExists" in str(failed) or exists(spark, f"{folder}/_CLAIMED"):
            return False
        raise
    return True


def delete(spark: SparkSession, *names: str) -> None:
    """Remove files or folders, where they exist."""
    if names:
        fs = store(spark, names[0])
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda name: fs.delete(path(spark, name), True), names))


def children(spark: SparkSession, folder: str, folders: bool = False) -> list[str]:
    """Names in a folder, sorted; those of hidden files are left out. With
    ``folders`` only those of folders."""
    if not exists(spark, folder):
        return []
    found = store(spark, folder).listStatus(path(spark, folder))
    names = [s.getPath().getName() for s in found if s.isDirectory() or not folders]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def files(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """``name/file`` of the files in the folders ``names`` below ``folder``."""
    with ThreadPoolExecutor(8) as pool:
        found = pool.map(lambda name: [f"{name}/{f}" for f in children(spark, f"{folder}/{name}")], names)
        return [f for files in found for f in files]


def n_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    return store(spark, folder).getContentSummary(path(spark, folder)).getLength() if exists(spark, folder) else 0
