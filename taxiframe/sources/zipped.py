"""Zipped trip files: unzip to text lines as a Spark job, archive inventory.

A zip archive is not splittable, so an archive is opened by one task
(``mapInPandas`` over the file listing; archives are hashed to ``SPREAD`` times
as many tasks, so few share one) and its members are streamed line by line in
batches; an archive is never held in memory as one value. It is read through
once before its first line is emitted, so a broken archive yields one error
row and no line, and the job goes on. Lines and errors are written once, by
kind and by archive.
"""

from __future__ import annotations

import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_SCHEMA = "archive string, entry string, line_no long, line string, error string"
INVENTORY_SCHEMA = "archive string, n_entries long, error string"
BATCH_LINES = 65536


def _open(uri: str):
    """Open a listed file from inside a task: local/shared-mount paths
    directly, other file systems through fsspec when it is installed."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return open(unquote(parsed.path), "rb")
    import fsspec  # noqa: PLC0415 - optional, only for remote schemes
    return fsspec.open(uri, "rb").open()


def list_archives(spark: SparkSession, glob: str) -> DataFrame:
    """``(path, length)`` of the archives; content is never selected."""
    return spark.read.format("binaryFile").load(glob).select("path", "length")


#: Tasks per archive.
SPREAD = 4
#: What a broken archive or text raises.
BROKEN = (zipfile.BadZipFile, zlib.error, OSError, UnicodeDecodeError, EOFError, NotImplementedError, RuntimeError)


def _spread(listing: DataFrame) -> DataFrame:
    return listing.repartition(max(1, SPREAD * listing.count()), "path")


def _members(zf: zipfile.ZipFile) -> Iterator[tuple[str, int, str]]:
    for entry in zf.namelist():
        with zf.open(entry) as member:
            for no, raw in enumerate(io.TextIOWrapper(member, encoding="utf-8", newline=""), 1):
                yield entry, no, raw.rstrip("\r\n")


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for uri in pdf["path"]:
            try:
                with _open(uri) as fh, zipfile.ZipFile(fh) as zf:
                    for _ in _members(zf):  # checks lengths, checksums and the encoding
                        pass
            except BROKEN as exc:
                yield pd.DataFrame([(uri, None, None, None, f"{type(exc).__name__}: {exc}")],
                                   columns=LINES_SCHEMA_COLS)
                continue
            with _open(uri) as fh, zipfile.ZipFile(fh) as zf:
                lines = ((uri, *line, None) for line in _members(zf))
                while rows := list(itertools.islice(lines, BATCH_LINES)):
                    yield pd.DataFrame(rows, columns=LINES_SCHEMA_COLS)


LINES_SCHEMA_COLS = ["archive", "entry", "line_no", "line", "error"]


def unzip_lines(spark: SparkSession, glob: str) -> DataFrame:
    """A5: one row per text line of every archive, or one error row per bad
    archive (``line`` null, ``error`` set)."""
    return _spread(list_archives(spark, glob)).mapInPandas(_unzip, LINES_SCHEMA)


def unzip_to_text(spark: SparkSession, glob: str, out: str) -> dict[str, str]:
    """Unzip every archive under ``glob`` into ``out`` in one job:
    ``out/kind=line/file=<archive name without .zip>`` holds the raw lines
    (readable by the trip reader, also by month globs on ``file=``) and
    ``out/kind=error`` one ``archive<TAB>error`` line per failed archive."""
    res = unzip_lines(spark, glob)
    value = F.when(F.col("error").isNull(), F.col("line")).otherwise(
        F.concat_ws("\t", "archive", "error"))
    kind = F.when(F.col("error").isNull(), F.lit("line")).otherwise(F.lit("error"))
    name = F.regexp_replace(F.regexp_extract("archive", r"([^/]+)$", 1), r"\.zip$", "")
    (res.select(kind.alias("kind"), name.alias("file"), value.alias("value")).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("kind", "file").text(out))
    return {"lines": f"{out}/kind=line", "errors": f"{out}/kind=error"}


def _inventory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for uri in pdf["path"]:
            try:
                with _open(uri) as fh, zipfile.ZipFile(fh) as zf:
                    rows.append((uri, len(zf.namelist()), None))
            except BROKEN as exc:
                rows.append((uri, None, f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(rows, columns=["archive", "n_entries", "error"])


def archive_inventory(spark: SparkSession, glob: str) -> DataFrame:
    """Number of entries per archive (reads only the zip directory)."""
    return _spread(list_archives(spark, glob)).mapInPandas(_inventory, INVENTORY_SCHEMA)
