"""Written tables between job steps.

A step whose result several later steps read is written once to the shared folder that the
session names in ``spark.checkpoint.dir`` and read back as a columnar table.  This cuts the
lineage, survives the loss of executors, and lets later steps read only their columns.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
import zlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
CODEC = "zstd"  # staged event texts take half the bytes that snappy leaves
_written: dict[tuple[str, str], str] = {}
_own_folder: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder; a fresh local one only where none is set and all work is on this machine."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{_SETTING} must name a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="railwatch-")
    return _own_folder[app]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folder_state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files below a folder, as one checksum."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return f"{zlib.crc32(repr(sorted(found)).encode()):08x}-{len(found)}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/railwatch/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", CODEC).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`staged` wrote, once every table that was made from them is written too."""
    for df in tables:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


LONG_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4"}


def write_long_rows(spark: SparkSession) -> None:
    """Let the Parquet writers of this session look at their size every few rows.

    Else they hold a hundred rows before they look, and up to 10,000 where the ones before were short.
    """
    for name, value in LONG_ROWS.items():
        spark.conf.set(name, value)


def staged_once(spark: SparkSession, key: str, build) -> DataFrame:
    """Like :func:`staged`, once per application and key while the table is still there."""
    slot = (spark.sparkContext.applicationId, key)
    path = _written.get(slot)
    if path is None or not path_exists(spark, f"{path}/_SUCCESS"):
        path = new_path(spark, "stage")
        build().write.option("compression", CODEC).parquet(path)
        _written[slot] = path
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors of a cluster this package, which their Python workers import."""
    context = spark.sparkContext
    if context.master.startswith("local") or context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='railwatch-')}/railwatch", "zip", root, "railwatch"
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
