"""Shared-folder materialisation.

A cluster names its shared folder in ``spark.checkpoint.dir``. Everything that
is written to cut lineage goes below that folder, never to a machine-local one.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPE: ContextVar[list[str] | None] = ContextVar("temporary tables", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="riskpanel-")
    return _LOCAL_FOLDERS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/riskpanel/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet and continue from the written table."""
    return _written(df, label, _SCOPE.get())


def _written(df: DataFrame, label: str, scope: list[str] | None) -> DataFrame:
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store it lies, if it is there."""
    files, place = _store(spark, path)
    files.delete(place, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, place = _store(spark, folder)
    return [str(f.getPath().getName()) for f in files.listStatus(place)] if files.exists(place) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, place = _store(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if it is."""
    files, place = _store(spark, path)
    try:
        stream = files.create(place, False)
    except Py4JJavaError as failed:
        if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
            raise
        return False
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables materialised inside are deleted at the end, when nothing reads them any more.

    Yields a ``materialise`` for those that stay: it belongs to the scope around this one.
    What leaves the scope must have been written with it.
    """
    outer, own = _SCOPE.get(), []
    token = _SCOPE.set(own)
    try:
        yield lambda df, label="table": _written(df, label, outer)
    finally:
        _SCOPE.reset(token)
        for path in own:
            delete_path(spark, path)
        # Spark removes a shuffle's files once the driver has collected its plan: not in half an hour, but now
        spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the operators that run Python there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    with tempfile.NamedTemporaryFile(prefix="riskpanel-", suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    atexit.register(Path(f.name).unlink, missing_ok=True)  # the driver serves it from there until then
    context.addPyFile(f.name)
    _SHIPPED.add(context.applicationId)
