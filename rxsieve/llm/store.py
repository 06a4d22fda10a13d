"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names.

    Only a local session, where driver and executors are one process, may leave it unset; it gets a folder
    that goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, _own[context.applicationId], True)
    return _own[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet and read back: a cut in the lineage that survives lost executors.

    Results are lazy and read these files, so they stay until ``release``.
    """
    path = new_path(frame.sparkSession, name)
    frame.write.parquet(path)
    _written.append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, True)
    if path in _written:
        _written.remove(path)


def drop_stored(frame: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned and nobody reads any more."""
    names = {f.rsplit("/", 2)[-2] for f in frame.inputFiles()}
    for path in [p for p in _written if p.rsplit("/", 1)[-1] in names]:
        _delete(frame.sparkSession, path)


def stored_paths() -> list[str]:
    """Paths of the intermediate tables of this process, the latest last."""
    return list(_written)


def release(spark: SparkSession, kept: Iterable[str] = ()) -> None:
    """Delete the intermediate tables of this process other than ``kept``, once all results that read them are written."""
    for path in set(_written) - set(kept):
        _delete(spark, path)
