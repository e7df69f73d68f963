"""Tables written on the way, so that a lost executor costs a read and not a recomputation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

#: Folders written by the operator at work, where one is to clear them.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
#: By application, in local mode.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where it is unset and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = f"file://{tempfile.mkdtemp(prefix='texts-')}"
    return _local[app]


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder as Parquet, and read from there."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    written = _written.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        place = jvm.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator with its result written, and all tables that it wrote on the way to it removed, also when it fails.

    The result's table alone stays in the shared folder; within another tidy operator it goes with that one's.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        around, own = _written.get(), []
        token = _written.set(own)
        try:
            result = operator(df, *args, **kwargs)
            _written.set(around)
            return cut(result)
        finally:
            _written.reset(token)
            remove(df.sparkSession, own)

    return run
