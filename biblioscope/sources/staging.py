"""Sets that several branches of a report read, and the folder all machines share."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_kept: ContextVar[list[DataFrame] | None] = ContextVar("kept", default=None)


def kept(df: DataFrame) -> DataFrame:
    """``df``, to be computed once for all branches that read it.

    Nothing runs until the report is read.  The set is spread over the executors' memory and disks, parts
    lost with an executor are computed anew, and adaptive execution plans with its true size.
    """
    df = df.persist()
    frames = _kept.get()
    if frames is not None:
        frames.append(df)
    return df


@contextmanager
def keeping() -> Iterator[list[DataFrame]]:
    """Notes the sets that are kept in this block."""
    token = _kept.set([])
    try:
        yield _kept.get()
    finally:
        _kept.reset(token)


def release(report: DataFrame) -> None:
    """Lets go of what was kept for one report; the report stays readable, and so do all others."""
    for df in getattr(report, "_kept", []):
        df.unpersist()


def shared_folder(spark: SparkSession) -> str:
    """Where the driver and all executors can read and write: the folder in ``spark.checkpoint.dir``.

    Where it is not set, a single machine has its warehouse folder; a cluster has no such place by itself.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return folder.rstrip("/")
