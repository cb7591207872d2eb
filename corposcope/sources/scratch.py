"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Paths of tables that are not removed yet, one list for each open scope; the first is removed when Python ends.
_scopes: list[dict[str, SparkSession]] = [{}]


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session that runs in one process may name none: it gets a local one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corposcope-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is put there goes with the scope or when Python ends."""
    path = f"{shared_folder(spark)}/corposcope-{label}-{uuid.uuid4().hex}"
    _scopes[-1][path] = spark
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path  # type: ignore[attr-defined]
    return out


def _removed(path: str, spark: SparkSession) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dropped(*tables: DataFrame) -> None:
    """Removes tables made by written() that no later plan reads."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path:
            for scope in _scopes:
                scope.pop(path, None)
            _removed(path, df.sparkSession)


@contextlib.contextmanager
def scope() -> Iterator[list[DataFrame]]:
    """Removes all tables that were written inside it when it ends, but those put into the list that it gives."""
    kept: list[DataFrame] = []
    here: dict[str, SparkSession] = {}
    _scopes.append(here)
    try:
        yield kept
    finally:
        _scopes.remove(here)
        stay = {df._scratch for df in kept}  # type: ignore[attr-defined]
        for path, spark in here.items():
            if path in stay:
                _scopes[-1][path] = spark
            else:
                _removed(path, spark)


@atexit.register
def _at_exit() -> None:
    for path, spark in _scopes[0].items():
        with contextlib.suppress(Exception):
            _removed(path, spark)
