"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent a local master gets a temporary folder of this
    process, and a cluster an error: its executors do not share local folders.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="netloom-"))
        atexit.register(shutil.rmtree, _LOCAL_ROOT[0], ignore_errors=True)
    return _LOCAL_ROOT[0]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/netloom/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks of the reader,
    not the whole history, and what is read twice is computed once.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a path of :func:`scratch` that no DataFrame reads any more."""
    if "/netloom/" not in path:
        raise ValueError(f"not a scratch path: {path}")
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Remove the files of :func:`materialize` tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            drop_scratch(table.sparkSession, folder)


def table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A Parquet table, or None while it does not exist or, where no schema is given, holds no file."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
