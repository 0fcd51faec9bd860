"""Writers: partitioned Parquet, guarded CSV, and retention."""

from __future__ import annotations

import os
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netloom.functions.exprs import csv_cell
from netloom.storage import materialize

#: Rows a CSV file holds at most.
CSV_ROWS = 1_000_000


class SchemaChanged(ValueError):
    """The target holds other columns."""


def csv_ready(df: DataFrame) -> DataFrame:
    """Cells made safe: not-finite numbers and nulls are empty, formula-like texts are quoted, booleans are 0 or 1."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = csv_cell(c, True)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = csv_cell(c, False)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def _header(spark: SparkSession, path: str) -> list[str] | None:
    try:
        found = spark.read.option("header", True).csv(path)
    except Exception as fault:  # the path does not exist yet
        if "PATH_NOT_FOUND" in str(fault) or "UNABLE_TO_INFER_SCHEMA" in str(fault):
            return None
        raise
    return found.columns or None


def write_csv(df: DataFrame, path: str, on_change: str = "rotate") -> str:
    """Append to a folder of CSV files with a locked header; returns the folder written.

    If the folder has other columns, ``rotate`` writes to a new one beside it
    (``path.1``, ``path.2``, ...), ``error`` raises.
    """
    target, n = path, 0
    while (held := _header(df.sparkSession, target)) is not None and held != df.columns:
        if on_change == "error":
            raise SchemaChanged(f"{target} holds {held}")
        n += 1
        target = f"{path}.{n}"
    csv_ready(df).write.mode("append").option("header", True).option("maxRecordsPerFile", CSV_ROWS).option("emptyValue", "").option("escape", '"').csv(target)
    return target


def read_csv(spark: SparkSession, path: str, columns: list[str], limit: int = 0) -> DataFrame:
    """All cells as text; rows with too few or too many cells are left out; a missing path gives no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if _header(spark, path) is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").option("escape", '"').csv(path)
    return rows.limit(limit) if limit else rows


def write_rows(df: DataFrame, path: str, by: tuple[str, ...] = ("capture_file",)) -> None:
    """Append to partitioned Parquet; rows of one partition value may come from many tasks."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def running_total(rows: DataFrame, value: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` up to each row in ``order``, without bringing all rows together.

    Rows are dealt to tasks by ranges of the order and written; the totals of the
    ranges, one number each, give what comes before a range, and a window inside it the rest.
    """
    part, before = f"{name}_range", f"{name}_before"
    dealt = materialize(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "running-total")
    totals = {r[part]: r["total"] for r in dealt.groupBy(part).agg(F.sum(value).alias("total")).collect()}  # one row a range
    starts = dict(zip(sorted(totals), accumulate([0, *(totals[p] or 0 for p in sorted(totals))])))
    offsets = rows.sparkSession.createDataFrame(list(starts.items()), f"`{part}` int, `{before}` long")
    inside = F.sum(value).over(Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dealt.withColumn(name, inside).join(F.broadcast(offsets), part).withColumn(name, F.col(name) + F.col(before)).drop(part, before)


def retention(files: DataFrame, max_bytes: int, min_modified=None, protect: tuple[str, ...] = ()) -> DataFrame:
    """Files (path, length, modified) to delete: those too old, then the oldest until the rest fits ``max_bytes``.

    What is kept is the newest files whose running size stays within the limit.
    """
    files = files.where(~F.col("path").isin(*protect)) if protect else files
    # Newest first: a file goes once it and all newer ones exceed the limit.
    held = running_total(files, "length", [F.desc("modified"), F.desc("path")], "newer")
    old = F.lit(False) if min_modified is None else F.col("modified") < min_modified
    return held.where(old | (F.col("newer") > max_bytes)).drop("newer")


def apply_retention(spark: SparkSession, root: str, max_bytes: int, min_modified=None, protect: tuple[str, ...] = ()) -> int:
    """Delete what :func:`retention` names under ``root``; returns how many files went.

    A root that is no folder of its own (empty, the working folder, the root of a
    store) is refused.  The listing is Spark's.  Files that executors can reach are
    deleted by tasks, those of other stores one by one through the driver.
    """
    if root.strip().rstrip("/\\") in ("", ".", "..") or re.fullmatch(r"[a-z0-9+.-]+:/*", root):
        raise ValueError(f"not a folder to clean: {root!r}")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    going = materialize(retention(listing, max_bytes, min_modified, protect).select("path"), "retention")

    def delete(batches):
        for batch in batches:
            done = 0
            for path in batch.column("path").to_pylist():
                try:
                    os.remove("/" + path.removeprefix("file:").lstrip("/"))
                    done += 1
                except FileNotFoundError:  # an earlier attempt of this task deleted it
                    pass
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["gone"])

    jvm = spark.sparkContext._jvm
    near = F.col("path").startswith("file:")
    gone = going.where(near).mapInArrow(delete, "gone long").agg(F.sum("gone")).first()[0] or 0
    for row in going.where(~near).toLocalIterator():
        where = jvm.org.apache.hadoop.fs.Path(row["path"])
        gone += bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, False))
    return gone
