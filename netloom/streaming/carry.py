"""Batch operators that look back to the row before, run over a stream.

Export templates and interface counters need the last template, or the last sample,
of each key.  That one row a key is kept in a table beside the checkpoint, for a time to
live, and put before the key's rows of the next micro-batch; the batch operator does
the work.  All of it is joins and aggregations: no row passes through Python for it.
A micro-batch reads and writes the rows of the keys that live, one each.
Results and kept rows are written per micro-batch, so one that is run again overwrites itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netloom.operators.counters import counter_deltas, interface_rows
from netloom.operators.netflow import data_records, export_sets, normalized, with_template
from netloom.operators.sflow import sflow_counters
from netloom.storage import discard, drop_scratch, materialize, table
from netloom.streaming.jobs import batch_folder, started

SEEN = "carried"
#: When a kept row was taken, in milliseconds of the clock.
TAKEN = "carried_at"
#: Milliseconds after which a key's row is given up if no other takes its place.
TTL_MS = 24 * 3_600_000


def _kept(checkpoint: str, number: int) -> str:
    """Where micro-batch ``number`` leaves the last row of each key."""
    return batch_folder(f"{checkpoint}/netloom/carried", number)


def run_carried(stream: DataFrame, job: Callable[[DataFrame], DataFrame], keys: list[str], order: list[str], out: str, checkpoint: str, leaves: str | None = None, available_now: bool = False, ttl_ms: int = TTL_MS):
    """Start ``job`` over a stream.

    ``job`` gets the rows of a micro-batch with a column ``carried``; rows with it
    set come from before.  What it gives with ``carried`` set is left out; a job whose
    results cannot come from such rows may drop the column.  Of the rows that have
    ``leaves`` (all, if none is named) the last of each key in ``order`` is carried on, for
    ``ttl_ms`` of the clock.
    """
    names = stream.columns
    kept = T.StructType([*(T.StructField(f.name, f.dataType) for f in stream.schema.fields), T.StructField(TAKEN, T.LongType())])

    def each(batch: DataFrame, number: int) -> None:
        spark, now = batch.sparkSession, int(time.time() * 1000)
        rows, before = batch.withColumns({TAKEN: F.lit(now), SEEN: F.lit(False)}), table(spark, _kept(checkpoint, number - 1), kept)
        if before is not None:
            rows = rows.unionByName(before.where(F.col(TAKEN) > now - ttl_ms).withColumn(SEEN, F.lit(True)))
        both = materialize(rows, "carried")  # read by the job and for the last rows
        made = job(both.drop(TAKEN))
        made = made.where(~F.col(SEEN)).drop(SEEN) if SEEN in made.columns else made
        made.write.mode("overwrite").parquet(batch_folder(out, number))
        # At the same time, what is new comes after what was carried.
        last = F.max_by(F.struct(*names, TAKEN), F.struct(order[0], ~F.col(SEEN), *order[1:]))
        whose = both if leaves is None else both.where(F.col(leaves).isNotNull())
        whose.groupBy(*keys).agg(last.alias("last")).select("last.*").write.mode("overwrite").parquet(_kept(checkpoint, number))
        discard(both)
        drop_scratch(spark, _kept(checkpoint, number - 2))  # the one before is needed if this one runs again

    return started(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), available_now)


def run_templates(sets: DataFrame, out: str, checkpoint: str, ttl_s: int = 3600, available_now: bool = False):
    """Data sets of a stream of export sets with the template that applies (see ``with_template``)."""
    order = ["recv_us", *(c for c in ("arrival",) if c in sets.columns), "seq"]
    return run_carried(sets, lambda rows: with_template(rows, ttl_s), ["exporter", "domain", "template_id"], order, out, checkpoint, "fields", available_now)


def run_exports(datagrams: DataFrame, out: str, checkpoint: str, ttl_s: int = 3600, available_now: bool = False):
    """Flow records of a stream of landed v9 and IPFIX datagrams; data sets wait for no template, those without one give no record."""

    def job(rows: DataFrame) -> DataFrame:
        first = F.when(F.col(SEEN), F.lit(-1)).otherwise(F.col("arrival"))  # what was carried came before
        return normalized(data_records(with_template(rows.withColumn("arrival", first), ttl_s)))

    return run_carried(export_sets(datagrams), job, ["exporter", "domain", "template_id"], ["recv_us", "arrival", "seq"], out, checkpoint, "fields", available_now)


def run_counters(samples: DataFrame, out: str, checkpoint: str, keys: tuple[str, ...] = ("device", "if_index", "if_name"), available_now: bool = False):
    """Deltas of a stream of interface samples (see ``counter_deltas``); samples of a key come in order of time."""
    return run_carried(samples, lambda rows: counter_deltas(rows, keys), list(keys), ["epoch", "arrival"], out, checkpoint, available_now=available_now)


def run_sflow_counters(datagrams: DataFrame, out: str, checkpoint: str, available_now: bool = False):
    """Interface rows (25 columns) of the counter samples in a stream of landed sFlow datagrams."""
    keys = ("device", "if_index", "if_name")

    def job(rows: DataFrame) -> DataFrame:
        return interface_rows(counter_deltas(rows, keys).where(~F.col(SEEN)))

    return run_carried(sflow_counters(datagrams), job, list(keys), ["epoch", "arrival"], out, checkpoint, available_now=available_now)
