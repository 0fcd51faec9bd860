"""The last row of each key, from micro-batch to micro-batch."""

import pathlib

from pyspark.sql import functions as F

from netloom.streaming import carry, jobs

SCHEMA = "k int, t long, v int, mark string"
BATCHES = [[(1, 1, 10, "a"), (1, 2, 11, None), (7, 1, 90, "a")], [(2, 3, 20, "b")], [(1, 4, 12, "c"), (7, 4, 91, "d")]]


def streamed(spark, root, **options):
    """The value before each row among its key's rows; one run of the stream a batch."""
    job = lambda rows: rows.withColumn("before", F.expr("lag(v) OVER (PARTITION BY k ORDER BY t)"))
    for rows in BATCHES:
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        carry.run_carried(stream, job, ["k"], ["t"], f"{root}/out", f"{root}/state", available_now=True, **options).awaitTermination()
    return sorted((r["k"], r["t"], r["before"]) for r in spark.read.parquet(f"{root}/out").collect())


def test_the_last_row_is_kept_over_batches_and_restarts(spark, tmp_path):
    assert streamed(spark, str(tmp_path)) == [(1, 1, None), (1, 2, 10), (1, 4, 11), (2, 3, None), (7, 1, None), (7, 4, 90)]
    # Only what a repeated batch needs is left.
    assert sorted(p.name for p in pathlib.Path(f"{tmp_path}/state/netloom/carried").iterdir()) == ["batch=1", "batch=2"]


def test_only_rows_that_leave_something_are_kept_and_not_for_ever(spark, tmp_path):
    assert (1, 4, 10) in streamed(spark, f"{tmp_path}/a", leaves="mark")
    assert (1, 4, None) in streamed(spark, f"{tmp_path}/b", ttl_ms=0)


def test_a_replay_computes_its_rows_once_and_lands_batches_as_many_files(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 900, 1, 6).withColumn("t", F.col("id")).mapInArrow(count, "id long, t long")
    files = []

    def job(stream):
        return lambda out, state: jobs.started(stream.writeStream.foreachBatch(lambda b, n: (files.append(len(b.inputFiles()) or b.rdd.getNumPartitions()), b.write.mode("overwrite").parquet(jobs.batch_folder(out, n)))[0]).option("checkpointLocation", state), True)

    assert jobs.replay(rows, job, order="t", batches=3, runs=True).count() == 900
    assert seen.value == 900 and len(files) == 3 and min(files) > 1
