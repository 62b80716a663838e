"""Observations of batches kept in a log, and histograms that are added up."""

import pytest
from pyspark.sql import functions as F

from clinflow.operators.metrics import BINS, latency_bins, observed_stream, quantile, sum_bins
from clinflow.streaming.metrics_log import MetricsLog


def test_histograms_of_parts_add_up(spark):
    values = [None, -5, 0, 1, 2, 3, 4, 1023, 1024, 10**12]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "part int, ms long")
    whole = df.agg(latency_bins(F.col("ms")).alias("b")).first().b
    parts = df.groupBy("part").agg(latency_bins(F.col("ms")).alias("b")).agg(sum_bins(F.col("b")).alias("b")).first().b
    expected = [0] * BINS
    for v in values[1:]:
        expected[max(v, 0).bit_length()] += 1
    assert whole == parts == expected


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_a_quantile_is_at_most_twice_too_large(spark, share):
    values = sorted(i * i for i in range(1, 200))
    df = spark.createDataFrame([(v,) for v in values], "ms long").agg(latency_bins(F.col("ms")).alias("b"))
    found = df.select(quantile(F.col("b"), share).alias("q")).first().q
    exact = values[max(0, -int(-len(values) * share // 1) - 1)]
    assert exact <= found < 2 * exact + 1
    none = spark.createDataFrame([([0] * BINS,)], "b array<long>")
    assert none.select(quantile(F.col("b"), 0.5).alias("q")).first().q is None


def test_every_batch_is_in_the_log_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    for n, rows in enumerate([[(1, 5), (2, None)], [(3, 9)]]):
        spark.createDataFrame(rows, "id int, ms long").coalesce(1).write.parquet(f"{folder}/p={n}")
    log = MetricsLog(spark, str(tmp_path / "log"))
    source = spark.readStream.schema("id int, ms long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
    stream = observed_stream(source.parquet(folder), "rows", F.col("id") < 3, F.col("ms"))
    spark.streams.addListener(log)
    try:
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    rows = [r for r in log.read().collect() if r.n_ok + r.n_failed]
    assert len({(r.batch_id, r.name) for r in rows}) == 2
    assert sorted((r.n_ok, r.n_failed, r.n, r.sum_ms, r.min_ms, r.max_ms) for r in rows) == [(0, 1, 1, 9, 9, 9), (2, 0, 1, 5, 5, 5)]
