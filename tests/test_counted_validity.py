from pyspark.sql import Observation
from pyspark.sql import functions as F

from auricle.operators import filters
from auricle.streaming import sinks

SCHEMA = "a STRING, b BIGINT"


def test_counts_come_with_the_rows_that_are_written(spark, rows, tmp_path):
    for data, want in (([("x", 1), (None, 1), ("y", None), ("z", 2)], (2, 2)), ([], (0, 0))):
        seen = Observation()
        out = f"{tmp_path}/{len(data)}"
        filters.counted_validity(rows(SCHEMA, data), ["a", "b"], seen).write.parquet(out)
        assert (seen.get["accepted"], seen.get["rejected"]) == want
        assert spark.read.parquet(out).where("valid").count() == want[0]


def test_a_stream_reports_counts_of_each_micro_batch(spark, rows, tmp_path):
    for data in ([("x", 1), (None, 1)], [("y", 2), ("z", 3)]):
        rows(SCHEMA, data).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = sinks.run(
        filters.counted_validity(stream, ["a", "b"], "validity"),
        lambda batch, epoch: sinks.write_epoch(batch, f"{tmp_path}/out", epoch),
        f"{tmp_path}/c",
    )
    query.awaitTermination()
    counts = [p["observedMetrics"]["validity"] for p in query.recentProgress if p["numInputRows"]]
    assert sorted((c["accepted"], c["rejected"]) for c in counts) == [(1, 1), (2, 0)]
    assert spark.read.parquet(f"{tmp_path}/out").where(F.col("valid")).count() == 3
