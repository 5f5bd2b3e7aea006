"""The stream aggregates give the batch results."""

from pyspark.sql import functions as F

from tabulens.operators.distribution import value_counts
from tabulens.operators.timeseries import aggregate_by
from tabulens.streaming.rollups import stream_aggregate_by, stream_value_counts


def test_stream_equals_batch(spark, tmp_path):
    batch = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 1800).alias("ts"), (F.col("id") % 7).cast("double").alias("v"), F.concat(F.lit("s"), F.col("id") % 3).alias("s")
    )
    batch.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))

    def run(df, name):
        q = df.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        return {tuple(r) for r in spark.table(name).collect()}

    assert run(stream_value_counts(stream, "s"), "counts") == {tuple(r) for r in value_counts(batch, "s").collect()}
    assert run(stream_aggregate_by(stream, "ts", ["v"], "D", "sum"), "days") == {tuple(r) for r in aggregate_by(batch, "ts", ["v"], "D", "sum").collect()}
