"""Helpers the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tabulens.session import shared_folder

#: Bytes of Arrow data a Python kernel works on at a time.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to a new table in the shared folder and read them back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a table of `staged` that nothing reads any more."""
    context = stored.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def batches_of(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes, so that very long texts don't pile up in one of them."""
    for batch in batches:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
