"""Structured Streaming over an append-only journal: the latest record of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslens.operators.ordering import first_by


def journal_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New JSON lines files of a folder; torn lines are dropped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(path)


def keep_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str) -> StreamingQuery:
    """Maintain the latest record of each key, one folder for each batch.

    A batch is folded into the state before it and written under its own number, so a batch
    that is run again writes the same folder and the result is exactly once. Records of one
    key with the same ``order`` are told apart by a hash of all their columns, so the
    result doesn't depend on arrival. States older than the one before are removed.
    """
    spark = stream.sparkSession

    def fold(batch: DataFrame, number: int) -> None:
        rows = batch if number == 0 else batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/batch={number - 1}"))
        best = first_by(rows, keys, [F.desc(order), F.xxhash64(*rows.columns).asc()])
        best.write.mode("overwrite").parquet(f"{path}/batch={number}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={number - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
