"""The driver's tables as attributes, read lazily, and tables between the steps of an operator."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where none is set and Spark is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpuslens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpoint_folder(spark: SparkSession) -> None:
    """Lets ``checkpoint()`` write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: it survives lost executors, and the planner knows its size.

    It backs lazy results, so it stays until the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with contextlib.suppress(Exception):  # only tidies up: an odd store may refuse it
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def rows(self, values: list[tuple], schema: str) -> DataFrame:
        """A small dimension table from literals, local to the plan, so that the planner knows its size and runs no Python for it."""
        columns = dict(zip(StructType.fromDDL(schema).names, map(list, zip(*values))))
        return self.spark.createDataFrame(pa.table(columns), schema)
