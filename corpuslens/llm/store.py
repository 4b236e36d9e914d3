"""Tables written in the shared folder of the cluster, to cut lineage.

``spark.checkpoint.dir`` names a folder that the driver and all executors share. A
table written there survives the loss of an executor, which a local checkpoint doesn't.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where none is set and Spark is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpuslens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Workspace:
    """A folder for the intermediate tables of one run of an operator.

    The tables back the lazy result, so they stay until the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with contextlib.suppress(Exception):  # only tidies up: an odd store may refuse it
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            path = jvm.org.apache.hadoop.fs.Path(self.path)
            path.getFileSystem(conf).deleteOnExit(path)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the table as it is read back."""
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
