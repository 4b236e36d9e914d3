"""Releases: tables that are written beside the last one, verified, and swapped in; submissions.

A release is a folder with a folder a table, files named by their place, and ``manifest``:
a line of JSON for each file with its path, bytes and SHA-256. The same rows give the same
files, byte for byte, however many tasks wrote them. All file operations go through the
file system that Spark has for the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.operators.ordering import numbered
from corpuslens.sources.files import file_hashes

#: Rows of a file; a file has to stay under 2 GB to be hashed.
FILE_ROWS = 1_000_000
MANIFEST = "path string, bytes long, sha256 string"


class _Folder:
    """A path's file system and the few operations that a release needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.system = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, end: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path + end)

    def there(self, end: str) -> bool:
        return self.system.exists(self.at(end))

    def drop(self, end: str) -> None:
        if self.there(end):
            self.system.delete(self.at(end), True)

    def move(self, old: str, new: str) -> None:
        if not self.system.rename(self.at(old), self.at(new)):
            raise OSError(f"{self.path}{old} can't be renamed to {self.path}{new}")

    def names(self, end: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self.system.listStatus(self.at(end)))


def _write_table(df: DataFrame, folder: _Folder, end: str, keys: list[str], file_rows: int) -> None:
    """Files ``data-00000.parquet`` and on, of ``file_rows`` rows each in the order of ``keys``."""
    rows = numbered(df, keys, "__at").withColumn("__file", F.floor(F.col("__at") / file_rows))
    files = rows.repartition("__file").sortWithinPartitions("__file", *keys).drop("__at")
    out = files.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", 9).option("parquet.block.size", 128 << 20)
    out.partitionBy("__file").parquet(f"{folder.path}{end}")
    for name in folder.names(end):
        if name.startswith("__file="):
            (part,) = [x for x in folder.names(f"{end}/{name}") if x.startswith("part-")]
            folder.move(f"{end}/{name}/{part}", f"{end}/data-{int(name[7:]):05d}.parquet")
        folder.drop(f"{end}/{name}")
    if not [x for x in folder.names(end) if x.startswith("data-")]:  # an empty table is one file with its schema
        df.limit(0).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder.path}{end}-empty")
        (part,) = [x for x in folder.names(f"{end}-empty") if x.startswith("part-")]
        folder.move(f"{end}-empty/{part}", f"{end}/data-00000.parquet")
        folder.drop(f"{end}-empty")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``MANIFEST`` of the data files that are in ``path``."""
    inside = F.regexp_extract("path", r"([^/]+/data-\d+\.parquet)$", 1)
    return file_hashes(spark, path).select(inside.alias("path"), "bytes", "sha256").where("path <> ''")


def write_release(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]], file_rows: int = FILE_ROWS) -> None:
    """Write ``tables`` as the release at ``path``; ``keys`` give each a total order of its rows.

    All is written to ``path``.building and read back: each table must have as many rows,
    with the same digest, as were given. Only then the last release is moved aside, the new
    one takes its place, and the old one is deleted. If anything fails before, the last
    release stays as it is; what an earlier attempt left is replaced.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = _Folder(spark, path)
    folder.drop(".building")
    try:
        for name, df in sorted(tables.items()):
            _write_table(df, folder, f".building/{name}", keys[name], file_rows)
            back = spark.read.schema(df.schema).parquet(f"{folder.path}.building/{name}")
            mark = lambda rows: rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("s")).first()
            if mark(df) != mark(back):
                raise RuntimeError(f"{name} does not read back as it was written")
        _listed(spark, f"{folder.path}.building").sort("path").write.json(f"{folder.path}.building/manifest")
    except BaseException:
        folder.drop(".building")
        raise
    if folder.there(""):
        folder.drop(".previous")
        folder.move("", ".previous")
    folder.move(".building", "")
    folder.drop(".previous")


def release_problems(spark: SparkSession, path: str) -> DataFrame:
    """``(path, problem)``: files that are not listed, not there, or not as the manifest says."""
    listed = spark.read.schema(MANIFEST).json(f"{path}/manifest").select("path", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    both = _listed(spark, path).join(listed, "path", "full")
    problem = F.when(F.col("s").isNull(), "not listed").when(F.col("sha256").isNull(), "missing").when((F.col("s") != F.col("sha256")) | (F.col("b") != F.col("bytes")), "changed")
    return both.select("path", problem.alias("problem")).where("problem is not null")


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """``(file, type, sequence, filename, description, text)`` of each document in submission files.

    A file is cut at its ``<DOCUMENT>`` marks by the text reader, record by record, so no
    task holds a file and long ones are split. Tags stand at the begin of a line; the text
    is what follows the line of ``<TEXT>`` up to ``</TEXT>``, with LF line ends. A record
    without a type and a file name (such as a submission's header) is none.
    """
    part = F.substring_index(F.regexp_replace("value", "\r\n?", "\n"), "</DOCUMENT>", 1)
    raw = spark.read.option("lineSep", "<DOCUMENT>").text(path).select(F.col("_metadata.file_path").alias("file"), part.alias("v"))
    head = F.substring_index("v", "<TEXT>", 1)
    tag = lambda name: F.trim(F.regexp_extract(head, rf"(?m)^\s*<{name}>([^\n]*)", 1))
    after = F.when(F.contains(F.col("v"), F.lit("<TEXT>")), F.expr("substring(v, instr(v, '<TEXT>') + 6)")).otherwise("")
    body = F.regexp_replace(F.substring_index(after, "</TEXT>", 1), r"^[^\n]*\n|\n\z", "")
    rows = raw.select("file", F.upper(tag("TYPE")).alias("type"), tag("SEQUENCE").alias("sequence"), tag("FILENAME").alias("filename"), tag("DESCRIPTION").alias("description"), body.alias("text"))
    return rows.where("type <> '' or filename <> ''")
