"""Readers and writers: config tables, journals, escaped CSV, safe JSON lines, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from corpuslens.operators.ordering import numbered

#: Rows of a file of ``write_sorted``.
FILE_ROWS = 1_000_000


def read_configs(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Splits of one config as a table with the column ``split``."""
    out = None
    for split, path in sorted(paths.items()):
        part = spark.read.parquet(path).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def expand_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Fields of a JSON column as columns; a column that exists already wins."""
    parsed = df.withColumn("__json", F.from_json(column, schema))
    have = {c.lower() for c in df.columns}
    fields = [f.name for f in parsed.schema["__json"].dataType.fields if f.name.lower() not in have]
    return parsed.select(*df.columns, *[F.col(f"__json.{f}").alias(f) for f in fields])


def read_journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only journal; blank and torn lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("lineSep", "\n").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines that must all be whole: a line that isn't is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("lineSep", "\n").json(path)


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` records, in the order of the files."""
    return df.limit(n)


def write_pinned(df: DataFrame, path: str, schema: str, config: str, split: str) -> None:
    """Write one config's split in exactly the columns and types of ``schema``; others are an error."""
    want = StructType.fromDDL(schema)
    if [(f.name, f.dataType) for f in df.schema] != [(f.name, f.dataType) for f in want]:
        raise ValueError(f"{config}/{split}: {df.schema.simpleString()}, expected {want.simpleString()}")
    df.write.mode("overwrite").parquet(f"{path}/{config}/{split}")


def rewrite_column(df: DataFrame, path: str, column: str, value: Column) -> DataFrame:
    """Write ``df`` with one column changed and return what is read back.

    It is an error if another column, or the number of rows, reads back otherwise. The new
    files stand beside the old ones: swap folders when this has returned.
    """
    df.withColumn(column, value).write.mode("errorifexists").parquet(path)
    back = df.sparkSession.read.schema(df.withColumn(column, value).schema).parquet(path)
    rest = [c for c in df.columns if c != column]
    mark = lambda rows: rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*rest).cast("decimal(38,0)")).alias("s")).first()
    if mark(df) != mark(back):
        raise RuntimeError(f"{path} does not read back as it was written")
    return back


def write_partitioned(df: DataFrame, path: str, by: str = "split") -> None:
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> None:
    """One file a range of the keys, of fixed size in rows, zstd level 9 and fixed row groups.

    Rows are numbered in the order of ``keys`` (a total order) and ``FILE_ROWS`` of them
    make a file, so the same rows give the same files whatever the cluster's size.
    """
    rows = numbered(df, keys, "__at").withColumn("__file", F.floor(F.col("__at") / FILE_ROWS))
    files = rows.repartition("__file").sortWithinPartitions("__file", *keys).drop("__at")
    out = files.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", 9).option("parquet.block.size", 128 << 20)
    out.partitionBy("__file").parquet(path)


def safe_line(c: Column) -> Column:
    """Escapes for characters that some readers take for line ends."""
    for code in ("2028", "2029", "0085"):
        c = F.regexp_replace(c, chr(int(code, 16)), "\\\\u" + code)
    return c


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, keys sorted."""
    row = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.select(safe_line(row).alias("value")).write.mode("overwrite").text(path)


def csv_cell(c: Column) -> Column:
    """A cell that no spreadsheet takes for a formula, on one line."""
    text = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "\n", r"\\n")
    return F.when(text.rlike(r"^[=+\-@\t\r']"), F.concat(F.lit("'"), text)).otherwise(text)


def csv_value(c: Column) -> Column:
    """What ``csv_cell`` was made from."""
    bare = F.when(c.rlike(r"^'[=+\-@\t\r']"), F.substring(c, 2, 2**31 - 1)).otherwise(c)
    parts = F.transform(F.split(bare, r"\\\\", -1), lambda x: F.regexp_replace(x, r"\\n", "\n"))
    return F.array_join(parts, "\\")


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted cells; arrays, maps and structs are JSON text."""
    nested = {f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    cells = [csv_cell(F.to_json(c) if c in nested else F.col(c).cast("string")).alias(c) for c in df.columns]
    df.select(*cells).write.mode("overwrite").option("quoteAll", True).option("escape", '"').csv(path, header=True)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """What ``write_csv`` wrote; a header with other columns is an error."""
    df = spark.read.option("escape", '"').csv(path, header=True)
    if df.columns != columns:
        raise ValueError(f"columns {df.columns}, expected {columns}")
    return df.select(*[csv_value(F.col(c)).alias(c) for c in columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``key : value`` entries of a text file; an indented line continues the value above it.

    A manifest is a small file, read as one row.
    """
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\n[ \t]+", " ").alias("value"))
    lines = whole.select(F.explode(F.split("value", r"\r?\n")).alias("value")).where(F.col("value").rlike(r"^[^:\s][^:]*:"))
    return lines.select(F.trim(F.regexp_extract("value", r"^([^:]+):", 1)).alias("key"), F.trim(F.regexp_extract("value", r"^[^:]+:(.*)$", 1)).alias("val"))


def manifest_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``(path, sha256)`` of the lines of a manifest that list files: a hash, then a path."""
    lines = spark.read.text(path).select(F.regexp_extract("value", r"^\s*([0-9a-f]{64})\s+\*?(\S.*?)\s*$", 1).alias("sha256"), F.regexp_extract("value", r"^\s*([0-9a-f]{64})\s+\*?(\S.*?)\s*$", 2).alias("path"))
    return lines.where("sha256 <> ''").select("path", "sha256")


def identical_files(files: DataFrame) -> DataFrame:
    """Groups of files with the same bytes, from ``file_hashes``: sha256, files, bytes of one, first path."""
    groups = files.groupBy("sha256").agg(F.count("*").alias("files"), F.max("bytes").alias("bytes"), F.min("path").alias("first"))
    return groups.where("files > 1")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Path, bytes and SHA-256 of each file of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
