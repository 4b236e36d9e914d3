"""Token counts as delta-maintained rollups.

A batch of changes is signed rows: +1 for a document that comes, -1 for one that goes; a
revised count is both. A batch is added up by source, language and tokenizer version, and
only these sums are kept, in a folder of the batch's own. The folder is complete once
Spark's commit has marked it, and a batch that is already there is not committed again, so
a replay changes nothing. Totals are the sums of the committed batches; because the sums
are additive, batches may come in any order, and folding them into one changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices
from corpuslens.llm.store import Workspace
from corpuslens.llm.tokenizing import BYTE_BPE, encoder

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_chars")
#: Bytes of text that a task encodes at once.
SLICE_BYTES = 1 << 20


def _count_rows(vocabulary: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                sizes = [len(ids) for ids in tokens.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), part.column(4), part.column(5), pa.array(sizes, pa.int64())], ["doc_id", "source", "lang", "n_chars", "n_words", "n_pieces"])

    return rows


def counted(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """doc_id, source, lang, n_chars, n_words and n_pieces (ids of the vocabulary) by row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.size(F.expr("filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.length(text).cast("long").alias("n_chars"), words.alias("n_words"))
    return rows.mapInArrow(_count_rows(vocabulary), "doc_id long, source string, lang string, n_chars long, n_words long, n_pieces long")


def signed(rows: DataFrame, sign: int, tokenizer: str, tokens: str) -> DataFrame:
    """Changes that count every row of ``rows`` once with ``sign``."""
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (sign * F.col(tokens)).alias("n_tokens"), (sign * F.col("n_chars")).alias("n_chars"))


class TokenRollup:
    """The committed batches in one folder, which all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed ``changes``; False, and nothing done, if it was added before.

        A run that broke off left no mark of success, and its folder is written anew.
        """
        if not batch.replace("-", "").isalnum():
            raise ValueError("a batch's name has letters, digits and hyphens only")
        folder = f"{self.path}/batch={batch}"
        if self._exists(f"{folder}/_SUCCESS"):
            return False
        sums = changes.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums.where(" or ".join(f"{c} <> 0" for c in SUMS)).write.mode("overwrite").parquet(folder)
        return True

    def totals(self) -> DataFrame:
        """Totals over the committed batches; a key without documents left has no row."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().toString() for f in system.listStatus(root)] if system.exists(root) else []
        paths = [p for p in names if "/batch=" in p and self._exists(f"{p}/_SUCCESS")]
        schema = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" or ".join(f"{c} <> 0" for c in SUMS))


def rollup_documents(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Totals of all ``docs`` after a load, a change of tokenizer, a withdrawal and replays.

    Batch ``load`` inserts every document under the version ``words``. ``recount`` revises
    every count to the version ``pieces``, the ids of ``vocabulary``: each document leaves
    ``words`` (a delete) and enters ``pieces`` (an insert). ``keep-words`` inserts under
    ``words`` again. ``withdraw`` deletes documents without words under both versions, and
    ``restore`` inserts them again. ``load`` and ``recount`` are then replayed. The totals
    are those of all documents under both versions: source, lang, tokenizer, n_docs,
    n_tokens, n_chars.

    Null source and lang are keys of their own; a null text has no tokens; repeated rows
    count each time. An empty table gives no rows; other columns are not read.
    """
    work = Workspace(docs.sparkSession, "token-rollup")
    rows = work.write(counted(docs, vocabulary), "counts")
    rollup = TokenRollup(docs.sparkSession, f"{work.path}/rollup")
    words = lambda sign, own=rows: signed(own, sign, "words", "n_words")
    pieces = lambda sign, own=rows: signed(own, sign, "pieces", "n_pieces")
    bare = rows.where("n_words = 0")
    batches = [("load", words(1)), ("recount", words(-1).unionByName(pieces(1))), ("keep-words", words(1)), ("withdraw", words(-1, bare).unionByName(pieces(-1, bare))), ("restore", words(1, bare).unionByName(pieces(1, bare)))]
    for name, changes in [*batches, *batches[:2]]:
        rollup.commit(name, changes)
    return rollup.totals()
