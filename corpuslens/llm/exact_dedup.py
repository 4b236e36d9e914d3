"""Exact deduplication by deterministic block naming.

The bytes of each text are cut into blocks of a fixed size. The distinct blocks are
sorted (by their first bytes, then by digest), and a block's place is its name; then adjacent pairs of names are
sorted and named in the same way, again and again, until each document has one name. Two
texts have the same length and the same final name exactly when their bytes are the same.
Names depend on the texts alone, not on partitions.

Text is shuffled once, when repeated blocks are reduced to one (within each task first);
the sort moves 64 bytes a block. Where a block occurs is carried by a SHA-256 of it,
not by its bytes; that each digest stands for one block only is checked, and a digest of
two blocks raises an error, so names are never shared by different blocks. From then on
only integers move. Both sides of the joins that give names and groups back to rows are
written tables: small ones are broadcast by the planner, which knows their size, and
beyond that adaptive execution splits a block or group that a third of all rows have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.rows import stay
from corpuslens.llm.store import Workspace

BLOCK_BYTES = 4096
#: Blocks are sorted by so many bytes and then by their SHA-256, so whole blocks needn't move again.
PREFIX_BYTES = 32


def _blocks(block_bytes: int) -> str:
    """The byte blocks of ``text`` in order; an empty or null text has one empty block."""
    return (
        "transform(array(cast(coalesce(text, '') as binary)), b -> "
        f"transform(sequence(0, int(greatest(octet_length(b) - 1, 0) div {block_bytes})), "
        f"i -> substring(b, i * {block_bytes} + 1, {block_bytes})))[0]"
    )


def _named(distinct: DataFrame, order: list[str], work: Workspace, name: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``name``, the place of each row of the table ``distinct`` in its global order.

    Rows are sorted by range, and the rows before each range are added up from one row a
    range. So a name depends on the rows alone, not on how many tasks named them.
    """
    place = F.monotonically_increasing_id()
    rows = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = work.write(rows.select(*keep, F.shiftright(place, 33).alias("range"), place.bitwiseAND((1 << 33) - 1).alias("own")), name)
    sizes = rows.groupBy("range").agg(F.count("*").alias("n"))
    before = work.write(sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before")), f"{name}-ranges")
    return rows.join(before, "range").select(*keep, (F.col("before") + F.col("own")).alias("name"))


def name_documents(docs: DataFrame, work: Workspace, block_bytes: int = BLOCK_BYTES, digest: str = "unhex(sha2(b, 256))") -> DataFrame:
    """``(rid, doc_id, text_sha256, level, name)`` of every row of ``docs``.

    Rows have the same ``(level, name)`` exactly when their texts have the same bytes.
    ``rid`` tells rows apart even if doc_id is null or repeats.
    """
    text = docs.select("doc_id", "text")
    places = work.write(
        text.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
            F.expr(f"transform({_blocks(block_bytes)}, b -> {digest})").alias("digests"),
        ),
        "places",
    )
    distinct = text.select(F.explode(F.expr(_blocks(block_bytes))).alias("b")).select(F.expr(digest).alias("digest"), "b").distinct()
    distinct = work.write(distinct.select(F.substring("b", 1, PREFIX_BYTES).alias("prefix"), "digest"), "blocks")
    names = work.write(_named(distinct, ["prefix", "digest"], work, "sorted-0", ["digest"]), "names-0")
    if not names.groupBy("digest").count().where("count > 1").isEmpty():
        raise RuntimeError("two different blocks have the same digest; use another digest")
    level = places.select("rid", F.size("digests").alias("n"), F.posexplode("digests").alias("pos", "digest"))
    level = work.write(level.join(names, "digest").select("rid", "n", "pos", "name"), "level-0")
    most = places.agg(F.max(F.size("digests"))).first()[0] or 1
    done, k = [], 0
    while True:
        done.append(level.where("n = 1").select("rid", F.lit(k).alias("level"), "name"))
        if most == 1:
            break
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = level.where("n > 1").groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("at")).agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("c"))
        pairs = work.write(pairs, f"pairs-{k}")
        k, most = k + 1, (most + 1) // 2
        distinct = work.write(pairs.select("a", "c").distinct(), f"distinct-{k}")
        names = work.write(_named(distinct, ["a", "c"], work, f"sorted-{k}", ["a", "c"]), f"names-{k}")
        level = pairs.join(names, ["a", "c"]).select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("at").alias("pos"), "name")
        level = work.write(level, f"level-{k}")
    final = done[0]
    for d in done[1:]:
        final = final.unionByName(d)
    return work.write(places.select("rid", "doc_id", "text_sha256").join(final, "rid"), "final")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with the same text, the one with the largest doc_id stays; where that id is
    on several of them, one of these. A null text is an empty text; empty texts are equal
    to each other. A null doc_id is less than any other. An empty table gives no rows.
    Texts may be of any length. Other columns of ``docs`` are not read, so their names
    can't clash.
    """
    work = Workspace(docs.sparkSession, "exact-dedup")
    named = name_documents(docs, work, block_bytes)
    best = named.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("best"), F.count("*").alias("group_size"))
    best = work.write(best, "best")  # so that the join's shuffle of the rows is its own and can be split
    return named.join(best, ["level", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, with all its columns."""
    work = Workspace(docs.sparkSession, "exact-dedup-stage")
    verdicts = work.write(exact_dedup(docs, block_bytes), "verdicts")
    keepers = verdicts.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("repeats"), F.max("kept").alias("kept")).where("kept")
    return stay(docs, work.write(keepers, "keepers"), {"doc_id": F.col("doc_id"), "text_sha256": F.sha2(F.coalesce("text", F.lit("")), 256)})
