"""Which texts contain which excerpts, without a join of all pairs.

Pieces are what stands between single spaces. A text that contains an excerpt has all the
excerpt's inner pieces, in a row and whole; only its first and last piece may be cut. An
excerpt is met by one anchor:

* ``pair``: two inner pieces in a row, where it has two or more;
* ``word``: its inner piece, where it has one;
* ``c13``, ``c6``, ``c3``: a run of so many characters inside a piece, where it has no inner
  piece, by the length of its longest piece;
* ``direct``: if no piece has three characters, there is no anchor; such excerpts go through
  all texts in blocks of bounded size.

Every anchor that an excerpt offers is counted over all texts, and the rarest one is taken;
an excerpt of which one anchor is in no text is in none. An anchor that is in more than
``HOT`` places is salted by text, so no key of the join has many more rows than that. The
texts' keys are computed where the text is; text moves only for the pairs that are left to
be tested.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.sources.tables import written

#: Places of texts that share a key of the join, about.
HOT = 100_000
#: Excerpts without an anchor that go through all texts at once.
BLOCK = 500
_RUNS = {"c13": 13, "c6": 6, "c3": 3}

_PAIRS = "if(size(w) < {least}, array(), transform(sequence({first}, size(w) - {last}), i -> xxhash64(w[i - 1], w[i])))"
_CHARS = (
    "flatten(transform(filter(w, x -> length(x) >= {q}), x -> transform(array(split(x, '')), c -> "
    "transform(sequence(0, size(c) - {q}), i -> xxhash64({parts})))[0]))"
)


def _chars(q: int) -> str:
    return _CHARS.format(q=q, parts=", ".join(f"c[i + {k}]" for k in range(q)))


def _text_keys(kind: str) -> Column:
    """All keys of a kind that the text with the pieces ``w`` has."""
    if kind == "pair":
        return F.expr(_PAIRS.format(least=2, first=1, last=1))
    return F.expr("transform(w, x -> xxhash64(x))" if kind == "word" else _chars(_RUNS[kind]))


def _own_keys() -> Column:
    """The anchors that an excerpt with the pieces ``w`` offers."""
    pair = F.expr(_PAIRS.format(least=4, first=2, last=2))
    out = F.when(F.col("kind") == "pair", pair).when(F.col("kind") == "word", F.expr("array(xxhash64(w[1]))"))
    for kind, q in _RUNS.items():
        out = out.when(F.col("kind") == kind, F.expr(_chars(q)))
    return out


def _kind() -> Column:
    longest = F.expr("array_max(transform(w, x -> length(x)))")
    out = F.when(F.size("w") >= 4, "pair").when(F.size("w") == 3, "word")
    for kind, q in _RUNS.items():
        out = out.when(longest >= q, kind)
    return out.otherwise("direct")


def _placed(texts: DataFrame, fold: Callable[[Column], Column], kinds: list[str], keys: DataFrame) -> DataFrame:
    """``(doc, kind, key)`` of each place in the texts that has a key of ``keys(kind, key)``."""
    out = None
    for kind in kinds:
        own = texts.select("doc", F.split(fold(F.col("text")), " ").alias("w"))
        own = own.select("doc", F.lit(kind).alias("kind"), F.explode(_text_keys(kind)).alias("key"))
        own = own.join(keys.where(F.col("kind") == kind).select("key"), "key", "left_semi").select("doc", "kind", "key")
        out = own if out is None else out.unionByName(own)
    return out


def _blocks(rows: DataFrame) -> Iterator[list]:
    block = []
    for row in rows.toLocalIterator():
        block.append(row)
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


def contained(texts: DataFrame, excerpts: DataFrame, fold: Callable[[Column], Column] = lambda c: c, hot: int = HOT) -> DataFrame:
    """``(item, doc)`` once for each row of ``excerpts(item, excerpt)`` and ``texts(doc, text)`` where the text has the excerpt.

    Texts are folded by ``fold`` before they are compared, excerpts are taken as they are.
    An empty excerpt is in every text that isn't null, a null one in none. Ids may repeat: then a pair is there if
    one of the rows fits. An empty table on either side gives no rows.
    """
    texts = texts.select("doc", "text").where("text is not null")
    asked = excerpts.select("item", "excerpt").where("excerpt is not null").withColumn("w", F.split("excerpt", " ")).withColumn("kind", _kind())
    asked = written(asked)
    kinds = sorted(r["kind"] for r in asked.select("kind").distinct().collect())
    out = None
    for block in _blocks(asked.where("kind = 'direct'").select("item", "excerpt")) if "direct" in kinds else []:
        literal = F.array(*[F.struct(F.lit(r["item"]).alias("item"), F.lit(r["excerpt"]).alias("excerpt")) for r in block])
        found = F.explode(F.filter(literal, lambda x: fold(F.col("text")).contains(x["excerpt"])))
        part = texts.select("doc", found.alias("x")).select("x.item", "doc")
        out = part if out is None else out.unionByName(part)
    kinds = [k for k in kinds if k != "direct"]
    if kinds:
        offered = asked.where("kind <> 'direct'").select("item", "excerpt", "kind", F.explode(F.array_distinct(_own_keys())).alias("key"))
        offered = written(offered)
        keys = written(offered.select("kind", "key").distinct())
        counts = written(_placed(texts, fold, kinds, keys).groupBy("kind", "key").agg(F.count("*").alias("places")))
        rated = offered.join(counts, ["kind", "key"], "left").groupBy("item", "excerpt", "kind")
        chosen = rated.agg(F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "key")).alias("rarest")).where("rarest.places > 0")
        chosen = written(chosen.select("item", "excerpt", "kind", "rarest.key", F.ceil(F.col("rarest.places") / hot).cast("int").alias("salts")))
        anchors = written(chosen.select("kind", "key", "salts").distinct())
        near = _placed(texts, fold, kinds, anchors).join(anchors, ["kind", "key"])
        near = near.withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts")))
        wanted = chosen.withColumn("salt", F.explode(F.expr("sequence(0L, salts - 1L)"))).drop("salts")
        pairs = near.join(wanted, ["kind", "key", "salt"]).select("doc", "item", "excerpt").distinct()
        pairs = written(pairs.withColumnRenamed("doc", "of"))
        tested = texts.join(pairs, F.col("doc").eqNullSafe(F.col("of"))).where(fold(F.col("text")).contains(F.col("excerpt"))).select("item", "doc")
        out = tested if out is None else out.unionByName(tested)
    if out is None:
        out = asked.select("item").limit(0).join(texts.select("doc").limit(0))
    return out.distinct()
