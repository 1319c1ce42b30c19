"""Exact duplicates by deterministic block naming, in DataFrame functions only.

Two texts are equal when they are after every character of ``[\\x20\\x09-\\x0D]`` is deleted. A
normalised text's UTF-8 bytes are cut into fixed-size blocks. The distinct blocks of the corpus are
sorted and each one's place in that order is its integer name; then adjacent names are paired, the
distinct pairs sorted and named in their turn, until a document has one name left. Equal
(number of rounds, last name) means equal bytes and unequal ones unequal bytes: a name stands for
one string, so no fingerprint decides.

Plan:

1. Distinct blocks. They are gathered by a 64-bit hash of the block and told apart by their bytes
   (``collect_set`` under each hash: one block, but for a clash), so the corpus's text crosses the
   network once, and a block that a third of all documents hold crosses once a task. The order that
   names them is (hash, bytes), numbered within ranges of the hash; a hash with several blocks gives
   each its own name and its bytes go to a table of clashes, in practice an empty one.
2. Occurrences: a narrow pass over the documents writes (row, place, hash, name if its hash
   clashes); the table of clashes is joined on hash and bytes, broadcast by Spark where its written
   size allows. All later steps move numbers only.
3. Rounds: places 2i and 2i + 1 of a row make a pair (a last single one pairs with none). Pairs are
   counted down to distinct ones before they are sorted, and joined back on the pair; Spark
   splits a pair that many rows share (skew join). Each round is written, and rows with one name
   left leave; there are as many rounds as the longest text's block count has bits.
4. Groups of equal identity: size, and the row that stays, by partial aggregates.

Defined results: a null text is empty; empty texts are one group. Of equal texts the row with most
code points in its original text stays, then the smallest id (null ids last); of rows alike in both
any one, but only one. Repeated rows are rows like others. Extra columns are not read. An empty
table gives an empty result. Texts of any length: a text is rows of blocks from step 1 on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revspark.llm.common import shuffle_partitions, written

# ---- fixed values: the white space that normalisation deletes ----------------------------------
WHITE_SPACE = " \t\n\x0b\x0c\r"
# ------------------------------------------------------------------------------------------------
BLOCK_BYTES = 4096
RANGES = 8  # ranges of the order that are numbered apart, for each shuffle partition
NAME_BITS = 40  # a name: its range, then its number within the range


def normalised(text: Column) -> Column:
    """The text without white space (null: empty)."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def blocks_of(data: Column, block_bytes: int) -> Column:
    """The fixed-size blocks of a binary column; an empty one has one empty block."""
    last = F.greatest(F.floor((F.length(data) - 1) / F.lit(block_bytes)), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(
        data, i * F.lit(block_bytes) + F.lit(1), F.lit(block_bytes)))


def _numbered(distinct: DataFrame, order: list[str], ranges: int, spread: Column) -> DataFrame:
    """``distinct`` rows with their ``name``: number of the range (by ``spread``, an evenly spread
    long), then place among the range's rows in ``order``."""
    at = F.pmod(spread, F.lit(ranges))
    rows = distinct.withColumn("range", at)
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)).cast("long")
    name = F.shiftleft(F.col("range").cast("long"), NAME_BITS) + place
    return rows.withColumn("name", name).drop("range")


def _block_names(docs: DataFrame, block_bytes: int, block_hash: Callable[[Column], Column],
                 ranges: int) -> tuple[DataFrame, DataFrame]:
    """(hash, name) of the blocks that are alone under their hash, (hash, block, name) of others."""
    blocks = docs.select(F.explode(blocks_of(F.col("data"), block_bytes)).alias("block"))
    sets = blocks.select(block_hash(F.col("block")).alias("hash"), "block").groupBy("hash").agg(
        F.sort_array(F.collect_set("block")).alias("blocks"))
    several = F.size("blocks") > 1
    distinct = sets.select("hash", several.alias("clash"), F.posexplode("blocks").alias("tie", "b"))
    distinct = distinct.select("hash", "tie", F.when(F.col("clash"), F.col("b")).alias("block"))
    numbered = _numbered(distinct, ["hash", "tie"], ranges, F.xxhash64("hash"))
    names = written(numbered.select("hash", "block", "name"), "block-names", merge=False)
    clashes = written(names.where("block IS NOT NULL"), "block-clashes")
    return names.where("block IS NULL").select("hash", "name"), clashes


def _occurrences(docs: DataFrame, clashes: DataFrame, block_bytes: int,
                 block_hash: Callable[[Column], Column]) -> DataFrame:
    """A row for each block of each row; what is known of the row itself stands at place 0."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "points", "data",
        F.sha2("data", 256).alias("text_sha256"))
    blocks = blocks_of(F.col("data"), block_bytes)
    places = numbered.withColumn("blocks", blocks).drop("data").withColumn(
        "n", F.size("blocks")).select(
        "row", "n", "doc_id", "points", "text_sha256", F.posexplode("blocks").alias("at", "block"))
    hashed = places.withColumn("hash", block_hash(F.col("block")))
    found = hashed.join(clashes.withColumnRenamed("name", "clash"), ["hash", "block"], "left")
    first = lambda c: F.when(F.col("at") == 0, F.col(c)).alias(c)
    return written(found.select("row", "at", "n", "hash", "clash", first("doc_id"),
                                first("points"), first("text_sha256")), "blocks", merge=False)


def _round(level: DataFrame, ranges: int) -> DataFrame:
    """Adjacent names of each row paired, and the pairs named."""
    half = F.shiftright("at", 1)
    side = F.col("at").bitwiseAND(1)
    pairs = level.groupBy("row", half.alias("at"), F.shiftright(F.col("n") + 1, 1).alias("n")).agg(
        F.max(F.when(side == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"))
    distinct = pairs.select("left", "right").distinct()
    named = _numbered(distinct, ["left", "right"], ranges, F.xxhash64("left", "right"))
    return pairs.join(named, ["left", "right"]).select("row", "at", "n", "name")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
               block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """row, doc_id, points, text_sha256 and the identity (rounds, name) of every row of ``docs``
    (doc_id, points, data)."""
    ranges = RANGES * shuffle_partitions(docs.sparkSession)
    names, clashes = _block_names(docs, block_bytes, block_hash, ranges)
    places = _occurrences(docs, clashes, block_bytes, block_hash)
    own = places.select("row", "at", "n", "hash", "clash").join(names, "hash", "left")
    level = written(own.select("row", "at", "n", F.coalesce("clash", "name").alias("name")),
                    "names", merge=False)
    most = places.agg(F.max("n")).first()[0] or 0
    done, rounds = [], 0
    while True:
        done.append(level.where("n = 1").select("row", "name", F.lit(rounds).alias("rounds")))
        if most <= 1:
            break
        level = written(_round(level.where("n > 1"), ranges), "names", merge=False)
        most, rounds = (most + 1) // 2, rounds + 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    facts = places.where("at = 0").select("row", "doc_id", "points", "text_sha256")
    return written(facts.join(found, "row"), "identities", merge=False)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES,
                     block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id (the id of the row that stays of its group),
    group_size, kept, text_sha256 (of the normalised text)."""
    text = F.col(text_col).cast("string")
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.coalesce(text, F.lit(""))).alias("points"),
        normalised(text).cast("binary").alias("data"))
    rows = identities(docs, block_bytes, block_hash)
    order = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("none"),
                     "doc_id", "row")
    # Written, so that the join below deals both sides anew and Spark can split a large group.
    groups = written(rows.groupBy("rounds", "name").agg(
        F.min(order).alias("stays"), F.count(F.lit(1)).alias("group_size")), "groups", merge=False)
    return rows.join(groups, ["rounds", "name"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256")
