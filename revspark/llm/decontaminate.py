"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

A benchmark item's windows are its runs of ``WINDOW`` words (all its words, if there are fewer).
A window occurs in a document if all its words do, in order and side by side, so the overlap
asked for is the whole window and the necessary prefix of its words, ordered by rarity, is the
rarest one. The join key is that word:

1. Windows are interned: the distinct windows of all items are one table, and which items have each is
   another that comes in last. A prompt that ten thousand items begin with is one window.
2. Rarity: how often each word of the benchmark occurs in all documents (one pass; a document's
   other words are dropped in the map tasks, the rest are counted there first). Each window gets its
   rarest word and that word's place in it.
3. One pass over the documents' words joins on the word. Positional and length bounds drop
   windows that would begin before the document's first word or end behind its last, then the
   window is compared with the document's words, once an occurrence, still in the same map task:
   nothing unverified is shuffled.
4. Verified windows become hit positions and sets of windows, counted per document; what items a set
   of windows has is found once for all documents with that set.

What is broadcast is made of the benchmark's distinct words and windows. Its bytes are summed first;
beyond ``BROADCAST_BYTES`` the rows are dealt into parts of at most that size, each joined in a pass of
its own, and the parts' hits are united.

Defined results: a null text has no words; an item without words or with a null id has no
windows; repeated items count once; rows with the same id and text get the same result,
rows with one id and different texts each their own, null ids included; empty tables give no
hits or no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import written

WINDOW = 10
BROADCAST_BYTES = 64 << 20
CHUNK = 64  # words of a document that are looked up together
# What isn't an ASCII letter or digit, or a character beyond ASCII, parts words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def raw_words(text: Column) -> Column:
    """Words in their own case; the first and the last entry may be empty strings."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS)


def n_words(words: Column) -> Column:
    edge = lambda w: F.when(w == "", 1).otherwise(0)
    last = F.when(F.size(words) > 1, edge(F.element_at(words, -1))).otherwise(0)
    return (F.size(words) - edge(words[0]) - last).cast("long")


def _parts(df: DataFrame, total_bytes: int, most: int) -> list[DataFrame]:
    """``df``, known to have at most ``total_bytes``, in parts of at most about ``most`` bytes."""
    n = max(1, -(-total_bytes // most))
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i) for i in range(n)]


def benchmark_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, words (lower case) of every distinct item that has words."""
    words = F.filter(raw_words(F.col(text_col)), lambda w: w != "")
    return (
        benchmark.select(F.col(id_col).cast("string").alias("item"),
                         F.transform(words, ascii_lower).alias("words"))
        .where("item IS NOT NULL AND size(words) > 0").distinct()
    )


def word_counts(documents: DataFrame, vocabulary: list[DataFrame]) -> DataFrame:
    """key, n: occurrences in all documents of the vocabulary's words."""
    # The outer form keeps the optimizer from adding a filter that would split the texts twice.
    found = documents.select(F.explode_outer("words").alias("word")).select(
        F.lower("word").alias("key"))
    counted = [found.join(F.broadcast(part), "key").groupBy("key").agg(
        F.count(F.lit(1)).alias("n")) for part in vocabulary]
    return reduce(DataFrame.unionByName, counted)


def window_owners(items: DataFrame, window: int) -> DataFrame:
    """window (its words, lower case, joined by spaces), size, item: the windows of every item."""
    size = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("words") - size)
    windows = F.transform(starts, lambda s: F.concat_ws(" ", F.slice("words", s + 1, size)))
    return items.select("item", size.alias("size"), F.explode(windows).alias("window")).distinct()


def rarest_words(owners: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per distinct window: key (its rarest word), at (that word's place in it), size,
    window."""
    distinct = owners.select("window", "size").distinct()
    each = distinct.select("window", "size", F.posexplode(F.split("window", " ")).alias("at", "word"))
    each = each.withColumn("key", F.lower("word")).join(counts, "key", "left")
    rare = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "at")).alias("rare")
    return each.groupBy("window", "size").agg(rare).select(
        "rare.key", "rare.at", "size", "window")


def occurrences(documents: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """doc_id, text_key, window, start, size of every verified window in ``documents``.

    Documents are taken apart into runs of ``CHUNK`` words, each with the words a window can reach
    around it, so what a matching word carries along is bounded, however long the document.
    """
    reach = window - 1
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(CHUNK)),
        lambda c: F.struct(
            c.alias("base"), F.slice("words", c + 1, F.lit(CHUNK)).alias("core"),
            F.slice("words", F.greatest(c - reach, F.lit(0)) + 1,
                    F.least(c, F.lit(reach)) + CHUNK + reach).alias("around")))
    each = documents.select("doc_id", "text_key", F.explode_outer(runs).alias("run")).select(
        "doc_id", "text_key", F.col("run.base").alias("base"), F.col("run.around").alias("around"),
        F.posexplode_outer("run.core").alias("place", "word"))
    each = each.withColumn("key", F.lower("word")).drop("word")
    joined = each.join(F.broadcast(prefixes), "key")
    # Places are counted from the first word of `around`.
    begin = F.least("base", F.lit(reach)) + F.col("place") - F.col("at")
    own = F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.col("size"))
    own = ascii_lower(F.concat_ws(" ", own))  # too short behind the document's end
    return joined.where((begin >= 0) & (own == F.col("window"))).select(
        "doc_id", "text_key", "window", "size",
        (F.col("base") + F.col("place") - F.col("at")).alias("start"))


def items_of_sets(sets: DataFrame, owners: DataFrame) -> DataFrame:
    """windows, n_items, items_sha256 of every distinct set of windows."""
    distinct = sets.select("windows").distinct()
    named = distinct.select("windows", F.explode("windows").alias("window")).join(
        owners.select("window", "item"), "window")
    items = F.array_sort(F.collect_set("item"))
    return named.groupBy("windows").agg(items.alias("items")).select(
        "windows", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES
                  ) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, n_hit, n_items, items_sha256, contaminated of
    every document row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.xxhash64(text).alias("text_key"),
                            raw_words(F.col(text_col)).alias("words"))
    items = benchmark_words(benchmark, item_col, item_text_col)
    owners = written(window_owners(items, window), "window-owners")
    vocabulary = items.select(F.explode("words").alias("word")).select(
        F.lower("word").alias("key")).distinct()
    row_bytes = F.sum(F.octet_length("key") + 64)
    counts = word_counts(docs, _parts(
        vocabulary, vocabulary.agg(row_bytes).first()[0] or 0, broadcast_bytes))
    # Written, so that the pass that counts words is over before the join's broadcast begins.
    prefixes = written(rarest_words(owners, counts), "rarest-words")
    row_bytes = F.sum(F.octet_length("key") + F.octet_length("window") + 96)
    found = [occurrences(docs, part, window) for part in _parts(
        prefixes, prefixes.agg(row_bytes).first()[0] or 0, broadcast_bytes)]
    hits = reduce(DataFrame.unionByName, found)
    # One row per document with hits; what it collects is bounded by the document's own words.
    place = F.struct("start", "size")
    marked = hits.groupBy("doc_id", "text_key").agg(
        F.collect_set(place).alias("places"), F.array_sort(F.collect_set("window")).alias("windows"))
    covered = F.flatten(F.transform("places", lambda p: F.sequence(
        p["start"], p["start"] + p["size"] - 1)))
    marked = written(marked.select(
        "doc_id", "text_key", F.size(F.array_distinct(covered)).alias("n_hit"), "windows"),
        "documents-hit")
    marked = marked.join(items_of_sets(marked, owners), "windows").drop("windows")
    counted = docs.select("doc_id", "text_key", n_words(F.col("words")).alias("n_words"))
    same = (counted["doc_id"].eqNullSafe(marked["doc_id"])
            & (counted["text_key"] == marked["text_key"]))
    return counted.join(marked, same, "left").select(
        counted["doc_id"], counted["text_key"], counted["n_words"],
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
