"""A corpus pipeline over ``documents``: five stages, each calling one operator of revspark.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller writes it as Parquet
and gives it to the next one as ``docs``. All stages but the last return the columns of
``documents``. A stage judges the whole of what its predecessor kept.

Defined results: a null or empty text is kept by the filtering stages (the toxicity stage scores
it like any text without toxic words); rows with a null id are judged like others, but substring
removal keeps their texts whole. Of near copies the row with the smallest id stays, null ids
last; of rows equal in id and text one stays. Documents without words have no near copies and all
stay. Other columns, whatever they are called, are kept as they are; n_chars is recounted where a
text has changed. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revspark.llm.common import small_batches, written
from revspark.llm.decontaminate import contamination
from revspark.llm.ngram_join import near_duplicates
from revspark.llm.packing import pack
from revspark.llm.substring_dedup import substring_dedup
from revspark.llm.toxicity import below, fit_from_labels
from revspark.session import sf_table

TOXIC = 0.7  # documents that score as much or more are rejected
TOKENIZER, END_ID = "byte_bpe_50k.json", 0
ORACLE_SQL = None  # trained, merged and tokenised: SQL can't express it


def _column(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _matched(docs: DataFrame, found: DataFrame, how: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` joined with results of an operator, by id (null ids too) and text; and the names that
    the results' columns have there, which are no columns of ``docs``."""
    prefix = "found_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = {c: prefix + c for c in found.columns}
    found = found.withColumnsRenamed(names)
    same = docs["doc_id"].eqNullSafe(found[names["doc_id"]])
    same = same & (_text_key(docs) == found[names["text_key"]])
    return docs.join(found, same, how), names


def _as_before(joined: DataFrame, docs: DataFrame) -> DataFrame:
    return joined.select(*[_column(docs, c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: toxic documents go. It learns from the labels that op2 learns from."""
    small_batches(spark)
    return below(docs, fit_from_labels(docs, sf_table(spark, sf_dir, "labels")), TOXIC)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near copies the document with the smallest id stays."""
    small_batches(spark)
    found = written(near_duplicates(docs, with_key=True), "near-copies")
    rows = found.groupBy("doc_id", "text_key", "component").agg(F.count(F.lit(1)).alias("n"))
    # The first of each group by (id, key): a group of any size is one row a task before the shuffle.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    each = F.struct(order.alias("o"), "n")
    first = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(each).alias("m"))
    wordless = rows.where("component IS NULL").select("doc_id", "text_key", F.lit(1).alias("n"))
    kept = first.select("m.o.doc_id", "m.o.text_key", "m.n").unionByName(wordless)
    joined, names = _matched(docs, kept, "inner")
    # Rows equal in id and text are copies too; few rows are, so only they are shuffled again.
    single = joined.where(F.col(names["n"]) == 1)
    repeated = joined.where(F.col(names["n"]) > 1).dropDuplicates(
        [names["doc_id"], names["text_key"]])
    return _as_before(single, docs).unionByName(_as_before(repeated, docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: strings of 50 bytes that a document with a smaller id has are cut out. Where a
    cut parts a character's bytes, what is left of the character goes too."""
    small_batches(spark)
    found = substring_dedup(docs, with_text=True).where("n_removed > 0")
    changed = found.select("doc_id", "text_key", "kept").dropDuplicates(["doc_id", "text_key"])
    joined, names = _matched(docs, changed, "left")
    kept = F.col(names["kept"])
    columns = {"text": F.when(kept.isNotNull(), kept).otherwise(docs["text"])}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(kept.isNotNull(), F.length(kept)).otherwise(
            docs["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[columns.get(c, _column(docs, c)).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a window of a benchmark item go."""
    found = contamination(docs, sf_table(spark, sf_dir, "benchmark"))
    found = found.where("contaminated").select("doc_id", "text_key")
    return _as_before(_matched(docs, found, "left_anti")[0], docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sequences of at most 1024 tokens."""
    small_batches(spark)
    return pack(docs, TOKENIZER, END_ID)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("decontamination", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = sf_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
