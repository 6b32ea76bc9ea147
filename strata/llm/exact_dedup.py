"""Exact dedup by content-defined chunk recipes.

A text is cut into chunks where its own content says so: at the first line or sentence end
after a least length, at a greatest length where there is none. A chunk's identifier is a
64-bit hash, verified: all chunks are grouped by hash and content, each task sends a chunk
once, and a hash that stands for two contents is found. A text's recipe is the ordered list of
its chunks' identifiers; texts with equal recipes are equal. A recipe that holds an identifier
that is not unique is told apart by the whole text as well. Whole texts are moved only in that
case; grouping compares recipes.

Cases: null text counts as empty; an empty text has an empty recipe, so all empty texts are
equal. Of equal texts the row with the largest id stays; rows that repeat that id and text are
all marked as kept; a null id is smaller than any other. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import staged

# Characters of a chunk, at least and at most.
LEAST, MOST = 512, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text cut after line or sentence ends, as an array; chunks join to the text."""
    pattern = f"(?s).{{{least},{most - 1}}}?[.\\n]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column, bits: int = 64) -> Column:
    """Hash of a chunk; fewer bits serve tests of the verification."""
    hashed = F.xxhash64(chunk)
    return hashed if bits == 64 else F.shiftrightunsigned(hashed, 64 - bits)


def ambiguous(texts: DataFrame, bits: int = 64) -> DataFrame:
    """Identifiers that stand for more than one content."""
    each = texts.select(F.explode(chunks(F.col("_text"))).alias("chunk"))
    dictionary = each.groupBy(identifier(F.col("chunk"), bits).alias("id"), "chunk").agg(
        F.lit(1).alias("one")
    )
    return dictionary.groupBy("id").agg(F.count(F.lit(1)).alias("contents")).filter(
        "contents > 1"
    ).select("id")


def group_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = 64
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
    )
    recipe = F.transform(chunks(F.col("_text")), lambda chunk: identifier(chunk, bits))
    rows = texts.select(
        "_id", "_text", recipe.alias("_recipe"), F.sha2("_text", 256).alias("_sha")
    )
    doubtful = staged(spark, ambiguous(texts, bits), "ambiguous-chunks")
    if doubtful.isEmpty():
        rows = rows.withColumn("_content", F.lit(None).cast("string"))
    else:
        rows = _told_apart(rows, doubtful)
    rows = rows.select("_id", "_sha", "_recipe", "_content")
    groups = rows.groupBy(F.col("_recipe").alias("_r"), F.col("_content").alias("_c")).agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    ).filter("_size > 1")
    # Staged, so that the rows of one very large group can be split in the join.
    groups = staged(spark, groups, "copy-groups")
    same = (F.col("_recipe") == F.col("_r")) & F.col("_content").eqNullSafe(F.col("_c"))
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return rows.join(groups, same, "left").select(
        F.col("_id").alias(id_column), keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def _told_apart(rows: DataFrame, doubtful: DataFrame) -> DataFrame:
    """Add the whole text to rows whose recipe holds a doubtful identifier."""
    recipes = rows.select("_recipe").distinct()
    held = recipes.select("_recipe", F.explode("_recipe").alias("id"))
    affected = held.join(doubtful, "id", "left_semi").select(F.col("_recipe").alias("_a")).distinct()
    marked = rows.join(affected, F.col("_recipe") == F.col("_a"), "left")
    return marked.withColumn("_content", F.when(F.col("_a").isNotNull(), F.col("_text"))).drop("_a")
