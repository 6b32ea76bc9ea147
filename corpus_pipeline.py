"""A corpus pipeline: each stage applies one operator to what the stage before it kept.

The stages reject documents of low quality, drop repeated lines, keep one document of each
group of near duplicates, mix the sources to their target weights, and encode the texts.
All but the last return the columns of documents.

Cases: each stage has the rules of its operator for nulls, empty texts, ties and repeated
rows. Extra columns of documents are carried to the last stage. A table that is empty, or that
a stage empties, gives empty results from there on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.bpe import decode, encode, load_vocabulary
from strata.llm.cotraining import score_documents
from strata.llm.line_dedup import dedup_lines
from strata.llm.mixing import repeat_rows
from strata.llm.ngram_join import join_near
from strata.session import staged

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_documents(docs, labels).filter("accepted").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows the text.

    A document that loses all of its lines stays, with an empty text.
    """
    shortened = dedup_lines(docs, lines_column="_lines", dropped_column="_dropped")
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return shortened.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links connect.

    Rows are documents: one that repeats an id with another text has its own group. Such rows,
    and those without an id, are given a number that follows their text and is larger than any
    real one, so they come last in a group. Of rows equal in id and text one stays.
    """
    named = with_row_names(docs)
    classes, _ = join_near(named, id_column="_name")
    flags = classes.groupBy(F.col("_name").alias("_flagged")).agg(
        F.max(F.col("_name") != F.col("class_id")).alias("_gone"), F.count(F.lit(1)).alias("_rows")
    ).filter("_gone or _rows > 1")
    marked = named.join(flags, F.col("_name") == F.col("_flagged"), "left").filter(
        ~F.coalesce("_gone", F.lit(False))
    )
    first = F.row_number().over(Window.partitionBy("_name").orderBy("text"))
    repeated = marked.filter("_rows > 1").withColumn("_n", first).filter("_n = 1")
    return marked.filter("_rows is null").select(*docs.columns).union(
        repeated.select(*docs.columns)
    )


def with_row_names(docs: DataFrame) -> DataFrame:
    """Adds ``_name``: the id, or a number made from id and text where it names several rows."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_of")).filter("_of is not null")
    shared = ids.groupBy("_of").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    shared = staged(docs.sparkSession, shared, "shared-ids")
    name = F.col("doc_id").cast("long")
    made = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    if shared.isEmpty():
        return docs.withColumn("_name", F.coalesce(name, made))
    named = docs.join(shared, name == F.col("_of"), "left")
    own = F.col("doc_id").isNotNull() & F.col("_rows").isNull()
    named = named.withColumn("_name", F.when(own, name).otherwise(made)).drop("_of", "_rows")
    return staged(docs.sparkSession, named, "row-names")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return repeat_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (packed), and digests of the ids and what they decode to.

    The ids are written before they are decoded, so that a task needs one Python worker, not two:
    executors keep workers, and what these hold, for later tasks.
    """
    vocabulary = load_vocabulary(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    encoded = staged(spark, encode(docs.select("doc_id", "source", "text"), vocabulary), "encoded")
    return decode(encoded, vocabulary).select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("mixing", mix),
    ("encoding", tokens),
]
# The classifier and the Bayesian join cannot be expressed in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(spark, docs, "pipeline")
    return docs
