"""Mixing sources to target weights by hash thresholds.

Each row gets a 60-bit hash of its id and text, and its size, the number of its words. A
source whose target is ``k`` times its size and a rest takes every row ``k`` times, and once
more the rows below a hash threshold whose sizes sum up to the rest. The threshold is found by
histograms: sizes are summed by source and leading hash bits, the bucket in which the rest is
reached is refined by the next bits, and so on down to a single hash value. No row is sorted.
The value on the boundary is taken if that brings the sum nearer to the target.

Cases: null text has size 0; a null source is a source like others, after all of them; equal
rows (same id and text) have one hash and are taken or left together; rows of size 0 take no
words. A source of size 0 has target 0. Columns beside the named ones are kept by
``repeat_rows`` and ignored by ``mixed_sizes``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.text import word_count
from strata.session import staged

# Bits of the hash that each histogram looks at, from the left.
HASH_BITS = 60
LEVELS = (12, 12, 18, 18)


def row_hash(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """Leading 60 bits of an MD5, as a number that is never negative."""
    def or_empty(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    digest = F.md5(F.concat(or_empty(id_column), F.lit(":"), or_empty(text_column)))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def cycled_weights(sources: DataFrame, cycle: tuple[float, ...]) -> DataFrame:
    """Weights for the sources by code point, null last, repeating the cycle.

    ``sources`` has one row per source, already summed.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), F.pmod(rank - 1, F.lit(len(cycle))) + 1)
    return sources.withColumn("weight", weight)


def targets(sources: DataFrame, max_repeats: float = 3.0) -> DataFrame:
    """Add ``target``: the weighted share of all sizes, at most ``max_repeats`` sizes.

    Sources are ordered by the level at which they reach their limit. The excess of the first
    k is reshared among the others; the right k is the first after which the next source
    stays below its limit. ``sources``: source, source_size, weight; one row per source.
    """
    order = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    share = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = sources.withColumn(
        "_limit", F.col("source_size") * F.lit(float(max_repeats))
    ).withColumn("_level", rest / share)
    # The first source that stays open carries the final level.
    is_open = F.col("_limit") >= F.col("_level") * F.col("weight")
    final = F.first(F.when(is_open, F.col("_level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("_limit"), F.coalesce(final, F.lit(0.0)) * F.col("weight"))
    return levelled.withColumn("target", target).drop("_limit", "_level")


def thresholds(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source ``whole`` copies of every row and a hash ``cut``: rows below it go once more.

    ``sizes``: source, size, row_hash (read once per level, so stage it); ``sources``: source,
    source_size, target.
    """
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    state = sources.withColumn("whole", whole).select(
        "*", (F.col("target") - F.col("whole") * size).alias("rest"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("unit"),
    )
    shift = HASH_BITS
    for bits in LEVELS:
        state = _refined(sizes, state, shift, bits)
        shift -= bits
    over, under = F.col("below") + F.col("unit") - F.col("rest"), F.col("rest") - F.col("below")
    cut = F.col("prefix") + F.when(over < under, F.lit(1)).otherwise(F.lit(0))
    return state.select("source", "source_size", "target", "whole", cut.alias("cut"))


def _refined(sizes: DataFrame, state: DataFrame, shift: int, bits: int) -> DataFrame:
    """Append the next bits of the bucket in which each source's rest is reached.

    ``below`` is the sum of all buckets before it, ``unit`` its own sum. The histogram has at
    most 2^bits rows per source; rows outside of the boundary bucket are not read into it.
    """
    bounds = state.select(F.col("source").alias("_s"), "prefix")
    mine = F.shiftright("row_hash", shift) == F.col("prefix")
    inside = sizes.join(bounds, F.col("source").eqNullSafe(F.col("_s")) & mine, "left_semi")
    bucket = F.shiftright("row_hash", shift - bits)
    histogram = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("sum"))
    upto = F.sum("sum").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    cumulated = histogram.withColumn("upto", upto).withColumnRenamed("source", "_s")
    joined = state.drop("prefix", "unit").join(
        cumulated, F.col("source").eqNullSafe(F.col("_s")), "left"
    )
    reached = (F.col("below") + F.col("upto")) > F.col("rest")
    keys = ["source", "source_size", "target", "whole", "rest", "below"]
    # No bucket may reach the rest only where a source has no words at all.
    found = joined.groupBy(*keys).agg(
        F.min_by(F.struct("bucket", "upto", "sum"), F.when(reached, F.col("bucket"))).alias("_b")
    )
    return found.select(
        *[k for k in keys if k != "below"],
        F.coalesce("_b.bucket", F.lit(0).cast("long")).alias("prefix"),
        (F.col("below") + F.coalesce(F.col("_b.upto") - F.col("_b.sum"), F.lit(0))).alias("below"),
        F.coalesce("_b.sum", F.lit(0).cast("long")).alias("unit"),
    )


def plan_mix(
    docs: DataFrame,
    cycle: tuple[float, ...] = (5, 2, 1),
    max_repeats: float = 3.0,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """Staged sizes of all rows (id, source, size, row_hash) and the plan of each source."""
    sizes = staged(docs.sparkSession, docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        word_count(F.col(text_column)).alias("size"),
        row_hash(id_column, text_column).alias("row_hash"),
    ), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(sizes, targets(cycled_weights(sources, cycle), max_repeats))
    return sizes, staged(docs.sparkSession, plan, "mix-plan")


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken (words, repeats counted)."""
    sizes, plan = plan_mix(docs, **options)
    joined = _with_plan(sizes, plan, F.col("source"))
    taken = F.col("size") * _repeats(F.col("row_hash"))
    return joined.select("id", "size", "source_size", "target", taken.alias("taken"))


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    _, plan = plan_mix(docs, **options)
    id_column = options.get("id_column", "doc_id")
    text_column = options.get("text_column", "text")
    source_column = options.get("source_column", "source")
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at = {name: f"_c{i}" for i, name in enumerate(names)}
    hashed = plain.withColumn("row_hash", row_hash(at[id_column], at[text_column]))
    joined = _with_plan(hashed, plan, F.col(at[source_column]))
    copies = F.array_repeat(F.lit(0), _repeats(F.col("row_hash")).cast("int"))
    repeated = joined.withColumn("_copy", F.explode(copies))
    return repeated.select(*[F.col(f"_c{i}").alias(name) for i, name in enumerate(names)])


def _with_plan(rows: DataFrame, plan: DataFrame, source: Column) -> DataFrame:
    # One row per source: Spark broadcasts it while it is below its own size threshold.
    return rows.join(plan.withColumnRenamed("source", "_s"), source.eqNullSafe(F.col("_s")))


def _repeats(hashed: Column) -> Column:
    return F.col("whole") + F.when(hashed < F.col("cut"), F.lit(1)).otherwise(F.lit(0))
