"""Latest row per key, global rank, running and previous values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import SHUFFLE_KEY

# Column of ``deal``.
SHARE = "_share"


def deal(
    df: DataFrame, partition: str, keys: Sequence[str], partitions: int, tasks: int
) -> DataFrame:
    """Rows dealt by a partition column and, in ``_share``, a share of the other keys.

    Rows of equal partition and keys meet, so what groups by ``partition``, ``_share`` and the
    keys needs no further shuffle, nor does a table that is written by partition: a task holds
    few partitions. ``partitions`` of them are expected and divided so that there are ``tasks``
    shares in all; other numbers give the same rows.
    """
    shares = -(-tasks // max(1, partitions))
    share = F.pmod(F.xxhash64(*keys), F.lit(shares)) if keys else F.lit(0).cast("long")
    held = int(df.sparkSession.conf.get(SHUFFLE_KEY))
    dealt = df.withColumn(SHARE, share)
    return dealt.repartition(max(held, shares * partitions), partition, SHARE)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row of every key; equal times are settled by ``ties``, smallest first.

    Each task keeps one row per key before the shuffle, so a key with very many versions
    costs one row per task. Among the forms measured (a ranked row, a least struct, a
    newest time joined back) this was the fastest where most keys have few versions, as
    in the monthly tables. A null time counts as newer than any other.
    """
    by = [F.col(order).desc_nulls_first(), *[F.col(name).asc_nulls_first() for name in ties]]
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_place", place).filter("_place = 1").select(*df.columns)


def rank_total(totals: DataFrame, name: str, measure: str, n: int) -> DataFrame:
    """The ``n`` largest members with their rank; null totals first, ties by name.

    The sort keeps ``n`` rows per task, so the final ranking sees ``n`` rows in all.
    """
    order = [F.col(measure).desc_nulls_first(), F.col(name).asc_nulls_first()]
    top = totals.orderBy(*order).limit(n)
    return top.withColumn("rn", F.row_number().over(W.orderBy(*order)))


def running_bucket_sum(
    buckets: DataFrame, labels: Sequence[str], index: str, count: str = "count"
) -> DataFrame:
    """Cumulative counts over the few buckets of each label set."""
    upto = W.partitionBy(*labels).orderBy(index).rowsBetween(W.unboundedPreceding, 0)
    return buckets.withColumn("cumulative", F.sum(count).over(upto))


def prev_sample(series: Sequence[str], ts: str = "ts", value: str = "value") -> Column:
    """Previous sample of the same series.

    A series is sorted by one task; for long ones use ``with_previous``.
    """
    return F.lag(value).over(W.partitionBy(*series).orderBy(ts))


def with_previous(
    samples: DataFrame, series: Sequence[str], seconds: int, ts: str = "ts", value: str = "value",
    alias: str = "previous",
) -> DataFrame:
    """``samples`` with the previous value of the same series, sorted by series and time pane.

    The first sample of a pane takes the last one of the pane before, of which there is one row
    per pane; so a task sorts the samples of a pane, or a row per pane of a series.
    """
    at = F.unix_seconds(ts)
    panes = samples.withColumn("_pane", at - F.pmod(at, F.lit(seconds)))
    keys = [*series, "_pane"]
    order = W.partitionBy(*keys).orderBy(ts)
    inside = panes.withColumn("_place", F.row_number().over(order)).withColumn(
        "_inside", F.lag(value).over(order)
    )
    ends = panes.groupBy(*keys).agg(F.max_by(value, ts).alias("_end"))
    before = ends.withColumn("_before", F.lag("_end").over(W.partitionBy(*series).orderBy("_pane")))
    previous = F.when(F.col("_place") == 1, F.col("_before")).otherwise(F.col("_inside"))
    return inside.join(before.select(*keys, "_before"), keys).select(
        *samples.columns, previous.alias(alias)
    )
