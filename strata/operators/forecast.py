"""Decline forecast per well and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import two_decimals
from strata.operators.joins import reject_unknown

# Fixed value: barrels per day a well loses every day.
DECLINE_PER_DAY = 7.5


def decline_forecast(
    wells: DataFrame, requests: DataFrame, decline: float = DECLINE_PER_DAY
) -> DataFrame:
    """One row per accepted request and day, both ends included.

    ``wells`` holds ``id_well`` and ``base_rate``, ``requests`` holds ``id_well``,
    ``date_start`` and ``date_end``; further request columns are kept.
    """
    accepted = requests.filter(F.col("date_end") >= F.col("date_start")).join(
        wells.select("id_well", "base_rate"), "id_well"
    )
    days = F.sequence("date_start", "date_end")
    kept = [name for name in requests.columns if name not in ("date_start", "date_end")]
    daily = accepted.select(*kept, "base_rate", F.posexplode(days).alias("day", "date"))
    rate = F.greatest(F.col("base_rate") - F.lit(float(decline)) * F.col("day"), F.lit(0.0))
    return daily.select(*kept, "date", two_decimals(rate).cast("double").alias("oil_bopd"))


def forecast_rejects(requests: DataFrame, wells: DataFrame) -> DataFrame:
    return reject_unknown(requests, wells)[1]


def wells_for_date(dim_pozo: DataFrame, day: str | date | Column) -> DataFrame:
    """Wells whose validity covers the day."""
    moment = day if isinstance(day, Column) else F.lit(day).cast("date")
    valid = (F.to_date("valid_from") <= moment) & (
        F.col("valid_to").isNull() | (F.to_date("valid_to") > moment)
    )
    return dim_pozo.filter(valid).select("id_pozo", "sigla")
