"""Threshold alerts, time-window deduplication and payloads (M2-M8)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import title_words, two_decimals
from strata.operators.aggregates import union_all
from strata.operators.metrics import duration_sum, is_error, pane_start
from strata.session import staged

# Severity numbers and their symbols, evaluation and quiet periods.
SEVERITIES = {"low": 1, "medium": 2, "high": 3, "critical": 4}
EMOJI = {1: "🟢", 2: "🟡", 3: "🔴", 4: "🔴❗"}
DEFAULT_EMOJI = "⚠️"
TICK_SECONDS = 30
DEDUP_SECONDS = 300

ALERT_SCHEMA = (
    "ts timestamp, alert_type string, severity int, status string, message string, "
    "context map<string,double>, key string"
)
# Deduplication composes this many stretches of a key at a time.
FAN_OUT = 64
# Blocked until before any time.
_NEVER = -(1 << 63)


class Limits(NamedTuple):
    """Beyond these the detectors speak up. The defaults.

    ``slow``: mean seconds per request; ``failing``: share of requests that end in an
    error; ``silent``: whole seconds without any request.
    """

    slow: float = 5.0
    failing: float = 0.05
    silent: int = 30

    def checked(self) -> Limits:
        """These limits, unless one of them could never or would always be passed."""
        usable = self.slow > 0 and 0 <= self.failing <= 1 and self.silent >= 1
        if not usable:
            raise ValueError(f"limits out of range: {self}")
        return self


def window_metrics(log: DataFrame, window: int = TICK_SECONDS) -> DataFrame:
    """Requests, mean latency and error rate per window; ``ts`` is the window's end."""
    requests = F.count(F.lit(1))
    summed = log.groupBy(pane_start("ts", window).alias("start")).agg(
        requests.alias("requests"),
        (duration_sum() / requests).alias("avg_latency"),
        (F.count_if(is_error()) / requests).alias("error_rate"),
    )
    end = F.timestamp_seconds(F.unix_seconds("start") + window)
    return summed.select(end.alias("ts"), "requests", "avg_latency", "error_rate")


def latency_alerts(metrics: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """HIGH where the mean latency is above the threshold; no data, no alert."""
    condition, columns = _latency_rule(limits)
    return metrics.filter(condition).select("ts", *columns)


def error_rate_alerts(metrics: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """MEDIUM where the error rate is above the threshold; no data, no alert."""
    condition, columns = _error_rate_rule(limits)
    return metrics.filter(condition).select("ts", *columns)


def metric_alerts(metrics: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Latency and error-rate alerts together, reading the metrics once."""
    found = [
        F.when(condition, F.struct(*columns))
        for condition, columns in (_latency_rule(limits), _error_rate_rule(limits))
    ]
    alerts = F.explode(F.filter(F.array(*found), lambda alert: alert.isNotNull()))
    return metrics.select("ts", alerts.alias("alert")).select("ts", "alert.*")


# The wording of the messages.
def _latency_rule(limits: Limits) -> tuple[Column, list[Column]]:
    limit, value = float(limits.checked().slow), F.col("avg_latency")
    return value > limit, _alert_columns(
        "latency",
        "high",
        F.concat(F.lit(f"API latency exceeded {limit}s: "), two_decimals(value), F.lit("s")),
        {"current_latency": value, "threshold": F.lit(limit)},
    )


def _error_rate_rule(limits: Limits) -> tuple[Column, list[Column]]:
    limit, value = float(limits.checked().failing), F.col("error_rate")
    return value > limit, _alert_columns(
        "error_rate",
        "medium",
        F.concat(
            F.lit(f"Error rate exceeded {limit * 100:.1f}%: "), two_decimals(value * 100), F.lit("%")
        ),
        {"current_error_rate": value, "threshold": F.lit(limit)},
    )


def tick_grid(log: DataFrame, seconds: int = TICK_SECONDS) -> DataFrame:
    """Evaluation times, multiples of ``seconds``, from the first to the last request.

    Only the two times come to the driver; the ticks are a distributed range.
    """
    seen = log.agg(
        F.unix_micros(F.min("ts")).alias("first"), F.unix_micros(F.max("ts")).alias("last")
    ).first()
    spark = log.sparkSession
    if seen["first"] is None:
        numbers = spark.range(0)
    else:
        step = seconds * 1_000_000
        numbers = spark.range(-(-seen["first"] // step), seen["last"] // step + 1)
    return numbers.select(F.timestamp_seconds(F.col("id") * seconds).alias("ts"))


def service_down_alerts(
    log: DataFrame,
    ticks: DataFrame,
    limits: Limits = Limits(),
    by: Sequence[str] = (),
) -> DataFrame:
    """CRITICAL for every tick without a request in the seconds up to it.

    The seconds before a tick lie in the tick's own cell of that length and the one
    before. They hold a request exactly if the own cell's first request is not after
    the tick or the other cell's last one is recent enough, so two numbers per cell
    answer all ticks by equality joins.
    """
    silence = limits.checked().silent
    span = silence * 1_000_000

    def cell(ts: Column) -> Column:
        micros = F.unix_micros(ts)
        return (micros - F.pmod(micros, F.lit(span))) / F.lit(span)

    cells = log.groupBy(*by, cell(F.col("ts")).cast("long").alias("cell")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    own = cells.select(*by, "cell", F.col("first").alias("own_first"))
    before = cells.select(*by, (F.col("cell") + 1).alias("cell"), F.col("last").alias("last_before"))
    keys = [*by, "cell"]
    seen = (
        ticks.withColumn("cell", cell(F.col("ts")).cast("long"))
        .join(own, keys, "left")
        .join(before, keys, "left")
    )
    recent = F.unix_micros("last_before") > F.unix_micros("ts") - F.lit(span)
    silent = seen.filter(
        ~F.coalesce(F.col("own_first") <= F.col("ts"), F.lit(False))
        & ~F.coalesce(recent, F.lit(False))
    )
    return silent.select("ts", *by, *service_down_columns(silence, by))


def service_down_columns(silence: int, by: Sequence[str] = ()) -> list[Column]:
    context = {
        "downtime_threshold_seconds": F.lit(float(silence)),
        "requests_in_window": F.lit(0.0),
    }
    message = F.lit(f"Service appears to be down: no requests in last {silence}s")
    return _alert_columns("service_down", "critical", message, context, by)


def alert_events(*alerts: DataFrame) -> DataFrame:
    return union_all(*alerts)


def _alert_columns(
    alert_type: str,
    severity: str,
    message: Column,
    context: dict[str, Column],
    by: Sequence[str] = (),
    status: str = "active",
) -> list[Column]:
    entries = [part for name, value in context.items() for part in (F.lit(name), value)]
    key_parts = [*[F.col(name).cast("string") for name in by], F.lit(alert_type), F.lit(status)]
    return [
        F.lit(alert_type).alias("alert_type"),
        F.lit(SEVERITIES[severity]).alias("severity"),
        F.lit(status).alias("status"),
        message.alias("message"),
        F.create_map(*entries).alias("context"),
        F.concat_ws(":", *key_parts).alias("key"),
    ]


def dedup_alerts(alerts: DataFrame, seconds: int = DEDUP_SECONDS) -> DataFrame:
    """Alerts to notify: the first of a key, then each at least ``seconds`` after the
    last notified one. Suppressed alerts do not extend the quiet period.

    The choice runs in time order within a key, yet no task walks a key. Time is cut into
    slots of one quiet period, in which at most one alert is chosen. A slot is a function from
    "blocked until", as the slots before leave it, to what it leaves to the next; the functions
    of ``FAN_OUT`` neighbours compose to that of a longer stretch, and so on up to one stretch
    per key. On the way back each stretch tells its parts how long they are blocked on entry, and
    each slot chooses. A row holds the alert times of one key and slot, or the functions of
    ``FAN_OUT`` stretches, which have few distinct outcomes. Of alerts with equal key and time
    the one with the smallest message is kept. The alerts are read several times; stage them
    where they are dear to compute.
    """
    quiet = seconds * 1_000_000
    single = (
        alerts.withColumn("_t", F.unix_micros("ts"))
        .groupBy("key", "_t")
        .agg(F.min_by(F.struct(*[c for c in alerts.columns if c != "key"]), "message").alias("_a"))
    )
    slot = ((F.col("_t") - F.pmod("_t", F.lit(quiet))) / F.lit(quiet)).cast("long")
    slots = staged(alerts.sparkSession, single.groupBy("key", slot.alias("part")).agg(
        F.array_sort(F.collect_set("_t")).alias("times")
    ), "quiet-slots")
    first, last = slots.agg(F.min("part"), F.max("part")).first()
    if first is None:
        return alerts
    level = slots.select("key", (F.col("part") - first).alias("part"), F.transform(
        "times", lambda t: F.struct(t.alias("t"), (t + quiet).alias("o"))
    ).alias("f"))
    stretches, width = [], 1
    while width <= last - first:
        width *= FAN_OUT
        start = (F.lit(first) + F.col("node") * F.lit(width)) * F.lit(quiet)
        grouped = level.groupBy("key", F.expr(f"part div {FAN_OUT}").alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("part", "f"))).alias("parts")
        )
        stretches.append(staged(alerts.sparkSession, grouped, "stretches"))
        level = stretches[-1].select("key", F.col("node").alias("part"), F.aggregate(
            "parts", _no_alerts(), lambda f, part: _composed(f, part["f"], start + quiet)
        ).alias("f"))
    entries = level.select("key", "part", F.lit(_NEVER).alias("blocked"))
    for held in reversed(stretches):
        inside = held.join(entries.withColumnRenamed("part", "node"), ["key", "node"]).select(
            "key", F.inline(_entries(F.col("parts"), F.col("blocked")))
        )
        entries = staged(alerts.sparkSession, inside, "entries")
    chosen = F.get(F.filter("times", lambda t: t >= F.col("blocked")), F.lit(0))
    picks = slots.withColumn("part", F.col("part") - first).join(entries, ["key", "part"]).select(
        "key", chosen.alias("_t")
    ).filter("_t is not null")
    notified = single.join(picks, ["key", "_t"], "left_semi")
    return notified.select("key", "_a.*").select(*alerts.columns)


def _no_alerts() -> Column:
    return F.array().cast("array<struct<t:bigint,o:bigint>>")


def _leaves(f: Column, blocked: Column) -> Column:
    """How long the next part is blocked after a stretch ``f`` that was blocked on entry.

    ``f`` lists first choices and what they lead to; the first one not blocked counts, and
    without any the stretch changes nothing.
    """
    return F.coalesce(F.get(F.filter(f, lambda x: x["t"] >= blocked), F.lit(0))["o"], blocked)


def _composed(f: Column, after: Column, open_by: Column) -> Column:
    """The stretch ``f`` and the one after it as one; every entry is over by ``open_by``.

    Of neighbouring first choices that lead to the same end the latest stands for all.
    """
    moved = F.transform(f, lambda x: F.struct(x["t"].alias("t"), _leaves(after, x["o"]).alias("o")))
    kept = F.filter(
        moved, lambda x, i: F.coalesce(F.get(moved, i + 1)["o"] != x["o"], F.lit(True))
    )
    covered = F.element_at(kept, -1)["t"] >= open_by
    later = F.when(covered, _no_alerts()).otherwise(F.slice(after, 1, 1))
    return F.when(F.size(f) == 0, after).otherwise(F.concat(kept, later))


def _entries(parts: Column, blocked: Column) -> Column:
    """Each part of a stretch with how long it is blocked on entry."""
    empty = F.array().cast("array<struct<part:bigint,blocked:bigint>>")
    start = F.struct(blocked.alias("blocked"), empty.alias("entries"))
    return F.aggregate(
        parts, start,
        lambda state, part: F.struct(
            _leaves(part["f"], state["blocked"]).alias("blocked"),
            F.concat(state["entries"], F.array(F.struct(
                part["part"].alias("part"), state["blocked"].alias("blocked")
            ))).alias("entries"),
        ),
        lambda state: state["entries"],
    )


def render_alert(alerts: DataFrame) -> DataFrame:
    """Add the channel payload as JSON: header, status and message, context if any."""
    emoji = F.lit(DEFAULT_EMOJI)
    for severity, symbol in EMOJI.items():
        emoji = F.when(F.col("severity") == severity, symbol).otherwise(emoji)
    title = title_words(F.col("alert_type"))
    whole_numbers = F.col("alert_type") == "service_down"
    lines = F.transform(
        F.map_entries("context"),
        lambda e: F.concat(
            F.lit("• *"), e["key"], F.lit(":* "),
            F.when(whole_numbers, e["value"].cast("long").cast("string")).otherwise(
                e["value"].cast("string")
            ),
        ),
    )
    header = _block("header", "plain_text", F.concat(emoji, F.lit(" Alert: "), title))
    body = _block(
        "section", "mrkdwn",
        F.concat(F.lit("*Status:* "), "status", F.lit("\n*Message:* "), "message"),
    )
    details = _block("section", "mrkdwn", F.concat(F.lit("*Context:*\n"), F.array_join(lines, "\n")))
    has_context = F.coalesce(F.size("context") > 0, F.lit(False))
    blocks = F.when(has_context, F.array(header, body, details)).otherwise(F.array(header, body))
    text = F.concat(F.lit("Alert: "), title, F.lit(" - "), "message")
    return alerts.withColumn("payload", F.to_json(F.struct(text.alias("text"), blocks.alias("blocks"))))


def _block(kind: str, text_kind: str, text: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("type"),
        F.struct(F.lit(text_kind).alias("type"), text.alias("text")).alias("text"),
    )
