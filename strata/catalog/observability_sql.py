"""DuckDB SQL twins of the request-log queries."""

from __future__ import annotations

# The histogram bounds in seconds.
BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)

REQUESTS = """
requests as (
  select ts, case when event_type = 'purchase' then 'POST' else 'GET' end as method,
    case when event_type in ('view', 'purchase') then '/api/v1/forecast'
      when event_type = 'click' then '/api/v1/wells'
      when event_type = 'signup' and user_id % 2 = 0 then '/healthz'
      when event_type = 'signup' then '/docs/signup'
      else '/api/v1/unknown' end as path,
    cast(case when event_type <> 'error' then 200 when user_id % 2 = 0 then 404 else 500 end as int)
      as status_code,
    value / 10 as duration_s
  from events),
log as (
  select * replace (case when path like '/docs%' then '/docs' else path end as path)
  from requests where path not in ('/metrics', '/healthz'))"""

_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S') as ts"
_START = "strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start"
_MEAN = "cast(sum(cast(duration_s as decimal(18,9))) as double) / count(*)"
_SUM = "cast(sum(cast(duration_s as decimal(18,9))) as double)"
_ERRORS = "count(*) filter (where status_code >= 400)"


def log(select: str, ctes: str = "") -> str:
    return f"with recursive {REQUESTS}{',' + ctes if ctes else ''}\n{select}"


def _bucket(ts: str = "ts", seconds: int = 900) -> str:
    return f"time_bucket(interval {seconds} seconds, {ts})"


_BOUND_ROWS = ", ".join(f"({b}, '{b}')" for b in BOUNDS) + ", ('inf'::double, '+Inf')"
_BUCKET_INDEX = (
    "case " + " ".join(f"when duration_s <= {b} then {i}" for i, b in enumerate(BOUNDS)) + " else 11 end"
)


def _histogram(keys: str, source: str = "log") -> str:
    return f"""
bounds(le, le_text) as (values {_BOUND_ROWS}),
hist as (
  select {keys}, le, le_text,
    count(*) filter (where duration_s <= le) as bucket_count, count(*) as total_count,
    {_SUM} as total_sum
  from {source} cross join bounds group by all)"""


def _quantile(q: float, keys: str) -> str:
    return f"""
cums as (
  select {keys}, le, sum(bucket_count) as cum from hist group by all),
ranked as (
  select *, cast({q} as double) * max(cast(cum as double)) over (partition by {keys}) as rank,
    coalesce(lag(cum) over (partition by {keys} order by le), 0) as cum_before,
    coalesce(lag(le) over (partition by {keys} order by le), 0) as low
  from cums),
quantiles as (
  select {keys}, case when le = 'inf'::double then low
    else low + (le - low) * ((rank - cum_before) / (cum - cum_before)) end as quantile_value
  from ranked where cum >= rank
  qualify row_number() over (partition by {keys} order by le) = 1)"""


_FORECAST_OK = (
    f"windowed as (select *, {_bucket()} as window_start from log "
    "where path = '/api/v1/forecast' and status_code = 200)"
)


def _sliding(measures: str, by: str = "") -> str:
    return f"""
slid as (
  select {_bucket('ts', 300)} - to_seconds(300 * step) as window_start, {by} status_code
  from log cross join (values (0), (1), (2)) as steps(step)),
counted as (select window_start, {by} {measures} from slid group by all)"""


_METRICS = f"""
metrics as (
  select {_bucket()} + interval 900 seconds as ts, count(*) as requests, {_MEAN} as avg_latency,
    {_ERRORS} / count(*) as error_rate
  from log group by {_bucket()})"""

_ALERTS = f"""{_METRICS},
ticks as (
  select unnest(generate_series(date_trunc('day', first), last, interval 300 seconds)) as ts,
    first, last
  from (select min(ts) as first, max(ts) as last from log)),
last_seen as (
  select ticks.ts, log.ts as seen
  from (select ts from ticks where ts between first and last) as ticks
  asof left join log on ticks.ts >= log.ts),
latency_alerts as (
  select ts, 'latency' as alert_type, 3 as severity, 'active' as status,
    'API latency exceeded 5.0s: ' || printf('%.2f', avg_latency) || 's' as message,
    'current_latency=' || format('{{:,.6f}}', avg_latency) || ';threshold=5.000000' as context,
    'latency:active' as key
  from metrics where avg_latency > 5.0),
error_rate_alerts as (
  select ts, 'error_rate' as alert_type, 2 as severity, 'active' as status,
    'Error rate exceeded 5.0%: ' || printf('%.2f', error_rate * 100) || '%' as message,
    'current_error_rate=' || format('{{:,.6f}}', error_rate) || ';threshold=0.050000' as context,
    'error_rate:active' as key
  from metrics where error_rate > 0.05),
service_down_alerts as (
  select ts, 'service_down' as alert_type, 4 as severity, 'active' as status,
    'Service appears to be down: no requests in last 600s' as message,
    'downtime_threshold_seconds=600.000000;requests_in_window=0.000000' as context,
    'service_down:active' as key
  from last_seen where seen is null or seen <= ts - interval 600 seconds),
alert_events as (
  select * from latency_alerts union all select * from error_rate_alerts
  union all select * from service_down_alerts)"""


def _picks(events: str, quiet: int) -> str:
    return f"""
picks(key, ts) as (
  select key, min(ts) from {events} group by key
  union all
  select picks.key, min(e.ts) from picks join {events} as e
    on e.key = picks.key and e.ts >= picks.ts + interval {quiet} seconds
  group by picks.key)"""


_CLOSED = f"""
hours as (
  select date_trunc('hour', ts) as window_start, count(*) as requests, {_ERRORS} as errors,
    {_MEAN} as avg_latency, {_ERRORS} / count(*) as error_rate
  from log group by all),
closed as (select * from hours)"""

_SAMPLES = """
hourly as (
  select event_type as series, date_trunc('hour', ts) as ts, count(*) as n from events group by all),
samples as (
  select series, ts, cast(sum(n) over (partition by series, cast(ts as date) order by ts
    rows unbounded preceding) as double) as value
  from hourly)"""

_STEPS = f"""{_SAMPLES},
steps as (
  select *, lag(value) over (partition by series order by ts) as previous,
    {_bucket('ts', 21600)} as window_start
  from samples),
increases as (
  select series, window_start, cast(sum(coalesce(case when value < previous then value
    else value - previous end, 0)) as double) as increase
  from steps group by all)"""

_EXTRAPOLATED = f"""{_SAMPLES},
paned as (select *, {_bucket('ts', 21600)} as window_start from samples),
steps as (
  select *, lag(value) over (partition by series, window_start order by ts) as previous from paned),
inside as (
  select series, window_start, count(*) as n, epoch(min(ts)) as first_at, epoch(max(ts)) as last_at,
    arg_min(value, ts) as first_value, epoch(window_start) as start_at,
    sum(coalesce(case when value < previous then value else value - previous end, 0)) as growth
  from steps group by all),
reach as (
  select *, last_at - first_at as sampled, (last_at - first_at) / (n - 1) as distance
  from inside where n > 1),
edges as (
  select *, case when first_at - start_at >= distance * 1.1 then distance / 2
      else first_at - start_at end as head,
    case when start_at + 21600 - last_at >= distance * 1.1 then distance / 2
      else start_at + 21600 - last_at end as tail
  from reach)"""

ORACLES = {
    "request_log": log(f"select * replace ({_TS}) from log"),
    "uninstrumented": log(
        f"select * replace ({_TS}) from requests where path not in ('/metrics', '/healthz')"
    ),
    "match_labels": log(
        f"select * replace ({_TS}) from log "
        "where status_code between 400 and 599 and path <> '/docs' and method = 'GET'"
    ),
    "request_counters": log(
        f"select method, path, status_code, count(*) as requests, {_ERRORS} as errors "
        "from log group by all"
    ),
    "request_counters_by_window": log(
        f"select method, path, status_code, {_START}, count(*) as requests, {_ERRORS} as errors "
        "from windowed group by all",
        f"windowed as (select *, {_bucket()} as window_start from log)",
    ),
    "order_labels": log(
        f"select method, path, status_code, count(*) as requests, {_ERRORS} as errors "
        "from log group by all"
    ),
    "latency_histogram": log(
        "select method, path, status_code, le_text as le, bucket_count, total_count, total_sum from hist",
        _histogram("method, path, status_code"),
    ),
    "running_bucket_sum": log(
        "select *, cast(sum(count) over (partition by method, path, status_code order by bucket "
        "rows unbounded preceding) as bigint) as cumulative from buckets",
        f"""buckets as (select method, path, status_code, cast({_BUCKET_INDEX} as int) as bucket,
  count(*) as count from log group by all)""",
    ),
    "avg_latency": log(f"select {_MEAN} as avg_latency from log"),
    "avg_latency_by_window": log(
        f"select {_START}, {_MEAN} as avg_latency from windowed group by window_start",
        f"windowed as (select *, {_bucket()} as window_start from log)",
    ),
    "error_rate": log(f"select {_ERRORS} / count(*) as error_rate from log"),
    "error_rate_by_window": log(
        f"select {_START}, {_ERRORS} / count(*) as error_rate from windowed group by window_start",
        f"windowed as (select *, {_bucket()} as window_start from log)",
    ),
    "requests_in_window": log(
        "select count(*) as requests from log "
        "where ts > (select max(ts) from log) - interval 6 hours"
    ),
    "histogram_quantile_p50": log(
        f"select {_START}, quantile_value * 1000 as millis from quantiles",
        _FORECAST_OK + "," + _histogram("window_start", "windowed") + "," + _quantile(0.5, "window_start"),
    ),
    "histogram_quantile_p95": log(
        f"select {_START}, quantile_value * 1000 as millis from quantiles",
        _FORECAST_OK + "," + _histogram("window_start", "windowed") + "," + _quantile(0.95, "window_start"),
    ),
    "histogram_quantile_by_path": log(
        "select * from quantiles", _histogram("path") + "," + _quantile(0.95, "path")
    ),
    "request_rate": log(
        f"select {_START}, requests / 900 as per_second, requests / 900 * 60 as per_minute from counted",
        _sliding("count(*) as requests"),
    ),
    "request_rate_by_path": log(
        f"select {_START}, path, requests / 900 as per_second, requests / 900 * 60 as per_minute "
        "from counted",
        _sliding("count(*) as requests", "path,"),
    ),
    "error_ratio": log(
        f"select {_START}, (errors / 900) / greatest(requests / 900, 0.0001::double) as error_ratio "
        "from counted",
        _sliding(f"count(*) as requests, {_ERRORS} as errors"),
    ),
    "error_ratio_by_class": log(
        f"select {_START}, client / greatest(requests, 1) as ratio_4xx, "
        "server / greatest(requests, 1) as ratio_5xx from counted",
        _sliding(
            "count(*) as requests, count(*) filter (where status_code between 400 and 499) as client, "
            "count(*) filter (where status_code between 500 and 599) as server"
        ),
    ),
    "prev_sample": f"with {_STEPS}\nselect series, {_TS}, value, previous from steps",
    "counter_increase": f"with {_STEPS}\nselect series, {_START}, increase from increases",
    "counter_rate": f"with {_STEPS}\nselect series, {_START}, increase / 21600 as increase from increases",
    "counter_increase_extrapolated": f"""with {_EXTRAPOLATED}
select series, {_START}, growth * (sampled + case when growth > 0
  then least(head, sampled * first_value / growth) else head end + tail) / sampled as increase
from edges
union all select series, {_START}, null from inside where n = 1""",
    "latest_gauge": f"with {_SAMPLES}\nselect series, arg_max(value, ts) as value from samples group by series",
    "window_metrics": log(f"select * replace ({_TS}) from metrics", _METRICS),
    "latency_alerts": log(f"select * replace ({_TS}) from latency_alerts", _ALERTS),
    "error_rate_alerts": log(f"select * replace ({_TS}) from error_rate_alerts", _ALERTS),
    "metric_alerts": log(
        f"select * replace ({_TS}) from latency_alerts union all "
        f"select * replace ({_TS}) from error_rate_alerts",
        _ALERTS,
    ),
    "service_down_alerts": log(f"select * replace ({_TS}) from service_down_alerts", _ALERTS),
    "alert_events": log(f"select * replace ({_TS}) from alert_events", _ALERTS),
    "dedup_alerts": log(
        f"select alert_events.* replace (strftime(alert_events.ts, '%Y-%m-%d %H:%M:%S') as ts) "
        "from alert_events join picks using (key, ts)",
        _ALERTS + "," + _picks("alert_events", 3600),
    ),
    "render_alert": log(
        f"""select {_TS}, key, '{{"text":"Alert: Service Down - ' || message ||
  '","blocks":[{{"type":"header","text":{{"type":"plain_text","text":"🔴❗ Alert: Service Down"}}}},' ||
  '{{"type":"section","text":{{"type":"mrkdwn","text":"*Status:* active\\n*Message:* ' || message || '"}}}},' ||
  '{{"type":"section","text":{{"type":"mrkdwn","text":"*Context:*\\n• *downtime_threshold_seconds:* 600' ||
  '\\n• *requests_in_window:* 0"}}}}]}}' as payload from service_down_alerts""",
        _ALERTS,
    ),
    "service_down_stream": log(
        "select path || ':service_down:active' as key, 4 as severity, "
        "'Service appears to be down: no requests in last 2s' as message from log group by path"
    ),
    "read_request_log": log(f"select * replace ({_TS}) from log"),
    "request_metrics_stream_sliding": log(
        f"""select strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as requests,
  {_ERRORS} as errors, {_MEAN} as avg_latency, {_ERRORS} / count(*) as error_rate
from (select *, time_bucket(interval 900 seconds, ts) - to_seconds(k * 900) as window_start
  from log, range(4) as shifts(k))
group by window_start"""
    ),
    "late_requests": log(
        """select strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start, method, path,
  count(*) as requests, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as newest
from (select *, date_trunc('hour', ts) as window_start from log where method = 'GET')
where window_start + interval 1 hour
  <= (select max(ts) from log where method = 'POST') - interval 10 minutes
group by window_start, method, path"""
    ),
    "request_metrics_stream": log(f"select * replace ({_START}) from closed", _CLOSED),
    "dedup_alerts_stream": log(
        "select strftime(ts - interval 1 microsecond, '%Y-%m-%d %H:%M:%S') as ts, key, severity, message "
        "from closed_alerts join picks using (key, ts)",
        _CLOSED
        + f""",
closed_alerts as (
  select window_start + interval 1 hour as ts, 'latency:active' as key, 3 as severity,
    'API latency exceeded 5.0s: ' || printf('%.2f', avg_latency) || 's' as message
  from closed where avg_latency > 5.0
  union all
  select window_start + interval 1 hour, 'error_rate:active', 2,
    'Error rate exceeded 5.0%: ' || printf('%.2f', error_rate * 100) || '%'
  from closed where error_rate > 0.05),"""
        + _picks("closed_alerts", 14400),
    ),
}
