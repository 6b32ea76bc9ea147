"""DuckDB SQL twins of the queries for sources, operators, tests and runs."""

from __future__ import annotations

from strata.catalog.medallion_sql import (
    BRONZE,
    GOLD,
    NO_NEGATIVE,
    PRODUCTION_CELLS,
    SILVER,
    TYPED_COLUMNS,
    _key,
    _row_hash,
    typed_columns,
    with_bronze,
    with_gold,
    with_silver,
)
from strata.catalog.medallion_sql import ORACLES as MEDALLION

_MONTH = "cast(periodo as varchar) as periodo"
_LOADED = "strftime(_loaded_at, '%Y-%m-%d %H:%M:%S') as _loaded_at"
_VOLUMES = ", ".join(
    f"cast({c} as double) as {c}" for c in ("prod_gas", "prod_petroleo", "prod_agua")
)
_REPLACED = f"{_MONTH}, {_LOADED}, {_VOLUMES}"
_TYPED = f"select * replace ({_REPLACED}) from typed"
_NEWEST = "row_number() over (partition by id_pozo, periodo order by _loaded_at desc, _row_hash)"


def _text_row_hash(columns: tuple[str, ...]) -> str:
    parts = " || ', ' || ".join(f"'\"{c}\": \"' || {c} || '\"'" for c in sorted(columns))
    return f"sha256('{{' || {parts} || '}}')"


_SUPPLIER = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")

# Landed reports: blank water is zero, all rows of a load share its time.
_LANDED_CELLS = ", ".join(
    "case when trim(prod_agua) = '' then '0' else prod_agua end as prod_agua"
    if c == "prod_agua" else c
    for c in PRODUCTION_CELLS
)


def _loads(*loads: tuple[str, str]) -> str:
    """CTEs for a sequence of (condition on the raw reports, load time)."""
    ctes = [
        BRONZE,
        f"landed as (select {_LANDED_CELLS} from produccion_raw)",
        f"hashed as (select *, {_row_hash(PRODUCTION_CELLS)} as _row_hash from landed)",
    ]
    previous = None
    for i, (condition, at) in enumerate(loads):
        ctes.append(
            f"""load_{i} as (
  select {typed_columns(f"timestamp '{at}'")} from hashed where {condition}),
batch_{i} as (
  select * exclude (_row_hash) from (
    select distinct on (id_pozo, periodo) * from load_{i} order by id_pozo, periodo, _row_hash)
  where {NO_NEGATIVE})"""
        )
        if previous is None:
            ctes.append(f"state_{i} as (select * from batch_{i})")
        else:
            ctes.append(
                f"""state_{i} as (
  select * from {previous} as old where not exists (
    select 1 from batch_{i} as new where new.id_pozo = old.id_pozo and new.periodo = old.periodo)
  union all select * from batch_{i})"""
            )
        previous = f"state_{i}"
    return ",\n".join(ctes)


def _fact(state: str) -> str:
    keys = ", ".join(
        f"{_key(column)} as {name}_key"
        for name, column in (
            ("pozo", "id_pozo"), ("empresa", "id_empresa"), ("area", "area"),
            ("cuenca", "cuenca"), ("tipo_recurso", "tipo_recurso"), ("fecha", "periodo"),
        )
    )
    return (
        f"select {_key('id_pozo', 'periodo')} as produccion_key, {keys}, id_pozo, id_empresa, "
        f"{_MONTH}, {_VOLUMES}, dias_produccion, {_LOADED} from {state}"
    )


_EARLY = "dias_produccion in ('', '1', '2', '3')"
_LATE = "dias_produccion in ('4', '5', '6')"
_FIRST_AT, _SECOND_AT = "2026-02-01 03:00:00", "2026-03-01 03:00:00"
_SILVER_ORDER = (
    f"id_pozo, id_empresa, empresa, area, cuenca, tipo_recurso, {_MONTH}, {_VOLUMES}, "
    f"dias_produccion, {_LOADED}"
)

# Streamed bronze rows keep their blank water cells.
_INGESTED = (
    _loads((_EARLY, _FIRST_AT), (_LATE, _SECOND_AT)).replace(
        f"landed as (select {_LANDED_CELLS} from produccion_raw)",
        f"landed as (select {', '.join(PRODUCTION_CELLS)} from produccion_raw)",
    )
)


def _mark(check: str, table: str, failing: str) -> str:
    return f"select '{check}' as check_name, '{table}' as dimension, ({failing}) as failed_rows"


def _incomplete(table: str, columns: str, also: str = "true") -> str:
    """Rows that are not complete: all of them less those with every column and ``also``."""
    held = " and ".join(f"{c} is not null" for c in columns.split(", "))
    return f"select count(*) - count(*) filter ({held} and {also}) from {table}"


# One statement per kind of check: completeness, ranges, grain, references.
_MARKS = "\nmarks as (\n" + "\nunion all ".join([
    _mark("dim_pozo_completeness", "dim_pozo", _incomplete(
        "dim_pozo",
        "pozo_key, id_pozo, sigla, formacion_productiva, id_empresa, area, cuenca, tipo_recurso, "
        "is_current",
    )),
    _mark("dim_empresa_completeness", "dim_empresa",
          _incomplete("dim_empresa", "empresa_key, id_empresa, empresa, is_current")),
    _mark("dim_fecha_valid_month", "dim_fecha",
          _incomplete("dim_fecha", "fecha_key, periodo, mes", "mes between 1 and 12")),
    _mark("fct_produccion_measure_ranges", "fct_produccion",
          "select count(*) from fct_produccion where "
          "least(0, prod_gas, prod_petroleo, prod_agua) < 0 "
          "or coalesce(dias_produccion, 0) not between 0 and 31"),
    _mark("fct_produccion_fact_grain", "fct_produccion",
          "select count(*) - count(distinct (id_pozo, periodo)) from fct_produccion"),
    *[
        _mark(f"fct_produccion_rel_{name}", "fct_produccion",
              f"select count(*) from fct_produccion anti join dim_{name} using ({name}_key)")
        for name in ("pozo", "empresa", "fecha")
    ],
]) + ")"
_MARK_ROWS = (
    f"with {GOLD},{_MARKS}\nselect check_name, dimension, "
    "case when failed_rows = 0 then 'PASS' else 'ERROR' end as status, failed_rows from marks"
)


def _results(tests: list[tuple[str, str, str, str]]) -> str:
    """Test results from (kind, table, columns, SQL that counts failing rows)."""
    rows = []
    for kind, table, columns, counted in tests:
        name = "_".join((kind, table, *columns.split(", ")))
        severity = "warn" if (kind, table) == ("relationships", "stg_produccion") else "error"
        rows.append(
            f"select '{name}' as test, '{table}' as table_name, '{severity}' as severity, "
            f"cast(({counted}) as bigint) as failed_rows"
        )
    united = "\nunion all ".join(rows)
    return (
        f"with {GOLD}, results as (\n{united})\nselect *, case when failed_rows = 0 then 'pass' "
        "when severity = 'warn' then 'warn' else 'fail' end as status from results"
    )


def _nulls(table: str, columns: str):
    return [
        ("not_null", table, c, f"select count(*) from {table} where {c} is null")
        for c in columns.split(", ")
    ]


def _uniques(table: str, columns: str):
    return [
        ("unique", table, c, f"select count(*) from (select {c} from {table} where {c} is not null "
         f"group by {c} having count(*) > 1)")
        for c in columns.split(", ")
    ]


def _combination(table: str, columns: str):
    return [
        ("unique_combination", table, columns,
         f"select count(*) from (select {columns} from {table} group by {columns} having count(*) > 1)")
    ]


def _exists(table: str, columns: str):
    return [
        ("column_exists", table, c, f"select count(*) from (select {c} from {table} limit 0)")
        for c in columns.split(", ")
    ]


def _between(table: str, column: str, condition: str):
    return [("between", table, column, f"select count(*) from {table} where {condition}")]


def _related(table: str, column: str, parent: str):
    return [
        ("relationships", table, column,
         f"select count(*) from {table} where {column} is not null "
         f"and {column} not in (select {column} from {parent})")
    ]


_SILVER_TESTS = [
    *_combination("stg_produccion", "id_pozo, periodo"),
    *_nulls(
        "stg_produccion",
        "id_pozo, id_empresa, area, cuenca, tipo_recurso, periodo, prod_gas, prod_petroleo, "
        "dias_produccion",
    ),
    *_related("stg_produccion", "id_pozo", "stg_pozos"),
    *_nulls("stg_pozos", "id_pozo"),
    *_uniques("stg_pozos", "id_pozo"),
]
_GOLD_TESTS = [
    *_exists("dim_pozo", "pozo_key, id_pozo, is_current"),
    *_nulls(
        "dim_pozo",
        "pozo_key, id_pozo, sigla, formacion_productiva, id_empresa, area, cuenca, tipo_recurso, "
        "valid_from, is_current",
    ),
    *_uniques("dim_pozo", "pozo_key, id_pozo"),
    ("accepted_values", "dim_pozo", "is_current",
     "select count(*) from dim_pozo where is_current not in (true, false)"),
    *_exists("dim_empresa", "empresa_key, id_empresa, is_current"),
    *_nulls("dim_empresa", "empresa_key, id_empresa, empresa, valid_from, is_current"),
    *_uniques("dim_empresa", "empresa_key, id_empresa"),
    ("accepted_values", "dim_empresa", "is_current",
     "select count(*) from dim_empresa where is_current not in (true, false)"),
    *[
        test
        for m in ("area", "cuenca", "tipo_recurso")
        for test in (
            ("distinct_count_gt", f"dim_{m}", m,
             f"select case when count(distinct {m}) > 1 then 0 else 1 end from dim_{m}"),
            *_nulls(f"dim_{m}", f"{m}_key, {m}"),
            *_uniques(f"dim_{m}", f"{m}_key, {m}"),
        )
    ],
    *_exists("dim_fecha", "fecha_key, periodo, mes"),
    *_nulls("dim_fecha", "fecha_key, periodo, anio, mes, trimestre"),
    *_uniques("dim_fecha", "fecha_key, periodo"),
    *_between("dim_fecha", "mes", "mes < 1 or mes > 12"),
    *_combination("fct_produccion", "id_pozo, periodo"),
    *_exists(
        "fct_produccion",
        "produccion_key, pozo_key, empresa_key, fecha_key, prod_gas, prod_petroleo, prod_agua, "
        "dias_produccion",
    ),
    *_nulls(
        "fct_produccion",
        "produccion_key, pozo_key, empresa_key, area_key, cuenca_key, tipo_recurso_key, fecha_key, "
        "id_pozo, id_empresa, periodo, prod_gas, prod_petroleo, prod_agua, dias_produccion, _loaded_at",
    ),
    *_uniques("fct_produccion", "produccion_key"),
    *[
        test
        for m in ("pozo", "empresa", "area", "cuenca", "tipo_recurso", "fecha")
        for test in _related("fct_produccion", f"{m}_key", f"dim_{m}")
    ],
    *_between("fct_produccion", "prod_gas", "prod_gas < 0"),
    *_between("fct_produccion", "prod_petroleo", "prod_petroleo < 0"),
    *_between("fct_produccion", "prod_agua", "prod_agua < 0"),
    *_between("fct_produccion", "dias_produccion", "dias_produccion < 0 or dias_produccion > 31"),
]

_FORECAST = """
wells as (select 'POZO-' || p_partkey as id_well, p_retailprice as base_rate from part),
asked as (
  select o_orderkey as request_id, 'POZO-' || (o_custkey * 2) as id_well,
    cast(o_orderdate as date) as date_start,
    cast(o_orderdate as date) + case when o_orderpriority like '4%' then -1
      else cast(o_orderpriority[1] as int) * 3 end as date_end
  from orders)"""
_ASKED = "request_id, id_well, cast(date_start as varchar) as date_start, cast(date_end as varchar) as date_end"
_REJECTS = f"""
select {_ASKED}, 'unknown well' as reason from asked where id_well not in (select id_well from wells)
union all
select {_ASKED}, 'date_end before date_start' from asked
where id_well in (select id_well from wells) and date_end < date_start"""


def _profile(column: str, shown: str | None = None) -> str:
    shown = shown or column
    return (
        f"select 'produccion' as table_name, '{column}' as column_name, count(*) as rows, "
        f"count(*) - count({column}) as null_count, cast(min({shown}) as varchar) as min_value, "
        f"cast(max({shown}) as varchar) as max_value, count(distinct {column}) as distinct_count from typed"
    )


ORACLES = {
    "read_csv_text": (
        "select cast(doc_id as varchar) as doc_id, lang, text as document_text, source from documents"
    ),
    "with_load_metadata": f"""
select *, '2026-01-01' as _load_period, '2026-02-01 03:00:00' as _loaded_at,
  'file:supplier' as _source_url, 'supplier' as _resource_id, {_text_row_hash(_SUPPLIER)} as _row_hash
from (select {', '.join(f'cast({c} as varchar) as {c}' for c in _SUPPLIER)} from supplier)""",
    "row_hash_text": r"""
select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn,
  '{"conv_id": "' || conv_id || '", "role": ' || to_json(role) || ', "text": ' || to_json(text)
    || ', "turn": "' || turn || '"}' as canonical
from conversations""",
    "replace_partition": """
select '2026-01' as _load_period, count(*) as rows, count(distinct o_orderkey) as orders,
  min(o_orderstatus) as status from orders
union all
select '2026-02', count(*), count(distinct o_orderkey), min(o_orderstatus) from orders
where o_orderstatus = 'F'""",
    "scan_bronze": """
with text as (select cast(c_custkey as varchar) as c_custkey, c_name,
    cast(c_nationkey as varchar) as c_nationkey, cast(c_acctbal as varchar) as c_acctbal, c_mktsegment
  from customer)
select * replace (cast(null as varchar) as c_mktsegment), '2026-01' as _load_period from text
union all select *, '2026-02' from text""",
    "evolve_schema": """
select n_name as name, n_nationkey, cast(null as double) as s_acctbal from nation
union all select s_name, null, s_acctbal from supplier""",
    "merge_upsert": f"""with {SILVER},
early as (select * exclude (rn) from (select *, {_NEWEST} as rn from typed where dias_produccion <= 3) where rn = 1),
late as (select * exclude (rn) from (select *, {_NEWEST} as rn from typed where dias_produccion > 3) where rn = 1)
select * exclude (_row_hash) replace ({_REPLACED}) from (
  select * from early as e where not exists (
    select 1 from late as l where l.id_pozo = e.id_pozo and l.periodo = e.periodo)
  union all select * from late)""",
    "incremental_filter": with_silver(
        f"select {_SILVER_ORDER} from stg_produccion as s where s.periodo = date '1996-05-01' or s._loaded_at > "
        "(select max(k._loaded_at) from stg_produccion as k where k.periodo < date '1997-01-01')"
    ),
    "incremental_filter_empty_target": with_silver(
        f"select {_SILVER_ORDER} from stg_produccion as s where s.periodo = date '1996-05-01'"
    ),
    "required_keys": with_bronze(
        "select idpozo, anio, mes, prod_agua, dias_produccion, _row_hash from produccion_raw "
        "where trim(prod_agua) <> '' and trim(dias_produccion) <> ''"
    ),
    "clean_columns": with_bronze(
        f"""select _row_hash, nullif(trim(prod_agua), '') as water_text, areayacimiento as area,
  idempresa as operator, coalesce(nullif(trim(tipo_de_recurso), ''), 'SIN DATO') as resource,
  upper(trim(idempresa)) as company,
  coalesce(cast(nullif(trim(dias_produccion), '') as int), 0) as days,
  cast(cast(nullif(trim(prod_agua), '') as decimal(20,6)) as double) as water,
  cast(make_date(cast(anio as int), cast(trim(mes) as int), 1) as varchar) as month,
  cast(anio as int) as anio, cast(trim(mes) as int) as mes,
  cast((cast(trim(mes) as int) + 2) // 3 as int) as trimestre,
  {_key("nullif(trim(prod_agua), '')", 'idpozo')} as key_with_null,
  coalesce(nullif(trim(area), ''), empresa) as name
from produccion_raw"""
    ),
    "summarize_text": r"""
with lines as (
  select doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as line
  from documents)
select doc_id, case when line = '' then '<empty>' when length(line) <= 160 then line
  else substr(line, 1, 157) || '...' end as summary from lines""",
    "title_words": """
select event_id, 'Api ' || upper(event_type[1]) || event_type[2:] as title from events""",
    "non_negative": with_silver(
        f"{_TYPED} where coalesce(typed.prod_gas, 0) >= 0 and coalesce(typed.prod_agua, 0) >= 0"
    ),
    "latest_period": MEDALLION["fct_produccion"]
    + " as f where f.periodo = (select max(x.periodo) from fct_produccion as x)",
    "active_rows": with_silver(f"{_TYPED} where typed.prod_gas + typed.prod_agua > 0"),
    "member_filter": with_silver(f"{_TYPED} where typed.prod_agua is not null"),
    "period_filter": MEDALLION["fct_produccion"] + " as f where f.periodo = date '1999-03-01'",
    "latest_per_key": with_silver(
        f"select * exclude (rn) replace ({_REPLACED}) from (select *, row_number() over (partition by id_pozo "
        "order by _loaded_at desc, _row_hash) as rn from typed) where rn = 1"
    ),
    "star_lookup": MEDALLION["fct_produccion"],
    "rank_total": """
select o_custkey, cast(total as double) as total, cast(rn as int) as rn from (
  select o_custkey, total, row_number() over (order by total desc, o_custkey) as rn from (
    select o_custkey, sum(cast(o_totalprice as decimal(18,2))) as total from orders group by all))
where rn <= 25""",
    "top_n_others": """
with priced as (select *, cast(o_totalprice as decimal(18,2)) as price
  from orders join customer on o_custkey = c_custkey),
ranked as (select c_mktsegment, row_number() over (order by sum(price) desc, c_mktsegment) as rn
  from priced group by c_mktsegment)
select o_orderstatus, case when rn <= 3 then c_mktsegment else 'Otras' end as segment,
  cast(sum(price) as double) as value
from priced join ranked using (c_mktsegment) group by all""",
    "top_k_sum": """
select o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as spent from orders
group by o_custkey order by sum(cast(o_totalprice as decimal(18,2))) desc, o_custkey limit 15""",
    "latest_first": """
select * replace (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate) from (
  select * from orders order by orders.o_orderdate desc, o_orderkey limit 20)""",
    "fk_orphans": """
select count(*) as failed_rows from documents where doc_id not in (select doc_id from labels)""",
    "relationships": """
select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)""",
    "fact_dim": """
select p_brand, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as value
from lineitem join part on l_partkey = p_partkey group by all""",
    "sum_by": with_silver(
        "select cast(typed.periodo as varchar) as periodo, cuenca, cast(sum(prod_gas) as double) as gas, "
        "cast(sum(prod_agua) as double) as water from typed group by all"
    ),
    "count_distinct": "select count(distinct l_orderkey) as orders from lineitem",
    "count_filter": with_silver(
        "select count(*) filter (where prod_gas < 0) as negative_gas, "
        "count(*) filter (where prod_agua < 0.05) as little_water, "
        "count(*) filter (where prod_agua is null) as no_water from typed"
    ),
    "duplicate_excess": """
select coalesce(cast(sum(n - 1) as bigint), 0) as failed_rows from (
  select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""",
    "select_distinct": "select distinct p_brand, p_type from part",
    "distinct_count_gt": """
select count(distinct p_brand) as distinct_values, count(distinct p_brand) > 24 as passed from part""",
    "partition_counts": with_bronze(
        "select 'produccion_raw' as table_name, count(*) as rows from produccion_raw "
        "where _load_period = '1997-06-01' union all "
        "select 'pozos_raw', count(*) from pozos_raw where _load_period = '1997-06-01'"
    ),
    "month_counts": with_gold(
        "select cast(periodo as varchar) as periodo, count(*) as rows, "
        "strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S') as last_loaded_at from fct_produccion group by periodo"
    ),
    "bronze_profile": with_silver(" union all ".join(
        f"select 'produccion_raw' as table_name, '{c}' as column_name, count(*) as rows, "
        f"count(*) - count({c}) as null_count, min({c}) as min_value, max({c}) as max_value, "
        "true as close from produccion_raw" for c in PRODUCTION_CELLS
    )),
    "column_profile": with_silver(" union all ".join(_profile(c) for c in TYPED_COLUMNS)),
    "union_distinct": "select c_nationkey as nation from customer union select s_nationkey from supplier",
    "union_all": """
select c_name as name, c_nationkey as nation from customer
union all select s_name, s_nationkey from supplier""",
    "test_not_null": with_silver(f"{_TYPED} where typed.prod_agua is null"),
    "test_unique": with_silver(
        "select id_pozo, count(*) as n_records from typed where id_pozo is not null "
        "group by id_pozo having count(*) > 1"
    ),
    "test_unique_combination": with_silver(
        "select id_pozo, cast(typed.periodo as varchar) as periodo, count(*) as n_records from typed "
        "group by id_pozo, typed.periodo having count(*) > 1"
    ),
    "test_accepted_values": with_silver(f"{_TYPED} where tipo_recurso not in ('ECONOMY', 'SMALL')"),
    "test_between": with_silver(f"{_TYPED} where typed.prod_gas < 0 or typed.prod_gas > 45"),
    "test_results_silver": _results(_SILVER_TESTS),
    "test_results_gold": _results(_GOLD_TESTS),
    "stored_failures": (
        f"select test, failed_rows as rows from ({_results(_GOLD_TESTS)}) where status <> 'pass'"
    ),
    "quality_marks": _MARK_ROWS,
    "quality_table": _MARK_ROWS,
    "source_freshness": with_bronze(
        """select 'produccion_raw' as source, strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S') as max_loaded_at,
  case when max(_loaded_at) < timestamp '2002-01-20' - interval 60 days then 'error'
    when max(_loaded_at) < timestamp '2002-01-20' - interval 35 days then 'warn' else 'pass' end as status
from produccion_raw
union all
select 'pozos_raw', strftime(max(_loaded_at), '%Y-%m-%d %H:%M:%S'),
  case when max(_loaded_at) < timestamp '2002-01-20' - interval 60 days then 'error'
    when max(_loaded_at) < timestamp '2002-01-20' - interval 35 days then 'warn' else 'pass' end
from pozos_raw"""
    ),
    "publish_gate": f"""with {GOLD},{_MARKS},
against as (
  select check_name as name from marks where failed_rows > 0
  union all
  select 'freshness_produccion_raw' from produccion_raw
  having max(_loaded_at) < timestamp '2002-01-20' - interval 35 days)
select count(*) = 0 as publish, coalesce(string_agg(name, ',' order by name), '') as failing_checks
from against""",
    "quality_alert": f"""
select 'data_quality_job_failed' as event, 'monthly' as job_name, 'gold' as op_name, 'run-1' as run_id,
  error, json_object('error', error, 'event', 'data_quality_job_failed', 'job_name', 'monthly',
    'op_name', 'gold', 'run_id', 'run-1')::varchar as payload
from (select 'data tests failed: ' || string_agg(test, ', ' order by test) as error
  from ({_results(_GOLD_TESTS)}) where status = 'fail')
where error is not null""",
    "decline_forecast": f"""with {_FORECAST}
select request_id, id_well, cast(date_start + cast(i as int) as varchar) as date,
  round_even(greatest(base_rate - 7.5 * i, 0), 2) as oil_bopd
from asked join wells using (id_well), unnest(range(0, date_end - date_start + 1)) as days(i)""",
    "forecast_rejects": f"with {_FORECAST}{_REJECTS}",
    "reject_unknown": f"""with {_FORECAST}{_REJECTS}
union all
select {_ASKED}, 'accepted' from asked
where id_well in (select id_well from wells) and date_end >= date_start""",
    "wells_for_date": with_gold(
        "select id_pozo, sigla from dim_pozo where valid_from < timestamp '1995-01-06'"
    ),
    "run_period": f"with {_loads(('true', _FIRST_AT))}\n{_fact('state_0')}",
    "backfill": f"with {_loads((_EARLY, _FIRST_AT), (_LATE, _SECOND_AT))}\n{_fact('state_1')}",
    "catch_up": f"with {_loads((_EARLY, _FIRST_AT), (_LATE, _SECOND_AT))}\n{_fact('state_1')}",
    "verify_reload": f"""with {_loads(('true', _FIRST_AT))}
select 'rows_produccion_raw' as check_name, cast(count(*) as varchar) as value from hashed
union all select 'rows_pozos_raw', cast(count(*) as varchar) from pozos_raw
union all select 'duplicate_grain', '0'
union all select 'fact_rows', cast(count(*) as varchar) from state_0 where periodo = date '1997-05-01'
union all select 'last_loaded_at', '{_FIRST_AT}'""",
    "incremental_ingest": f"with {_INGESTED}\nselect {_SILVER_ORDER} from state_1",
}
