"""DuckDB SQL twins of the medallion queries, over the given tables."""

from __future__ import annotations

PRODUCTION_CELLS = (
    "anio", "area", "areayacimiento", "cuenca", "dias_produccion", "empresa", "idempresa",
    "idpozo", "mes", "prod_agua", "prod_gas", "prod_pet", "tipo_de_recurso",
)
_WELL_CELLS = (
    "areayacimiento", "cuenca", "empresa", "formprod", "idempresa", "idpozo", "sigla",
    "tipo_reservorio",
)


def _row_hash(cells: tuple[str, ...]) -> str:
    parts = " || ', ' || ".join(f"'\"{c}\": \"' || {c} || '\"'" for c in cells)
    return f"sha256('{{' || {parts} || '}}')"


def _key(*columns: str) -> str:
    parts = " || '-' || ".join(
        f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns
    )
    return f"md5({parts})"


BRONZE = f"""
produccion_cells as (
  select cast(year(l_shipdate) as varchar) as anio, '' as area, p_brand as areayacimiento,
    r_name as cuenca,
    case when l_linenumber = 7 then '' else cast(l_linenumber as varchar) end as dias_produccion,
    s_name as empresa, ' s' || l_suppkey as idempresa, ' ' || l_partkey || ' ' as idpozo,
    ' ' || month(l_shipdate) as mes,
    case when l_tax = 0 then ' ' else cast(cast(l_tax as decimal(18,2)) as varchar) end as prod_agua,
    case when l_returnflag = 'R' and l_discount >= 0.09 then '-' else '' end
      || cast(cast(l_quantity as decimal(18,2)) as varchar) as prod_gas,
    cast(cast(l_extendedprice as decimal(18,2)) as varchar) as prod_pet,
    case when p_type = 'PROMO' then ' ' else p_type end as tipo_de_recurso,
    cast(date_trunc('month', l_shipdate) as date) as ship_month, l_linenumber
  from lineitem
    join part on l_partkey = p_partkey
    join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey),
produccion_raw as (
  select {', '.join(PRODUCTION_CELLS)},
    strftime(ship_month + interval 1 month + to_days(l_linenumber), '%Y-%m-01') as _load_period,
    cast(ship_month + interval 1 month + to_days(l_linenumber) as timestamp) as _loaded_at,
    {_row_hash(PRODUCTION_CELLS)} as _row_hash
  from produccion_cells),
pozos_cells as (
  select p_brand as areayacimiento, coalesce(r_name, '') as cuenca,
    coalesce(s_name, '') as empresa, case when load = 1 then ' ' else p_type end as formprod,
    's' || p_size || ' ' as idempresa, cast(p_partkey as varchar) as idpozo,
    ' ' || p_name || '-' || p_size as sigla, p_type as tipo_reservorio,
    case when load = 1 then timestamp '1994-12-20'
      else cast(date '1994-12-01' + p_size as timestamp) end as _loaded_at
  from part
    left join (select s_suppkey, s_name, r_name from supplier
      join nation on s_nationkey = n_nationkey
      join region on n_regionkey = r_regionkey) as owner on p_size = s_suppkey
    cross join (values (1), (2)) as loads(load)),
pozos_raw as (
  select {', '.join(_WELL_CELLS)}, strftime(_loaded_at, '%Y-%m-01') as _load_period,
    _loaded_at, {_row_hash(_WELL_CELLS)} as _row_hash
  from pozos_cells)"""

# What becomes of the cells, beside keys, volumes and the month.
_KINDS = {
    "code": "upper(trim({0}))",
    "text": "nullif(trim({0}), '')",
    # Fixed value: the name of the unknown member.
    "member": "ifnull(nullif(trim({0}), ''), 'SIN DATO')",
    "count": "ifnull(try_cast(trim({0}) as int), 0)",
}
_REPORT = {
    "id_pozo": ("key", "idpozo"), "id_empresa": ("code", "idempresa"), "empresa": ("text", "empresa"),
    "area": ("member", "areayacimiento"), "cuenca": ("member", "cuenca"),
    "tipo_recurso": ("member", "tipo_de_recurso"), "periodo": ("month", "anio"),
    "prod_gas": ("volume", "prod_gas"), "prod_petroleo": ("volume", "prod_pet"),
    "prod_agua": ("volume", "prod_agua"), "dias_produccion": ("count", "dias_produccion"),
}
_WELL = {
    "id_pozo": ("key", "idpozo"), "sigla": ("text", "sigla"),
    "formacion_productiva": ("member", "formprod"), "id_empresa": ("code", "idempresa"),
    "empresa": ("text", "empresa"), "area": ("member", "areayacimiento"),
    "cuenca": ("member", "cuenca"), "tipo_recurso": ("member", "tipo_reservorio"),
}
TYPED_COLUMNS = (*_REPORT, "_loaded_at", "_row_hash")
NO_NEGATIVE = "least(0, prod_gas, prod_petroleo, prod_agua) = 0"


def _cell(kind: str, column: str) -> str:
    if kind == "month":
        return "strptime(trim(anio) || '-' || trim(mes), '%Y-%m')::date"
    if kind == "volume":
        return f"cast(nullif(trim({column}), '') as decimal(20,6))"
    if kind == "key":
        return f"cast(trim({column}) as bigint)"
    return _KINDS[kind].format(column)


def _cells(shape: dict[str, tuple[str, str]]) -> str:
    return ", ".join(f"{_cell(*cell)} as {name}" for name, cell in shape.items())


def typed_columns(loaded_at: str = "_loaded_at") -> str:
    """Typed columns of a production report, for a select list."""
    return f"{_cells(_REPORT)}, {loaded_at} as _loaded_at, _row_hash"


def _newest(keys: str, rows: str) -> str:
    """The newest row per key, of equally new ones that with the least hash."""
    return (
        f"select * exclude (_row_hash) from (select distinct on ({keys}) * from {rows} "
        f"order by {keys}, _loaded_at desc, _row_hash)"
    )


SILVER = (
    BRONZE
    + f""",
typed as (select {typed_columns()} from produccion_raw),
stg_produccion as ({_newest("id_pozo, periodo", "typed")} where {NO_NEGATIVE}),
typed_wells as (select {_cells(_WELL)}, _loaded_at, _row_hash from pozos_raw),
stg_pozos as ({_newest("id_pozo", "typed_wells")})"""
)


def _member(column: str) -> str:
    return f"""dim_{column} as (
  select {_key(column)} as {column}_key, {column} from
    (select {column} from stg_pozos union select {column} from stg_produccion))"""


def _open(key: str, rest: str, rows: str) -> str:
    """A dimension of current rows, valid from their load on."""
    return (
        f"select {_key(key)} as {key.removeprefix('id_')}_key, {rest}, _loaded_at as valid_from, "
        f"null::timestamp as valid_to, true as is_current from {rows}"
    )


_FACT_KEYS = {
    "pozo": "id_pozo", "empresa": "id_empresa", "area": "area", "cuenca": "cuenca",
    "tipo_recurso": "tipo_recurso", "fecha": "periodo",
}

# Keys follow from the members, and only a report of an unlisted well has none in a dimension.
GOLD = (
    SILVER
    + f""",
dim_pozo as ({_open("id_pozo", "* exclude (empresa, _loaded_at)", "stg_pozos")}),
companies as (
  select id_empresa, ifnull(empresa, id_empresa) as empresa, _loaded_at from stg_pozos
  union all by name
  select id_empresa, ifnull(empresa, id_empresa) as empresa, _loaded_at from stg_produccion),
dim_empresa as ({_open(
    "id_empresa", "id_empresa, empresa",
    "(select distinct on (id_empresa) * from companies order by id_empresa, _loaded_at desc, empresa)",
)}),
{_member('area')},
{_member('cuenca')},
{_member('tipo_recurso')},
dim_fecha as (
  select {_key('periodo')} as fecha_key, periodo, year(periodo)::int as anio,
    month(periodo)::int as mes, quarter(periodo)::int as trimestre
  from stg_produccion group by periodo),
fct_produccion as (
  select {_key('id_pozo', 'periodo')} as produccion_key,
    {', '.join(f'{_key(c)} as {name}_key' for name, c in _FACT_KEYS.items())},
    * exclude (empresa, area, cuenca, tipo_recurso)
  from stg_produccion semi join stg_pozos using (id_pozo))"""
)

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"
_VOLUMES = ", ".join(
    f"cast({c} as double) as {c}" for c in ("prod_gas", "prod_petroleo", "prod_agua")
)
_PERIOD = "cast(periodo as varchar) as periodo"
_IN_PERIOD = "where periodo between date '1996-01-01' and date '1998-12-01'"


def with_gold(select: str) -> str:
    return f"with {GOLD}\n{select}"


def with_silver(select: str) -> str:
    return f"with {SILVER}\n{select}"


def with_bronze(select: str) -> str:
    return f"with {BRONZE}\n{select}"


def _total(column: str, alias: str, where: str = "") -> str:
    return with_gold(f"select cast(sum({column}) as double) as {alias} from fct_produccion {where}")


def _by(dim: str, member: str, measure: str, alias: str, where: str = "") -> str:
    return with_gold(
        f"select {_PERIOD}, {member}, cast(sum({measure}) as double) as {alias} "
        f"from fct_produccion join {dim} using ({member}_key) {where} group by all"
    )


def _operators(where: str = "") -> str:
    return with_gold(
        f"""select {_PERIOD}, grupo as operadora, cast(sum(prod_petroleo) as double) as prod_petroleo
from fct_produccion join dim_empresa using (empresa_key) join (
  select empresa, case when row_number() over (order by sum(prod_petroleo) desc nulls first, empresa)
    <= 8 then empresa else 'Otras' end as grupo
  from fct_produccion join dim_empresa using (empresa_key) group by empresa) as ranked using (empresa)
{where} group by all"""
    )


def _top_wells(where: str = "") -> str:
    return with_gold(
        f"""select sigla as pozo, cast(sum(prod_gas + prod_petroleo) as double) as produccion_total
from fct_produccion join dim_pozo using (pozo_key) {where} group by sigla
order by sum(prod_gas + prod_petroleo) desc nulls first, sigla limit 20"""
    )


def _months(where: str = "") -> str:
    sums = ", ".join(
        f"cast(sum({c}) as double) as {c}" for c in ("prod_gas", "prod_petroleo", "prod_agua")
    )
    return with_gold(f"select {_PERIOD}, {sums} from fct_produccion {where} group by all")


_VALIDITY = f"{_TS.format('valid_from')}, {_TS.format('valid_to')}, is_current"

ORACLES = {
    "bronze_produccion": with_bronze(
        f"select * replace ({_TS.format('_loaded_at')}) from produccion_raw"
    ),
    "bronze_pozos": with_bronze(f"select * replace ({_TS.format('_loaded_at')}) from pozos_raw"),
    "stg_produccion": with_silver(
        f"select id_pozo, id_empresa, empresa, area, cuenca, tipo_recurso, {_PERIOD}, {_VOLUMES}, "
        f"dias_produccion, {_TS.format('_loaded_at')} from stg_produccion"
    ),
    "stg_pozos": with_silver(f"select * replace ({_TS.format('_loaded_at')}) from stg_pozos"),
    "dim_pozo": with_gold(
        "select pozo_key, id_pozo, sigla, formacion_productiva, id_empresa, area, cuenca, "
        f"tipo_recurso, {_VALIDITY} from dim_pozo"
    ),
    "dim_empresa": with_gold(f"select empresa_key, id_empresa, empresa, {_VALIDITY} from dim_empresa"),
    "dim_area": with_gold("select * from dim_area"),
    "dim_cuenca": with_gold("select * from dim_cuenca"),
    "dim_tipo_recurso": with_gold("select * from dim_tipo_recurso"),
    "dim_fecha": with_gold(f"select * replace ({_PERIOD}) from dim_fecha"),
    "fct_produccion": with_gold(
        "select produccion_key, pozo_key, empresa_key, area_key, cuenca_key, tipo_recurso_key, "
        f"fecha_key, id_pozo, id_empresa, {_PERIOD}, {_VOLUMES}, dias_produccion, "
        f"{_TS.format('_loaded_at')} from fct_produccion"
    ),
    "gas_total": _total("prod_gas", "gas_acumulado"),
    "gas_total_in_period": _total("prod_gas", "gas_acumulado", _IN_PERIOD),
    "oil_total": _total("prod_petroleo", "petroleo_acumulado"),
    "oil_total_in_period": _total("prod_petroleo", "petroleo_acumulado", _IN_PERIOD),
    "active_wells": with_gold(
        "select count(distinct id_pozo) as pozos_activos from fct_produccion "
        "where periodo = (select max(periodo) from fct_produccion) and prod_gas + prod_petroleo > 0"
    ),
    "last_period": with_gold(
        "select cast(max(periodo) as varchar) as ultimo_periodo from fct_produccion"
    ),
    "gas_by_basin": _by("dim_cuenca", "cuenca", "prod_gas", "prod_gas"),
    "gas_by_basin_in_period": _by("dim_cuenca", "cuenca", "prod_gas", "prod_gas", _IN_PERIOD),
    "oil_by_operator": _operators(),
    "oil_by_operator_in_period": _operators(_IN_PERIOD),
    "total_by_resource": _by(
        "dim_tipo_recurso", "tipo_recurso", "prod_gas + prod_petroleo", "produccion_total"
    ),
    "total_by_resource_in_period": _by(
        "dim_tipo_recurso", "tipo_recurso", "prod_gas + prod_petroleo", "produccion_total", _IN_PERIOD
    ),
    "top_wells": _top_wells(),
    "top_wells_in_period": _top_wells(_IN_PERIOD),
    "monthly_totals": _months(),
    "monthly_totals_in_period": _months(_IN_PERIOD),
}
