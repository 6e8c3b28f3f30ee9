"""DuckDB rendering of the panel pipeline (oracle side), built from the same column lists."""

from __future__ import annotations

from agrospark.dims import SEASON4
from agrospark.operators.clean import PANEL_COLUMNS, PANEL_NUMERIC
from agrospark.sources.adapters import OBS_ORDER, OBS_SQL

MERGE_VALUE_COLS = [c for c in PANEL_NUMERIC if c not in ("latitude", "longitude")] + ["data_source"]


def merged_ordered_sql() -> str:
    """merge_sources with a full ordering (rank, row ids, value)."""
    order = ", ".join(f"k{i} := {o}" for i, o in enumerate(OBS_ORDER))
    aggs = ",\n    ".join(
        f"arg_min({c}, struct_pack({order}, v := {c})) filter (where {c} is not null) as {c}" for c in MERGE_VALUE_COLS)
    return f"""select region, date, latitude, longitude,
    {aggs}
  from ({OBS_SQL}) o
  where region is not null and date is not null and latitude is not null and longitude is not null
  group by region, date, latitude, longitude"""


def merged_sql() -> str:
    """merge_by_rank: per (key, rank) the smallest value, then per key the smallest rank with a value."""
    vals = [c for c in MERGE_VALUE_COLS if c != "data_source"]
    l1 = ", ".join(f"min({c}) as {c}" for c in vals)
    l2 = ", ".join(f"arg_min({c}, source_rank) filter (where {c} is not null) as {c}" for c in vals)
    return f"""select region, date, latitude, longitude, {l2},
    ['ERA5', 'CHIRPS', 'MODIS_TEMP', 'MODIS_VI', 'SMAP'][min(source_rank)] as data_source
  from (select region, date, latitude, longitude, source_rank, {l1}
        from ({OBS_SQL}) o
        where region is not null and date is not null and latitude is not null and longitude is not null
        group by region, date, latitude, longitude, source_rank) l1
  group by region, date, latitude, longitude"""


def dedup_sql(src: str) -> str:
    return f"""select * exclude (_k) from (
    select *, row_number() over (partition by region, date order by latitude, longitude) as _k from {src}) where _k = 1"""


def interp_sql(src: str, cols, part="region", order="date") -> str:
    w = f"partition by {part} order by {order}"
    back = f"({w} rows between unbounded preceding and current row)"
    fwd = f"({w} rows between current row and unbounded following)"
    inner = []
    for c in cols:
        inner.append(f"max(case when {c} is not null then _rn end) over {back} as _prn_{c}, "
                     f"last_value({c} ignore nulls) over {back} as _pv_{c}, "
                     f"min(case when {c} is not null then _rn end) over {fwd} as _nrn_{c}, "
                     f"first_value({c} ignore nulls) over {fwd} as _nv_{c}")
    outer = []
    for c in cols:
        outer.append(f"coalesce({c}, case when _prn_{c} is not null and _nrn_{c} is not null then "
                     f"(_nv_{c} - _pv_{c}) / cast(_nrn_{c} - _prn_{c} as double) * cast(_rn - _prn_{c} as double) "
                     f"+ _pv_{c} end, _pv_{c}, _nv_{c}) as {c}")
    keep = [f"s.* exclude ({', '.join(cols)})"]
    return f"""select {', '.join(keep)}, {', '.join(outer)} from (
    select *, {', '.join(inner)} from (select *, row_number() over ({w}) as _rn from {src}) q) s"""


def _interp_select(src, cols):
    # drop helper columns of interp_sql
    helpers = ", ".join(["_rn"] + [f"_{k}_{c}" for c in cols for k in ("prn", "pv", "nrn", "nv")])
    return f"select * exclude ({helpers}) from ({interp_sql(src, cols)}) z"


def edges_sql(src: str, cols, part="region", order="date") -> str:
    aggs = ", ".join(f"arg_min({c}, {order}) filter (where {c} is not null) as _first_{c}, "
                     f"arg_max({c}, {order}) filter (where {c} is not null) as _last_{c}" for c in cols)
    sel = ", ".join(f"last_value(_last_{c} ignore nulls) over (order by {part} rows between unbounded preceding "
                    f"and 1 preceding) as _prev_{c}, first_value(_first_{c} ignore nulls) over (order by {part} rows "
                    f"between 1 following and unbounded following) as _next_{c}" for c in cols)
    return f"select {part}, {sel} from (select {part}, {aggs} from {src} group by {part}) e"


def fill_sql(src: str, cols, table_scope_prev: bool, part="region", order="date") -> str:
    """fallback_fill (table_scope_prev=False) or fill_table_order (True) over ``src``."""
    w = f"partition by f.{part} order by f.{order}"
    back = f"({w} rows between unbounded preceding and current row)"
    fwd = f"({w} rows between current row and unbounded following)"
    outs = []
    for c in cols:
        legs = [f"f.{c}", f"last_value(f.{c} ignore nulls) over {back}"]
        if table_scope_prev:
            legs.append(f"e._prev_{c}")
        legs += [f"first_value(f.{c} ignore nulls) over {fwd}", f"e._next_{c}"]
        outs.append(f"coalesce({', '.join(legs)}) as {c}")
    return f"""select f.* exclude ({', '.join(cols)}), {', '.join(outs)}
  from {src} f left join ({edges_sql(src, cols, part, order)}) e on f.{part} = e.{part}"""


def season4_case(month: str) -> str:
    whens = " ".join(f"when {m} then '{s}'" for m, s in SEASON4)
    return f"case {month} {whens} end"


def panel_ctes() -> str:
    """CTE chain ending in ``panel`` (the clean daily panel)."""
    num = PANEL_NUMERIC
    cols = ", ".join(PANEL_COLUMNS)
    return f"""with merged as ({merged_sql()}),
keyed as ({dedup_sql('merged')}),
interp as ({_interp_select('keyed', num)}),
filled as ({fill_sql('interp', num, False)}),
conv as (select * exclude (temperature_2m, lst_day_1km, lst_night_1km, ssm),
    case when temperature_2m > 200 then temperature_2m - cast(273.15 as double) else temperature_2m end as temperature_2m,
    case when lst_day_1km > 200 then lst_day_1km - cast(273.15 as double) else lst_day_1km end as lst_day_1km,
    case when lst_night_1km > 200 then lst_night_1km - cast(273.15 as double) else lst_night_1km end as lst_night_1km,
    case when ssm < 0 then null when ssm > 1 then ssm / cast(100 as double) else ssm end as ssm,
    cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day,
    {season4_case('month(date)')} as season
  from filled),
panel as (select {cols} from conv)"""
