"""The SQL each query's result must equal, written for DuckDB independently of the Spark plans."""

# The groups with more than one route, and those that are their only route.
_MERGED = {"1": ["1", "1L"], "24": ["24", "18"], "51": ["51", "52"]}
_SINGLE = (
    "2 3 7 9 10 13 14 15 16 23 31 40 41 42 44 54 60 61 66 67 69 73 80A 81 83 84 84A 93 94 99 "
    "411 413 432 434 501 504 671 672 673 674 A C"
).split()
_GROUPS = _MERGED | {route: [route] for route in _SINGLE}
_PAIRS = ", ".join(f"('{g}', '{r}')" for g, routes in _GROUPS.items() for r in routes)
# Stops of the lineitem adapter that the sheet lists: lines 1 to 6, two stops each.
_LABELS = [f"St. {line}, N - {100 * line + side}" for line in range(1, 7) for side in (0, 1)]

_FEW = """case l_orderkey % 10 when 0 then '1' when 1 then '1L' when 2 then '24' when 3 then '18'
      when 4 then '51' when 5 then '52' when 6 then '7' when 7 then '99' when 8 then 'Car' end"""
# The adapter numbers all routes as the groups are printed: 48, then the one that is not printed.
_PRINTED = (
    "1 1L 2 3 7 9 10 13 14 15 16 23 24 18 31 40 41 42 44 51 52 54 60 61 66 67 69 73 80A 81 83 84 84A 93 94 99 "
    "411 413 432 434 501 504 671 672 673 674 A C Car"
).split()
_ALL = "case l_orderkey % 50 " + " ".join(f"when {i} then '{r}'" for i, r in enumerate(_PRINTED)) + " end"
_CTES = f"""
with minutes as (
  select *, 270 + (l_orderkey * 37) % 1380 + 4 * l_linenumber
    + case when l_partkey % 40 = 7 then 2 else 0 end as m
  from lineitem
),
trip_stops as (
  select 'lineitem.parquet' as id,
    cast(l_orderkey as varchar) as trp_number_trim,
    {_FEW} as route,
    case (l_orderkey // 10) % 5 when 0 then 'North' when 1 then 'East' when 3 then 'East' else 'West' end
      as direction,
    'P' || l_linenumber as place,
    cast(100 * l_linenumber + l_suppkey % 2 as varchar) as stop,
    'St. ' || l_linenumber || ', N' as stop_name,
    case l_orderkey % 3 when 0 then 'Weekday' when 1 then 'Saturday' else 'Sunday' end as op_day,
    case when l_partkey % 50 = 0 then '5:30p' when l_partkey % 50 = 1 then null
      else cast(case when (m // 60) % 12 = 0 then 12 else (m // 60) % 12 end as varchar)
        || lpad(cast(m % 60 as varchar), 2, '0')
        || case when m // 60 < 12 then 'a' when m // 60 < 24 then 'p' else 'x' end end as departure,
    case when l_orderkey % 17 = 0 then 'School' end as evt_sta
  from minutes
),
stop_order as (
  select distinct route, direction, stop,
    (cast(stop as int) // 10) || '.' || (cast(stop as int) % 10) as stop_order
  from trip_stops where route is not null and stop not like '7%'
),
route_groups(route_group, route) as (values {_PAIRS}),
clean as (select * from trip_stops where route is not null and route <> 'Car'),
split as (
  select *, regexp_matches(departure, '^[0-9]+[a-z]+$') as readable,
    case when regexp_matches(departure, '^[0-9]+[a-z]+$')
      then cast(regexp_extract(departure, '^[0-9]+') as double) end as time,
    case when regexp_matches(departure, '^[0-9]+[a-z]+$')
      then regexp_extract(departure, '[a-z]+$') end as meridian
  from clean
),
clock as (
  select *,
    case when meridian = 'p' and time < 1200 then time + 1200
      when meridian = 'x' and time > 1200 then time + 1200
      when meridian = 'x' and time < 1200 then time + 2400
      else time end as dep_time_24h,
    regexp_replace(departure, 'x', 'a') as departure_save
  from split
),
base_rows as (
  select coalesce(c.trp_number_trim, 'NA') || ' - ' || coalesce(c.op_day, 'NA') as trp_op_day,
    c.trp_number_trim, c.route, c.direction, c.place,
    coalesce(c.stop_name, 'NA') || ' - ' || coalesce(c.stop, 'NA') as stop_info,
    c.stop, c.op_day, c.stop_name, c.departure_save, c.dep_time_24h,
    cast(s.stop_order as double) as stop_order, coalesce(c.evt_sta, '') as evt_sta
  from clock c join stop_order s
    on c.route is not distinct from s.route and c.direction is not distinct from s.direction
    and c.stop is not distinct from s.stop
),
base as (select distinct * from base_rows),
printed as (
  select g.route_group, b.* from base b join route_groups g on b.route = g.route
  where b.direction in ('East', 'West')
),
cells as (
  select route_group, direction, trp_op_day, route, evt_sta, stop_info,
    min(dep_time_24h) as dep_time_24h, max(dep_time_24h) as latest_time,
    coalesce(
      min(departure_save) filter (where dep_time_24h = least_time), min(departure_save)) as display
  from (
    select *, min(dep_time_24h) over (
      partition by route_group, direction, trp_op_day, route, evt_sta, stop_info) as least_time
    from printed)
  group by all
),
counts as (
  select route_group, direction, stop_info, count(*) filter (where dep_time_24h > 0) as cnt
  from cells group by all
),
firsts as (
  select route_group, direction, stop_info, route, stop_order, dep_time_24h,
    row_number() over (partition by route_group, direction, stop_info
      order by route, stop_order nulls last, dep_time_24h nulls last) as nth
  from printed
),
positions as (
  select route_group, direction, stop_info,
    cast(row_number() over (partition by route_group, direction
      order by route, stop_order nulls last, dep_time_24h nulls last, stop_info) as int) as stop_pos
  from firsts where nth = 1
),
stops as (
  select *, row_number() over (partition by route_group, direction order by cnt desc, stop_pos) = 1
    as is_anchor
  from counts join positions using (route_group, direction, stop_info)
),
trip_firsts as (
  select * from (
    select route_group, direction, trp_op_day, route, evt_sta, stop_order, dep_time_24h,
      row_number() over (partition by route_group, direction, trp_op_day, route, evt_sta
        order by stop_order nulls last, dep_time_24h nulls last) as nth
    from printed)
  where nth = 1
),
anchored as (
  select c.route_group, c.direction, c.trp_op_day, c.route, c.evt_sta, c.dep_time_24h as anchor_time
  from cells c join stops s using (route_group, direction, stop_info) where s.is_anchor
),
trips as (
  select f.route_group, f.direction, f.trp_op_day, f.route, f.evt_sta, a.anchor_time,
    row_number() over (partition by f.route_group, f.direction
      order by a.anchor_time nulls last, f.route, f.stop_order nulls last, f.dep_time_24h nulls last,
        f.trp_op_day, f.evt_sta) as trip_rank
  from trip_firsts f left join anchored a using (route_group, direction, trp_op_day, route, evt_sta)
),
grid as (
  select t.route_group, t.direction, t.trip_rank, t.trp_op_day, t.route, t.evt_sta, s.stop_pos,
    s.stop_info, c.dep_time_24h, c.display as raw_display, coalesce(c.display, '.....') as display
  from trips t join stops s using (route_group, direction)
  left join cells c using (route_group, direction, trp_op_day, route, evt_sta, stop_info)
),
rows as (
  select route_group, direction, trip_rank, trp_op_day, route, evt_sta,
    string_agg(display, '|' order by stop_pos) as cells
  from grid group by all
),
one_grid as (select * from grid where route_group = '24' and direction = 'East')
"""

_IDS = "trp_op_day, route, direction, evt_sta"
_TRIP_STOPS = (
    "trp_number_trim, route, direction, place, stop, stop_name, op_day, departure, evt_sta"
)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _wide(value, ids):
    stops = ", ".join(f"min(case when stop_info = '{s}' then {value} end) as \"{s}\"" for s in _LABELS)
    return f"select {ids}, {stops} from one_grid group by {ids}"


def _csv(column):
    return f"'\"' || replace({column}, '\"', '\"\"') || '\"'"


_QUERIES = {
    "scan_text_dir": f"""
        select {_TRIP_STOPS.replace("stop_name", "replace(stop_name, 'St.', '\"St.\"') as stop_name")} from trip_stops""",
    "stack_files": f"select coalesce(op_day, 'other') || '.csv' as id, {_TRIP_STOPS} from trip_stops",
    "base_csv": "select * replace (nullif(evt_sta, '') as evt_sta) from base",
    "write_timetable": "select * from rows",
    "write_timetable_csv": f"""
        select route_group, direction,
          '"trp_op_day","route","direction","evt_sta",'
            || string_agg({_csv('stop_info')}, ',' order by stop_pos) as line
        from stops group by all
        union all
        select route_group, direction,
          {_csv('trp_op_day')} || ',' || {_csv('route')} || ',' || {_csv('direction')} || ','
            || {_csv('evt_sta')} || ',' || string_agg({_csv('display')}, ',' order by stop_pos)
        from grid group by route_group, direction, trip_rank, trp_op_day, route, evt_sta""",
    "clean_trip_stops": f"select {_TRIP_STOPS} from clean",
    "filter_route_group": f"""
        select {_TRIP_STOPS} from trip_stops where (route = '24' or route = '18') and direction = 'East'""",
    "select_columns": """
        select trp_number_trim, op_day as "Op Day", stop_name as "Stop Name", evt_sta as "Evt, Sta"
        from trip_stops""",
    "attach_stop_order": f"""
        select c.trp_number_trim, c.route, c.direction, c.place, c.stop, c.stop_name, c.op_day,
          c.departure, c.evt_sta, s.stop_order
        from clean c join stop_order s
          on c.route = s.route and c.direction = s.direction and c.stop = s.stop""",
    "restore_display": f"""
        select distinct g.trp_op_day, g.route, g.direction, g.evt_sta, g.stop_info, b.departure_save
        from grid g left join base b
          on g.trp_op_day = b.trp_op_day and g.route = b.route and g.direction = b.direction
          and g.evt_sta = b.evt_sta and g.stop_info = b.stop_info
          and g.dep_time_24h is not distinct from b.dep_time_24h""",
    "distinct_base": f"select distinct {_IDS}, stop_info, dep_time_24h from base",
    "stop_service_counts": "select route_group, direction, stop_info, cnt from stops",
    "anchor_stop": "select route_group, direction, stop_info, cnt from stops where is_anchor",
    "pivot_times": _wide("dep_time_24h", _IDS),
    "unpivot_times": f"select {_IDS}, stop_info, dep_time_24h from one_grid",
    "pivot_display": _wide("display", _IDS),
    "stop_positions": "select route_group, direction, stop_info, stop_pos from stops",
    "trip_ranks": "select * from trips",
    "split_departure": """
        select departure, time, meridian, count(*) as row_count from split group by all""",
    "normalize_clock": """
        select trp_number_trim, stop, departure, dep_time_24h,
          case when meridian = 'a' and time >= 1200 then time - 1200
            when meridian = 'p' and time < 1200 then time + 1200
            when meridian = 'x' and time < 1200 then time + 2400
            when meridian = 'x' then time + 1200 else time end as strict_time_24h
        from clock""",
    "display_time": "select trp_number_trim, stop, departure, departure_save from clock",
    "number_stop_order": """
        select c.trp_number_trim, c.route, c.direction, c.stop,
          try_cast(s.stop_order as double) as stop_order,
          try_cast(c.departure as double) as departure_number
        from clean c join stop_order s
          on c.route = s.route and c.direction = s.direction and c.stop = s.stop""",
    "trip_stop_labels": """
        select trp_number_trim || ' - ' || op_day as trp_op_day, stop_name || ' - ' || stop as stop_info, route
        from trip_stops""",
    "fill_placeholder": """
        select trp_number_trim, coalesce(route, '.....') as route, direction, place, stop, stop_name, op_day,
          coalesce(departure, '.....') as departure, coalesce(evt_sta, '') as evt_sta
        from trip_stops""",
    "timetable_base": "select * from base",
    "route_groups": """
        select g.route_group, g.route, count(c.route) as row_count
        from route_groups g left join clean c on g.route = c.route group by all""",
    "timetable_cells": """
        select route_group, direction, trip_rank, trp_op_day, route, evt_sta, stop_pos, stop_info, display
        from grid""",
    "timetable_rows": "select * from rows",
    "timetable_wide": _wide("display", f"trip_rank, {_IDS}"),
    "timetable_merged_routes": """
        select * from rows where route_group in (
          select route_group from route_groups group by route_group having count(*) > 1)""",
    "cell_conflicts": """, ordered as (
          select route_group, direction, trp_op_day, route, evt_sta, stop_info, dep_time_24h as t, departure_save as d,
            row_number() over (partition by all_keys order by dep_time_24h nulls last, departure_save nulls last) as nth,
            count(*) over (partition by all_keys) as n
          from (select distinct route_group, direction, trp_op_day, route, evt_sta, stop_info, dep_time_24h, departure_save,
              (route_group, direction, trp_op_day, route, evt_sta, stop_info) as all_keys from printed))
        select a.route_group, a.direction, a.trp_op_day, a.route, a.evt_sta, a.stop_info,
          a.t as earliest_time, b.t as latest_time, a.d as earliest_display, b.d as latest_display
        from ordered a join ordered b using (route_group, direction, trp_op_day, route, evt_sta, stop_info)
        where a.nth = 1 and a.n > 1 and b.nth = b.n""",
    "unparsed_departures": """
        select route, direction, departure, count(*) as row_count
        from split where departure is not null and not readable group by all""",
    "coverage_gaps": """
        select * from (
          select c.route, c.direction, c.stop, c.row_count,
            s.stop is null as not_in_stop_order,
            coalesce(c.route not in (select route from route_groups), true) as route_not_grouped,
            coalesce(c.direction not in ('East', 'West'), true) as direction_not_printed
          from (select route, direction, stop, count(*) as row_count from trip_stops group by all) c
          left join (select distinct route, direction, stop from stop_order) s
            on c.route = s.route and c.direction = s.direction and c.stop = s.stop)
        where not_in_stop_order or route_not_grouped or direction_not_printed""",
}

ORACLE = {name: _CTES + sql for name, sql in _QUERIES.items()}
ORACLE |= {f"{name}_all": _CTES.replace(_FEW, _ALL) + _QUERIES[name] for name in ("route_groups", "trip_ranks", "timetable_rows")}
ORACLE["scan_provenance"] = " union all ".join(
    f"select '{t}.parquet' as id, count(*) as row_count from {t}" for t in TABLES
)
