"""SQL counterparts of the registered queries, over the same tables, for an independent engine.

They are built from named pieces. Where the Spark side scans rows, these group runs; where it scans
one time line, these join.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
DEBOUNCE_US = 12 * 3600 * 1_000_000
DISCREPANCY_US = 36 * 3600 * 1_000_000
EXPIRY_US = 72 * 3600 * 1_000_000

_CTE: list[tuple[str, str]] = [
    ("ev", """
        select event_id, user_id, event_type, value, ts, date_trunc('second', ts) as event_time,
               cast(100000000 + user_id as varchar) as mmsi,
               cast(json_extract_string(props, '$.k') as int) as k
        from events"""),
    ("delivered", """
        select *, 0 as copy from ev
        union all select *, 1 as copy from ev where event_id % 50 = 0"""),
    ("pos", """
        select mmsi, event_time,
               event_time + to_seconds((case when k = 7 then 600 else (k % 6) * 60 end) + copy) as ingested_at,
               33.56e0 + 0.022e0 * (k % 10) as lat, -118.29e0 + 0.025e0 * (k // 10) as lon,
               case when event_type in ('view', 'click', 'purchase') then value / 100e0 else value / 8e0 end as sog,
               case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 5
                    when 'signup' then 8 else 15 end as nav_status_code,
               0 as "partition", event_id + copy * 1000000000 as "offset"
        from delivered"""),
    ("tagged", """
        select *, nullif(concat_ws(',',
               case when mmsi is null then 'mmsi:not_nullable' end,
               case when not regexp_full_match(mmsi, '[0-9]{9}') then 'mmsi:str_matches' end,
               case when lat is null then 'lat:not_nullable' end,
               case when lat < 33.55e0 or lat > 33.78e0 then 'lat:in_range' end,
               case when lon is null then 'lon:not_nullable' end,
               case when lon < -118.30e0 or lon > -118.05e0 then 'lon:in_range' end,
               case when sog is null then 'sog:not_nullable' end,
               case when sog < 0 or sog > 40 then 'sog:in_range' end,
               case when abs(epoch_us(ingested_at) - epoch_us(event_time)) > 300000000 then 'timestamp_skew' end
               ), '') as quality_failures
        from pos"""),
    ("valid", "select * from tagged where quality_failures is null"),
    ("clean", """
        select * exclude (rn) from (
            select *, row_number() over (partition by mmsi, event_time order by "offset") as rn from valid
        ) where rn = 1"""),
    ("corner", """
        select * from (values
          ('anch-b', 1, -118.30e0, 33.55e0), ('anch-b', 2, -118.20e0, 33.55e0), ('anch-b', 3, -118.20e0, 33.65e0), ('anch-b', 4, -118.30e0, 33.65e0),
          ('anch-b-7', 1, -118.275e0, 33.57e0), ('anch-b-7', 2, -118.23e0, 33.57e0), ('anch-b-7', 3, -118.23e0, 33.61e0), ('anch-b-7', 4, -118.275e0, 33.61e0),
          ('anch-g', 1, -118.20e0, 33.55e0), ('anch-g', 2, -118.06e0, 33.55e0), ('anch-g', 3, -118.06e0, 33.64e0),
          ('berth-1', 1, -118.20e0, 33.65e0), ('berth-1', 2, -118.10e0, 33.65e0), ('berth-1', 3, -118.10e0, 33.70e0), ('berth-1', 4, -118.15e0, 33.70e0), ('berth-1', 5, -118.15e0, 33.765e0), ('berth-1', 6, -118.20e0, 33.765e0),
          ('harbor-1', 1, -118.21e0, 33.66e0), ('harbor-1', 2, -118.095e0, 33.66e0), ('harbor-1', 3, -118.095e0, 33.77e0), ('harbor-1', 4, -118.21e0, 33.77e0)
        ) as t(zone_id, seq, x, y)"""),
    ("zone", """
        select * from (values
          ('anch-b', 'anchorage', 'Anchorage B', 1), ('anch-b-7', 'anchorage', 'Sub-Anchorage B-7', 1),
          ('anch-g', 'anchorage', 'Anchorage G', 1), ('berth-1', 'berth', 'Berth 1', 0), ('harbor-1', 'harbor', 'Harbor 1', 2)
        ) as t(zone_id, zone_type, zone_name, priority)"""),
    ("edge", """
        select zone_id, x as x1, y as y1,
               coalesce(lead(x) over w, first_value(x) over w) as x2,
               coalesce(lead(y) over w, first_value(y) over w) as y2
        from corner window w as (partition by zone_id order by seq)"""),
    ("area", "select zone_id, abs(sum(x1 * y2 - x2 * y1)) / 2 as area from edge group by zone_id"),
    ("place", "select distinct lat, lon from pos"),
    ("place_zone", """
        select p.lat, p.lon, e.zone_id
        from place p join edge e
          on (e.y1 > p.lat) <> (e.y2 > p.lat) and p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
        group by p.lat, p.lon, e.zone_id having count(*) % 2 = 1"""),
    ("place_best", """
        select lat, lon, zone_id, zone_type, zone_name from (
            select pz.lat, pz.lon, z.*, row_number() over (
                partition by pz.lat, pz.lon order by z.priority, a.area, z.zone_id) as rn
            from place_zone pz join zone z using (zone_id) join area a using (zone_id)
        ) where rn = 1"""),
    ("silver", """
        select c.mmsi, c.event_time, cast(c.event_time as date) as event_date, c.lat, c.lon, c.sog, c.nav_status_code,
               b.zone_id, b.zone_type, b.zone_name, c.ingested_at, c."partition", c."offset"
        from clean c left join place_best b on c.lat = b.lat and c.lon = b.lon"""),
    # --- state machine: tracks, runs of equal raw state, first row of a run that was held long enough
    ("obs", """
        select mmsi, event_time, epoch_us(event_time) as t, "offset" as off,
               row_number() over (partition by mmsi order by event_time, "offset") as rn,
               case when sog < 0.5 and zone_type = 'berth' then 'MOORED'
                    when sog < 0.5 and zone_type = 'anchorage' then 'AT_ANCHOR' else 'UNDERWAY' end as raw,
               zone_id,
               case when nav_status_code in (0, 8) then 'UNDERWAY' when nav_status_code = 1 then 'AT_ANCHOR'
                    when nav_status_code = 5 then 'MOORED' else 'OTHER' end as reported
        from silver"""),
    ("tracked", f"""
        select *, sum(case when gap is null or gap > {EXPIRY_US} then 1 else 0 end)
                      over (partition by mmsi order by rn) as track
        from (select *, t - lag(t) over (partition by mmsi order by rn) as gap from obs)"""),
    ("ran", """
        select *, sum(case when before is null or before <> raw then 1 else 0 end)
                      over (partition by mmsi, track order by rn) as run
        from (select *, lag(raw) over (partition by mmsi, track order by rn) as before from tracked)"""),
    ("run_start", "select mmsi, track, run, min(rn) as rn0, min(t) as t0 from ran group by all"),
    ("effect", f"""
        select r.mmsi, r.track, r.run, min(r.rn) as rn
        from ran r join run_start s using (mmsi, track, run)
        where (r.run = 1 and r.rn = s.rn0) or (r.run > 1 and r.rn > s.rn0 and r.t - s.t0 >= {DEBOUNCE_US})
        group by all"""),
    ("effective", """
        select r.*, lag(r.raw) over (partition by r.mmsi, r.track order by r.rn) as state_before
        from ran r join effect e on r.mmsi = e.mmsi and r.rn = e.rn"""),
    ("stated", """
        select r.*, last_value(e.raw ignore nulls) over (
                   partition by r.mmsi, r.track order by r.rn rows between unbounded preceding and current row) as state
        from ran r left join effective e on r.mmsi = e.mmsi and r.rn = e.rn"""),
    ("transition", """
        select mmsi, 'state_transition' as event_type, coalesce(state_before, 'UNKNOWN') as from_state, raw as to_state,
               case when raw <> 'UNDERWAY' then zone_id end as zone_id, raw as derived_state,
               cast(null as varchar) as reported_status, event_time as transition_time
        from effective where state_before is null or state_before <> raw"""),
    ("track_end", """
        select mmsi, track, max_by(state, rn) as state, max_by(event_time, rn) as event_time, max_by(t, rn) as t,
               track < max(track) over (partition by mmsi) as followed
        from stated group by mmsi, track"""),
    ("expired", """
        select mmsi, 'state_transition' as event_type, state as from_state, 'EXPIRED' as to_state,
               cast(null as varchar) as zone_id, 'EXPIRED' as derived_state, cast(null as varchar) as reported_status,
               event_time as transition_time
        from track_end where followed"""),
    ("comparable", """
        select *, reported = state as agrees,
               row_number() over (partition by mmsi, track order by rn) as cn
        from stated where reported <> 'OTHER'"""),
    ("cmp_ran", """
        select *, cn - row_number() over (partition by mmsi, track, agrees order by rn) as grp from comparable"""),
    ("cmp_run", "select mmsi, track, agrees, grp, min(cn) as cn0, max(cn) as cn1, min(t) as t0 from cmp_ran group by all"),
    ("flag_at", f"""
        select c.mmsi, c.track, r.cn1, min(c.rn) as rn
        from cmp_ran c join cmp_run r using (mmsi, track, agrees, grp)
        where not c.agrees and c.cn > r.cn0 and c.t - r.t0 >= {DISCREPANCY_US}
        group by all"""),
    ("discrepancy", """
        select c.mmsi, 'discrepancy_flagged' as event_type, c.state as derived_state, c.reported as reported_status,
               c.event_time as transition_time
        from flag_at f join comparable c on f.mmsi = c.mmsi and f.rn = c.rn
        union all
        select c.mmsi, 'discrepancy_cleared', c.state, c.reported, c.event_time
        from flag_at f join comparable c on f.mmsi = c.mmsi and f.track = c.track and c.cn = f.cn1 + 1"""),
    ("change", """
        select * from transition union all select * from expired
        union all select mmsi, event_type, null, null, null, derived_state, reported_status, transition_time from discrepancy"""),
    # --- models
    ("zones_seen", "select distinct zone_id, zone_type, zone_name from silver where zone_id is not null"),
    ("step", """
        select distinct mmsi, to_state as state, zone_id, transition_time as session_start
        from change where event_type = 'state_transition'"""),
    ("session_all", """
        select *, lead(session_start) over (partition by mmsi order by session_start, state = 'EXPIRED', state) as session_end
        from step"""),
    ("session", f"""
        select md5(s.mmsi || '|' || cast(s.session_start as varchar)) as session_id, s.mmsi, s.state, s.zone_id,
               z.zone_type, z.zone_name, s.session_start, s.session_end,
               date_diff('second', s.session_start, coalesce(s.session_end, {AS_OF})) as session_duration_seconds,
               s.session_end is null as is_ongoing
        from session_all s left join zones_seen z using (zone_id) where s.state <> 'EXPIRED'"""),
    ("next_session", """
        select session_id, lead(state) over w as next_state, lead(zone_type) over w as next_type
        from session window w as (partition by mmsi order by session_start)"""),
    ("dwell", """
        select s.session_id as anchorage_dwell_id, s.mmsi, s.zone_id as anchorage_id, s.zone_name as anchorage_name,
               s.session_start as arrival_time, s.session_end as departure_time,
               s.session_duration_seconds as dwell_seconds, s.is_ongoing,
               (n.next_state = 'MOORED' and n.next_type = 'berth') as proceeded_to_berth
        from session s left join next_session n using (session_id)
        where s.state = 'AT_ANCHOR' and s.zone_type = 'anchorage'"""),
    ("static", """
        select mmsi, 'SHIP ' || user_id || '-' || k || '   ' as ship_name, 'C' || k || ' ' as call_sign,
               k as ship_type_code, case when k % 2 = 0 then 'USLAX  ' else 'USLGB  ' end as destination,
               9000000 + user_id as imo_number, value / 10e0 as max_static_draught, ts as ingested_at, event_id as off
        from ev where event_type = 'signup'"""),
    ("vessel", """
        select mmsi, trim(ship_name) as ship_name, trim(call_sign) as call_sign, ship_type_code,
               trim(destination) as destination, imo_number, max_static_draught, ingested_at as last_seen_at
        from (select *, row_number() over (partition by mmsi order by ingested_at desc, off desc) as rn from static)
        where rn = 1"""),
    ("snapshot", f"""
        select d.mmsi, v.ship_name, d.anchorage_name, d.arrival_time,
               date_diff('minute', d.arrival_time, {AS_OF}) as minutes_at_anchor
        from dwell d left join vessel v using (mmsi) where d.is_ongoing"""),
    ("located", """
        select s.mmsi, s.event_time, s."offset", s.nav_status_code,
               (select max_by(t.to_state, (t.transition_time, t.to_state = 'EXPIRED', t.to_state)) from step0 t
                where t.mmsi = s.mmsi and t.transition_time <= s.event_time) as derived_state
        from silver s"""),
    ("compared", """
        select *, derived_state = reported as agrees from (
            select *, case when nav_status_code in (0, 8) then 'UNDERWAY' when nav_status_code = 1 then 'AT_ANCHOR'
                           when nav_status_code = 5 then 'MOORED' else 'OTHER' end as reported from located)
        where reported <> 'OTHER' and derived_state is not null"""),
    # --- messages
    ("feed", """
        select *, case event_type when 'signup' then 'ShipStaticData' when 'purchase' then 'BaseStationReport'
                       else 'PositionReport' end as message_type,
               case when k % 40 <> 39 then cast(user_id + 100000000 as varchar) end as number,
               33.56e0 + 0.022e0 * (k % 10) as lat, -118.29e0 + 0.025e0 * (k // 10) as lon
        from ev"""),
    ("routed", """
        select event_id, case when event_type in ('error', 'purchase') then 'ais.deadletter'
                    when event_type = 'signup' then 'ais.raw.static' else 'ais.raw.positions' end as topic,
               case when event_type <> 'error' then number end as "key"
        from feed"""),
    # --- zones derived from tables
    ("czone", """
        select 'zone-' || lpad(cast(c_custkey as varchar), 9, '0') as zone_id,
               case c_custkey % 3 when 0 then 'anchorage' when 1 then 'berth' else 'harbor' end as zone_type,
               'NOAA' as authority, 'customer ' || c_custkey as source_ref, c_name as name, c_custkey,
               ((c_custkey // 40) % 300) - 150 + 0.02e0 * (c_custkey % 40) + 0.001e0 * (c_custkey % 7) as x0,
               (c_custkey // 12000) - 60 + 0.01e0 * ((c_custkey * 13) % 40) as y0,
               0.05e0 + 0.002e0 * (c_custkey % 11) as w, 0.15e0 + 0.003e0 * (c_custkey % 5) as h
        from customer"""),
    ("crect", """
        select zone_id, 1 as sign, x0 as rx0, y0 as ry0, x0 + w as rx1, y0 + h as ry1 from czone
        union all select zone_id, -1, x0 + w * 0.25e0, y0 + h * 0.25e0, x0 + w * 0.75e0, y0 + h * 0.75e0 from czone where c_custkey % 3 = 0
        union all select zone_id, 1, x0 + w * 2, y0, x0 + w * 2.5e0, y0 + h from czone where c_custkey % 5 = 0"""),
    ("waypoint", """
        select l_orderkey, l_linenumber as seq,
               -118.2e0 + (0.001e0 + l_quantity / 5000e0) * cos(l_linenumber * (2 * pi() / 8)) as x,
               33.7e0 + (0.001e0 + l_quantity / 5000e0) * sin(l_linenumber * (2 * pi() / 8)) as y
        from lineitem"""),
    ("ring_edge", """
        select l_orderkey, x as x1, y as y1, seq,
               coalesce(lead(x) over w, first_value(x) over w) as x2, coalesce(lead(y) over w, first_value(y) over w) as y2,
               first_value(x) over w as ox, first_value(y) over w as oy,
               last_value(x) over (w rows between unbounded preceding and unbounded following) as x_last,
               last_value(y) over (w rows between unbounded preceding and unbounded following) as y_last
        from waypoint window w as (partition by l_orderkey order by seq, x, y)"""),
    ("knot", """
        select distinct a.l_orderkey from ring_edge a join ring_edge b using (l_orderkey)
        where sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1))
            * sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) < 0
          and sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
            * sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) < 0"""),
    ("ring", """
        select l_orderkey, count(*) as corners, count(*) > 1 and any_value(x_last = ox and y_last = oy) as returns,
               abs(sum((x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy))) / 2 as area
        from ring_edge group by l_orderkey"""),
    ("mapped", """
        select p_partkey, case when p_partkey % 3 = 0 then label when p_partkey % 3 = 1 then p_name end as name,
               case when p_partkey % 4 = 1 then label end as operator,
               case when p_partkey % 5 = 2 then label else p_brand end as brand
        from (select *, ['Pier 400', 'TraPac', 'Long Beach Container Terminal', 'Everport', 'ITS Terminal', 'APL',
                         'Yusen', 'PCT', 'Terminal Island', 'Port of Los Angeles'][p_partkey % 10 + 1] as label from part)"""),
]
_CTE.insert(
    [n for n, _ in _CTE].index("located"),
    ("step0", "select mmsi, to_state, transition_time from change where event_type = 'state_transition'"),
)


def _with(select: str, **instead: str) -> str:
    """`select` preceded by the pieces it needs, some of them replaced."""
    pieces = [(name, instead.get(name, body)) for name, body in _CTE]
    bodies, needed, todo = dict(pieces), set(), [select]
    while todo:
        words = set(todo.pop().replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in bodies.keys() & words - needed:
            needed.add(name)
            todo.append(bodies[name])
    parts = ",\n".join(f"{name} as ({body})" for name, body in pieces if name in needed)
    return f"with {parts}\n{select}" if parts else select


def _tag(*columns: str) -> str:
    """Operator by alias over the lower-cased, blank-joined names."""
    text = "lower(" + " || ".join(f"coalesce({c}, '') || ' '" for c in columns) + ")"
    rules = [
        ("APM", ["apm terminals", "pier 400", "apm"]), ("TraPac", ["trapac"]),
        ("LBCT", ["long beach container terminal", "lbct"]), ("Everport", ["everport"]),
        ("ITS", ["international transportation service", "its terminal"]), ("APL", ["apl "]),
        ("YTI", ["yusen", "yti"]), ("PCT", ["pacific container terminal", "pct"]),
    ]
    cases = " ".join(
        "when " + " or ".join(f"contains({text}, '{a}')" for a in aliases) + f" then '{code}'" for code, aliases in rules
    )
    return f"case {cases} end"


def _check(check: str, table: str, column: str, severity: str, failures: str) -> str:
    bad = "warn" if severity == "warn" else "error"
    return (
        f"select '{check}' as \"check\", '{table}' as \"table\", '{column}' as \"column\", '{severity}' as severity, "
        f"cast(n as bigint) as failures, case when n = 0 then 'pass' else '{bad}' end as status from ({failures}) q(n)"
    )


def _fresh(table: str, source: str, column: str, warn: int, error: int) -> str:
    return f"""
        select 'freshness' as "check", '{table}' as "table", '{column}' as "column", status as severity,
               cast(case when status = 'pass' then 0 else 1 end as bigint) as failures, status
        from (select case when age is null or age > {error * 60_000_000} then 'error'
                          when age > {warn * 60_000_000} then 'warn' else 'pass' end as status
              from (select epoch_us(TIMESTAMP '2024-01-31 01:00:00') - epoch_us(max({column})) as age from {source}))"""


def _unique(table: str, column: str, source: str | None = None) -> str:
    return _check("unique", table, column, "error",
                  f"select count(*) from (select {column} from {source or table} where {column} is not null "
                  f"group by {column} having count(*) > 1)")


def _union(*selects: str) -> str:
    return "\nunion all\n".join(selects)


_PAIR_COUNT = "count(distinct derived_state || '/' || reported)"
_AGREEMENT = f"""
    select mmsi, count(*) as n_comparable,
           round(sum(case when agrees then 1 else 0 end) / count(*), 6) as agreement_rate,
           {_PAIR_COUNT} as state_pairs, {_PAIR_COUNT} <= 1 as trivial_window
    from (select c.* from compared c where {{where}}) group by mmsi
    union all
    select null, count(*), round(sum(case when agrees then 1 else 0 end) / nullif(count(*), 0), 6),
           {_PAIR_COUNT}, {_PAIR_COUNT} <= 1
    from (select c.* from compared c where {{where}})"""


def _trailing(hours: int) -> str:
    return (
        f"(select max(event_time) from silver ) - interval {hours} hour <= event_time"
    )


_TOP5 = f"""c.mmsi in (select mmsi from silver where {_trailing(240)} group by mmsi order by count(*) desc, mmsi limit 5)"""

_DAY_SPLIT = """
    select mmsi, cast(day as date) as activity_date, state, count(*) as session_count,
           cast(sum(date_diff('second', greatest(session_start, day), least(session_end, day + interval 1 day))) as bigint)
               as total_duration_seconds
    from (select *, unnest(generate_series(date_trunc('day', session_start),
                 greatest(date_trunc('day', session_end - interval 1 microsecond), date_trunc('day', session_start)),
                 interval 1 day)) as day
          from session where session_end is not null)
    group by all"""


def _episodes(bounded: bool) -> str:
    open_at_next = """
        and (c.transition_time <= (select min(g.transition_time) from discrepancy g where g.mmsi = f.mmsi
             and g.event_type = 'discrepancy_flagged' and g.transition_time > f.transition_time)
             or not exists (select 1 from discrepancy g where g.mmsi = f.mmsi
             and g.event_type = 'discrepancy_flagged' and g.transition_time > f.transition_time))""" if bounded else ""
    return f"""
        select md5(mmsi || '|' || cast(flagged_at as varchar)) as discrepancy_event_id, mmsi, derived_state, reported_status,
               flagged_at, cleared_at, date_diff('second', flagged_at, coalesce(cleared_at, {AS_OF})) as duration_seconds,
               cleared_at is null as is_ongoing
        from (select f.mmsi, f.transition_time as flagged_at, f.derived_state, f.reported_status,
                     min(c.transition_time) as cleared_at
              from discrepancy f left join discrepancy c
                on f.mmsi = c.mmsi and c.event_type = 'discrepancy_cleared' and c.transition_time > f.transition_time
                {open_at_next}
              where f.event_type = 'discrepancy_flagged' group by all)"""


_METRES = """
    select *, 6378137e0 / sqrt(w2) * cos(radians(lat)) * pi() / 180 as east,
           6378137e0 * (1 - 0.00669437999014e0) / (w2 * sqrt(w2)) * pi() / 180 as north
    from (select *, 1 - 0.00669437999014e0 * sin(radians(lat)) * sin(radians(lat)) as w2 from ({source}))"""

# Ways of odd orders are closed only if their last point happens to equal the first.
_CLOSED_AREA = """(l_orderkey % 2 = 0 and corners >= 3 or l_orderkey % 2 = 1 and returns and corners >= 4)
    and area > 0 and l_orderkey not in (select l_orderkey from knot )"""

_SELECT = {
    "quality_tagged": """select mmsi, event_time, "offset", quality_failures is null as quality_ok, quality_failures from tagged""",
    "quarantine_summary": """
        select quality_failures, count(*) as n, count(distinct mmsi) as vessels from tagged
        where quality_failures is not null group by quality_failures""",
    "quality_split": "select quality_failures is null as quality_ok, count(*) as n from tagged group by 1",
    "silver_positions": 'select * replace (round(lat, 6) as lat, round(lon, 6) as lon, round(sog, 6) as sog) from silver',
    "silver_table": """
        select event_date, count(*) as n, count(zone_id) as in_zone, max("offset") as max_offset from silver group by event_date""",
    "zone_matches": """
        select v.mmsi, v.event_time, v."offset", p.zone_id, z.zone_type
        from valid v left join place_zone p on v.lat = p.lat and v.lon = p.lon left join zone z on z.zone_id = p.zone_id""",
    "best_zone": """
        select v.mmsi, v.event_time, v."offset", b.zone_id, b.zone_type, b.zone_name
        from valid v left join place_best b on v.lat = b.lat and v.lon = b.lon""",
    "best_zone_large": """
        select v.mmsi, v.event_time, case when v."offset" % 3 = 0 then null else v."offset" % 10 end as "offset", b.zone_id, b.zone_type, b.zone_name
        from valid v left join place_best b on v.lat = b.lat and v.lon = b.lon""",
    "zone_occupancy": """
        select zone_id, zone_type, count(*) as positions, count(distinct mmsi) as vessels from silver group by zone_id, zone_type""",
    "match_summary": """
        select count(*) as total, count(zone_id) as matched,
               count(distinct case when zone_id is not null then mmsi || '/' || lat || '/' || lon end) as matched_distinct
        from silver""",
    "vessel_zones": "select distinct mmsi, zone_id, zone_type, zone_name from silver where zone_id is not null",
    "zones_lookup": "select * from zones_seen",
    "zone_priority": """
        select p.zone_id, z.zone_type, coalesce(z.priority, null) as priority, round(a.area, 9) as area, count(*) as n
        from valid v left join place_zone p on v.lat = p.lat and v.lon = p.lon
        left join zone z on z.zone_id = p.zone_id left join area a on a.zone_id = p.zone_id group by all""",
    "zone_overlaps": """
        select * from (
            select a.zone_id as zone_a, a.zone_type as type_a, b.zone_id as zone_b, b.zone_type as type_b,
                   round(p.area, 8) as overlap_area,
                   case when a.zone_type = b.zone_type then 'error' else 'warning' end as severity
            from (select i.zone_id as id_a, j.zone_id as id_b, sum(i.sign * j.sign
                         * (least(i.rx1, j.rx1) - greatest(i.rx0, j.rx0)) * (least(i.ry1, j.ry1) - greatest(i.ry0, j.ry0))) as area
                  from crect i join crect j on i.zone_id < j.zone_id
                   and least(i.rx1, j.rx1) > greatest(i.rx0, j.rx0) and least(i.ry1, j.ry1) > greatest(i.ry0, j.ry0)
                  group by 1, 2) p
            join czone a on a.zone_id = p.id_a join czone b on b.zone_id = p.id_b
            where b.c_custkey <> a.c_custkey + 3 and p.area > 1e-12)""",
    "zone_faults": """
        select zone_id, zone_type, case c_custkey % 4 when 1 then 'spike' when 2 then 'self_touch' else 'crossing' end as fault
        from czone where c_custkey % 4 <> 0""",
    "valid_zone_overlaps": """
        select a.zone_id as zone_a, b.zone_id as zone_b, round(p.area, 8) as overlap_area,
               case when a.zone_type = b.zone_type then 'error' else 'warning' end as severity
        from (select i.zone_id as id_a, j.zone_id as id_b, sum(i.sign * j.sign
                     * (least(i.rx1, j.rx1) - greatest(i.rx0, j.rx0)) * (least(i.ry1, j.ry1) - greatest(i.ry0, j.ry0))) as area
              from crect i join crect j on i.zone_id < j.zone_id
               and least(i.rx1, j.rx1) > greatest(i.rx0, j.rx0) and least(i.ry1, j.ry1) > greatest(i.ry0, j.ry0)
              group by 1, 2) p
        join czone a on a.zone_id = p.id_a join czone b on b.zone_id = p.id_b
        where a.c_custkey % 4 = 0 and b.c_custkey % 4 = 0 and p.area > 1e-12""",
    "customer_zone_matches": """
        select s.s_suppkey, z.zone_id, z.zone_type
        from (select s_suppkey, ((s_suppkey // 4) % 300) - 150 + 0.02e0 * ((s_suppkey * 7) % 40) + 0.00517e0 as lon,
                     (s_suppkey // 1200) - 60 + 0.01e0 * ((s_suppkey * 29) % 40) + 0.00713e0 as lat from supplier) s
        left join (
            select q.s_suppkey, r.zone_id from (
                select s_suppkey, ((s_suppkey // 4) % 300) - 150 + 0.02e0 * ((s_suppkey * 7) % 40) + 0.00517e0 as lon,
                       (s_suppkey // 1200) - 60 + 0.01e0 * ((s_suppkey * 29) % 40) + 0.00713e0 as lat from supplier) q
            join crect r on q.lon > r.rx0 and q.lon < r.rx1 and q.lat > r.ry0 and q.lat < r.ry1
            group by q.s_suppkey, r.zone_id having sum(r.sign) > 0) h on h.s_suppkey = s.s_suppkey
        left join czone z on z.zone_id = h.zone_id""",
    "geojson_zones": """
        select zone_id, zone_type, authority, source_ref, name, cast(case when c_custkey % 5 = 0 then 2 else 1 end as int) as polygons,
               cast(n as int) as rings, cast(5 * n as int) as points, round(a, 8) as area
        from czone join (select zone_id, count(*) as n, sum(sign * (rx1 - rx0) * (ry1 - ry0)) as a from crect group by zone_id) using (zone_id)""",
    "merged_zones": """
        select zone_type, authority, count(*) as n, sum(case when name is null then 1 else 0 end)::bigint as unnamed from (
            select zone_type, authority, name from czone
            union all select 'anchorage', 'CFR', s_name from supplier
            union all select 'berth', 'OSM', null from part) group by all""",
    "zone_checks": _union(
        *[_check("not_null", "zones", c, "error",
                 "select count(*) from czone where zone_id like '%5'" if c == "source_ref" else "select 0")
          for c in ("zone_id", "zone_type", "authority", "source_ref")],
        _check("accepted_values", "zones", "zone_type", "error",
               "select count(distinct length(name)) from czone where zone_type = 'harbor'"),
        _check("accepted_values", "zones", "authority", "error", "select 0"),
        _check("unique", "zones", "zone_id", "error", "select 0"),
        _check("valid_shape", "zones", "shape", "error", "select count(*) from czone where c_custkey % 4 <> 0"),
        *[_check(f"no_{fault}", "zones", "shape", "error", f"select count(*) from czone where c_custkey % 4 = {n}")
          for fault, n in (("spike", 1), ("self_touch", 2), ("crossing", 3), ("empty", 9), ("overlap", 9))],
    ),
    "waypoint_rings": "select l_orderkey, cast(case when corners = 1 or returns then corners else corners + 1 end as int) as points, round(area, 9) as area from ring",
    "circle_zones": f"""
        select s_suppkey, 129 as points, round(0.5e0 * 128 * sin(2 * pi() / 128) * (radius / east) * (radius / north), 8) as area,
               round(2 * radius / east, 7) as width, round(2 * radius / north, 7) as height
        from ({_METRES.format(source="select s_suppkey, 33.5e0 as lat, abs(s_acctbal) * 0.9144e0 as radius from supplier")})""",
    "line_buffers": f"""
        select o_orderkey, len > 0 as has_area, case when len > 0 then round(len, 7) end as width,
               case when len > 0 then round(20e0 / north, 7) end as height,
               case when len > 0 then round(len * 20e0 / north, 9) end as area
        from ({_METRES.format(source="select o_orderkey, 33.7e0 as lat, (o_orderkey % 17) / 1000e0 as len from orders")})""",
    "bent_line_buffers": f"""
        select o_orderkey, cast(7 + steps as int) as points, true as usable,
               round((20e0 * (len1 + len2) - 100e0 * tan(turn / 2) + steps * 50e0 * sin(turn / steps)) / east / north, 10) as area
        from (select *, ceil(turn / (pi() / 32)) as steps from (
            select *, dx1 * east as len1, sqrt(dx2 * east * dx2 * east + dy2 * north * dy2 * north) as len2,
                   atan2(dy2 * north, dx2 * east) as turn
            from ({_METRES.format(source="""select o_orderkey, 33.7e0 + (0.001e0 + (o_orderkey % 13) / 10000e0) / 2 as lat,
                       0.002e0 + (o_orderkey % 17) / 10000e0 as dx1, 0.0013e0 - (o_orderkey % 29) / 10000e0 as dx2,
                       0.001e0 + (o_orderkey % 13) / 10000e0 as dy2 from orders""")})))""",
    "closed_ways": f"select l_orderkey, ({_CLOSED_AREA}) as is_area from ring",
    "largest_outer_rings": f"""
        select o_custkey as element_id, round(max(area), 9) as area from orders join ring on l_orderkey = o_orderkey
        where o_orderstatus = 'F' and {_CLOSED_AREA} group by o_custkey""",
    "dms_decimal": """
        select event_id, case when k % 3 = 2 then null else round(
               case when k % 3 <= 1 and event_id % 2 = 0 then -1 else 1 end
               * ((k % 120) + (k % 60) / 60e0 + ((event_id % 600) / 10e0) / 3600e0), 6) end as degrees from ev""",
    "operator_tags": f"""
        select p_partkey, name, {_tag("name", "operator", "brand")} as operator from mapped
        where name is null or name not in ('Port of Los Angeles', 'Port of Long Beach', 'Terminal Island')""",
    "mapped_berths": f"""
        select 'osm-way-' || p_partkey as zone_id, 'berth' as zone_type, 'OSM' as authority,
               'https://www.openstreetmap.org/way/' || p_partkey as source_ref, name,
               {_tag("name", "operator", "brand")} as operator, operator as osm_operator_tag from mapped
        where p_partkey % 4 <> 3 and (name is null or name not in ('Port of Los Angeles', 'Port of Long Beach', 'Terminal Island'))""",
    "skipped_areas": """
        select reason, count(*) as n from (
            select case when name in ('Port of Los Angeles', 'Port of Long Beach', 'Terminal Island') then 'excluded name'
                        when p_partkey % 4 = 3 then 'not a closed area' end as reason from mapped)
        where reason is not null group by reason""",
    "attribution_report": f"""
        select count(*) as zones, sum(case when {_tag("name", "operator", "brand")} is null then 1 else 0 end)::bigint as unattributed
        from mapped""",
    "missing_operators": f"""
        select operator from (values ('APM'), ('TraPac'), ('LBCT'), ('Everport'), ('ITS'), ('APL'), ('YTI'), ('PCT')) t(operator)
        where operator not in (select op from (select {_tag("name", "operator")} as op from mapped) where op is not null)""",
    "named_lines": """
        select p_partkey, name, 'noaa-breakwater-' || lower(replace(name, ' ', '-')) as zone_id from (
            select p_partkey, coalesce(name, 'Unnamed Breakwater '
                   || row_number() over (partition by name is null order by p_partkey)) as name from mapped)""",
    "raw_state": "select raw as raw_state, count(*) as n from obs group by raw",
    "reported_bucket": """
        select s.nav_status_code, o.reported, count(*) as n
        from silver s join obs o on o.mmsi = s.mmsi and o.off = s."offset" group by all""",
    "vessel_states": 'select mmsi, event_time, off as "offset", raw, state, reported from stated',
    "state_transitions": """
        select mmsi, from_state, to_state, zone_id, transition_time from change where event_type = 'state_transition'""",
    "discrepancy_events": "select * from discrepancy",
    "state_changes": f"""
        select * from change union all
        select mmsi, 'state_transition', state, 'EXPIRED', null, 'EXPIRED', null, event_time from track_end
        where not followed and epoch_us(TIMESTAMP '2024-02-02 12:00:00') >= t + {EXPIRY_US}""",
    "vessel_sessions": "select * from session",
    "berth_visits": """
        select session_id as berth_visit_id, mmsi, zone_id as berth_id, zone_name as berth_name, session_start as arrival_time,
               session_end as departure_time, session_duration_seconds, is_ongoing
        from session where state = 'MOORED' and zone_type = 'berth'""",
    "anchorage_dwell": "select * from dwell",
    "activity_daily": """
        select mmsi, cast(session_start as date) as activity_date, state, count(*) as session_count,
               cast(sum(session_duration_seconds) as bigint) as total_duration_seconds
        from session where session_end is not null group by all""",
    "activity_daily_split": _DAY_SPLIT,
    "discrepancy_episodes": _episodes(False),
    "discrepancy_episodes_bounded": _episodes(True),
    "dim_vessels": "select * from vessel",
    "at_anchor_snapshot": "select * from snapshot",
    "ships_at_anchor": "select count(*) as ships_at_anchor from snapshot",
    "snapshot_export": "select * from snapshot",
    "presented_snapshot": """
        select mmsi as "MMSI", ship_name as "Ship", anchorage_name as "Anchorage", arrival_time as "Arrived",
               minutes_at_anchor as "Minutes at anchor" from snapshot""",
    "staged_state_changes": """
        select mmsi, event_type, from_state, to_state, zone_id, derived_state, reported_status, transition_time from change""",
    "staged_positions": """
        select mmsi, event_time, event_date, round(lat, 6) as lat, round(lon, 6) as lon, round(sog, 6) as sog, nav_status_code,
               zone_id, zone_type, zone_name, ingested_at from silver""",
    "inspected_silver": """
        select mmsi, event_time, "offset", (select count(*) from silver) as n from silver order by "offset" desc limit 10""",
    "source_views": """
        select zone_type, count(*) as n, count(distinct mmsi) as vessels from silver group by zone_type""",
    "asof_state": 'select mmsi, event_time, "offset", derived_state from located',
    "top_vessels": "select mmsi, count(*) as n from silver group by mmsi order by count(*) desc, mmsi limit 5",
    "trailing_window": f"""
        select count(*) as n, min(event_time) as first, max(event_time) as last from silver where {_trailing(240)}""",
    "agreement": _AGREEMENT.format(where=f"{_trailing(240)} and {_TOP5}"),
    "agreement_all_vessels": _AGREEMENT.format(where=_trailing(720)),
    "uncovered_vessels": f"""
        select distinct mmsi from silver where {_trailing(48)}
        except select mmsi from compared where {_trailing(48)}""",
    "dq_unique": _union(
        _unique("anchorage_dwell", "anchorage_dwell_id", "dwell"), _unique("lineitem", "l_orderkey"),
        _unique("orders", "o_orderkey"),
    ),
    "dq_not_null": _union(
        *[_check("not_null", "positions_silver", c, "error", f"select count(*) from silver where {c} is null")
          for c in ("mmsi", "event_time", "zone_id")],
        *[_check("not_null", "vessel_sessions", c, "warn", f"select count(*) from session where {c} is null")
          for c in ("session_id", "mmsi", "session_end")],
    ),
    "dq_accepted": _union(
        _check("accepted_values", "vessel_sessions", "state", "error",
               "select count(distinct state) from session where state not in ('UNDERWAY', 'AT_ANCHOR', 'MOORED')"),
        _check("accepted_values", "vessel_state_changes", "to_state", "error",
               "select count(distinct to_state) from change where to_state not in ('UNDERWAY', 'AT_ANCHOR', 'MOORED')"),
        _check("accepted_values", "orders", "o_orderpriority", "warn",
               "select count(distinct o_orderpriority) from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')"),
    ),
    "dq_relationships": _union(
        _check("relationships", "anchorage_dwell", "mmsi", "warn",
               "select count(*) from dwell where mmsi not in (select mmsi from vessel )"),
        _check("relationships", "orders", "o_custkey", "error",
               "select count(*) from orders where o_custkey not in (select c_custkey from customer)"),
        _check("relationships", "events", "user_id", "error",
               "select count(*) from events where user_id not in (select s_suppkey from supplier)"),
    ),
    "dq_freshness": _union(
        _fresh("positions_silver", "silver", "ingested_at", 15, 30),
        _fresh("vessel_state_changes", "change", "transition_time", 15, 30),
        _fresh("ship_static", "static", "ingested_at", 60, 180),
    ),
    "routed_messages": """
        select topic, count(*) as n, sum(case when "key" is null then 1 else 0 end)::bigint as without_key,
               count(distinct "key") as "keys" from routed group by topic""",
    "dead_letters": """
        select 'message is not valid JSON' as error, count(*) as n, sum(case when k % 5 <> 3 then 1 else 0 end)::bigint as with_text from feed
        where event_type = 'error' having count(*) > 0""",
    "source_filter": """
        select message_type, count(*) as n from feed
        where lat between 33.57e0 and 33.70e0 and lon between -118.25e0 and -118.10e0
          and message_type in ('PositionReport', 'ShipStaticData') group by message_type""",
    "decode_audit": """
        select count(*) as total, sum(case when event_id % 25 = 0 then 1 else 0 end)::bigint as failed from routed
        where topic = 'ais.raw.positions'""",
    "decoded_sample": """
        select f.number as "key", 'SHIP ' || f.user_id as ship_name, round(f.lat, 6) as latitude, round(f.lon, 6) as longitude,
               round(case when f.event_type in ('view', 'click', 'purchase') then f.value / 100e0 else f.value / 8e0 end, 6) as sog
        from feed f join routed r using (event_id) where r.topic = 'ais.raw.positions' and f.event_id % 25 <> 0
        order by f.event_id limit 10""",
    "decoded_positions": """
        select f.number as mmsi, f.event_time, f.ts as ingested_at, round(f.lat, 6) as lat, round(f.lon, 6) as lon,
               round(case when f.event_type in ('view', 'click', 'purchase') then f.value / 100e0 else f.value / 8e0 end, 6) as sog,
               case f.event_type when 'view' then 0 when 'click' then 1 else 15 end as nav_status_code,
               0 as "partition", f.event_id as "offset"
        from feed f join routed r using (event_id) where r.topic = 'ais.raw.positions' and f.event_id % 25 <> 0""",
    "decoded_static": """
        select f.number as mmsi, 'SHIP ' || f.user_id as ship_name, 'C' || f.k || ' ' as call_sign, f.k as ship_type_code,
               case when f.k % 2 = 0 then 'USLAX  ' else 'USLGB  ' end as destination, 9000000 + f.user_id as imo_number,
               round(f.value / 10e0, 6) as max_static_draught, f.ts as ingested_at
        from feed f join routed r using (event_id) where r.topic = 'ais.raw.static' and f.event_id % 25 <> 0""",
    "newest_positions": 'select mmsi, event_time, "offset" from clean order by event_time desc, "offset" limit 10',
    "numbered_orders": "select o_orderkey, row_number() over (order by o_orderkey) as n from orders",
    "minute_differences": """
        select event_id, date_diff('minute', ts, TIMESTAMP '2024-01-15 12:00:30') as minutes,
               date_diff('second', ts, TIMESTAMP '2024-01-15 12:00:30') as seconds from ev""",
    "surrogate_keys": "select event_id, md5(mmsi || '|' || cast(ts as varchar)) as \"key\" from ev",
}

_SELECT |= {
    "stream_silver": _SELECT["silver_positions"],
    "stream_compacted": """
        select event_date, count(*) as n, count(distinct mmsi) as vessels, max(event_time) as newest from silver group by event_date""",
    "stream_quarantine": _SELECT["quarantine_summary"],
    "stream_ship_static": "select * exclude (off) replace (round(max_static_draught, 6) as max_static_draught) from static",
    "stream_routed": _SELECT["routed_messages"],
    "stream_deduplicated": "select distinct mmsi, event_time from pos",
}

# State stream: a row is late if the watermark of its slice, two days behind the newest time of the slices before, has
# passed it; what the last watermark has passed is applied, and vessels silent for the expiry by then have expired.
_STREAMED = f"""
    select *, least(4, greatest(0, cast(floor((epoch_us(event_time) - lo + (("offset" % 1000000000 * 7919) % 7 - 3) * 43200000000)
                  / cast((hi - lo) // 5 + 1 as double)) as bigint)) + "offset" // 1000000000) as slice
    from pos, (select min(epoch_us(event_time)) as lo, max(epoch_us(event_time)) as hi from pos)"""
_MARKED = f"""
    select s.*, coalesce((select max(epoch_us(b.event_time)) - 172800000000 from ({_STREAMED}) b where b.slice < n.slice), 0) as mark
    from ({_STREAMED}) s join (select unnest([0, 1, 2, 3, 4]) as slice) n on s.slice = n.slice"""
_LAST_MARK = "(select max(epoch_us(event_time)) - 172800000000 from pos )"
_APPLIED = f"""
    select a.mmsi, a.event_time, cast(a.event_time as date) as event_date, a.lat, a.lon, a.sog, a.nav_status_code,
           b.zone_id, b.zone_type, b.zone_name, a.ingested_at, a."partition", a."offset"
    from ({_MARKED}) a left join place_best b on a.lat = b.lat and a.lon = b.lon
    where epoch_us(a.event_time) > a.mark and epoch_us(a.event_time) <= {_LAST_MARK}"""
_STATE = f"""
    select * from change union all
    select mmsi, 'state_transition', state, 'EXPIRED', null, 'EXPIRED', null, event_time from track_end
    where not followed and {_LAST_MARK} > t + {EXPIRY_US}"""

ORACLE = {name: _with(select) for name, select in _SELECT.items()} | {
    "stream_state": _with(_STATE, silver=_APPLIED),
    "stream_state_messages": _with(f"""
        select 'vessel.state.changes' as topic, event_type, derived_state, count(*) as n, count(distinct mmsi) as vessels,
               max(transition_time) as newest from ({_STATE}) group by all""", silver=_APPLIED),
    "stream_late_rows": _with(f"select mmsi, count(*) as late_rows from ({_MARKED}) where epoch_us(event_time) <= mark group by mmsi"),
}
