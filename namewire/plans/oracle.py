"""The given tables' views in SQL, for checking results with another engine."""

from __future__ import annotations

from namewire.schema import JUNK_NAME

LINES = f"""lines as (
  select event_id, ts, concat_ws(chr(9),
    concat(strftime(ts, '%Y%m%d%H%M%S'), '-', event_id), strftime(ts, '%Y%m%d%H%M%S'),
    repeat(chr(9), 20),
    concat(listed, case when event_id % 5 = 0 then ';' else '' end,
           case when event_id % 13 = 0 then ';{JUNK_NAME},7' else '' end),
    '', '', case when event_id % 17 = 0 then null else '' end) as value
  from (select event_id, ts, event_id % (select count(*) from documents) as doc_id from events) e
  join (select doc_id, array_to_string(list_transform(
          string_split(translate(text, chr(10) || chr(9) || chr(13), '   '), ' '),
          lambda w, i: concat(w, ',', i)), ';') as listed from documents) d using (doc_id))"""

VALID = """valid as (
  select event_id, ts, value, string_split(value, chr(9)) as f from lines
  where len(string_split(value, chr(9))) = 27)"""

NAMES = f"""names as (
  select publish_date, ts, string_split(entry, ',')[1] as name from (
    select substr(f[2], 1, 8) as publish_date, ts, unnest(string_split(f[24], ';')) as entry from valid
    where try_strptime(substr(f[2], 1, 8), '%Y%m%d') is not null)
  where string_split(entry, ',')[1] not in ('', '{JUNK_NAME}'))"""

COUNTS = f"""{LINES}, {VALID}, {NAMES}, counts as (
  select publish_date, name, count(*) as cnt from names group by all)"""

CHANGELOG = """changelog as (
  select event_id as seq, cast(user_id as varchar) as name,
    case when event_id % 7 = 0 then 0 else cast(floor(value) as bigint) end as cnt, ts from events)"""

STATE = f"""{CHANGELOG}, state as (
  select name, cnt from changelog qualify row_number() over (partition by name order by seq desc) = 1),
  live as (select * from state where cnt <> 0)"""


def machine(number: str) -> str:
    return f"concat(case ({number}) % 3 when 0 then 'c' when 1 then 'm' else 'r' end, {number})"


PRICES = f"""prices as (
  select {machine('user_id')} as instance_type,
    concat('us-east-', user_id % 2 + 1, case event_id % 3 when 0 then 'a' when 1 then 'b' else 'c' end) as zone,
    case when event_type = 'error' then 'Windows' else 'Linux/UNIX' end as product,
    ts, value as price, event_id from events)"""

LATEST = f"""{PRICES}, latest as (
  select instance_type, zone, price from prices
  qualify row_number() over (partition by instance_type, zone order by ts desc, event_id desc) = 1)"""

CHEAPEST = f"""{LATEST}, cheapest as (
  select instance_type, zone, price as min_price from latest
  qualify row_number() over (partition by instance_type order by price, zone) = 1)"""

ATTRIBUTES = f"""attributes as (
  select {machine('p_partkey')} as instance_type, concat(p_size, ' GiB') as memory,
    case when p_partkey % 10 = 9 then 'Variable' else concat(p_size + 1, '.5') end as ecu from part)"""

RUNS = f"""runs as (
  select o_orderkey as run_id, {machine('(o_custkey % 10)')} as instance_type,
    o_custkey % 5 + 1 as instances, o_orderpriority as data_size, o_totalprice / 1000 as runtime_min
  from orders)"""

TIMED_RUNS = f"""{RUNS}, timed as (
  select *, concat('us-east-', substr(instance_type, 2)::int % 2 + 1, ['a', 'b', 'c'][run_id % 3 + 1]) as zone,
    started + to_seconds(floor(runtime_min * 60)) as ended
  from (select runs.*, origin + to_seconds(run_id * 7919 % span) as started
    from runs, (select min(ts) as origin, (floor(epoch(max(ts))) - floor(epoch(min(ts))))::bigint as span from events)))"""

COSTS = f"""{CHEAPEST}, {RUNS}, costs as (
  select run_id, instance_type, instances, data_size, runtime_min,
    runtime_min / 60 * instances * min_price as cost
  from runs join cheapest using (instance_type))"""

BY_REGION = """by_region as (
  select instance_type, zone[length(zone) - 1] as region, min(price) as price from latest group by all)"""

SEGMENT = "strftime(to_timestamp(floor(epoch(ts) / 900) * 900) at time zone 'UTC', '%Y%m%d%H%M00')"
