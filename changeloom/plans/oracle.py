"""SQL on the base tables for each query, sharing no code with it."""

from __future__ import annotations

NOW_MS = "1700000000000"
NOW = "timestamp '2024-01-20 00:00:00'"
DELAY = "interval 5 day"

E = """
e as (select user_id, value, props, 'cdc.events' as topic, cast(event_id % 4 as int) as part, event_id as off,
        case event_type when 'signup' then 'c' when 'view' then 'r' when 'error' then 'd' else 'u' end as op,
        ts, event_id // 500 as blk
      from events)"""

O = """
t as (select * from orders where o_orderstatus <> 'P'),
o as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice + (case when op = 'u' then 1 else 0 end) as o_totalprice,
        o_orderdate, o_orderpriority, 'cdc.orders' as topic, cast(o_orderkey % 8 as int) as part,
        o_orderkey * 3 + seq as off, op
      from (select *, 0 as seq, 'c' as op from orders where o_orderstatus = 'P'
            union all select *, 0, 'r' from orders where o_orderstatus = 'F' and o_orderpriority = '3-MEDIUM'
            union all select *, 1, 'u' from orders where o_orderpriority in ('1-URGENT', '2-HIGH')
            union all select *, 2, 'd' from orders where o_orderpriority = '5-LOW'))"""

O_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
META = """topic as "KFK_TOPIC", part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP",
        o_orderdate as "KFK_DATETIME", 'block-0' as "KFK_BLOCKID" """

O_WINNERS = """
w as (select * from (select *, row_number() over (partition by o_orderkey order by off desc, part desc) as rn from o)
      where rn = 1)"""


def _merge(columns: str, inserted: str = "('c','r')") -> str:
    """New target after one merge: untouched rows, updated rows, inserted rows."""
    values = ", ".join("w." + c.strip() for c in columns.split(","))
    return f"""with {O}, {O_WINNERS}
select {", ".join("t." + c.strip() for c in columns.split(","))} from t
  where not exists (select 1 from w where w.o_orderkey = t.o_orderkey)
union all select {values} from w join t on w.o_orderkey = t.o_orderkey where w.op in ('c','r','u')
union all select {values} from w where w.op in {inserted}
  and not exists (select 1 from t where t.o_orderkey = w.o_orderkey)"""


def _replay_merge(ctes: str, log: str, key: str, columns: list[str], batch: str, initial: str | None) -> str:
    """Closed form of merging batch by batch: last create after last delete, values of the last write."""
    cols = ", ".join(columns)
    seed = f"union all select {cols}, 'c' as op, -1 as b from {initial}" if initial else ""
    return f"""with {ctes},
win as (select {cols}, op, b from (
    select *, row_number() over (partition by {key}, b order by off desc, part desc) as rn
    from (select *, {batch} as b from {log})) where rn = 1 and op in ('c','r','u','d') {seed}),
life as (select {key} as k, max(b) filter (where op in ('c','r')) as c, max(b) filter (where op = 'd') as d,
    max(b) filter (where op <> 'd') as v from win group by {key})
select {cols} from win join life on win.{key} = life.k and win.b = life.v
where life.c > coalesce(life.d, -2)"""


def _replay_blocks(ctes: str, log: str, key: str, columns: list[str], block: str, initial: str | None) -> str:
    """Closed form of applying block by block: created after the last delete, values of the latest later update."""
    seed = f"union all select {', '.join(columns)}, -1 as b from {initial}" if initial else ""
    rest = [c for c in columns if c != key]
    picked = ", ".join(f"case when upd.b >= born.b then upd.{c} else born.{c} end as {c}" for c in rest)
    return f"""with {ctes},
born as (select {', '.join(columns)}, {block} as b from {log} where op in ('c','r') {seed}),
del as (select {key} as k, max({block}) as b from {log} where op = 'd' group by {key}),
upd as (select * from (select *, {block} as b, row_number() over (
    partition by {key} order by {block} desc, off desc, part desc) as rn from {log} where op = 'u') where rn = 1)
select born.{key}, {picked} from born
left join del on born.{key} = del.k left join upd on born.{key} = upd.{key}
where born.b > coalesce(del.b, -2)"""


E_COLS = ["user_id", "value", "props"]
O_LIST = [c.strip() for c in O_COLS.split(",")]
QUARTER = "off * 4 // (select max(event_id) + 1 from events)"

_US = "(epoch_us(ts) - 1705300000000000 + event_id)"
# Cut toward zero: DuckDB integer division of negative numbers is spelled out.
_CUT_MS = f"cast(sign({_US}) * (abs({_US}) // 1000) as bigint)"
_NS = f"({_US} * 1000 + 7)"


def _cut(number: str, by: int) -> str:
    return f"cast(sign({number}) * (abs({number}) // {by}) as bigint)"


def _at_ms(millis: str) -> str:
    return f"(timestamp '1970-01-01 00:00:00' + to_milliseconds({millis}))"


def _at_us(micros: str) -> str:
    return f"(timestamp '1970-01-01 00:00:00' + to_microseconds({micros}))"


def _short(text: str) -> str:
    """Clock text HH:mm:ss.ffffff without zero seconds and trailing groups of zeros."""
    return f"""case when {text} like '%:00.000000' then left({text}, length({text}) - 10)
      when {text} like '%.000000' then left({text}, length({text}) - 7)
      when {text} like '%000' then left({text}, length({text}) - 3) else {text} end"""


_TS_TEXT = f"strftime({_at_ms(_CUT_MS)}, '%Y-%m-%dT%H:%M:%S.%f')"
_T_MICROS = "((event_id * 7919000013) % 86400000000)"
_T_MILLIS = "((event_id * 60000) % 86400000)"
_CLOCK_US = f"strftime({_at_us(_T_MICROS)}, '%H:%M:%S.%f')"
_CLOCK_MS = f"strftime({_at_ms(_T_MILLIS)}, '%H:%M:%S.%f')"

_KIND = "event_type"

ORACLE: dict[str, str] = {
    "parse_flat": f"""select {O_COLS}, 'c' as "KFK_OP", o_orderkey as "KFK_OFFSET" from orders""",
    "parse_envelope": f"""with {O} select {O_COLS}, part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP",
        o_orderdate as "KFK_DATETIME" from o""",
    "parse_envelope_schema": f"""with {O} select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
        date_trunc('millisecond', o_orderdate + to_microseconds(off * 1001)) as entered, o_orderstatus,
        off as "KFK_OFFSET", op as "KFK_OP" from o""",
    "parse_lineitem": """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
        l_tax, l_returnflag, l_linestatus, l_shipdate, l_orderkey * 8 + l_linenumber as "KFK_OFFSET",
        case when l_returnflag = 'R' then 'd' when l_linestatus = 'F' then 'u' else 'c' end as "KFK_OP",
        l_shipdate as "KFK_DATETIME" from lineitem""",
    "logical_types": f"""with {O} select off as "offset", 2 as n_types, 'io.debezium.time.Date' as date_type,
        'io.debezium.time.MicroTimestamp' as entered_type, cast(null as varchar) as status_type from o""",
    "normalise_fields": f"""with {O}, n as (select *, strftime(date_trunc('millisecond', o_orderdate
        + to_microseconds(off * 1001)), '%Y-%m-%dT%H:%M:%S.%f') as txt from o)
        select off as "offset", cast(o_orderkey as varchar) as o_orderkey,
        strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, {_short("txt")} || 'Z' as entered, o_orderstatus from n""",
    "unwrap_payload": "select event_id, user_id from events",
    "parse_struct_envelope": f"""with {O} select o_orderkey, o_orderdate,
        '{{"id":' || o_custkey || ',"status":"' || o_orderstatus || '"}}' as customer,
        off as "KFK_OFFSET", op as "KFK_OP", o_orderdate as "KFK_DATETIME" from o""",
    "parse_flat_struct": """select c_custkey, c_name, c_nationkey, c_acctbal, 'c' as "KFK_OP",
        c_custkey as "KFK_OFFSET" from customer""",
    "detect_format": f"""select event_id, case {_KIND} when 'signup' then 'flat' when 'view' then 'envelope'
        when 'click' then 'envelope' when 'purchase' then 'flat' end as fmt from events""",
    "reject_reasons": f"""select event_id, case {_KIND} when 'view' then 'null_value' when 'click' then 'malformed'
        when 'purchase' then 'not_object' when 'error' then 'bad_image' end as reject_reason from events""",
    "quarantine": f"""select event_id, case {_KIND} when 'click' then 'malformed' when 'purchase' then 'not_object'
        when 'error' then 'bad_image' else 'kept' end as outcome from events where {_KIND} <> 'view'""",
    "envelope_defaults": f"""select event_id, case {_KIND} when 'signup' then 'c' when 'error' then 'r' else 'u' end as op,
        case when {_KIND} in ('purchase', 'error') then event_id else {NOW_MS} end as ts_ms from events""",
    "row_image": f"""select event_id, case {_KIND} when 'error' then 'd' when 'signup' then 'c' else 'u' end as op,
        case {_KIND} when 'error' then event_id else event_id + 1 end as n from events""",
    "missing_image": f"""select event_id, {_KIND} in ('view', 'click', 'error') as missing_image,
        case {_KIND} when 'signup' then 1 else 0 end as n_fields, cast(null as varchar) as reject_reason from events""",
    "logical_date": """select o_orderkey, strftime(date '1970-01-01' + cast(o_orderkey - 5000 as int), '%Y-%m-%d') as d from orders""",
    "logical_ts_millis": f"""select event_id, {_at_ms("event_id * 86399999 - 1000000000000")} as t from events""",
    "logical_ts_micros": f"""select event_id, {_at_ms(_CUT_MS)} as t, {_at_us(_US)} as exact,
        {_short(_TS_TEXT)} || 'Z' as text from events""",
    "logical_ts_nanos": f"""select event_id, {_at_ms(_cut(_NS, 1000000))} as t, {_at_us(_cut(_NS, 1000))} as exact
        from events""",
    "logical_time": f"""select event_id, {_short(_CLOCK_US)} as micros_text, {_short(_CLOCK_MS)} as millis_text,
        rtrim(rtrim({_CLOCK_US}, '0'), '.') as micros_time from events""",
    "coerce_number": f"""select event_id, case when {_KIND} <> 'error' then cast(round(cast(cast(value as varchar) as decimal(18,4)), 0) as bigint) end as whole,
        case when {_KIND} <> 'error' then cast(cast(round(cast(cast(value as varchar) as decimal(18,4)), 1) as decimal(12,1)) as varchar) end as one_digit,
        case when {_KIND} <> 'error' then cast(cast(round(cast(cast(value as varchar) as decimal(18,4)), 0) as decimal(12,2)) as varchar) end as scale_zero
        from events""",
    "coerce_float": f"select event_id, case when {_KIND} in ('signup', 'view') then value end as x from events",
    "coerce_boolean": f"""select event_id, case {_KIND} when 'signup' then true when 'click' then true
        when 'view' then false when 'purchase' then false end as flag from events""",
    "coerce_date_mixed": f"select event_id, case when {_KIND} <> 'error' then strftime(ts, '%Y-%m-%d') end as d from events",
    "coerce_timestamp": f"""select event_id, case {_KIND} when 'signup' then date_trunc('minute', ts)
        when 'view' then date_trunc('millisecond', ts) when 'click' then date_trunc('second', ts) else ts end as t
        from events""",
    "coerce_time": f"""select event_id, case {_KIND} when 'signup' then strftime(ts, '%H:%M:00')
        when 'view' then strftime(ts, '%H:%M:%S')
        when 'purchase' then rtrim(rtrim(strftime(ts, '%H:%M:%S.%g'), '0'), '.') end as t from events""",
    "coerce_binary": f"select event_id, case when {_KIND} <> 'error' then {_KIND} end as text from events",
    "coerce_variant_text": f"""select event_id, '{{"event_type":"' || {_KIND} || '","user_id":' || user_id || '}}' as nested,
        {_KIND} as word, user_id, user_id as typed from events""",
    "ingest_rows": f"with {O} select {O_COLS}, {META} from o",
    "row_bytes": """select o_orderkey as "offset", 100 + 47 + length(cast(o_orderkey as varchar))
        + length(cast(o_custkey as varchar)) + length(o_orderstatus) + length(o_orderpriority) as n_bytes from orders""",
    "dedup_ingest": f"""with {O} select topic as "KFK_TOPIC", part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP",
        o_totalprice from o where op <> 'd'""",
    "first_record_columns": f"""select user_id, {_KIND}, case when {_KIND} <> 'error' and
        (select {_KIND} from events order by event_id % 4, event_id limit 1) <> 'error' then value end as value,
        event_id as "KFK_OFFSET" from events""",
    "copy_into": f"with {O} select {O_COLS}, {META} from o",
    "empty_as_null": f"select event_id, case when {_KIND} <> 'error' then {_KIND} end as kind from events",
    "block_filters": f"""with {O} select o_orderkey, case op when 'u' then 'update' when 'd' then 'delete'
        else 'insert' end as part from o where year(o_orderdate) = 1997""",
    "latest_per_key": f"""with {E} select user_id, value, props, part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP"
        from (select *, row_number() over (partition by user_id order by off desc, part desc) as rn from e) where rn = 1""",
    "latest_per_key_orders": f"""with {O}, {O_WINNERS} select o_orderkey, o_totalprice, off as "KFK_OFFSET",
        op as "KFK_OP" from w""",
    "take_batch": f"""with {E} select user_id, value, props, part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP"
        from e order by part, off limit 137""",
    "key_partition_audit": f"""with {E} select user_id, count(distinct part) as n_partitions from e group by user_id
        having count(distinct part) > 1""",
    "has_pending": f"with {O} select count(*) > 0 as pending from o",
    "merge_single": _merge(O_COLS),
    "merge_broadcast": _merge(O_COLS),
    "merge_counts": f"""with {O}, {O_WINNERS} select action, count(*) as n from (
        select case when t.o_orderkey is not null and op = 'd' then 'deleted'
          when t.o_orderkey is not null then 'updated' when op in ('c','r') then 'inserted' else 'dropped' end as action
        from w left join t on w.o_orderkey = t.o_orderkey) group by action""",
    "merge_to_null": _merge(O_COLS).replace("w.o_orderpriority", "case when w.op <> 'u' then w.o_orderpriority end as o_orderpriority"),
    "merge_null_keys": f"""with {O}, tn as (select case when o_orderkey % 5 <> 0 then o_orderkey end as o_orderkey,
          {O_COLS.removeprefix("o_orderkey, ")} from t),
        l as (select * exclude (o_orderkey), case when o_orderkey % 5 <> 0 then o_orderkey end as o_orderkey from o),
        w as (select * from (select *, row_number() over (partition by o_orderkey order by off desc, part desc) as rn from l)
          where rn = 1)
        select {", ".join("tn." + c.strip() for c in O_COLS.split(","))} from tn
          where not exists (select 1 from w where w.o_orderkey = tn.o_orderkey)
        union all select {", ".join("w." + c.strip() for c in O_COLS.split(","))} from w
          join tn on w.o_orderkey = tn.o_orderkey where w.op in ('c','r','u')
        union all select {", ".join("w." + c.strip() for c in O_COLS.split(","))} from w where w.op in ('c','r')
          and not exists (select 1 from tn where tn.o_orderkey = w.o_orderkey)""",
    "merge_two_keys": """with t as (select distinct l_orderkey, l_linenumber from lineitem where l_linestatus = 'F'),
        w as (select * from (select l_orderkey, l_linenumber, l_quantity + 1 as l_quantity,
            case when l_returnflag = 'R' then 'd' when l_linestatus = 'F' then 'u' else 'c' end as op,
            row_number() over (partition by l_orderkey, l_linenumber order by l_orderkey) as rn
          from lineitem where l_linenumber > 1) where rn = 1)
        select t.l_orderkey, t.l_linenumber, case when w.op is null then 0.0::double else w.l_quantity end as l_quantity
          from t left join w on t.l_orderkey = w.l_orderkey and t.l_linenumber = w.l_linenumber
          where w.op is null or w.op <> 'd'
        union all select l_orderkey, l_linenumber, l_quantity from w where op = 'c' and not exists (
          select 1 from t where t.l_orderkey = w.l_orderkey and t.l_linenumber = w.l_linenumber)""",
    "block_many_updates": f"""with {E}, u as (select * from (select *, row_number() over (partition by user_id
          order by off desc, part desc) as rn from e where op = 'u') where rn = 1)
        select k.user_id, coalesce(u.value, 0.0) as value, coalesce(u.props, 'none') as props
        from (select distinct user_id from events) k left join u on k.user_id = u.user_id""",
    "parse_map": """select o_orderkey, o_orderstatus, o_totalprice, o_orderkey as "KFK_OFFSET", 'c' as "KFK_OP" from orders""",
    "stream_out_of_order": _replay_merge(E, "e", "user_id", E_COLS, f"3 - ({QUARTER})", None),
    "merge_key_only": _merge("o_orderkey"),
    "merge_missing_update_insert": _merge(O_COLS, "('c','r','u')"),
    "block_insert": f"with {O} select {O_COLS} from t union all select {O_COLS} from o where op in ('c','r')",
    "block_update": f"""with {O} select t.o_orderkey, t.o_custkey, t.o_orderstatus,
        coalesce(u.o_totalprice, t.o_totalprice) as o_totalprice, t.o_orderdate, t.o_orderpriority
        from t left join (select * from o where op = 'u') u on t.o_orderkey = u.o_orderkey""",
    "block_delete": f"""with {O} select {O_COLS} from t
        where o_orderkey not in (select o_orderkey from o where op = 'd')""",
    "block_apply": f"""with {O}, i as (select {O_COLS} from t union all select {O_COLS} from o where op in ('c','r'))
        select i.o_orderkey, i.o_custkey, i.o_orderstatus, coalesce(u.o_totalprice, i.o_totalprice) as o_totalprice,
        i.o_orderdate, i.o_orderpriority from i left join (select * from o where op = 'u') u on i.o_orderkey = u.o_orderkey
        where i.o_orderkey not in (select o_orderkey from o where op = 'd')""",
    "block_counts": f"""with {O}, i as (select {O_COLS} from t union all select {O_COLS} from o where op in ('c','r'))
        select (select count(*) from o where op in ('c','r')) as inserted,
        (select count(*) from i where o_orderkey in (select o_orderkey from o where op = 'u')) as updated,
        (select count(*) from i where o_orderkey in (select o_orderkey from o where op = 'd')) as deleted""",
    "replay_merge": _replay_merge(E, "e", "user_id", E_COLS, "blk", None),
    "replay_merge_initial": _replay_merge(O, "o", "o_orderkey", O_LIST, "year(o_orderdate) - 1990", "t"),
    "replay_blocks": _replay_blocks(E, "e", "user_id", E_COLS, "blk", None),
    "replay_blocks_initial": _replay_blocks(O, "o", "o_orderkey", O_LIST, "year(o_orderdate) - 1990", "t"),
    "remove_batch": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP" from e
        where (part, off) not in (select (part, off) from e order by part, off limit 137)""",
    "remove_batch_by_key": f"""with {O} select part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP" from o
        where op <> 'u'""",
    "cleanup_block": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET", cast(blk as varchar) as "KFK_BLOCKID"
        from e where not (blk = 11 and ts <= {NOW} - {DELAY})""",
    "expire_rows": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET", cast(blk as varchar) as "KFK_BLOCKID"
        from e where ts > {NOW} - {DELAY}""",
    "expire_applied_rows": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET",
        cast(blk as varchar) as "KFK_BLOCKID" from e where ts > {NOW} - {DELAY} or part >= 2""",
    "apply_pending": f"""with {E}, b as (select * from e order by part, off limit 137),
        w as (select * from (select *, row_number() over (partition by user_id order by off desc) as rn from b) where rn = 1)
        select user_id, value, cast(null as bigint) as pending_offset from w where op in ('c','r')
        union all select null, null, off from e where (part, off) not in (select (part, off) from b)""",
    "stream_merge": _replay_merge(E, "e", "user_id", E_COLS, QUARTER, None),
    "stream_blocks": _replay_blocks(E, "e", "user_id", E_COLS, QUARTER, None),
    "stream_dedup": _replay_blocks(E, "e", "user_id", E_COLS, QUARTER, None),
    "stream_merge_bounded": _replay_merge(
        E.replace("select user_id,", "select case when event_id % 3 = 0 then 0 else user_id end as user_id,"), "e", "user_id", E_COLS, QUARTER, None
    ),
    "stream_cut_blocks": f"""with {E}, s as (
          select part, off, 100 + 12 + length(cast(user_id as varchar)) + coalesce(length(props), 0) as size from e),
        m as (select *, max(size) filter (where size <= 15000) over (partition by part) as most,
            row_number() over (partition by part order by off) as n, sum(size) over (partition by part order by off) as b,
            coalesce(count(*) filter (where size > 15000) over (partition by part order by off
              rows between unbounded preceding and 1 preceding), 0) as o from s)
        select part as "KFK_PARTITION", off as "KFK_OFFSET",
          concat_ws('-', part, (n - 1) // 100, cast((b - 1) // (15000 - most + 1) as bigint), o) as block from m""",
    "reject_prefix": """select cast(event_id % 4 as int) as "partition", event_id as "offset" from events e
        where event_id < coalesce((select min(event_id) from events b
          where b.event_id % 4 = e.event_id % 4 and b.event_id % 977 = 600), 9223372036854775807)""",
    "stream_retention": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP" from e
        where not date_trunc('milliseconds', ts) <= {NOW} - {DELAY}""",
    "expire_idle": f"""with {E} select part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP" from e
        where not date_trunc('milliseconds', ts) <= {NOW} - {DELAY}""",
    "job_from_catalog": _replay_merge(
        E.replace("select user_id, value, props,", f"select user_id, value, case when {QUARTER.replace('off', 'event_id')} >= 2 then props end as props,"),
        "e", "user_id", E_COLS, QUARTER, None,
    ),
    "struct_logical_types": """select o_orderkey, cast(o_orderdate as date) as o_orderdate,
        o_orderdate + to_hours(o_orderkey % 24) + to_milliseconds(1) as entered, o_orderstatus from orders""",
    "stream_copy_into": f"""with {E} select user_id, value, props, part as "KFK_PARTITION", off as "KFK_OFFSET", op as "KFK_OP",
        'part-' || ({QUARTER}) as "KFK_BLOCKID" from e""",
    "stream_continuous": _replay_merge(E, "e", "user_id", E_COLS, QUARTER, None),
}
