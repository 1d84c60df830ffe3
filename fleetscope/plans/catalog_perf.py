"""Registered jobs of section C (performance time series) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetscope import params
from fleetscope.operators import timeseries as ts
from fleetscope.plans.oracle_sql import delta_sql, mode_cte, pct_expr, profile_sql, sorted_list
from fleetscope.plans.spec import Spec

CK = "pkey, dbid, instance_number, stat_name"
AS_OF = "2024-01-31 00:00:00"

COUNTERS = "select * from est_counters"
C1_SQL = f"select *, {delta_sql('value', CK)} from est_counters"

IO_EVENTS = """select pkey, dbid, instance_number, snap_id, begin_ts, stat_name as event_name,
  case stat_name when 'click' then 'User I/O' when 'view' then 'System I/O' when 'purchase' then 'Commit' else 'Idle' end as wait_class,
  value as total_waits, value * 2 as total_timeouts, value * 1000 as time_waited_micro
from est_counters"""

IO_FUNCS = ("select pkey, dbid, instance_number, snap_id, begin_ts, stat_name as function_name, "
            + ", ".join(f"value * {i + 1} as {c}" for i, c in enumerate(ts.IO_FUNCTION_COUNTERS))
            + " from est_counters")

# snapshots of every collection and instance, numbered within each
SNAPS_SQL = """select pkey, dbid, instance_number, h as begin_ts,
  row_number() over (partition by pkey, dbid, instance_number order by h) as snap_id
from (select distinct pkey, dbid, instance_number, date_trunc('hour', begin_ts) as h from est_counters) t"""
STATS_SQL = """select pkey, 1 as dbid, cast(executions % 2 as int) as instance_number, sql_id, cast(substr(sql_id, 4) as bigint) % 700 + 1 as snap_id,
  rows_processed * 10 as buffer_gets, elapsed as elapsed_time, rows_processed, executions, elapsed % 1000 as cpu_time,
  elapsed % 97 as iowait, elapsed % 13 as clwait, rows_processed % 7 as apwait, executions % 2 as ccwait,
  rows_processed % 5 as plsexec_time
from est_statements"""
TEXT_SQL = """select pkey, sql_id, min(cast(signature as int)) % 8 as command_type from est_statements group by pkey, sql_id"""
NAMES_SQL = params.values_sql(params.COMMAND_NAMES, ["command_type", "command_name"])
SESSIONS_SQL = """select pkey, 1 as dbid, cast(executions % 2 as int) as instance_number,
  cast(substr(sql_id, 4) as bigint) % 700 + 1 as snap_id,
  case when executions > 0 then 'FOREGROUND' else 'BACKGROUND' end as session_type,
  concat('prog|', cast(cast(signature as int) % 4 as string)) as program,
  concat('mod', cast(rows_processed % 3 as string)) as module,
  concat('host_', pkey) as machine, cast(signature as int) % 8 as command_type
from est_statements"""

HEALTH_SQL = """select concat('pk', cast(user_id % 3 as string)) as pkey,
  concat('<Record id="', cast(event_id as string), '"><SchedulerMonitorEvent><SystemHealth><SystemIdle>',
         cast(user_id % 50 as string), '</SystemIdle><ProcessUtilization>', cast(cast(floor(value) as bigint) % 100 as string),
         '</ProcessUtilization><UserModeTime>', cast(event_id * 10 as string), '</UserModeTime><KernelModeTime>',
         cast(event_id % 13 as string), '</KernelModeTime><MemoryUtilization>', cast(100 - user_id % 7 as string),
         '</MemoryUtilization></SystemHealth></SchedulerMonitorEvent></Record>') as record,
  event_id, user_id % 50 as src_idle, cast(floor(value) as bigint) % 100 as src_proc, 100 - user_id % 7 as src_mem,
  timestamp '2024-02-01 00:00:00' as now_ts, cast(5000000000 as bigint) as ms_ticks, event_id * 1000 as timestamp_ms
from events"""

FILE_IO_SQL = """select pkey, value as num_of_reads, value % 7 as num_of_writes, value * 2 as io_stall_read_ms,
  value % 5 as io_stall_write_ms, value * 8192 as bytes_read, (value % 7) * 8192 as bytes_written, snap_id * 1000 as sample_ms
from est_counters"""

ORDERS_LOGS = """select concat('pk', cast(o_custkey % 3 as string)) as pkey, o_orderdate as first_time,
  1 + o_orderkey % 2 as thread, 1 + o_custkey % 2 as dest_id, cast(floor(o_totalprice) as bigint) as blocks, 512 as block_size
from orders"""
BACKUP_JOBS = """select concat('pk', cast(o_custkey % 3 as string)) as pkey, o_orderdate as start_time, o_orderpriority as input_type,
  o_custkey % 3600 as elapsed_seconds, cast(floor(o_totalprice * 1000) as bigint) as input_bytes,
  cast(floor(o_totalprice * 300) as bigint) as output_bytes
from orders"""
EVENTS_PK = "select concat('pk', cast(user_id % 3 as string)) as pkey, ts, event_type, cast(floor(value * 100000) as bigint) as bytes from events"

SUMM_SQL = """select pkey, dbid, instance_number, stat_name as metric_name, date_trunc('hour', begin_ts) as begin_ts,
  round(avg(value), 4) as average, round(coalesce(stddev_samp(value), 0), 4) as standard_deviation,
  min(value) as minval, max(value) as maxval
from est_counters group by pkey, dbid, instance_number, stat_name, date_trunc('hour', begin_ts)"""


def PCT_SQL(lst):
    return ", ".join(f"round({pct_expr(lst, p)}) as {n}" for n, p in
                     [("perc50", 0.5), ("perc75", 0.75), ("perc90", 0.9), ("perc95", 0.95), ("perc100", 1.0)])


def JOIN_ON(cols):
    return " and ".join(f"a.{c} = m.{c}" for c in cols)


STMT_ORACLE = """with g as (select pkey, signature, min(sql_id) as sql_id, sum(executions) as executions,
    sum(elapsed) as elapsed, sum(rows_processed) as rows_processed from stats group by pkey, signature),
r as (select *, case when executions = 0 then 0 else trunc(elapsed / executions) end as elapsed_per_exec,
    case when executions = 0 then 0 else trunc(rows_processed / executions) end as rows_per_exec,
    row_number() over (partition by pkey order by elapsed desc, signature) as rank from g)
select * from r where rank <= 299"""

PIVOT_NAMES = ["click", "view", "purchase", "signup", "error"]


def _c1(counters):
    return ts.counter_delta(counters)


def _c3(facts, snaps):
    bounds = ts.snapshot_window(snaps, days=7, as_of=AS_OF)
    return ts.join_snapshots(facts, snaps, on=["dbid", "begin_ts"], bounds=bounds)


def _c12(stats, text, snaps, names):
    return ts.command_profile(stats, text, snaps, names)


COVERAGE_DAY = "2024-01-20 00:00:00"

SPECS: dict[str, Spec] = {
    "c1_counter_delta": Spec(
        build=_c1, inputs={"counters": COUNTERS}, oracle=C1_SQL),
    "c2_counter_or_gauge": Spec(
        build=lambda counters: ts.counter_or_gauge(counters, counter_names=["click", "view"]),
        inputs={"counters": COUNTERS},
        oracle=f"""select pkey, dbid, instance_number, stat_name, snap_id, begin_ts, value,
  case when stat_name in ('click', 'view') then d else value end as delta_value
from (select *, {delta_sql('value', CK, alias='d')} from est_counters) t"""),
    "c2_counter_delta_drop_first": Spec(
        build=lambda counters: ts.counter_or_gauge(counters, drop_first=True),
        inputs={"counters": COUNTERS},
        oracle=f"""select pkey, dbid, instance_number, stat_name, snap_id, begin_ts, value, delta_value from (
  select *, {delta_sql('value', CK, alias='delta_value')},
         lag(snap_id) over (partition by {CK} order by snap_id) as p from est_counters) t where p is not null"""),
    "c3_join_snapshots": Spec(
        build=_c3,
        inputs={"facts": "select pkey, dbid, instance_number, stat_name, snap_id as sample_id, "
                         "date_trunc('hour', begin_ts) as begin_ts, value from est_counters",
                "snaps": "select dbid, begin_ts, snap_id, startup_tag from est_snapshots"},
        oracle=f"""with b as (select dbid, min(snap_id) as lo, max(snap_id) as hi from snaps
  where begin_ts >= timestamp '{AS_OF}' - interval 7 day and begin_ts <= timestamp '{AS_OF}' group by dbid)
select f.dbid, f.begin_ts, f.pkey, f.instance_number, f.stat_name, f.sample_id, f.value, s.snap_id, s.startup_tag
from facts f join snaps s on f.dbid = s.dbid and f.begin_ts = s.begin_ts
join b on s.dbid = b.dbid and s.snap_id between b.lo and b.hi"""),
    "c4_snapshot_window": Spec(
        build=lambda snaps: ts.snapshot_window(snaps, days=7, as_of=AS_OF),
        inputs={"snaps": "select * from est_snapshots"},
        oracle=f"""select dbid, min(snap_id) as min_snap_id, max(snap_id) as max_snap_id, min(begin_ts) as min_begin_ts,
  max(begin_ts) as max_begin_ts from snaps
where begin_ts >= timestamp '{AS_OF}' - interval 7 day and begin_ts <= timestamp '{AS_OF}' group by dbid"""),
    # flagship
    "c5_hourly_profile": Spec(
        build=lambda counters: ts.hourly_profile(ts.counter_delta(counters)),
        inputs={"counters": COUNTERS},
        oracle=f"with d as ({C1_SQL}),\n" + profile_sql("d", CK.split(", "), "value_delta")[5:]),
    "c5_hourly_profile_split": Spec(
        build=lambda counters: ts.hourly_profile(ts.counter_delta(counters)),
        inputs={"counters": COUNTERS},
        oracle=f"with d as ({C1_SQL}),\n" + profile_sql("d", CK.split(", "), "value_delta")[5:]),
    "c6_os_stat_profile": Spec(
        build=lambda counters: ts.os_stat_profile(counters, counter_names=["click", "view"]),
        inputs={"counters": "select *, date_trunc('hour', begin_ts) + interval 1 hour as end_ts from est_counters"},
        oracle=f"""with d as (select *, case when stat_name in ('click', 'view') then dd else value end as delta_value,
    strftime(begin_ts, '%H') as hh24, epoch_us(end_ts) - epoch_us(begin_ts) as us
  from (select *, {delta_sql('value', CK, alias='dd')} from counters) t),
{mode_cte('d', CK.split(', ') + ['hh24'], 'delta_value')}
select a.* exclude (__l), round({pct_expr('a.__l', 0.5)}) as median_value, {PCT_SQL('a.__l')},
  round(m.mode_v) as mode_value from (
  select {CK}, hh24, round(sum(us) / 1e6) as hh24_total_secs, round(avg(value)) as cumulative_value,
    round(avg(delta_value)) as avg_value, {sorted_list('delta_value')} as __l,
    round(min(delta_value)) as min_value, round(max(delta_value)) as max_value,
    cast(round(sum(delta_value)) as bigint) as sum_value, count(*) as count
  from d group by {CK}, hh24) a
left join __mode m on {JOIN_ON(CK.split(', ') + ['hh24'])}"""),
    "c7_peak_metric_profile": Spec(
        build=lambda summ: ts.peak_metric_profile(summ),
        inputs={"summ": SUMM_SQL},
        oracle="with d as (select *, average + 2 * case when standard_deviation > 0.999 and standard_deviation < 1 "
               "and minval = 0 and average = maxval then 0.0 else standard_deviation end as peak_value from summ),\n"
               + profile_sql("d", ["pkey", "dbid", "instance_number", "metric_name"], "peak_value", int_sum=False)[5:]),
    "c8_peak_from_samples": Spec(
        build=lambda samples: ts.peak_from_samples(samples),
        inputs={"samples": "select pkey, dbid, instance_number, stat_name as metric_name, begin_ts, value from est_counters"},
        oracle="""with g as (select pkey, dbid, instance_number, metric_name, strftime(begin_ts, '%H') as hour, count(*) as cnt,
    avg(value) as a, coalesce(stddev_samp(value), 0) as sd, min(value) as mn, max(value) as mx
  from samples group by pkey, dbid, instance_number, metric_name, strftime(begin_ts, '%H')),
p as (select *, a + 2 * case when sd > 0.999 and sd < 1 and mn = 0 and a = mx then 0.0 else sd end as pk from g)
select pkey, dbid, instance_number, metric_name, hour, cnt, round(pk) as avg_value, round(pk) as mode_value,
  round(pk) as median_value, round(pk) as min_value, round(pk) as max_value, round(pk * cnt) as sum_value,
  round(pk) as perc50, round(pk) as perc75, round(pk) as perc90, round(pk) as perc95, round(pk) as perc100 from p"""),
    "c9_io_event_profile": Spec(
        build=lambda ev: ts.io_event_profile(ev),
        inputs={"ev": IO_EVENTS},
        oracle=f"""with d as (select *, {', '.join(delta_sql(c, 'pkey, dbid, instance_number, wait_class, event_name')
                                          for c in ts.IO_EVENT_COUNTERS)}
  from ev where wait_class in ('User I/O', 'System I/O', 'Commit'))
select pkey, dbid, instance_number, wait_class, event_name, hour,
  {', '.join(f"round({pct_expr('l_' + c, 0.95)}) as {c}_p95, round({pct_expr('l_' + c, 1.0)}) as {c}_p100"
             for c in ts.IO_EVENT_COUNTERS)}
from (select pkey, dbid, instance_number, wait_class, event_name, strftime(begin_ts, '%H') as hour,
  {', '.join(f"{sorted_list(c + '_delta')} as l_{c}" for c in ts.IO_EVENT_COUNTERS)}
  from d group by pkey, dbid, instance_number, wait_class, event_name, strftime(begin_ts, '%H')) g"""),
    "c10_io_function_profile": Spec(
        build=lambda fn: ts.io_function_profile(fn),
        inputs={"fn": IO_FUNCS},
        oracle=f"""with d as (select *, {', '.join(delta_sql(c, 'pkey, dbid, instance_number, function_name')
                                          for c in ts.IO_FUNCTION_COUNTERS)} from fn)
select pkey, dbid, instance_number, function_name, hour,
  {', '.join(f"round({pct_expr('l_' + c, 0.95)}) as {c}_p95, round({pct_expr('l_' + c, 1.0)}) as {c}_p100"
             for c in ts.IO_FUNCTION_COUNTERS)},
  {', '.join(f"round({pct_expr('l_sm_' + k, q)} + {pct_expr('l_lg_' + k, q)}) as tot_{k}_{p}"
             for k in ('read_bytes', 'write_bytes', 'read_reqs', 'write_reqs') for q, p in ((0.95, 'p95'), (1.0, 'p100')))}
from (select pkey, dbid, instance_number, function_name, strftime(begin_ts, '%H') as hour,
  {', '.join(f"{sorted_list(c + '_delta')} as l_{c}" for c in ts.IO_FUNCTION_COUNTERS)}
  from d group by pkey, dbid, instance_number, function_name, strftime(begin_ts, '%H')) g"""),
    "c11_snapshot_intervals": Spec(
        build=lambda snaps: ts.snapshot_intervals(snaps),
        inputs={"snaps": "select * from est_snapshots"},
        oracle=f"""with s as (select *, coalesce(epoch_us(begin_ts) - epoch_us(lag(begin_ts) over w), 0) / 1e6 as secs,
    lag(startup_tag) over w as ps from snaps window w as (partition by dbid order by snap_id)),
k as (select *, strftime(begin_ts, '%H') as hour from s where startup_tag = ps),
{mode_cte('k', ['dbid', 'hour'], 'secs')}
select a.*, round(m.mode_v) as mode_secs from (
  select dbid, hour, min(snap_id) as min_snap_id, max(snap_id) as max_snap_id, min(begin_ts) as min_begin_ts,
    max(begin_ts) as max_begin_ts, count(*) as cnt, round(sum(secs)) as sum_secs, round(avg(secs)) as avg_secs,
    round(median(secs)) as median_secs, round(min(secs)) as min_secs, round(max(secs)) as max_secs
  from k group by dbid, hour) a left join __mode m on a.dbid = m.dbid and a.hour = m.hour"""),
    "c12_command_profile": Spec(
        build=_c12,
        inputs={"stats": STATS_SQL, "text": TEXT_SQL, "snaps": SNAPS_SQL, "names": NAMES_SQL},
        oracle=f"""select st.pkey, strftime(sn.begin_ts, '%H') as hh24, st.command_type, n.command_name, count(*) as cnt,
  {', '.join(f"round(avg({m})) as avg_{m}" for m in ts.COMMAND_MEASURES)}
from (select s.*, t.command_type from stats s join text t on s.pkey = t.pkey and s.sql_id = t.sql_id) st
join snaps sn on st.pkey = sn.pkey and st.dbid = sn.dbid and st.instance_number = sn.instance_number and st.snap_id = sn.snap_id
left join names n on st.command_type = n.command_type
group by st.pkey, strftime(sn.begin_ts, '%H'), st.command_type, n.command_name"""),
    "c13_source_connections": Spec(
        build=lambda sessions, snaps, names: ts.source_connections(sessions, snaps, names),
        inputs={"sessions": SESSIONS_SQL, "snaps": SNAPS_SQL, "names": NAMES_SQL},
        oracle="""select s.pkey, s.dbid, s.instance_number, strftime(sn.begin_ts, '%H') as hour,
  replace(s.program, '|', '_') as program, replace(s.module, '|', '_') as module, replace(s.machine, '|', '_') as machine,
  n.command_name, count(*) as cnt
from sessions s join snaps sn on s.pkey = sn.pkey and s.dbid = sn.dbid and s.instance_number = sn.instance_number and s.snap_id = sn.snap_id
join names n on s.command_type = n.command_type
where s.session_type = 'FOREGROUND'
group by s.pkey, s.dbid, s.instance_number, strftime(sn.begin_ts, '%H'), replace(s.program, '|', '_'),
  replace(s.module, '|', '_'), replace(s.machine, '|', '_'), n.command_name"""),
    "c14_top_statements": Spec(
        build=lambda stats: ts.top_statements(stats, n=299),
        inputs={"stats": "select * from est_statements"},
        oracle=STMT_ORACLE),
    "c15_log_volume": Spec(
        build=lambda logs: ts.log_volume(logs, as_of="1998-08-02", days=3650),
        inputs={"logs": ORDERS_LOGS},
        oracle="""select pkey, cast(first_time as date) as log_start_date, strftime(first_time, '%H') as hour,
  thread as thread_num, dest_id, count(*) as cnt, round(sum(blocks * block_size) / 1048576.0) as mbytes
from logs where first_time >= cast(date '1998-08-02' - interval 3650 day as timestamp)
group by pkey, cast(first_time as date), strftime(first_time, '%H'), thread, dest_id"""),
    "c16_backup_volume": Spec(
        build=lambda jobs: ts.backup_volume(jobs, as_of="1998-08-02", days=3650),
        inputs={"jobs": BACKUP_JOBS},
        oracle="""select pkey, cast(start_time as date) as backup_start_date, input_type,
  round(sum(elapsed_seconds)) as elapsed_seconds, round(sum(input_bytes) / 1048576.0) as mbytes_in,
  round(sum(output_bytes) / 1048576.0) as mbytes_out
from jobs where start_time >= cast(date '1998-08-02' - interval 3650 day as timestamp)
group by pkey, cast(start_time as date), input_type"""),
    "c17_hour_matrix_count": Spec(
        build=lambda ev: ts.hour_matrix(ev, as_of="2024-01-30 00:00:00"),
        inputs={"ev": EVENTS_PK},
        oracle=f"""select pkey, strftime(ts, '%m/%d/%Y') as collection_date, day(ts) as day_of_month,
  count(*) as total_logs_generated,
  {', '.join(f"sum(case when hour(ts) = {h} then 1 else 0 end) as h{h}_count" for h in range(24))},
  count(*) // 24 as avg_per_hour
from ev where ts < timestamp '2024-01-30 00:00:00' group by pkey, strftime(ts, '%m/%d/%Y'), day(ts)"""),
    "c17_hour_matrix_size": Spec(
        build=lambda ev: ts.hour_matrix(ev.where(F.col("event_type") == "click"), size_col="bytes"),
        inputs={"ev": EVENTS_PK},
        oracle=f"""select pkey, strftime(ts, '%m/%d/%Y') as collection_date, day(ts) as day_of_month,
  cast(ceil(round(sum(bytes / 1048576.0))) as bigint) as total_logs_generated_in_mb,
  {', '.join(f"sum(case when hour(ts) = {h} then cast(ceil(bytes / 1048576.0) as bigint) else 0 end) as h{h}_size_in_mb" for h in range(24))},
  cast(ceil(round(sum(bytes / 1048576.0) / 24.0)) as bigint) as avg_mb_per_hour
from ev where event_type = 'click' group by pkey, strftime(ts, '%m/%d/%Y'), day(ts)"""),
    "c18_counter_pivot": Spec(
        build=lambda counters: ts.counter_pivot(counters, PIVOT_NAMES, keys=("pkey", "instance_number"),
                                                name_col="stat_name", ratio=("hit_ratio", "purchase", "click"),
                                                digits=4),
        inputs={"counters": COUNTERS},
        oracle=f"""select *, round(case when click = 0 then 0.0 else 100.0 * purchase / click end) as hit_ratio from (
  select pkey, instance_number, {', '.join(f"round(avg(case when stat_name = '{n}' then value end), 4) as {n}" for n in PIVOT_NAMES)}
  from counters group by pkey, instance_number) t"""),
    "c19_health_samples": Spec(
        build=lambda rec: ts.health_samples(rec),
        inputs={"rec": HEALTH_SQL},
        oracle="""select pkey, event_id as record_id, case when src_idle = 0 then 100 - src_proc else src_idle end as system_idle,
  src_proc as sql_cpu, event_id * 10 as user_mode_time, event_id % 13 as kernel_mode_time, src_mem as memory_utilization,
  now_ts - to_milliseconds(ms_ticks - timestamp_ms) as event_time
from rec"""),
    "c20_file_io_summary": Spec(
        build=lambda st: ts.file_io_summary(st),
        inputs={"st": FILE_IO_SQL},
        oracle="""select pkey, reads, writes, read_stall_ms, write_stall_ms, bytes_read, bytes_written,
  round(case when reads = 0 then 0.0 else bytes_read / reads end, 2) as bytes_per_read,
  round(case when writes = 0 then 0.0 else bytes_written / writes end, 2) as bytes_per_write,
  round(case when reads = 0 then 0.0 else read_stall_ms / reads end, 2) as ms_per_read,
  round(case when writes = 0 then 0.0 else write_stall_ms / writes end, 2) as ms_per_write,
  round(case when sample_ms / 1000.0 = 0 then 0.0 else (reads + writes) / (sample_ms / 1000.0) end, 2) as ops_per_sec
from (select pkey, cast(sum(num_of_reads) as bigint) as reads, cast(sum(num_of_writes) as bigint) as writes,
  cast(sum(io_stall_read_ms) as bigint) as read_stall_ms, cast(sum(io_stall_write_ms) as bigint) as write_stall_ms,
  cast(sum(bytes_read) as bigint) as bytes_read, cast(sum(bytes_written) as bigint) as bytes_written, cast(sum(sample_ms) as bigint) as sample_ms
  from st group by pkey) t"""),
    "c21_snapshot_coverage": Spec(
        build=lambda cols, snaps: ts.snapshot_coverage(cols, snaps, COVERAGE_DAY),
        inputs={"cols": "select distinct pkey from est_databases", "snaps": COUNTERS},
        oracle=f"""with g as (select c.pkey, count(s.begin_ts) as snap_count, min(begin_ts) as first_ts, max(begin_ts) as last_ts,
    cast(floor((epoch_us(max(begin_ts)) - epoch_us(min(begin_ts))) / 86400e6) as bigint) as days
  from cols c left join snaps s on s.pkey = c.pkey and s.begin_ts <= timestamp '{COVERAGE_DAY}' group by c.pkey),
h as (select *, round(case when days > 0 then snap_count / days end, 2) as snaps_per_day from g)
select *, case when snap_count = 0 or days = 0 then 'FAILED' when days < 7 or snaps_per_day < 20 then 'WARNING' else 'SUCCESS' end as status
from h"""),
    "c22_redo_per_day": Spec(
        build=lambda hist, logs: ts.redo_per_day(hist, logs, as_of="1998-08-02"),
        inputs={"hist": ORDERS_LOGS, "logs": "select pkey, bytes from est_tables"},
        oracle="""with d as (select pkey, cast(first_time as date) as day, count(*) as switches from hist
    where cast(first_time as date) < date '1998-08-02' group by pkey, cast(first_time as date)),
a as (select pkey, avg(switches) as avg_switches from d group by pkey),
b as (select pkey, avg(bytes) as avg_log_bytes from logs group by pkey)
select a.pkey, round(avg_switches * avg_log_bytes / 1073741824.0) as redo_gb_per_day from a join b on a.pkey = b.pkey"""),
    "c3_join_snapshots_as_of": Spec(
        build=lambda facts, snaps: ts.snapshots_as_of(facts, snaps, keys=["dbid"], fact_ts="sample_ts"),
        inputs={"facts": "select pkey, dbid, instance_number, stat_name, snap_id as sample_id, begin_ts as sample_ts, "
                         "value from est_counters",
                "snaps": "select dbid, begin_ts, snap_id from est_snapshots where extract(hour from begin_ts) <> 3"},
        oracle="""select f.pkey, f.dbid, f.instance_number, f.stat_name, f.sample_id, f.sample_ts, f.value, s.snap_id
from facts f asof left join snaps s on f.dbid = s.dbid and f.sample_ts >= s.begin_ts"""),
    "c11_snapshot_intervals_awr": Spec(
        build=lambda snaps: ts.snapshot_intervals(snaps, keys=("dbid", "instance_number"), form="awr"),
        inputs={"snaps": "select dbid, 1 as instance_number, snap_id, begin_ts, "
                         "begin_ts + interval 50 minute as end_ts, startup_tag from est_snapshots"},
        oracle=f"""with s as (select *, (epoch_us(end_ts) - epoch_us(begin_ts)) / 1e6 as secs,
    lag(startup_tag) over (partition by dbid, instance_number order by snap_id) as ps from snaps),
k as (select *, strftime(begin_ts, '%H') as hour from s where startup_tag = ps),
{mode_cte('k', ['dbid', 'instance_number', 'hour'], 'secs')}
select a.*, round(m.mode_v) as mode_secs from (
  select dbid, instance_number, hour, min(snap_id) as min_snap_id, max(snap_id) as max_snap_id,
    strftime(min(begin_ts), '%Y-%m-%d %H:%M:%S') as min_begin_ts, strftime(max(begin_ts), '%Y-%m-%d %H:%M:%S') as max_begin_ts,
    count(*) as cnt, round(sum(secs)) as sum_secs, round(avg(secs)) as avg_secs, round(median(secs)) as median_secs,
    round(min(secs)) as min_secs, round(max(secs)) as max_secs
  from k group by dbid, instance_number, hour) a
left join __mode m on a.dbid = m.dbid and a.instance_number = m.instance_number and a.hour = m.hour"""),
    "c14_top_statements_bytes": Spec(
        build=lambda stats: ts.top_statements(stats, n=299, byte_columns=["physical_read_bytes", "physical_write_bytes"]),
        inputs={"stats": "select *, elapsed * 8 as physical_read_bytes, rows_processed * 512 as physical_write_bytes "
                         "from est_statements"},
        oracle=STMT_ORACLE.replace("sum(rows_processed) as rows_processed from stats",
                                   "sum(rows_processed) as rows_processed, cast(round(sum(physical_read_bytes)) as bigint) "
                                   "as physical_read_bytes_total, cast(round(sum(physical_write_bytes)) as bigint) "
                                   "as physical_write_bytes_total from stats")),
    "c14_top_statements_111": Spec(
        build=lambda stats: ts.top_statements(stats, n=299, byte_columns=["physical_read_bytes", "physical_write_bytes"],
                                              bytes_unavailable=True),
        inputs={"stats": "select * from est_statements"},
        oracle=STMT_ORACLE.replace("sum(rows_processed) as rows_processed from stats",
                                   "sum(rows_processed) as rows_processed, -1 as physical_read_bytes_total, "
                                   "-1 as physical_write_bytes_total from stats")),
}

# C14 with snapshots and all measures; every counter is a different multiple of two columns
_C14_COUNTERS = ["executions_delta", "px_servers_execs_delta", "elapsed_time_total", "disk_reads_delta",
                 "physical_read_bytes_delta", "physical_write_bytes_delta", "io_offload_elig_bytes_delta",
                 "io_interconnect_bytes_delta", "optimized_physical_reads_delta", "cell_uncompressed_bytes_delta",
                 "io_offload_return_bytes_delta", "direct_writes_delta", "end_of_fetch_count_delta", "rows_processed_delta",
                 "buffer_gets_delta", "cpu_time_delta", "elapsed_time_delta", "iowait_delta", "clwait_delta", "apwait_delta",
                 "ccwait_delta", "plsexec_time_delta", "javexec_time_delta"]
C14_INPUTS = {
    "stats": "select concat('pk', cast(l_suppkey % 3 as string)) as pkey, 'N/A' as con_id, 1 as dbid, "
             "cast(l_suppkey % 2 as int) as instance_number, l_orderkey % 97 as snap_id, "
             "cast(l_partkey % 700 as string) as force_matching_signature, concat('sql', cast(l_orderkey as string)) as sql_id, "
             + ", ".join("cast(l_linenumber % 3 as bigint) as executions_delta" if i == 0 else
                         f"cast(floor(l_extendedprice) as bigint) * {i} + cast(l_quantity as bigint) % {i + 1} as {c}"
                         for i, c in enumerate(_C14_COUNTERS)) + " from lineitem",
    "snaps": "select distinct concat('pk', cast(o_custkey % 3 as string)) as pkey, 1 as dbid, "
             "cast(o_custkey % 2 as int) as instance_number, o_orderkey % 97 as snap_id from orders where o_orderkey % 13 <> 5",
}


def _c14_avg(c, name, factor=""):
    return f"cast(trunc(case when sum(executions_delta) = 0 then 0 else sum({c}){factor} / sum(executions_delta) end) as bigint) as {name}"


C14_ORACLE = """with g as (select a.pkey, a.con_id, b.dbid, b.instance_number, force_matching_signature, min(sql_id) as sql_id,
  cast(round(sum(executions_delta)) as bigint) as total_executions, cast(round(sum(px_servers_execs_delta)) as bigint)
  as total_px_servers_execs, cast(round(sum(elapsed_time_total)) as bigint) as elapsed_time_total,
  """ + ",\n  ".join([f"cast(round(sum({c}_delta)) as bigint) as {c}_total" for c in (
    "disk_reads", "physical_read_bytes", "physical_write_bytes", "io_offload_elig_bytes", "io_interconnect_bytes",
    "optimized_physical_reads", "cell_uncompressed_bytes", "io_offload_return_bytes", "direct_writes")]
    + [_c14_avg("end_of_fetch_count_delta", "perc_exec_finished", " * 100"), _c14_avg("rows_processed_delta", "avg_rows"),
       _c14_avg("disk_reads_delta", "avg_disk_reads"), _c14_avg("buffer_gets_delta", "avg_buffer_gets"),
       _c14_avg("cpu_time_delta", "avg_cpu_time_us"), _c14_avg("elapsed_time_delta", "avg_elapsed_us")]
    + [_c14_avg(f"{c}_delta", f"avg_{c}_us") for c in ("iowait", "clwait", "apwait", "ccwait")]
    + [_c14_avg("plsexec_time_delta", "avg_plsexec_us"), _c14_avg("javexec_time_delta", "avg_javexec_us")]) + """
from stats a join snaps b on a.pkey = b.pkey and a.snap_id = b.snap_id and a.instance_number = b.instance_number and a.dbid = b.dbid
where b.snap_id between 10 and 80 group by a.pkey, a.con_id, b.dbid, b.instance_number, force_matching_signature)
select * from (select *, row_number() over (partition by pkey order by elapsed_time_total desc, con_id, dbid, instance_number,
  force_matching_signature) as rank from g) r where rank <= 299"""
SPECS["c14_statement_profile"] = Spec(build=lambda stats, snaps: ts.statement_profile(stats, snaps, lo=10, hi=80),
                                      inputs=C14_INPUTS, oracle=C14_ORACLE)
