"""Registered jobs of sections A10 and E (readiness rules) with their oracles."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from fleetscope.functions.expressions import major_version, minor_version
from fleetscope.operators import inventory as inv
from fleetscope.plans import readiness as R
from fleetscope.plans.catalog_inventory import D39_KINDS_INPUTS, D39_KINDS_ORACLE
from fleetscope.plans.spec import Spec


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def major_sql(v: str, fam: str) -> str:
    cut = f"(case when strpos({v}, 'beta') > 0 then split_part({v}, 'beta', 1) || '.0' else {v} end)"
    return (f"coalesce(case when {cut} like '{fam}%' then try_cast(array_to_string(string_split({cut}, '.')[1:2], '.')"
            f" as double) else try_cast(string_split({cut}, '.')[1] as double) end, -1.0)")


def minor_sql(v: str, fam: str) -> str:
    m = f"regexp_extract({v}, '^(\\d+\\.\\d+(\\.\\d+)?)', 1)"
    return (f"(case when {m} = '' then -1 when {v} like '{fam}%' then coalesce(try_cast(string_split({m}, '.')[3] as int), -1)"
            f" else coalesce(try_cast(string_split({m}, '.')[2] as int), -1) end)")


TG = "tg as (select * from (values " + ", ".join(
    f"('{t['target']}', cast({t['min_major']} as double), cast({t['max_major']} as double), {t['extra']})"
    for t in R.PG_TARGETS) + ") as t(migration_target, min_major, max_major, extra))"
TG_MY = "tg as (select * from (values " + ", ".join(
    f"('{t['target']}', cast({t['min_major']} as double), cast({t['max_major']} as double), {t['extra']})"
    for t in R.MYSQL_TARGETS) + ") as t(migration_target, min_major, max_major, extra))"
MANAGED = """col as (select distinct pkey from databases),
mg as (select col.pkey, coalesce(max(case when e.extension_owner = 'rdsadmin' and e.is_super_user then 1 else 0 end), 0) = 1 as is_managed
  from col left join extensions e on col.pkey = e.pkey group by col.pkey)"""


def _ext_in(col: str, key: str) -> str:
    return "(case " + " ".join(f"when tg.migration_target = '{t['target']}' then {col} in ({_in(t[key])})"
                               for t in R.PG_TARGETS) + " end)"


INPUTS = {
    "databases": "select * from est_databases",
    "settings": "select * from est_settings",
    "extensions": "select * from est_extensions",
    "ftables": """select pkey, owner as table_schema, table_name, case when num_rows % 300 = 0 then 'postgres_fdw'
  when num_rows % 200 = 0 then 'file_fdw' else 'mysql_fdw' end as fdw_name from est_tables where relkind = 'f'""",
    "slots": "select pkey, database_name from est_extensions where extension_name = 'pglogical'",
    "roles": "select distinct pkey, case when pkey = 'pk1' then 'false' else 'true' end as rolreplication from est_settings",
    "usage": """select pkey, database_name, extension_owner <> 'rdsadmin' as has_schema_usage_privilege from est_extensions
where extension_name = 'pglogical'""",
    "privs": """select pkey, database_name, true as has_tables_select_privilege,
  database_name <> 'db3' as has_local_node_select_privilege, true as has_node_select_privilege,
  true as has_node_interface_select_privilege from est_extensions where extension_name = 'pg_cron'""",
    **D39_KINDS_INPUTS,
    "nodes": "select distinct pkey, database_name from est_extensions where extension_owner = 'alloydbadmin'",
    "nopk": """select t.pkey, concat('db', cast(t.object_id % 3 + 5 * (t.object_id % 4) as string)) as database_name, t.owner as schema_name, t.table_name
from est_tables t left join (select distinct pkey, owner, table_name from est_constraints where constraint_type = 'P') c
  on t.pkey = c.pkey and t.owner = c.owner and t.table_name = c.table_name
where c.table_name is null and t.relkind in ('r', 'p')""",
    "replica": """select t.pkey, concat('db', cast(t.object_id % 3 + 5 * (t.object_id % 4) as string)) as database_name, t.owner as schema_name, t.table_name
from est_tables t join (select distinct pkey, owner, table_name from est_constraints where constraint_type = 'P') c
  on t.pkey = c.pkey and t.owner = c.owner and t.table_name = c.table_name
where t.num_rows % 300 in (0, 100)""",
}
MYSQL_INPUTS = {
    "mdatabases": """select pkey, database_name, case cast(substr(database_name, 3) as int) % 5 when 0 then '5.7.44'
  when 1 then '8.0.36' when 2 then '5.5.1' when 3 then '8.4.0' else 'bad' end as version from est_databases""",
    "plugins": "select distinct pkey, extension_name as plugin_name from est_extensions",
}


def _managed(databases, extensions):
    return R.managed_flag(databases, extensions)


def _facts(databases, settings=None, extensions=None, slots=None):
    return R.collection_facts(databases, databases, settings, extensions, slots)


def _per_db_items(databases, extensions, usage, privs, o, g, nodes, nopk, replica):
    missing = inv.missing_privilege_messages(inv.missing_privileges_by_kind(o, g))
    gate = R.database_gate(databases, extensions, usage, privs, missing)
    return R.items_per_database(gate, nodes, nopk, replica)


def _per_db(**frames):
    return R.list_findings(_per_db_items(**frames), R.LIST_FORMATS, R.PG_TARGETS)


PER_DB_INPUTS = {k: INPUTS[k] for k in ("databases", "extensions", "usage", "privs", "o", "g", "nodes", "nopk", "replica")}


# --- oracle bodies (all over the same input aliases) ----------------------------------------

O_E1 = f"""with {TG}, {MANAGED},
c as (select pkey, min(version) as version from databases group by pkey),
v as (select c.pkey, c.version, mg.is_managed, {major_sql('c.version', '9')} as major, {minor_sql('c.version', '9')} as minor
  from c left join mg on c.pkey = mg.pkey),
r as (select v.*, tg.*, case when coalesce(is_managed, false) then
    (case major {' '.join(f'when {k} then {m}' for k, m in R.PG_MANAGED_MIN_MINOR.items())} end) is not null
    and minor < (case major {' '.join(f'when {k} then {m}' for k, m in R.PG_MANAGED_MIN_MINOR.items())} end)
  else (major not in ({', '.join(str(x) for x in R.PG_VERSIONS)}) or major < min_major
        or (max_major is not null and major > max_major)) end as is_err from v cross join tg)
select pkey, migration_target, 'DATABASE_VERSION' as rule_code, case when is_err then 'ERROR' else 'PASS' end as severity,
  case when is_err then (case when coalesce(is_managed, false)
      then 'Source managed database server has unsupported minor version: (' || cast(minor as varchar) || ')'
      else 'Migration from source database server (' || version || ') is not supported' end)
    else 'Version ' || version || ' is supported.  Please ensure that you selected a version that meets or exceeds version '
      || cast(major as varchar) || '.' end as info
from r"""

O_E2 = f"""with {TG},
items as (select distinct pkey, lower(collation_name) as coll from databases),
bad as (select * from items cross join tg
  where not (coll in ({_in([c.lower() for c in R.BASE_COLLATIONS])}) or regexp_matches(coll, '{R.ICU_COLLATION_REGEX}'))),
base as (select distinct d.pkey, tg.migration_target from databases d cross join tg)
select pkey, migration_target, 'COLLATION' as rule_code, 'ERROR' as severity,
  'Unsupported collation: ' || coll || ' is not supported on this instance' as info from bad
union all
select pkey, migration_target, 'COLLATION', 'PASS', 'All utilized collations are supported.' from base b
where not exists (select 1 from bad where bad.pkey = b.pkey and bad.migration_target = b.migration_target)"""

O_E3 = f"""with {TG}, {MANAGED},
s as (select pkey, min(setting_value) as v from settings where setting_name = 'rds.logical_replication' group by pkey),
c as (select mg.pkey, coalesce(s.v, 'unset') as v from mg left join s on mg.pkey = s.pkey where mg.is_managed)
select pkey, migration_target, 'RDS_LOGICAL_REPLICATION' as rule_code,
  case when v <> 'on' then 'ACTION REQUIRED' else 'PASS' end as severity,
  case when v <> 'on' then '`rds.logical_replication` should be set to "on" instead of (' || v || ')'
    else '`rds.logical_replication` was correctly set to "on"' end as info
from c cross join tg"""

O_E4 = f"""with {TG},
s as (select pkey, min(setting_value) as v from settings where setting_name = 'wal_level' and setting_value <> 'logical'
  group by pkey),
c as (select col.pkey, s.v from (select distinct pkey from databases) col left join s on col.pkey = s.pkey)
select pkey, migration_target, 'WAL_LEVEL' as rule_code, case when v is not null then 'ACTION REQUIRED' else 'PASS' end
  as severity,
  case when v is not null then 'The `wal_level` settings should be set to "logical" instead of "' || v || '".'
    else '`wal_level` is correctly set to "logical".' end as info
from c cross join tg"""

COUNTS = """cnt as (select col.pkey, coalesce(db.n, 0) as db_count,
    coalesce(try_cast(s1.v as bigint), 0) as slots, coalesce(try_cast(s2.v as bigint), 0) as senders,
    coalesce(try_cast(s3.v as bigint), 0) as workers, coalesce(us.n, 0) as used_slots
  from (select distinct pkey from databases) col
  left join (select pkey, count(*) as n from databases group by pkey) db on col.pkey = db.pkey
  left join (select pkey, min(setting_value) as v from settings where setting_name = 'max_replication_slots' group by pkey) s1
    on col.pkey = s1.pkey
  left join (select pkey, min(setting_value) as v from settings where setting_name = 'max_wal_senders' group by pkey) s2
    on col.pkey = s2.pkey
  left join (select pkey, min(setting_value) as v from settings where setting_name = 'max_worker_processes' group by pkey) s3
    on col.pkey = s3.pkey
  left join (select pkey, count(*) as n from {slots} group by pkey) us on col.pkey = us.pkey)"""


def band_sql(rule: str, have: str, need: str, setting: str, word: str, slots: str = "slots") -> str:
    counts = COUNTS.replace("{slots}", slots) if slots else COUNTS.replace(
        "left join (select pkey, count(*) as n from {slots} group by pkey) us on col.pkey = us.pkey", "").replace(
        "coalesce(us.n, 0) as used_slots", "0 as used_slots")
    return f"""with {TG}, {counts},
t as (select cnt.*, tg.*, {need} as need, {need} + extra as mx from cnt cross join tg)
select pkey, migration_target, '{rule}' as rule_code,
  case when {have} < need then 'ACTION REQUIRED' when {have} < mx then 'WARNING' else 'PASS' end as severity,
  case when {have} < need then 'Insufficient `{setting}`: ' || cast({have} as varchar) || ', should be set to at least '
      || cast(need as varchar) || '. Up to ' || cast(extra as varchar) || ' additional {word} might be required depending on '
      || 'the parallelism level set for migration.'
    when {have} < mx then '`{setting}` current value: ' || cast({have} as varchar) || ', this might need to be increased to '
      || cast(mx as varchar) || ' depending on the parallelism level set for migration.'
    else '`{setting}` current value: ' || cast({have} as varchar) || ', this meets or exceeds the maximum required value of '
      || cast(mx as varchar) end as info
from t"""


O_E5 = band_sql("MAX_REPLICATION_SLOTS", "slots", "db_count + used_slots", "max_replication_slots", "subscriptions")
O_E7 = band_sql("MAX_WORKER_PROCESSES", "workers", "db_count", "max_worker_processes", "`worker_processes`", slots="")
O_E8 = band_sql("MAX_WAL_SENDERS", "senders", "db_count", "max_wal_senders", "`wal_senders`", slots="")
O_E6 = f"""with {TG}, {COUNTS.replace("left join (select pkey, count(*) as n from {slots} group by pkey) us on col.pkey = us.pkey", "").replace("coalesce(us.n, 0) as used_slots", "0 as used_slots")}
select pkey, migration_target, 'WAL_SENDERS_REPLICATION_SLOTS' as rule_code,
  case when senders < slots then 'ACTION REQUIRED' else 'PASS' end as severity,
  case when senders < slots then 'Insufficient `max_wal_senders`: ' || cast(senders as varchar)
      || ', should be set to at least the same as `max_replication_slots`: ' || cast(slots as varchar) || '.'
    else '`max_wal_senders` current value: ' || cast(senders as varchar)
      || ', this meets or exceeds the `max_replication_slots` value of ' || cast(slots as varchar) end as info
from cnt cross join tg"""

O_E9 = f"""with {TG},
items as (select pkey, fdw_name, count(distinct table_schema || table_name) as table_count from ftables
  where fdw_name is not null group by pkey, fdw_name),
bad as (select * from items cross join tg where not {_ext_in('fdw_name', 'fdws')}),
base as (select distinct d.pkey, tg.migration_target from databases d cross join tg)
select pkey, migration_target, 'FDWS' as rule_code, 'ACTION REQUIRED' as severity,
  'Unsupported FDW: detected ' || cast(table_count as varchar) || ' "' || fdw_name || '" foreign tables.' as info from bad
union all
select pkey, migration_target, 'FDWS', 'PASS', 'All utilized foreign data wrappers are supported.' from base b
where not exists (select 1 from bad where bad.pkey = b.pkey and bad.migration_target = b.migration_target)"""


def ext_sql(rule: str, cond: str, text: str, pass_info: str) -> str:
    return f"""with {TG},
picked as (select e.*, tg.migration_target from extensions e cross join tg where {cond}),
per_db as (select pkey, migration_target, database_name, 'database ' || database_name || '{text}'
    || string_agg(extension_name, ',' order by extension_name) || ';' || chr(10) || chr(10) as msg
  from picked group by pkey, migration_target, database_name),
per_key as (select pkey, migration_target, string_agg(msg, '' order by database_name, msg) as info
  from per_db group by pkey, migration_target),
base as (select distinct d.pkey, tg.migration_target from databases d cross join tg)
select pkey, migration_target, '{rule}' as rule_code, 'WARNING' as severity, info, 0 as part from per_key
union all
select pkey, migration_target, '{rule}', 'PASS', '{pass_info}', 0 from base b
where not exists (select 1 from per_key k where k.pkey = b.pkey and k.migration_target = b.migration_target)"""


O_E10 = ext_sql("UNSUPPORTED_EXTENSIONS_NOT_MIGRATED",
                f"extension_owner not in ({_in(R.SUPER_ROLES)}) and not {_ext_in('extension_name', 'extensions')}",
                " has unsupported extensions installed and they will not be migrated: ",
                "All utilized extensions are supported.")
O_E11 = ext_sql("EXTENSIONS_NOT_MIGRATED", f"extension_name in ({_in(R.NONMIGRATED_EXTENSIONS)})",
                " has extensions that will not be migrated: ", "All utilized extensions will be migrated.")

O_E12 = f"""with {TG}, {MANAGED},
r as (select pkey, min(rolreplication) as r from roles group by pkey),
c as (select r.* from r join mg on r.pkey = mg.pkey where not mg.is_managed)
select pkey, migration_target, 'REPLICATION_ROLE' as rule_code, case when r = 'false' then 'ACTION REQUIRED' else 'PASS' end
  as severity, case when r = 'false' then 'user does not have rolreplication role.' else 'user has rolreplication role.' end
  as info from c cross join tg"""

NL = "chr(10)"
PRIV_COLS = [c for c, _ in R.PGLOGICAL_TABLE_PRIVS]
# missing privileges as D39 gives them
_D39_MESSAGES = f"""select pkey, database_name, case object_type when 'SCHEMA' then 1 when 'TABLE' then 2 when 'VIEW' then 3 else 4 end
  as kind_order, 'user doesn''t have ' || case object_type when 'SCHEMA' then 'USAGE privilege on schema ' || owner
  else 'SELECT privilege on ' || lower(object_type) || ' ' || owner || '.' || object_name end as message
from ({D39_KINDS_ORACLE}) m"""
O_PER_DB = f"""with {TG}, missing as ({_D39_MESSAGES}),
dbs as (select distinct pkey, database_name from databases),
inst as (select distinct pkey, database_name from extensions where extension_name = 'pglogical'),
d as (select dbs.*, inst.pkey is not null as installed from dbs left join inst
  on dbs.pkey = inst.pkey and dbs.database_name = inst.database_name),
u as (select pkey, database_name, min(cast(has_schema_usage_privilege as int)) as uu from usage group by all),
p as (select pkey, database_name, 1 as pp, {', '.join(f'min(cast({c} as int)) as {c}' for c in PRIV_COLS)}
  from privs group by all),
held as (select d.pkey, d.database_name, u.uu, p.pp, {', '.join('p.' + c for c in PRIV_COLS)} from d
  left join u on d.pkey = u.pkey and d.database_name = u.database_name
  left join p on d.pkey = p.pkey and d.database_name = p.database_name where d.installed),
own as (select pkey, database_name, 0 as kind_order, '' as sub,
    case when uu is null then 'Empty result reading pglogical schema usage privilege for the user'
      when uu = 0 then 'user doesn''t have USAGE privilege on schema pglogical'
      when pp is null then 'Empty result reading pglogical privileges for the user' end as msg from held
  {' '.join(f"union all select pkey, database_name, {i + 1}, '', case when uu = 1 and {c} = 0 then 'user doesn''t have SELECT privilege on table {t}' end from held" for i, (c, t) in enumerate(R.PGLOGICAL_TABLE_PRIVS))}),
objs as (select m.pkey, m.database_name, m.kind_order + 100 as kind_order, m.message as sub, m.message as msg
  from missing m join d on m.pkey = d.pkey and m.database_name = d.database_name where d.installed),
errs as (select pkey, database_name, string_agg(msg, {NL} order by kind_order, sub, msg) as errors from (
  select * from own where msg is not null union all select * from objs) x group by pkey, database_name),
gate as (select d.*, e.errors, d.installed and e.errors is null as passed from d left join errs e
  on d.pkey = e.pkey and d.database_name = e.database_name),
chk as (select g.*, n.pkey is not null as has_node from gate g left join (select distinct pkey, database_name from nodes) n
  on g.pkey = n.pkey and g.database_name = n.database_name where g.passed),
open_dbs as (select pkey, database_name from gate where not installed or passed),
nopk_db as (select t.pkey, t.database_name, string_agg(t.schema_name || '.' || t.table_name, ', '
    order by t.schema_name || '.' || t.table_name) as tables
  from nopk t join open_dbs o on t.pkey = o.pkey and t.database_name = o.database_name group by all),
rep_db as (select t.pkey, t.database_name, string_agg(t.schema_name || '.' || t.table_name, ', '
    order by t.schema_name || '.' || t.table_name) as tables
  from replica t join open_dbs o on t.pkey = o.pkey and t.database_name = o.database_name group by all),
rows as (
  select pkey, 'PGLOGICAL_INSTALLED' as rule_code, 'ACTION REQUIRED' as severity,
    '`pglogical` extension is not installed on the databases: ' || string_agg(database_name, ',' order by database_name)
    || '.' as info from gate where not installed group by pkey
  union all select pkey, 'PGLOGICAL_INSTALLED', 'PASS', '`pglogical` is installed on the databases: '
    || string_agg(database_name, ',' order by database_name) || '.' from gate where installed group by pkey
  union all select pkey, 'PRIVILEGES', 'ACTION REQUIRED', string_agg(errors || ' in database ' || database_name,
    ';' || {NL} || {NL} order by database_name) from gate where installed and not passed group by pkey
  union all select pkey, 'PRIVILEGES', 'PASS', string_agg('User has all privileges required for migration for the database '
    || database_name, ';' || {NL} order by database_name) from gate where passed group by pkey
  union all select pkey, 'PGLOGICAL_NODE_ALREADY_EXISTS', 'ACTION REQUIRED',
    'pglogical provider node already exists on databases: ' || string_agg(database_name, ',' order by database_name)
    from chk where has_node group by pkey
  union all select pkey, 'PGLOGICAL_NODE_ALREADY_EXISTS', 'PASS', 'No existing pglogical provider node on the database: '
    || string_agg(database_name, ',' order by database_name) from chk where not has_node group by pkey
  union all select pkey, 'TABLES_WITH_NO_PK', 'WARNING', 'Some tables have limited support. Tables without primary keys '
    || 'were identified and only INSERT statements will be replicated for these tables: '
    || string_agg('In database ' || database_name || ', ' || tables || ' don''t have primary keys', ';' order by database_name)
    from nopk_db group by pkey
  union all select pkey, 'UNSUPPORTED_TABLES_WITH_REPLICA_IDENTITY', 'ACTION REQUIRED', 'Source has table(s) with both '
    || 'primary key and replica identity FULL or NOTHING. Please remove replica identity or change it to DEFAULT to migrate: '
    || string_agg(tables || ' in database ' || database_name, ';' order by database_name) from rep_db group by pkey)
select rows.pkey, tg.migration_target, rows.rule_code, rows.severity, rows.info, 0 as part from rows cross join tg"""

O_E18 = f"""with {MANAGED} select * from mg"""

O_E19 = f"""with {TG_MY},
c as (select pkey, min(version) as version from mdatabases group by pkey),
v as (select c.*, {major_sql('version', '5')} as major from c),
r as (select v.*, tg.*, major not in (5.6, 5.7, 8.0) or major < min_major as is_err from v cross join tg)
select pkey, migration_target, 'DATABASE_VERSION' as rule_code, case when is_err then 'ERROR' else 'PASS' end as severity,
  case when is_err then 'Replication from source database server (' || version || ') is not supported'
    else 'Version ' || version || ' is supported.  Please ensure that you selected a version that meets or exceeds version '
      || cast(major as varchar) || '.' end as info from r"""

O_E20 = f"""with {TG_MY},
bad as (select distinct p.pkey, p.plugin_name, tg.migration_target from plugins p cross join tg),
base as (select distinct d.pkey, tg.migration_target from mdatabases d cross join tg)
select pkey, migration_target, 'PLUGINS' as rule_code, 'ERROR' as severity,
  'Unsupported plugin: ' || plugin_name || ' is not supported on this instance' as info from bad
union all
select pkey, migration_target, 'PLUGINS', 'PASS', 'All utilized plugins are supported.' from base b
where not exists (select 1 from bad where bad.pkey = b.pkey and bad.migration_target = b.migration_target)"""

PG_RULE_ORACLES = [O_E1, O_E2, O_E3, O_E4, O_E5, O_E6, O_E7, O_E9, O_E10, O_E11, O_E12, O_PER_DB]
SEV_RANK_SQL = "case severity " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(R.SEVERITY_ORDER)) + " end"


def _pg_all(databases, settings, extensions, ftables, slots, roles, **frames):
    f = _facts(databases, settings, extensions, slots)
    lacking, supported = R.unsupported_extensions(extensions, databases)
    left, migrated = R.extensions_not_migrated(extensions, databases)
    items = lacking.unionByName(left).unionByName(_per_db_items(databases=databases, extensions=extensions, **frames))
    return R.evaluate([
        R.rule_database_version_pg(f),
        R.rule_collation(databases),
        R.rule_managed_logical_replication(f),
        R.rule_wal_level(f),
        R.rule_max_replication_slots(f),
        R.rule_wal_senders_replication_slots(f),
        R.rule_max_worker_processes(f),
        R.rule_fdws(ftables, databases),
        supported, migrated,
        R.rule_replication_role(f, roles),
        R.list_findings(items, R.LIST_FORMATS, R.PG_TARGETS),   # E10, E11, E13-E17 in one pass
    ])


def _pick(rule_code):
    def build(**frames):
        items = _per_db_items(**frames).where(F.col("rule_code") == rule_code)
        return R.list_findings(items, R.LIST_FORMATS, R.PG_TARGETS)
    return build


def _sub(body: str) -> str:
    return f"select *{'' if ' as part' in body else ', 0 as part'} from ({body}) x"


SPECS: dict[str, Spec] = {
    "a10_parse_version": Spec(
        build=lambda d: d.select("database_name", "version", major_version("version", "9").alias("pg_major"),
                                 minor_version("version", "9").alias("pg_minor"),
                                 major_version("version", "5").alias("mysql_major"),
                                 minor_version("version", "5").alias("mysql_minor")),
        inputs={"d": """select database_name, version from est_databases
union all select database_name, concat(version, 'beta2') from est_databases
union all select database_name, case cast(substr(database_name, 3) as int) % 4 when 0 then '5.7.44' when 1 then '15.0.100'
  when 2 then '2.0' else '9.6' end from est_databases"""},
        oracle=f"""select database_name, version, {major_sql('version', '9')} as pg_major, {minor_sql('version', '9')} as pg_minor,
  {major_sql('version', '5')} as mysql_major, {minor_sql('version', '5')} as mysql_minor from d"""),
    "e1_database_version": Spec(
        build=lambda databases, extensions: R.rule_database_version_pg(_facts(databases, extensions=extensions)),
        inputs={k: INPUTS[k] for k in ("databases", "extensions")}, oracle=O_E1),
    "e2_collation": Spec(
        build=lambda databases: R.rule_collation(databases), inputs={"databases": INPUTS["databases"]}, oracle=O_E2),
    "e3_rds_logical_replication": Spec(
        build=lambda databases, extensions, settings: R.rule_managed_logical_replication(
            _facts(databases, settings, extensions)),
        inputs={k: INPUTS[k] for k in ("databases", "extensions", "settings")}, oracle=O_E3),
    "e4_wal_level": Spec(
        build=lambda databases, settings: R.rule_wal_level(_facts(databases, settings)),
        inputs={k: INPUTS[k] for k in ("databases", "settings")}, oracle=O_E4),
    "e5_max_replication_slots": Spec(
        build=lambda databases, settings, slots: R.rule_max_replication_slots(_facts(databases, settings, slots=slots)),
        inputs={k: INPUTS[k] for k in ("databases", "settings", "slots")}, oracle=O_E5),
    "e6_wal_senders_replication_slots": Spec(
        build=lambda databases, settings: R.rule_wal_senders_replication_slots(_facts(databases, settings)),
        inputs={k: INPUTS[k] for k in ("databases", "settings")}, oracle=O_E6),
    "e7_max_worker_processes": Spec(
        build=lambda databases, settings: R.rule_max_worker_processes(_facts(databases, settings)),
        inputs={k: INPUTS[k] for k in ("databases", "settings")}, oracle=O_E7),
    "e8_max_wal_senders": Spec(
        build=lambda databases, settings: R.rule_max_wal_senders(_facts(databases, settings)),
        inputs={k: INPUTS[k] for k in ("databases", "settings")}, oracle=O_E8),
    "e9_fdws": Spec(
        build=lambda ftables, databases: R.rule_fdws(ftables, databases),
        inputs={k: INPUTS[k] for k in ("ftables", "databases")}, oracle=O_E9),
    "e10_unsupported_extensions": Spec(
        build=lambda extensions, databases: R.rule_unsupported_extensions(extensions, databases),
        inputs={k: INPUTS[k] for k in ("extensions", "databases")}, oracle=O_E10),
    "e11_extensions_not_migrated": Spec(
        build=lambda extensions, databases: R.rule_extensions_not_migrated(extensions, databases),
        inputs={k: INPUTS[k] for k in ("extensions", "databases")}, oracle=O_E11),
    "e12_replication_role": Spec(
        build=lambda databases, extensions, roles: R.rule_replication_role(_facts(databases, extensions=extensions), roles),
        inputs={k: INPUTS[k] for k in ("databases", "extensions", "roles")}, oracle=O_E12),
    "e13_e17_per_database_checks": Spec(
        build=_per_db,
        inputs=PER_DB_INPUTS, oracle=O_PER_DB),
    "e18_managed_flag": Spec(
        build=_managed, inputs={k: INPUTS[k] for k in ("databases", "extensions")}, oracle=O_E18),
    "e18_managed_flag_mysql": Spec(
        build=R.managed_flag_by_plugin,
        inputs={"collections": "select * from est_databases",
                "plugins": """select pkey, case when pkey in ('pk1', 'pk4') and extension_name = 'plpgsql' then 'rdsadmin'
  when pkey = 'pk2' then 'rdsadmin_x' else extension_name end as plugin_name from est_extensions"""},
        oracle="select distinct pkey, (select count(*) from plugins p where p.pkey = c.pkey and plugin_name = 'rdsadmin') > 0 "
               "as is_managed from collections c"),
    "e19_database_version_mysql": Spec(
        build=lambda mdatabases: R.rule_database_version_mysql(R.collection_facts(mdatabases, mdatabases)),
        inputs={"mdatabases": MYSQL_INPUTS["mdatabases"]}, oracle=O_E19),
    "e20_plugins": Spec(
        build=lambda plugins, mdatabases: R.rule_plugins(plugins, mdatabases),
        inputs=MYSQL_INPUTS, oracle=O_E20),
    "e0_readiness_report": Spec(
        build=lambda **frames: R.report(_pg_all(**frames)),
        inputs=INPUTS,
        oracle="select *, " + SEV_RANK_SQL + " as severity_rank from (\n"
               + "\nunion all\n".join(_sub(b) for b in PG_RULE_ORACLES) + "\n) y"),
}
for _code, _key in [("PGLOGICAL_INSTALLED", "e13_pglogical_installed"), ("PRIVILEGES", "e14_privileges"),
                    ("PGLOGICAL_NODE_ALREADY_EXISTS", "e15_pglogical_node_exists"),
                    ("TABLES_WITH_NO_PK", "e16_tables_with_no_pk"),
                    ("UNSUPPORTED_TABLES_WITH_REPLICA_IDENTITY", "e17_replica_identity")]:
    SPECS[_key] = Spec(build=_pick(_code),
                       inputs=PER_DB_INPUTS,
                       oracle=f"select * from ({O_PER_DB}) y where rule_code = '{_code}'")

# every job of E14 reads the rows of D39; the earlier name of the one that did stays
SPECS["e14_privileges_of_objects"] = replace(SPECS["e14_privileges"])
