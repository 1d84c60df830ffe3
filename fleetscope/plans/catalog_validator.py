"""Registered jobs of section F (migration-job validation) with their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from fleetscope import params
from fleetscope.operators import filters as flt
from fleetscope.plans import validator as V
from fleetscope.plans.spec import Spec


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# fixed values: the left-out owners as the oracles spell them, apart from the operators' list
LEFT_OUT_OWNERS = """'ANONYMOUS', 'APPQOSSYS', 'AUDSYS', 'CSMIG', 'CTXSYS', 'DBSFWUSER', 'DBSNMP', 'DIP', 'DMA_COLLECTOR', 'DMSYS',
  'DVSYS', 'DVF', 'EXFSYS', 'GSMADMIN_INTERNAL', 'GSMCATUSER', 'GSMUSER', 'LBACSYS', 'MDDATA', 'MDSYS', 'MGDSYS', 'MGMT_VIEW',
  'MTMSYS', 'ODM', 'ODM_MTR', 'ODMRSYS', 'OJVMSYS', 'OLAPSYS', 'ORACLE_OCM', 'ORDDATA', 'ORDPLUGINS', 'ORDS_METADATA',
  'ORDS_PUBLIC_USER', 'ORDSYS', 'OSE$HTTP$ADMIN', 'OUTLN', 'OWBSYS', 'OWBSYS_AUDIT', 'PERFSTAT', 'SI_INFORMTN_SCHEMA',
  'SPATIAL_CSW_ADMIN_USR', 'SPATIAL_WFS_ADMIN_USR', 'SQLTXPLAIN', 'SYS$UMF', 'SYS', 'SYSBACKUP', 'SYSDG', 'SYSKM', 'SYSMAN',
  'SYSTEM', 'TRACESRV', 'TSMSYS', 'WEBSYS', 'WK_PROXY', 'WK_TEST', 'WKPROXY', 'WKSYS', 'WMSYS', 'XDB', 'XS$NULL'"""


def valid_sql(col: str) -> str:
    return (f"not coalesce({col} in ({LEFT_OUT_OWNERS}) or starts_with({col}, 'APEX_') or starts_with({col}, 'AURORA$') "
            f"or starts_with({col}, 'OPS$') or starts_with({col}, 'FLOWS_'), false)")


INPUTS = {
    "vt": """select pkey, owner, case when num_rows % 700 = 0 then concat(table_name, '_HAS_A_VERY_LONG_IDENTIFIER')
  else table_name end as table_name, temporary, iot_type,
  case when num_rows % 1800 = 0 then concat('IOT_', table_name) end as iot_name, relkind
from est_tables where relkind in ('r', 'p')""",
    "vc": """select pkey, owner, table_name, column_name, data_type, data_type_owner, nullable,
  case when column_name like '%1#' then 'YES' else 'NO' end as hidden_column,
  case when data_type = 'XMLTYPE' then concat('"', column_name, '"."X"') else column_name end as qualified_col_name
from est_columns""",
    "types": """select distinct pkey, data_type_owner as owner, data_type as type_name from est_columns
where data_type = 'GEO_T' and data_type_owner = 'APP'""",
    "cons": "select * from est_constraints",
    "objt": """select pkey, owner, table_name, case when num_rows % 300 = 0 then 'XMLTYPE' else 'ADDRESS_T' end as table_type,
  owner as table_type_owner from est_tables where relkind = 'q'""",
    "xmlt": "select pkey, owner, table_name from est_tables where relkind = 'f'",
    "seqs": "select pkey, owner as sequence_owner, index_name as sequence_name from est_indexes where index_type = 'BITMAP'",
    "mv": "select pkey, owner, table_name as mview_name from est_tables where relkind = 'v' and temporary = 'Y'",
    "jobs": """select pkey, owner as log_user, case when uniqueness = 'UNIQUE' then owner else 'SYS' end as schema_user
from est_indexes""",
    "sjobs": """select pkey, owner, case when relkind = 'r' then owner else 'APEX_040200' end as program_owner
from est_tables where relkind in ('r', 'v')""",
    "tcount": "select pkey, owner, table_name from est_columns",
    "users": "select distinct pkey, case when owner = 'OWN3' then 'OWN-3' else owner end as username from est_tables",
    "icols": """select pkey, owner as table_owner, table_name, column_name, length(column_name) % 3 as column_position
from est_columns where data_type = 'NUMBER' and column_name like '%1#'""",
    "iexpr": """select pkey, owner as table_owner, table_name, length(column_name) % 3 as column_position,
  'UPPER(X)' as column_expression
from est_columns where data_type = 'NUMBER' and column_name like '%1#' and length(column_name) % 2 = 0""",
    "lobs": """select pkey, owner, table_name, column_name, concat('SEG_', column_name) as segment_name from est_columns
where data_type = 'CLOB'""",
    "nls": """select distinct pkey, 'NLS_CHARACTERSET' as parameter,
  case when version = '9.4.1' then 'WE8DEC' else 'AL32UTF8' end as value from est_databases""",
    "ols": """select pkey, case setting_name when 'wal_level' then 'OLS_CONFIGURE_STATUS' when 'max_wal_senders'
  then 'OLS_ENABLE_STATUS' else 'OLS_OTHER' end as name,
  case when setting_value in ('logical', '8') then 'TRUE' else 'FALSE' end as status from est_settings""",
    "views": """select pkey, case when num_rows = 100 then 'OCI_AUTONOMOUS_DATABASES' else table_name end as view_name
from est_tables where relkind = 'v'""",
    "vdb": """select pkey, max(case when collation_name = 'xx_unknown' then 'NOARCHIVELOG' else 'ARCHIVELOG' end) as log_mode,
  min(case when version = '10.2' then 'NO' else 'YES' end) as supplemental_log_data_min,
  min(case when version in ('10.2', '14.2') then 'NO' else 'YES' end) as supplemental_log_data_all,
  min(version) as version
from est_databases group by pkey""",
    "lgroups": """select pkey, owner, table_name, 'ALL COLUMN LOGGING' as log_group_type from est_constraints
where constraint_type = 'C'""",
    "alogs": """select concat('pk', cast(o_custkey % 4 as string)) as pkey, o_orderpriority as name,
  case when o_orderstatus = 'F' then 'NO' else 'YES' end as deleted,
  case when o_orderkey % 2 = 0 then 'ARCH' else 'LGWR' end as creator from orders""",
    "sprivs": """select distinct pkey, case when extension_owner = 'alloydbadmin' then 'APP_USER' else 'MIGRATION_USER' end as grantee,
  case extension_name when 'pglogical' then 'CREATE SESSION'
  when 'pg_cron' then 'SELECT ANY DICTIONARY' when 'hstore' then 'LOGMINING' else 'ALTER SESSION' end as privilege
from est_extensions""",
    "rprivs": """select distinct pkey, case when extension_owner = 'alloydbadmin' then 'APP_USER' else 'MIGRATION_USER' end as grantee,
  case when extension_owner = 'rdsadmin' then 'DBA' when extension_owner = 'alloydbadmin' then 'DBA' else 'CONNECT' end as granted_role
from est_extensions""",
    "rsprivs": """select distinct pkey, case when version = '9.4.1' then 'RESOURCE' else 'CONNECT' end as role,
  case when version = '14.2' then 'CREATE TABLE' else 'CREATE SESSION' end as privilege from est_databases""",
    "tprivs": """select pkey, 'MIGRATION_USER' as grantee, 'SYS' as owner, 'V_$DATABASE' as table_name, 'SELECT' as privilege from est_databases
union all select pkey, case when table_name like '%3' then 'APP_USER' else 'MIGRATION_USER' end, owner, table_name, 'SELECT'
from est_constraints where constraint_type = 'U'""",
}

# container databases: pluggable database 3 and root 1 of every collection, chains and a cycle of roles
MT_INPUTS = {
    "mdb": "select pkey, min(version) as version, 3 as pdb_con_id from est_databases group by pkey",
    "msprivs": """select distinct pkey, case when database_name in ('db0', 'db2', 'db4', 'db6', 'db8') then 1 else 3 end as con_id,
  case when extension_owner = 'alloydbadmin' then 'APP_USER' else 'MIGRATION_USER' end as grantee,
  case extension_name when 'pglogical' then 'SET CONTAINER' when 'hstore' then 'LOGMINING' else 'ALTER SESSION' end as privilege
from est_extensions""",
    "mrprivs": """select distinct pkey, case when database_name in ('db0', 'db2', 'db4', 'db6', 'db8') then 1 else 3 end as con_id,
  case extension_name when 'pglogical' then 'MIGRATION_USER' when 'pg_cron' then 'CONNECT' when 'plpgsql' then 'BASE_ROLE'
    when 'hstore' then 'BASE_ROLE' else 'APP_USER' end as grantee,
  case extension_name when 'pglogical' then 'CONNECT' when 'pg_cron' then 'BASE_ROLE' when 'plpgsql' then 'CONNECT'
    when 'hstore' then 'EXECUTE_CATALOG_ROLE' else 'DBA' end as granted_role
from est_extensions
union select distinct pkey, 3, 'MIGRATION_USER', 'DBA' from est_extensions where extension_owner = 'rdsadmin'""",
    "mrsprivs": """select distinct pkey, case when database_name in ('db0', 'db2', 'db4', 'db6', 'db8') then 1 else 3 end as con_id,
  'BASE_ROLE' as role, case when extension_name = 'hstore' then 'SELECT ANY DICTIONARY' else 'CREATE SESSION' end as privilege
from est_extensions where extension_name in ('hstore', 'plpgsql')""",
    "mtprivs": """select pkey, 1 as con_id, 'MIGRATION_USER' as grantee, 'SYS' as owner, 'DBMS_LOGMNR' as table_name, 'EXECUTE' as privilege
from est_databases
union all select pkey, 3, 'MIGRATION_USER', 'SYS', 'V_$DATABASE', 'SELECT' from est_databases where version <> '14.2'
union all select pkey, case when table_name like '%5' then 1 else 3 end, case when table_name like '%3' then 'APP_USER' else 'MIGRATION_USER' end,
  owner, table_name, 'SELECT' from est_constraints where constraint_type = 'U'""",
    "mvt": f"""select *, case when table_name like '%9' then 4 else 3 end as con_id from ({INPUTS['vt']}) v""",
}


def _sev(code: str) -> str:
    return f"'{code}' as finding, '{V.SEVERITY[code]}' as severity"


def _qual(*cols) -> str:
    return "concat_ws('.', " + ", ".join(cols) + ")"


O = {
    "NAME_LENGTHS": f"""select distinct * from (
  select pkey, {_sev('NAME_LENGTHS')}, 'Unsupported table name' as result_message, {_qual('owner', 'table_name')} as result_object
  from vt where {valid_sql('owner')} and length(table_name) > 30
  union all
  select pkey, {_sev('NAME_LENGTHS')}, 'Unsupported column name', {_qual('owner', 'table_name', 'column_name')}
  from vc where {valid_sql('owner')} and length(column_name) > 30) x""",
    "NAMESPACE_CLASH": f"""select pkey, {_sev('NAMESPACE_CLASH')}, 'Constraint name ' || {_qual('owner', 'constraint_name')}
  as result_message, 'Table name ' || {_qual('owner', 'table_name')} as result_object
from cons where {valid_sql('owner')} and constraint_name = table_name""",
    "OBJECT_TABLES": f"""select pkey, {_sev('OBJECT_TABLES')}, 'Object table type ' || {_qual('table_type_owner', 'table_type')}
  as result_message, {_qual('owner', 'table_name')} as result_object
from objt where {valid_sql('owner')} and table_type <> 'XMLTYPE'""",
    "XML_TABLES": f"""select pkey, {_sev('XML_TABLES')}, 'XMLType table' as result_message,
  {_qual('owner', 'table_name')} as result_object from xmlt where {valid_sql('owner')}""",
    "SEQUENCES": f"""select pkey, {_sev('SEQUENCES')}, 'Count of sequences in schema ' || sequence_owner as result_message,
  cast(count(*) as varchar) as result_object from seqs where {valid_sql('sequence_owner')} group by pkey, sequence_owner""",
    "MVIEWS": f"""select pkey, {_sev('MVIEWS')}, 'Materialized view' as result_message,
  {_qual('owner', 'mview_name')} as result_object from mv where {valid_sql('owner')}""",
    "JOBS": f"""select distinct * from (
  select pkey, {_sev('JOBS')}, 'Jobs owned by the ' || log_user || ' user' as result_message,
    cast(count(*) as varchar) as result_object from jobs where {valid_sql('log_user')} group by pkey, log_user
  union all select pkey, {_sev('JOBS')}, 'Jobs where job program owned by the ' || schema_user || ' user',
    cast(count(*) as varchar) from jobs where {valid_sql('schema_user')} group by pkey, schema_user
  union all select pkey, {_sev('JOBS')}, 'Scheduler jobs owned by the ' || owner || ' user',
    cast(count(*) as varchar) from sjobs where {valid_sql('owner')} group by pkey, owner
  union all select pkey, {_sev('JOBS')}, 'Jobs where job program owned by the ' || program_owner || ' user',
    cast(count(*) as varchar) from sjobs where {valid_sql('program_owner')} group by pkey, program_owner) x""",
    "GTTS": f"""select pkey, {_sev('GTTS')}, 'Global temporary table' as result_message,
  {_qual('owner', 'table_name')} as result_object from vt where {valid_sql('owner')} and temporary = 'Y'""",
    "TABLE_COUNT": f"""select pkey, {_sev('TABLE_COUNT')}, 'Count of tables in schema ' || owner as result_message,
  cast(schema_count as varchar) || ' of ' || cast(total_count as varchar) || ' total' as result_object from (
  select pkey, owner, count(*) as schema_count, sum(count(*)) over (partition by pkey) as total_count
  from tcount where {valid_sql('owner')} group by pkey, owner) x where total_count > 10000""",
}
TYPED = f"""from vt t join vc c on t.pkey = c.pkey and t.owner = c.owner and t.table_name = c.table_name
left join (select distinct pkey, owner, type_name from types) typ
  on c.pkey = typ.pkey and c.data_type_owner = typ.owner and c.data_type = typ.type_name
where {valid_sql('t.owner')} and (c.data_type in ({_in(V.UNSUPPORTED_TYPES)}) or c.data_type like 'INTERVAL%'
  or typ.type_name is not null)"""
O["DATA_TYPES_NN"] = f"""select t.pkey, {_sev('DATA_TYPES_NN')}, 'Column ' || c.column_name || ' in table '
  || {_qual('t.owner', 't.table_name')} as result_message, c.data_type as result_object {TYPED} and c.nullable = 'N'"""
O["DATA_TYPES_NO_NN"] = f"""select t.pkey, {_sev('DATA_TYPES_NO_NN')}, 'Column ' || c.column_name || ' in table '
  || {_qual('t.owner', 't.table_name')} as result_message, c.data_type as result_object {TYPED} and c.nullable = 'Y'"""
O["OBJ_NAMES"] = f"""select distinct * from (
  select pkey, {_sev('OBJ_NAMES')}, 'Unsupported schema name' as result_message, username as result_object
  from users where {valid_sql('username')} and regexp_matches(username, '{V.BAD_NAME_REGEX}')
  union all
  select pkey, {_sev('OBJ_NAMES')}, case when table_name like 'MLOG$\\_%' escape '\\' then 'Materialized view table'
    else 'Unsupported table name' end, {_qual('owner', 'table_name')}
  from vt where temporary = 'N' and {valid_sql('owner')} and regexp_matches(table_name, '{V.BAD_NAME_REGEX}')) x"""
O["COL_NAMES"] = f"""select distinct t.pkey, {_sev('COL_NAMES')}, 'Unsupported column name in table '
  || {_qual('t.owner', 't.table_name')} as result_message, c.column_name as result_object
from vt t join vc c on t.pkey = c.pkey and t.owner = c.owner and t.table_name = c.table_name
where t.temporary = 'N' and {valid_sql('t.owner')} and t.table_name not like 'MLOG$\\_%' escape '\\'
  and regexp_matches(c.column_name, '{V.BAD_NAME_REGEX}') and c.hidden_column = 'NO'"""
O["INTERNAL_COL_NAMES"] = f"""select distinct t.pkey, {_sev('INTERNAL_COL_NAMES')},
  case when c.qualified_col_name <> c.column_name then 'Type ' when ie.column_expression is not null
    then 'Function-based index ' when l.column_name is not null then 'LOB ' when c.column_name like 'SYS_ST%'
    then 'Extended statistics ' else 'Unknown ' end || 'column name in table ' || {_qual('t.owner', 't.table_name')}
    as result_message,
  c.column_name || ' (' || case when c.qualified_col_name <> c.column_name then c.qualified_col_name
    when l.column_name is not null then l.segment_name
    when ie.column_expression is not null then 'Column position #' || cast(ic.column_position + 1 as varchar)
    when c.column_name like 'SYS_ST%' then 'Not queried' else '?' end || ')' as result_object
from vt t join vc c on t.pkey = c.pkey and t.owner = c.owner and t.table_name = c.table_name
left join icols ic on t.pkey = ic.pkey and t.owner = ic.table_owner and t.table_name = ic.table_name
  and c.column_name = ic.column_name
left join iexpr ie on ic.pkey = ie.pkey and ic.table_owner = ie.table_owner and ic.table_name = ie.table_name
  and ic.column_position = ie.column_position
left join lobs l on c.pkey = l.pkey and c.owner = l.owner and c.table_name = l.table_name and c.column_name = l.column_name
where t.temporary = 'N' and {valid_sql('t.owner')} and regexp_matches(c.column_name, '{V.BAD_NAME_REGEX}')
  and c.hidden_column = 'YES'"""
O["IOTS"] = f"""select pkey, {_sev('IOTS')}, 'Unsupported IOT' as result_message,
  {_qual('owner', 'table_name')} || case when iot_name is not null then ' [' || iot_name || ']' else '' end as result_object
from vt where iot_type is not null and {valid_sql('owner')}"""
O["NO_PK"] = f"""select pkey, {_sev('NO_PK')}, 'Table with no primary key' as result_message,
  {_qual('owner', 'table_name')} as result_object from vt t where temporary = 'N' and {valid_sql('owner')}
  and not exists (select 1 from cons c where c.pkey = t.pkey and c.owner = t.owner and c.table_name = t.table_name
    and c.constraint_type = 'P')"""
O["CHARSET"] = f"""select pkey, {_sev('CHARSET')}, 'Unsupported character set' as result_message, value as result_object
from nls where parameter = 'NLS_CHARACTERSET' and value not in ({_in(V.SUPPORTED_CHARSETS)})"""
O["OLS"] = f"""select pkey, {_sev('OLS')}, 'OLS status set to TRUE' as result_message, name as result_object from ols
where name in ('OLS_CONFIGURE_STATUS', 'OLS_ENABLE_STATUS') and status = 'TRUE'"""
O["OCI_DB"] = f"""select distinct pkey, {_sev('OCI_DB')}, 'OCI view exists' as result_message,
  'OCI_AUTONOMOUS_DATABASES' as result_object from views where view_name = 'OCI_AUTONOMOUS_DATABASES'"""
O["ARCH_LOG_MODE"] = f"""select pkey, {_sev('ARCH_LOG_MODE')}, 'Database log mode' as result_message,
  log_mode as result_object from vdb where log_mode <> 'ARCHIVELOG'"""
O["MIN_SUPP_LOG"] = f"""select pkey, {_sev('MIN_SUPP_LOG')}, 'Database minimal supplemental logging' as result_message,
  supplemental_log_data_min as result_object from vdb where supplemental_log_data_min <> 'YES'"""
O["OBJ_SUPP_LOG"] = f"""select t.pkey, {_sev('OBJ_SUPP_LOG')},
  'Count of tables without ALL column supplemental logging enabled in schema ' || t.owner as result_message,
  cast(count(*) as varchar) as result_object
from vt t join vdb d on t.pkey = d.pkey and d.supplemental_log_data_all <> 'YES'
where t.temporary = 'N' and t.iot_type is null and {valid_sql('t.owner')}
  and not exists (select 1 from lgroups g where g.pkey = t.pkey and g.owner = t.owner and g.table_name = t.table_name
    and g.log_group_type = 'ALL COLUMN LOGGING')
group by t.pkey, t.owner"""
O["ARCH_LOG_COUNT"] = f"""select d.pkey, {_sev('ARCH_LOG_COUNT')}, 'Count of available archive logs' as result_message,
  '0' as result_object from vdb d left join (select pkey, count(*) as n from alogs where name is not null
  and deleted = 'NO' and creator <> 'LGWR' group by pkey) a on d.pkey = a.pkey where coalesce(a.n, 0) = 0"""
O["PRIVS_PERMS"] = f"""with held as (select distinct pkey, privilege from (
    select pkey, privilege from sprivs where grantee = 'MIGRATION_USER'
    union all select pkey, granted_role from rprivs where grantee = 'MIGRATION_USER'
    union all select r.pkey, s.privilege from rprivs r join rsprivs s on r.granted_role = s.role and r.pkey = s.pkey
      where r.grantee = 'MIGRATION_USER') h),
fl as (select pkey, max(case when privilege = 'DBA' then 1 else 0 end) as is_dba,
    max(case when privilege = 'SELECT ANY DICTIONARY' then 1 else 0 end) as any_dict,
    max(case when privilege = 'SELECT ANY TABLE' then 1 else 0 end) as any_table from held group by pkey),
d as (select v.pkey, try_cast(regexp_extract(v.version, '[0-9]+', 0) as int) as db_version,
    coalesce(fl.is_dba, 0) as is_dba, coalesce(fl.any_dict, 0) as any_dict, coalesce(fl.any_table, 0) as any_table
  from vdb v left join fl on v.pkey = fl.pkey),
need_priv as (select pkey, unnest(case when is_dba = 1 then []::varchar[] when db_version > 11
    then [{_in(V.REQUIRED_PRIVS + V.REQUIRED_PRIVS_AFTER_11)}] else [{_in(V.REQUIRED_PRIVS)}] end) as privilege from d),
need_dict as (select pkey, unnest(case when is_dba = 1 or any_dict = 1 then []::varchar[]
    else [{_in(V.REQUIRED_DICT_PERMS)}] end) as permission from d),
have_dict as (select distinct pkey, privilege || ':' || table_name as permission from tprivs where owner = 'SYS' and grantee = 'MIGRATION_USER'),
mt as (select t.pkey, t.owner, count(*) as n from vt t join d on t.pkey = d.pkey and d.is_dba = 0 and d.any_table = 0
  where t.temporary = 'N' and t.iot_type is null and {valid_sql('t.owner')}
    and not exists (select 1 from tprivs p where p.pkey = t.pkey and p.owner = t.owner and p.table_name = t.table_name
      and p.grantee = 'MIGRATION_USER')
  group by t.pkey, t.owner)
select distinct * from (
  select pkey, {_sev('PRIVS_PERMS')}, 'Missing privilege' as result_message, privilege as result_object from need_priv n
  where not exists (select 1 from held h where h.pkey = n.pkey and h.privilege = n.privilege)
  union all
  select pkey, {_sev('PRIVS_PERMS')}, 'Missing permission', replace(permission, ':', ' on ') from need_dict n
  where not exists (select 1 from have_dict h where h.pkey = n.pkey and h.permission = n.permission)
  union all
  select pkey, {_sev('PRIVS_PERMS')}, 'Count of tables with missing SELECT permission in schema ' || owner,
    cast(n as varchar) from mt where n > 0) x"""


def _one(index):
    def build(**f):
        return _all_lazy(f, index)
    return build


_BUILDERS = [
    lambda f: V.name_lengths(f["vt"], f["vc"]), lambda f: V.namespace_clash(f["cons"]),
    lambda f: V.object_tables(f["objt"]), lambda f: V.xml_tables(f["xmlt"]), lambda f: V.sequences(f["seqs"]),
    lambda f: V.mviews(f["mv"]), lambda f: V.jobs(f["jobs"], f["sjobs"]), lambda f: V.temporary_tables(f["vt"]),
    lambda f: V.table_count(f["tcount"]), lambda f: V.data_types(f["vt"], f["vc"], f["types"], "N"),
    lambda f: V.data_types(f["vt"], f["vc"], f["types"], "Y"), lambda f: V.object_names(f["users"], f["vt"]),
    lambda f: V.column_names(f["vt"], f["vc"]),
    lambda f: V.internal_column_names(f["vt"], f["vc"], f["icols"], f["iexpr"], f["lobs"]),
    lambda f: V.iots(f["vt"]), lambda f: V.no_pk(f["vt"], f["cons"]), lambda f: V.charset(f["nls"]),
    lambda f: V.label_security(f["ols"]), lambda f: V.autonomous_database(f["views"]),
    lambda f: V.archive_log_mode(f["vdb"]), lambda f: V.min_supplemental_logging(f["vdb"]),
    lambda f: V.object_supplemental_logging(f["vt"], f["lgroups"], f["vdb"]),
    lambda f: V.archive_log_count(f["vdb"], f["alogs"]),
    lambda f: V.privileges(f["vdb"], f["sprivs"], f["rprivs"], f["rsprivs"], f["tprivs"], f["vt"]),
]


def _all_lazy(f, index=None):
    if index is not None:
        return _BUILDERS[index](f)
    return reduce(DataFrame.unionByName, [b(f) for b in _BUILDERS])


UNION_SQL = "\nunion all\n".join(f"select * from ({O[code]}) x{i}" for i, (code, _) in enumerate(V.FINDINGS))

_NEEDS = [
    ("vt", "vc"), ("cons",), ("objt",), ("xmlt",), ("seqs",), ("mv",), ("jobs", "sjobs"), ("vt",), ("tcount",),
    ("vt", "vc", "types"), ("vt", "vc", "types"), ("users", "vt"), ("vt", "vc"), ("vt", "vc", "icols", "iexpr", "lobs"),
    ("vt",), ("vt", "cons"), ("nls",), ("ols",), ("views",), ("vdb",), ("vdb",), ("vt", "lgroups", "vdb"),
    ("vdb", "alogs"), ("vdb", "sprivs", "rprivs", "rsprivs", "tprivs", "vt"),
]

SPECS: dict[str, Spec] = {}
for _i, (_code, _sev_) in enumerate(V.FINDINGS):
    SPECS[f"f{_i + 1}_{_code.lower()}"] = Spec(
        build=_one(_i), inputs={k: INPUTS[k] for k in _NEEDS[_i]}, oracle=O[_code])
SPECS["f0_validation_findings"] = Spec(build=lambda **f: _all_lazy(f), inputs=INPUTS, oracle=UNION_SQL)
SPECS["f25_validation_summary"] = Spec(
    build=lambda **f: V.summary(_all_lazy(f), f["vdb"]),
    inputs=INPUTS,
    oracle=f"""with fnd as ({UNION_SQL}),
c as (select pkey, finding, count(*) as n from fnd group by pkey, finding),
grid as (select v.pkey, t.finding, t.sev from vdb v, (values {', '.join(f"('{c}', '{s}')" for c, s in V.FINDINGS)})
  as t(finding, sev))
select g.pkey, case when coalesce(c.n, 0) > 0 then g.sev else 'NO ISSUES' end as severity, count(*) as finding_count
from grid g left join c on g.pkey = c.pkey and g.finding = c.finding
group by g.pkey, case when coalesce(c.n, 0) > 0 then g.sev else 'NO ISSUES' end""")
SPECS["f24_privileges_multitenant"] = Spec(
    build=lambda mdb, msprivs, mrprivs, mrsprivs, mtprivs, mvt: V.privileges_multitenant(mdb, msprivs, mrprivs, mrsprivs, mtprivs, mvt),
    inputs=MT_INPUTS,
    oracle=f"""select distinct pkey, {_sev('PRIVS_PERMS')}, result_message, result_object from (
with recursive roles as (select pkey, con_id, granted_role as role from mrprivs where grantee = 'MIGRATION_USER'
  union select g.pkey, g.con_id, g.granted_role from roles r join mrprivs g on g.pkey = r.pkey and g.con_id = r.con_id and g.grantee = r.role),
held as (select pkey, con_id, privilege from msprivs where grantee = 'MIGRATION_USER' union select pkey, con_id, role from roles
  union select r.pkey, r.con_id, p.privilege from roles r join mrsprivs p on p.pkey = r.pkey and p.con_id = r.con_id and p.role = r.role),
place as (select pkey, version, 'PDB' as scope, pdb_con_id as con_id from mdb union all select pkey, version, 'CDB$ROOT', 1 from mdb),
need as (select pkey, con_id, scope, 'privilege' as what, unnest(case when scope = 'PDB' then ['CREATE SESSION', 'SET CONTAINER']
    when try_cast(regexp_extract(version, '[0-9]+') as int) > 11 then ['CREATE SESSION', 'SET CONTAINER', 'EXECUTE_CATALOG_ROLE', 'LOGMINING']
    else ['CREATE SESSION', 'SET CONTAINER', 'EXECUTE_CATALOG_ROLE'] end) as name from place
  union all select pkey, con_id, scope, 'permission', unnest(case when scope = 'PDB'
    then ['SELECT on V_$DATABASE', 'SELECT on V_$ARCHIVED_LOG', 'SELECT on DBA_SUPPLEMENTAL_LOGGING']
    else ['SELECT on V_$DATABASE', 'SELECT on V_$LOGMNR_CONTENTS', 'EXECUTE on DBMS_LOGMNR', 'EXECUTE on DBMS_LOGMNR_D'] end) from place),
have as (select pkey, con_id, 'privilege' as what, privilege as name from held
  union select pkey, con_id, 'permission', privilege || ' on ' || table_name from mtprivs where owner = 'SYS' and grantee = 'MIGRATION_USER'),
free as (select pkey, con_id, what from held, (values ('privilege'), ('permission'), ('table')) w(what) where privilege = 'DBA'
  or (what = 'permission' and privilege = 'SELECT ANY DICTIONARY') or (what = 'table' and privilege = 'SELECT ANY TABLE'))
select pkey, 'Missing ' || scope || ' ' || what as result_message, name as result_object from need
  where (pkey, con_id, what) not in (select pkey, con_id, what from free) and (pkey, con_id, what, name) not in (select pkey, con_id, what, name from have)
union all
select t.pkey, 'Count of tables with missing SELECT permission in schema ' || t.owner, cast(count(*) as varchar) from mvt t
  join mdb d on d.pkey = t.pkey and d.pdb_con_id = t.con_id
  where t.temporary = 'N' and t.iot_type is null and {valid_sql('t.owner')}
    and (t.pkey, t.con_id, 'table') not in (select pkey, con_id, what from free)
    and not exists (select 1 from mtprivs p where p.pkey = t.pkey and p.con_id = t.con_id and p.owner = t.owner
      and p.table_name = t.table_name and p.grantee = 'MIGRATION_USER')
  group by t.pkey, t.owner) x""")
