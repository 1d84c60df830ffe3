"""Synthetic estate views over the driver's parquet tables.

The view text is plain SQL accepted by both Spark and DuckDB, so the same text
binds the Spark jobs and prefixes the DuckDB oracle queries.  Each view maps rows
of a benchmark table onto an estate table (counters, snapshots, tables, columns,
constraints, indexes, statements, databases, settings, extensions, source lines),
so every job's work grows with the input tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed view texts of the test binding (shared verbatim with the oracle SQL).
VIEWS: dict[str, str] = {
    "est_counters": """
select concat('pk', cast(user_id % 3 as string)) as pkey, 1 as dbid, cast(user_id % 2 as int) as instance_number,
       event_type as stat_name, event_id as snap_id, ts as begin_ts, cast(floor(value) as bigint) as value
from events
""",
    "est_snapshots": """
select 1 as dbid, h as begin_ts, row_number() over (order by h) as snap_id,
       case when extract(hour from h) < 12 then 'a' else 'b' end as startup_tag
from (select distinct date_trunc('hour', ts) as h from events) t
""",
    "est_tables": """
select concat('pk', cast(p_partkey % 3 as string)) as pkey,
       case when p_partkey % 23 = 0 then 'SYS' else concat('OWN', cast(p_partkey % 7 as string)) end as owner,
       case when p_partkey % 31 = 0 then concat('BAD-', cast(p_partkey as string))
            when p_partkey % 29 = 0 then concat('BIN$', cast(p_partkey as string))
            else concat('TAB_', cast(p_partkey as string)) end as table_name,
       p_partkey as object_id, p_size * 100 as num_rows, cast(floor(p_retailprice * 1048576) as bigint) as bytes,
       case when p_size % 10 = 0 then 'Y' else 'N' end as temporary,
       case when p_size % 9 = 0 then 'IOT' end as iot_type,
       case when p_size % 4 = 0 then 'InnoDB' else 'MyISAM' end as engine,
       case p_partkey % 5 when 0 then 'r' when 1 then 'p' when 2 then 'v' when 3 then 'f' else 'q' end as relkind,
       case p_partkey % 6 when 0 then 'BASIC' when 1 then 'OLTP' when 2 then 'ADVANCED' when 3 then 'QUERY LOW' when 4 then 'ENABLED' else 'ARCHIVE HIGH' end as compress_for
from part
""",
    "est_columns": """
select concat('pk', cast(l_partkey % 3 as string)) as pkey,
       case when l_partkey % 23 = 0 then 'SYS' else concat('OWN', cast(l_partkey % 7 as string)) end as owner,
       concat('TAB_', cast(l_partkey as string)) as table_name,
       concat('C', cast(l_orderkey as string), '_', cast(l_linenumber as string), case when l_suppkey % 41 = 0 then '#' else '' end) as column_name,
       case cast(l_quantity as int) % 8 when 0 then 'NUMBER' when 1 then 'VARCHAR2' when 2 then 'DATE' when 3 then 'TIMESTAMP(6)' when 4 then 'CLOB' when 5 then 'LONG' when 6 then 'XMLTYPE' else 'GEO_T' end as data_type,
       case when cast(l_quantity as int) % 8 = 7 then case when l_linenumber % 2 = 0 then 'MDSYS' else 'APP' end end as data_type_owner,
       case when l_returnflag = 'N' then 'N' else 'Y' end as nullable
from lineitem
""",
    "est_constraints": """
select concat('pk', cast(p_partkey % 3 as string)) as pkey,
       case when p_partkey % 23 = 0 then 'SYS' else concat('OWN', cast(p_partkey % 7 as string)) end as owner,
       case when p_partkey % 7 = 1 then concat('GONE_', cast(p_partkey as string))
            else concat('TAB_', cast(p_partkey as string)) end as table_name,
       case when p_partkey % 37 = 0 then concat('TAB_', cast(p_partkey as string)) else concat('CON_', cast(p_partkey as string)) end as constraint_name,
       case p_size % 4 when 0 then 'P' when 1 then 'U' when 2 then 'C' else 'R' end as constraint_type
from part
""",
    "est_indexes": """
select concat('pk', cast(o_custkey % 3 as string)) as pkey, concat('OWN', cast(o_custkey % 7 as string)) as owner,
       concat('TAB_', cast(o_custkey as string)) as table_name, concat('IDX_', cast(o_orderkey as string)) as index_name,
       case when o_orderstatus = 'F' then 'NORMAL' else 'BITMAP' end as index_type,
       case when o_orderkey % 2 = 0 then 'UNIQUE' else 'NONUNIQUE' end as uniqueness,
       cast(floor(o_totalprice) as bigint) as bytes
from orders
""",
    "est_statements": """
select concat('pk', cast(l_suppkey % 3 as string)) as pkey, cast(l_partkey % 50 as string) as signature,
       concat('sql', cast(l_orderkey as string)) as sql_id, cast(l_linenumber % 3 as bigint) as executions,
       cast(floor(l_extendedprice) as bigint) as elapsed, cast(l_quantity as bigint) as rows_processed, l_shipdate as sample_ts
from lineitem
""",
    "est_databases": """
select concat('pk', cast(s_suppkey % 5 as string)) as pkey, concat('db', cast(s_suppkey as string)) as database_name,
       case s_suppkey % 5 when 0 then '9.4.1' when 1 then '10.2' when 2 then '14.2' when 3 then '17.0' else 'asdf' end as version,
       case when s_suppkey % 4 = 0 then 'xx_unknown' else 'C.UTF-8' end as collation_name
from supplier
""",
    "est_settings": """
select distinct concat('pk', cast(s_suppkey % 5 as string)) as pkey,
       case when s_suppkey % 5 = 4 then concat('other_', n.setting_name) else n.setting_name end as setting_name,
       case n.setting_name when 'wal_level' then case when s_suppkey % 5 = 1 then 'replica' else 'logical' end
            when 'max_replication_slots' then cast((s_suppkey % 5) * 10 as string)
            when 'max_wal_senders' then cast((s_suppkey % 5) * 8 as string)
            else cast((s_suppkey % 5) * 6 as string) end as setting_value
from (select s_suppkey, 'wal_level' as setting_name from supplier
      union all select s_suppkey, 'max_replication_slots' from supplier
      union all select s_suppkey, 'max_wal_senders' from supplier
      union all select s_suppkey, 'max_worker_processes' from supplier) n
""",
    "est_extensions": """
select distinct concat('pk', cast(c_custkey % 5 as string)) as pkey, concat('db', cast(c_custkey % 10 as string)) as database_name,
       case c_nationkey % 5 when 0 then 'pglogical' when 1 then 'pg_cron' when 2 then 'unsupported_ext' when 3 then 'plpgsql' else 'hstore' end as extension_name,
       case when c_custkey % 5 = 3 then 'rdsadmin' when c_custkey % 11 = 0 then 'alloydbadmin' else 'postgres' end as extension_owner,
       c_custkey % 5 in (1, 3) as is_super_user
from customer
""",
    "est_lines": """
select concat('pk', cast(doc_id % 3 as string)) as pkey, source as owner, lang as type, doc_id as object_id, text as definition
from documents
""",
}

_VIEW_ORDER = list(VIEWS)


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Register the driver's parquet tables as temp views under their own names."""
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def referenced(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def estate(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One estate view as a DataFrame bound to ``sf_dir``."""
    text = VIEWS[name]
    register_tables(spark, sf_dir, referenced(text, BASE_TABLES))
    return spark.sql(text)


def estates(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [estate(spark, sf_dir, n) for n in names]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(sql: str) -> str:
    """Prefix an oracle query with the CTEs of the estate views it names."""
    used = referenced(sql, _VIEW_ORDER)
    if not used:
        return sql
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
