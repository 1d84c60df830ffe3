"""Filters and classifications applied inside the jobs (survey sections A11, B1, B2, B6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: built-in Oracle owners (exact names)
ORACLE_SYSTEM_OWNERS = [
    "ORDS_METADATA", "ORDS_PUBLIC_USER", "APEX_PUBLIC_USER", "FLOWS_FILES", "PERFSTAT", "ORDSYS", "MDSYS", "TSMSYS",
    "WMSYS", "CTXSYS", "DMSYS", "EXFSYS", "OLAPSYS", "XDB", "DBA_ADM", "SYSTEM", "DBSNMP", "LBACSYS", "MGMT_VIEW",
    "ORDDATA", "OWBSYS", "ORDPLUGINS", "OUTLN", "SI_INFORMTN_SCHEMA", "SYS", "SYSMAN", "WK_TEST", "WKSYS",
    "WKPROXY", "DIP", "FLOWS_020100", "FLOWS_030000", "FLOWS_040100", "FLOWS_010600", "MDDATA", "ORACLE_OCM",
    "SPATIAL_CSW_ADMIN_USR", "SPATIAL_WFS_ADMIN_USR", "XS$NULL", "SQLTXPLAIN", "APEX_040000", "APEX_040200",
    "DVSYS", "OJVMSYS", "GSMADMIN_INTERNAL", "APPQOSSYS", "DVF", "AUDSYS", "APEX_030200", "ODM", "ODM_MTR",
    "TRACESRV", "MTMSYS", "OWBSYS_AUDIT", "WEBSYS", "WK_PROXY", "OSE$HTTP$ADMIN", "AURORA$JIS$UTILITY$",
    "AURORA$ORB$UNAUTHENTICATED", "DBMS_PRIVILEGE_CAPTURE", "CSMIG", "MGDSYS", "SDE", "DBSFWUSER",
]
# fixed values: built-in Oracle owner LIKE patterns
ORACLE_SYSTEM_PATTERNS = ["WWV_FLOWS%", "APEX%", "%GGADMIN"]
# fixed values: owners and owner prefixes that the migration-job validator leaves out
VALIDATOR_OWNERS = [
    "ANONYMOUS", "APPQOSSYS", "AUDSYS", "CSMIG", "CTXSYS", "DBSFWUSER", "DBSNMP", "DIP", "DMA_COLLECTOR", "DMSYS", "DVSYS",
    "DVF", "EXFSYS", "GSMADMIN_INTERNAL", "GSMCATUSER", "GSMUSER", "LBACSYS", "MDDATA", "MDSYS", "MGDSYS", "MGMT_VIEW",
    "MTMSYS", "ODM", "ODM_MTR", "ODMRSYS", "OJVMSYS", "OLAPSYS", "ORACLE_OCM", "ORDDATA", "ORDPLUGINS", "ORDS_METADATA",
    "ORDS_PUBLIC_USER", "ORDSYS", "OSE$HTTP$ADMIN", "OUTLN", "OWBSYS", "OWBSYS_AUDIT", "PERFSTAT", "SI_INFORMTN_SCHEMA",
    "SPATIAL_CSW_ADMIN_USR", "SPATIAL_WFS_ADMIN_USR", "SQLTXPLAIN", "SYS$UMF", "SYS", "SYSBACKUP", "SYSDG", "SYSKM",
    "SYSMAN", "SYSTEM", "TRACESRV", "TSMSYS", "WEBSYS", "WK_PROXY", "WK_TEST", "WKPROXY", "WKSYS", "WMSYS", "XDB", "XS$NULL",
]
VALIDATOR_PATTERNS = ["APEX\\_%", "AURORA$%", "OPS$%", "FLOWS\\_%"]
# fixed values: Postgres and MySQL system schemas
POSTGRES_SYSTEM_SCHEMAS = ["pg_catalog", "information_schema"]
POSTGRES_SYSTEM_REGEX = "^pg_toast"
MYSQL_SYSTEM_SCHEMAS = ["mysql", "information_schema", "performance_schema", "sys"]


def is_system_schema(c, family: str = "oracle") -> Column:
    """True for built-in owners of the given family (exact list as an ``IN`` set, patterns as
    ``LIKE`` / ``RLIKE``; no join needed for a fixed list)."""
    c = F.col(c) if isinstance(c, str) else c
    if family == "oracle":
        cond = c.isin(*ORACLE_SYSTEM_OWNERS)
        for p in ORACLE_SYSTEM_PATTERNS:
            cond = cond | c.like(p)
        return cond
    if family == "validator":
        cond = c.isin(*VALIDATOR_OWNERS)
        for p in VALIDATOR_PATTERNS:
            cond = cond | c.like(p)
        return cond
    if family == "postgres":
        return c.isin(*POSTGRES_SYSTEM_SCHEMAS) | c.rlike(POSTGRES_SYSTEM_REGEX)
    if family == "mysql":
        return c.isin(*MYSQL_SYSTEM_SCHEMAS)
    raise ValueError(family)


def exclude_system_schemas(df: DataFrame, col: str, family: str = "oracle", keep: bool = True) -> DataFrame:
    """B1: drop rows of built-in owners (``keep=False`` returns only those rows).  A null owner
    is kept, as with SQL ``NOT IN`` over a non-null list it would be dropped: filter explicitly."""
    sys_cond = F.coalesce(is_system_schema(col, family), F.lit(False))
    return df.where(~sys_cond) if keep else df.where(sys_cond)


def classify_object(df: DataFrame, col: str, mapping: dict, default: str | None = None, out: str = "object_type",
                    name_col: str | None = None, name_rules=()) -> DataFrame:
    """B2: one-letter kind -> label via a literal map with a default; ``name_rules`` =
    ``[(kind, regex, label), ...]`` override the label when the object name matches."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    label = F.coalesce(m[F.col(col)], F.lit(default))
    for kind, regex, lab in name_rules:
        label = F.when((F.col(col) == kind) & F.col(name_col).rlike(regex), F.lit(lab)).otherwise(label)
    return df.withColumn(out, label)


def container_filter(df: DataFrame, name_col: str = "database_name", system_names=(), pattern: str = "%",
                     state_col: str | None = "state", online: str = "ONLINE", writable_col: str | None = "is_read_only"
                     ) -> DataFrame:
    """User databases only - not a system name, name LIKE pattern, online and writable."""
    cond = ~F.col(name_col).isin(*system_names) & F.col(name_col).like(pattern)
    if state_col:
        cond = cond & (F.col(state_col) == online)
    if writable_col:
        cond = cond & ~F.col(writable_col)
    return df.where(cond)


def duplicate_ids(df: DataFrame, col: str) -> DataFrame:
    """Identifiers occurring more than once, with their counts; blank ids ignored."""
    return (df.where(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))
            .groupBy(col).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))
