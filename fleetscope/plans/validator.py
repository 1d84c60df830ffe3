"""Migration-job validation (survey section F): catalog rules -> findings.

Each check returns ``(pkey, finding, severity, result_message, result_object)``
over the whole fleet.  Schemas are restricted with the validator's system-owner
filter (B1, ``validator`` family).  Database-level facts are one row per
collection; checks that the reference runs as scalar subqueries become joins on
``pkey``; "required minus held" lists are literal arrays exploded per collection
and anti-joined with what is held (no cross join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.operators.filters import exclude_system_schemas

CRITICAL, WARNING, INFORMATION, NO_ISSUES = "CRITICAL", "WARNING", "INFORMATION", "NO ISSUES"
OUT = ["pkey", "finding", "severity", "result_message", "result_object"]

# fixed values: finding codes and severities
FINDINGS = [
    ("NAME_LENGTHS", CRITICAL), ("NAMESPACE_CLASH", CRITICAL), ("OBJECT_TABLES", CRITICAL), ("XML_TABLES", CRITICAL),
    ("SEQUENCES", INFORMATION), ("MVIEWS", INFORMATION), ("JOBS", INFORMATION), ("GTTS", WARNING),
    ("TABLE_COUNT", INFORMATION), ("DATA_TYPES_NN", CRITICAL), ("DATA_TYPES_NO_NN", WARNING),
    ("OBJ_NAMES", CRITICAL), ("COL_NAMES", WARNING), ("INTERNAL_COL_NAMES", WARNING), ("IOTS", WARNING),
    ("NO_PK", INFORMATION), ("CHARSET", CRITICAL), ("OLS", WARNING), ("OCI_DB", CRITICAL),
    ("ARCH_LOG_MODE", CRITICAL), ("MIN_SUPP_LOG", CRITICAL), ("OBJ_SUPP_LOG", CRITICAL),
    ("ARCH_LOG_COUNT", CRITICAL), ("PRIVS_PERMS", CRITICAL),
]
SEVERITY = dict(FINDINGS)
# fixed values: column types the replication cannot carry
UNSUPPORTED_TYPES = ["ANYDATA", "BFILE", "LONG", "LONG RAW", "SDO_GEOMETRY", "UROWID", "XMLTYPE"]
# fixed values: supported database character sets
SUPPORTED_CHARSETS = ["AL16UTF16", "AL32UTF8", "IN8ISCII", "JA16SJIS", "US7ASCII", "UTF8", "WE8ISO8859P1",
                      "WE8ISO8859P9", "WE8ISO8859P15", "WE8MSWIN1252", "ZHT16BIG5"]
BAD_NAME_REGEX = "[^a-zA-Z0-9_]"
MAX_NAME_LENGTH = 30
TABLE_COUNT_LIMIT = 10000
# fixed values: privileges and dictionary permissions required by log-based change capture
REQUIRED_PRIVS = ["CREATE SESSION"]
REQUIRED_PRIVS_AFTER_11 = ["LOGMINING"]
REQUIRED_DICT_PERMS = ["SELECT:V_$DATABASE", "SELECT:V_$ARCHIVED_LOG", "SELECT:V_$LOGMNR_CONTENTS",
                       "EXECUTE:DBMS_LOGMNR", "EXECUTE:DBMS_LOGMNR_D"]


def _valid(df: DataFrame, col: str = "owner") -> DataFrame:
    return exclude_system_schemas(df, col, family="validator")


def _out(df: DataFrame, code: str, message: Column, obj: Column) -> DataFrame:
    return df.select("pkey", F.lit(code).alias("finding"), F.lit(SEVERITY[code]).alias("severity"),
                     message.alias("result_message"), obj.cast("string").alias("result_object"))


def _qual(*cols) -> Column:
    return F.concat_ws(".", *[F.col(c) for c in cols])


# F1 - F9 ---------------------------------------------------------------------------
def name_lengths(tables: DataFrame, columns: DataFrame, limit: int = MAX_NAME_LENGTH) -> DataFrame:
    t = _out(_valid(tables).where(F.length("table_name") > limit), "NAME_LENGTHS", F.lit("Unsupported table name"),
             _qual("owner", "table_name"))
    c = _out(_valid(columns).where(F.length("column_name") > limit), "NAME_LENGTHS", F.lit("Unsupported column name"),
             _qual("owner", "table_name", "column_name"))
    return t.unionByName(c).distinct()


def namespace_clash(cons: DataFrame) -> DataFrame:
    c = _valid(cons).where(F.col("constraint_name") == F.col("table_name"))
    return _out(c, "NAMESPACE_CLASH", F.concat(F.lit("Constraint name "), _qual("owner", "constraint_name")),
                F.concat(F.lit("Table name "), _qual("owner", "table_name")))


def object_tables(obj_tables: DataFrame) -> DataFrame:
    o = _valid(obj_tables).where(F.col("table_type") != "XMLTYPE")
    return _out(o, "OBJECT_TABLES", F.concat(F.lit("Object table type "), _qual("table_type_owner", "table_type")),
                _qual("owner", "table_name"))


def xml_tables(xml: DataFrame) -> DataFrame:
    return _out(_valid(xml), "XML_TABLES", F.lit("XMLType table"), _qual("owner", "table_name"))


def sequences(seqs: DataFrame) -> DataFrame:
    g = _valid(seqs, "sequence_owner").groupBy("pkey", "sequence_owner").agg(F.count(F.lit(1)).alias("n"))
    return _out(g, "SEQUENCES", F.concat(F.lit("Count of sequences in schema "), F.col("sequence_owner")), F.col("n"))


def mviews(mv: DataFrame) -> DataFrame:
    return _out(_valid(mv), "MVIEWS", F.lit("Materialized view"), _qual("owner", "mview_name"))


def jobs(jobs_df: DataFrame, scheduler_jobs: DataFrame) -> DataFrame:
    def count_by(df, col, text):
        g = _valid(df, col).groupBy("pkey", col).agg(F.count(F.lit(1)).alias("n"))
        return _out(g, "JOBS", F.concat(F.lit(text[0]), F.col(col), F.lit(text[1])), F.col("n"))
    parts = [count_by(jobs_df, "log_user", ("Jobs owned by the ", " user")),
             count_by(jobs_df, "schema_user", ("Jobs where job program owned by the ", " user")),
             count_by(scheduler_jobs, "owner", ("Scheduler jobs owned by the ", " user")),
             count_by(scheduler_jobs, "program_owner", ("Jobs where job program owned by the ", " user"))]
    return reduce(DataFrame.unionByName, parts).distinct()


def temporary_tables(tables: DataFrame) -> DataFrame:
    return _out(_valid(tables).where(F.col("temporary") == "Y"), "GTTS", F.lit("Global temporary table"),
                _qual("owner", "table_name"))


def table_count(tables: DataFrame, limit: int = TABLE_COUNT_LIMIT) -> DataFrame:
    """Per owner, with the collection total (a grouped sum joined back); only collections
    whose total exceeds ``limit``."""
    per_owner = _valid(tables).groupBy("pkey", "owner").agg(F.count(F.lit(1)).alias("schema_count"))
    total = per_owner.groupBy("pkey").agg(F.sum("schema_count").alias("total_count"))
    g = per_owner.join(total, "pkey").where(F.col("total_count") > limit)
    return _out(g, "TABLE_COUNT", F.concat(F.lit("Count of tables in schema "), F.col("owner")),
                F.concat(F.col("schema_count").cast("string"), F.lit(" of "), F.col("total_count").cast("string"),
                         F.lit(" total")))


# F10 - F16 -----------------------------------------------------------------------------
def _typed_columns(tables: DataFrame, columns: DataFrame, types: DataFrame) -> DataFrame:
    t = _valid(tables).select("pkey", "owner", "table_name")
    typ = types.select("pkey", F.col("owner").alias("data_type_owner"), F.col("type_name").alias("data_type"),
                       F.lit(True).alias("__udt")).distinct()
    j = (t.join(columns, ["pkey", "owner", "table_name"])
         .join(typ, ["pkey", "data_type_owner", "data_type"], "left"))
    return j.where(F.col("data_type").isin(*UNSUPPORTED_TYPES) | F.col("data_type").like("INTERVAL%")
                   | F.col("__udt").isNotNull())


def data_types(tables: DataFrame, columns: DataFrame, types: DataFrame, nullable: str) -> DataFrame:
    code = "DATA_TYPES_NN" if nullable == "N" else "DATA_TYPES_NO_NN"
    c = _typed_columns(tables, columns, types).where(F.col("nullable") == nullable)
    return _out(c, code, F.concat(F.lit("Column "), F.col("column_name"), F.lit(" in table "),
                                  _qual("owner", "table_name")), F.col("data_type"))


def object_names(users: DataFrame, tables: DataFrame) -> DataFrame:
    u = _valid(users, "username").where(F.col("username").rlike(BAD_NAME_REGEX))
    t = _valid(tables).where((F.col("temporary") == "N") & F.col("table_name").rlike(BAD_NAME_REGEX))
    label = F.when(F.col("table_name").like("MLOG$\\_%"), F.lit("Materialized view table")) \
        .otherwise(F.lit("Unsupported table name"))
    return (_out(u, "OBJ_NAMES", F.lit("Unsupported schema name"), F.col("username"))
            .unionByName(_out(t, "OBJ_NAMES", label, _qual("owner", "table_name"))).distinct())


def column_names(tables: DataFrame, columns: DataFrame) -> DataFrame:
    t = _valid(tables).where((F.col("temporary") == "N") & ~F.col("table_name").like("MLOG$\\_%")) \
        .select("pkey", "owner", "table_name")
    c = t.join(columns, ["pkey", "owner", "table_name"]).where(
        F.col("column_name").rlike(BAD_NAME_REGEX) & (F.col("hidden_column") == "NO"))
    return _out(c, "COL_NAMES", F.concat(F.lit("Unsupported column name in table "), _qual("owner", "table_name")),
                F.col("column_name")).distinct()


def internal_column_names(tables: DataFrame, columns: DataFrame, ind_columns: DataFrame, ind_expressions: DataFrame,
                          lobs: DataFrame) -> DataFrame:
    """Hidden columns with unsupported names, labelled by their cause (type attribute,
    function-based index, LOB, extended statistics)."""
    t = _valid(tables).where(F.col("temporary") == "N").select("pkey", "owner", "table_name")
    c = (t.join(columns, ["pkey", "owner", "table_name"])
         .where(F.col("column_name").rlike(BAD_NAME_REGEX) & (F.col("hidden_column") == "YES")))
    ic = ind_columns.select("pkey", F.col("table_owner").alias("owner"), "table_name", "column_name",
                            "column_position")
    ie = ind_expressions.select("pkey", F.col("table_owner").alias("owner"), "table_name", "column_position",
                                "column_expression")
    lb = lobs.select("pkey", "owner", "table_name", "column_name", "segment_name")
    j = (c.join(ic, ["pkey", "owner", "table_name", "column_name"], "left")
         .join(ie, ["pkey", "owner", "table_name", "column_position"], "left")
         .join(lb, ["pkey", "owner", "table_name", "column_name"], "left"))
    typed = F.col("qualified_col_name") != F.col("column_name")
    fbi = F.col("column_expression").isNotNull()
    lob = F.col("segment_name").isNotNull()
    stats = F.col("column_name").like("SYS_ST%")
    cause = (F.when(typed, "Type ").when(fbi, "Function-based index ").when(lob, "LOB ")
             .when(stats, "Extended statistics ").otherwise("Unknown "))
    detail = (F.when(typed, F.col("qualified_col_name")).when(lob, F.col("segment_name"))
              .when(fbi, F.concat(F.lit("Column position #"), (F.col("column_position") + 1).cast("string")))
              .when(stats, F.lit("Not queried")).otherwise(F.lit("?")))
    return _out(j, "INTERNAL_COL_NAMES", F.concat(cause, F.lit("column name in table "), _qual("owner", "table_name")),
                F.concat(F.col("column_name"), F.lit(" ("), detail, F.lit(")"))).distinct()


def iots(tables: DataFrame) -> DataFrame:
    t = _valid(tables).where(F.col("iot_type").isNotNull())
    suffix = F.when(F.col("iot_name").isNotNull(), F.concat(F.lit(" ["), F.col("iot_name"), F.lit("]"))).otherwise("")
    return _out(t, "IOTS", F.lit("Unsupported IOT"), F.concat(_qual("owner", "table_name"), suffix))


def no_pk(tables: DataFrame, cons: DataFrame) -> DataFrame:
    t = _valid(tables).where(F.col("temporary") == "N")
    pk = cons.where(F.col("constraint_type") == "P").select("pkey", "owner", "table_name").distinct()
    t = t.join(pk, ["pkey", "owner", "table_name"], "left_anti")
    return _out(t, "NO_PK", F.lit("Table with no primary key"), _qual("owner", "table_name"))


# F17 - F24 -------------------------------------------------------------------------------
def charset(nls: DataFrame) -> DataFrame:
    n = nls.where((F.col("parameter") == "NLS_CHARACTERSET") & ~F.col("value").isin(*SUPPORTED_CHARSETS))
    return _out(n, "CHARSET", F.lit("Unsupported character set"), F.col("value"))


def label_security(ols: DataFrame) -> DataFrame:
    o = ols.where(F.col("name").isin("OLS_CONFIGURE_STATUS", "OLS_ENABLE_STATUS") & (F.col("status") == "TRUE"))
    return _out(o, "OLS", F.lit("OLS status set to TRUE"), F.col("name"))


def autonomous_database(views: DataFrame) -> DataFrame:
    v = views.where(F.col("view_name") == "OCI_AUTONOMOUS_DATABASES").select("pkey").distinct()
    return _out(v, "OCI_DB", F.lit("OCI view exists"), F.lit("OCI_AUTONOMOUS_DATABASES"))


def archive_log_mode(db: DataFrame) -> DataFrame:
    return _out(db.where(F.col("log_mode") != "ARCHIVELOG"), "ARCH_LOG_MODE", F.lit("Database log mode"),
                F.col("log_mode"))


def min_supplemental_logging(db: DataFrame) -> DataFrame:
    return _out(db.where(F.col("supplemental_log_data_min") != "YES"), "MIN_SUPP_LOG",
                F.lit("Database minimal supplemental logging"), F.col("supplemental_log_data_min"))


def object_supplemental_logging(tables: DataFrame, log_groups: DataFrame, db: DataFrame) -> DataFrame:
    """Per owner, tables without an ALL-column log group, only where the database-wide flag is
    not set (a join on the collection row instead of a scalar subquery)."""
    t = _valid(tables).where((F.col("temporary") == "N") & F.col("iot_type").isNull())
    g = log_groups.where(F.col("log_group_type") == "ALL COLUMN LOGGING").select("pkey", "owner", "table_name")
    t = (t.join(g, ["pkey", "owner", "table_name"], "left_anti")
         .join(db.where(F.col("supplemental_log_data_all") != "YES").select("pkey"), "pkey"))
    c = t.groupBy("pkey", "owner").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 0)
    return _out(c, "OBJ_SUPP_LOG",
                F.concat(F.lit("Count of tables without ALL column supplemental logging enabled in schema "),
                         F.col("owner")), F.col("cnt"))


def archive_log_count(db: DataFrame, logs: DataFrame) -> DataFrame:
    avail = (logs.where(F.col("name").isNotNull() & (F.col("deleted") == "NO") & (F.col("creator") != "LGWR"))
             .groupBy("pkey").agg(F.count(F.lit(1)).alias("n")))
    c = db.select("pkey").join(avail, "pkey", "left").where(F.coalesce("n", F.lit(0)) == 0)
    return _out(c, "ARCH_LOG_COUNT", F.lit("Count of available archive logs"), F.lit(0))


# fixed values: privileges and dictionary permissions of the two containers
REQUIRED_PDB_PRIVS = ["CREATE SESSION", "SET CONTAINER"]
REQUIRED_ROOT_PRIVS = ["CREATE SESSION", "SET CONTAINER", "EXECUTE_CATALOG_ROLE"]
REQUIRED_PDB_DICT_PERMS = ["SELECT:V_$DATABASE", "SELECT:V_$ARCHIVED_LOG", "SELECT:DBA_SUPPLEMENTAL_LOGGING"]
REQUIRED_ROOT_DICT_PERMS = ["SELECT:V_$DATABASE", "SELECT:V_$LOGMNR_CONTENTS", "EXECUTE:DBMS_LOGMNR", "EXECUTE:DBMS_LOGMNR_D"]
ROOT_CON_ID = 1


def granted_roles(role_privs: DataFrame, user: str, keys: tuple[str, ...] = ("pkey",), nested: bool = False) -> DataFrame:
    """(keys, role): roles granted to ``user``; ``nested`` follows roles granted to roles to
    their end.  A frontier of roles not seen before is joined with the grants until it is empty,
    so cycles of grants end; every step is checkpointed in the session's shared folder."""
    grants = role_privs.select(*keys, "grantee", F.col("granted_role").alias("role")).distinct()
    found = grants.where(F.col("grantee") == user).select(*keys, "role")
    if not nested:
        return found
    found = frontier = found.checkpoint()
    while True:
        further = frontier.withColumnRenamed("role", "grantee").join(grants, [*keys, "grantee"]).select(*keys, "role").distinct()
        frontier = further.join(found, [*keys, "role"], "left_anti").checkpoint()
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier).checkpoint()


def held_privileges(sys_privs: DataFrame, role_privs: DataFrame, role_sys_privs: DataFrame, user: str,
                    keys: tuple[str, ...] = ("pkey",), nested: bool = False) -> DataFrame:
    """(keys, privilege): direct system privileges of ``user`` U its roles U privileges of its
    roles, each within its own collection (and container); grants to others do not count."""
    roles = granted_roles(role_privs, user, keys, nested)
    return (sys_privs.where(F.col("grantee") == user).select(*keys, "privilege")
            .unionByName(roles.select(*keys, F.col("role").alias("privilege")))
            .unionByName(roles.join(role_sys_privs, [*keys, "role"]).select(*keys, "privilege")).distinct())


def privileges_multitenant(db: DataFrame, sys_privs: DataFrame, role_privs: DataFrame, role_sys_privs: DataFrame,
                           tab_privs: DataFrame, tables: DataFrame, user: str = "MIGRATION_USER", nested: bool = True) -> DataFrame:
    """F24 for container databases (inputs carry ``con_id``; ``db`` names the collection's
    ``pdb_con_id``): privileges and dictionary permissions are required in the pluggable database
    and in the root, each set skipped where the user has DBA there (permissions also with SELECT
    ANY DICTIONARY); the per-owner table check runs in the pluggable database."""
    keys = ("pkey", "con_id")
    held = held_privileges(sys_privs, role_privs, role_sys_privs, user, keys, nested)

    def has(privilege):
        return F.max(F.when(F.col("privilege") == privilege, 1).otherwise(0))

    flags = held.groupBy(*keys).agg(has("DBA").alias("is_dba"), has("SELECT ANY DICTIONARY").alias("any_dict"), has("SELECT ANY TABLE").alias("any_table"))
    scopes = F.array(F.struct(F.lit("PDB").alias("scope"), F.col("pdb_con_id").cast("int").alias("con_id")),
                     F.struct(F.lit("CDB$ROOT").alias("scope"), F.lit(ROOT_CON_ID).alias("con_id")))
    d = db.select("pkey", F.regexp_extract("version", "[0-9]+", 0).try_cast("int").alias("db_version"), F.explode(scopes).alias("s"))
    d = d.select("pkey", "db_version", "s.*").join(flags, [*keys], "left").na.fill(0, ["is_dba", "any_dict", "any_table"])

    def names(values):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    pdb = F.col("scope") == "PDB"
    privs = (F.when(F.col("is_dba") == 1, names([])).when(pdb, names(REQUIRED_PDB_PRIVS))
             .when(F.col("db_version") > 11, names(REQUIRED_ROOT_PRIVS + REQUIRED_PRIVS_AFTER_11)).otherwise(names(REQUIRED_ROOT_PRIVS)))
    perms = (F.when((F.col("is_dba") == 1) | (F.col("any_dict") == 1), names([]))
             .when(pdb, names(REQUIRED_PDB_DICT_PERMS)).otherwise(names(REQUIRED_ROOT_DICT_PERMS)))
    own = tab_privs.where(F.col("grantee") == user)
    have = own.where(F.col("owner") == "SYS").select(*keys, F.concat("privilege", F.lit(":"), "table_name").alias("permission")).distinct()
    miss_priv = d.select(*keys, "scope", F.explode(privs).alias("privilege")).join(held, [*keys, "privilege"], "left_anti")
    miss_perm = d.select(*keys, "scope", F.explode(perms).alias("permission")).join(have, [*keys, "permission"], "left_anti")
    t = (_valid(tables).where((F.col("temporary") == "N") & F.col("iot_type").isNull())
         .join(own.select(*keys, "owner", "table_name").distinct(), [*keys, "owner", "table_name"], "left_anti")
         .join(d.where(pdb & (F.col("is_dba") == 0) & (F.col("any_table") == 0)).select(*keys), [*keys])
         .groupBy("pkey", "owner").agg(F.count(F.lit(1)).alias("n")))
    parts = [_out(miss_priv, "PRIVS_PERMS", F.concat(F.lit("Missing "), F.col("scope"), F.lit(" privilege")), F.col("privilege")),
             _out(miss_perm, "PRIVS_PERMS", F.concat(F.lit("Missing "), F.col("scope"), F.lit(" permission")),
                  F.replace(F.col("permission"), F.lit(":"), F.lit(" on "))),
             _out(t, "PRIVS_PERMS", F.concat(F.lit("Count of tables with missing SELECT permission in schema "), F.col("owner")), F.col("n"))]
    return reduce(DataFrame.unionByName, parts).distinct()


def privileges(db: DataFrame, sys_privs: DataFrame, role_privs: DataFrame, role_sys_privs: DataFrame,
               tab_privs: DataFrame, tables: DataFrame, user: str = "MIGRATION_USER", nested: bool = False) -> DataFrame:
    """Held = direct system privileges U granted roles U privileges of granted roles of ``user``.
    Required privileges depend on the version (>11 adds LOGMINING); nothing is required
    with the DBA role; dictionary permissions are skipped with SELECT ANY DICTIONARY and
    the per-owner table check with SELECT ANY TABLE."""
    held = held_privileges(sys_privs, role_privs, role_sys_privs, user, nested=nested)
    tab_privs = tab_privs.where(F.col("grantee") == user)
    flags = held.groupBy("pkey").agg(
        F.max(F.when(F.col("privilege") == "DBA", 1).otherwise(0)).alias("is_dba"),
        F.max(F.when(F.col("privilege") == "SELECT ANY DICTIONARY", 1).otherwise(0)).alias("any_dict"),
        F.max(F.when(F.col("privilege") == "SELECT ANY TABLE", 1).otherwise(0)).alias("any_table"))
    d = (db.select("pkey", F.regexp_extract("version", "[0-9]+", 0).try_cast("int").alias("db_version"))
         .join(flags, "pkey", "left").na.fill(0, ["is_dba", "any_dict", "any_table"]))
    req = F.when(F.col("is_dba") == 1, F.array().cast("array<string>")).otherwise(
        F.when(F.col("db_version") > 11, F.array(*[F.lit(p) for p in REQUIRED_PRIVS + REQUIRED_PRIVS_AFTER_11]))
        .otherwise(F.array(*[F.lit(p) for p in REQUIRED_PRIVS])))
    need_priv = d.select("pkey", F.explode(req).alias("privilege"))
    miss_priv = need_priv.join(held, ["pkey", "privilege"], "left_anti")
    req_dict = F.when((F.col("is_dba") == 1) | (F.col("any_dict") == 1), F.array().cast("array<string>")) \
        .otherwise(F.array(*[F.lit(p) for p in REQUIRED_DICT_PERMS]))
    need_dict = d.select("pkey", F.explode(req_dict).alias("permission"))
    have_dict = (tab_privs.where(F.col("owner") == "SYS")
                 .select("pkey", F.concat(F.col("privilege"), F.lit(":"), F.col("table_name")).alias("permission")))
    miss_dict = need_dict.join(have_dict.distinct(), ["pkey", "permission"], "left_anti")
    t = (_valid(tables).where((F.col("temporary") == "N") & F.col("iot_type").isNull())
         .join(tab_privs.select("pkey", "owner", "table_name").distinct(), ["pkey", "owner", "table_name"],
               "left_anti")
         .join(d.where((F.col("is_dba") == 0) & (F.col("any_table") == 0)).select("pkey"), "pkey")
         .groupBy("pkey", "owner").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0))
    parts = [_out(miss_priv, "PRIVS_PERMS", F.lit("Missing privilege"), F.col("privilege")),
             _out(miss_dict, "PRIVS_PERMS", F.lit("Missing permission"), F.regexp_replace("permission", ":", " on ")),
             _out(t, "PRIVS_PERMS", F.concat(F.lit("Count of tables with missing SELECT permission in schema "),
                                             F.col("owner")), F.col("n"))]
    return reduce(DataFrame.unionByName, parts).distinct()


# F25 -------------------------------------------------------------------------------------
def summary(findings: DataFrame, collections: DataFrame) -> DataFrame:
    """Per collection: findings with at least one row counted by severity, the others as
    NO ISSUES.  One grouped row per collection with a conditional count per finding code,
    unpivoted (the finding list is a fixed literal)."""
    cells = [F.count(F.when(F.col("finding") == code, 1)).alias(f"c{i}") for i, (code, _) in enumerate(FINDINGS)]
    g = collections.select("pkey").distinct().join(findings.groupBy("pkey").agg(*cells), "pkey", "left")
    stack = "stack({n}, {args}) as (finding, severity)".format(
        n=len(FINDINGS),
        args=", ".join(f"'{code}', case when coalesce(c{i}, 0) > 0 then '{sev}' else '{NO_ISSUES}' end"
                       for i, (code, sev) in enumerate(FINDINGS)))
    return (g.select("pkey", F.expr(stack)).groupBy("pkey", "severity")
            .agg(F.count(F.lit(1)).alias("finding_count")))
