"""Readiness rules (survey section E): facts per collection -> findings per target.

Every rule returns rows ``(pkey, migration_target, rule_code, severity, info)``; rules that
list databases, extensions or tables also ``part`` (``long_findings``).
The fleet version of the reference's per-database Python loop is a set of
grouped DataFrame jobs: targets are a bounded literal list attached with
``explode`` (no join), allow-lists are ``IN`` sets, and the per-database gate
(pglogical installed -> privileges -> node / table checks) is a join on a
boolean column instead of ``continue``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.session import ensure_checkpoint_dir
from fleetscope.functions.expressions import major_version, minor_version
from fleetscope.plans.long_findings import items_of, list_findings

ERROR, ACTION, WARNING, PASS, INFO = "ERROR", "ACTION REQUIRED", "WARNING", "PASS", "INFO"
# fixed values: report order of severities
SEVERITY_ORDER = [INFO, PASS, WARNING, ACTION, ERROR]
FINDING_COLS = ["pkey", "migration_target", "rule_code", "severity", "info"]

# fixed values: supported Postgres major versions and minimum minor versions of managed sources
PG_VERSIONS = [9.4, 9.5, 9.6, 10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 16.0, 17.0]
PG_MANAGED_MIN_MINOR = {9.6: 10, 10.0: 5, 11.0: 1, 12.0: 2}
MYSQL_VERSIONS = [5.6, 5.7, 8.0]
# fixed values: platform super roles whose extensions are ignored, and extensions never migrated
SUPER_ROLES = ["cloudsqladmin", "alloydbadmin"]
NONMIGRATED_EXTENSIONS = ["pg_cron"]
MANAGED_ADMIN_ROLE = "rdsadmin"
# fixed values: collations named outside ICU; any ICU collation (``*-x-icu``) is supported as well
BASE_COLLATIONS = ["default", "C", "POSIX", "ucs_basic", "C.UTF-8", "en_US", "en_US.iso88591", "en_US.utf8"]
ICU_COLLATION_REGEX = "-x-icu$"
SUPPORTED_FDWS = ["oracle_fdw", "orafdw", "postgres_fdw"]
# fixed values: extensions supported per target
ALLOYDB_EXTENSIONS = [
    "address_standardizer", "address_standardizer_data_us", "alloydb_ai_nl", "alloydb_scann", "amcheck", "anon",
    "autoinc", "bloom", "btree_gin", "btree_gist", "citext", "cube", "dblink", "dict_int", "dict_xsyn",
    "earthdistance", "fuzzystrmatch", "google_columnar_engine", "google_db_advisor", "google_ml_integration",
    "google_plan_management", "hll", "hstore", "hypopg", "insert_username", "intagg", "intarray", "ip4r", "isn", "lo",
    "ltree", "moddatetime", "oracle_fdw", "orafce", "pageinspect", "parameterized_views", "pg_background", "pg_bigm",
    "pg_buffercache", "pg_cron", "pg_freespacemap", "pg_hint_plan", "pg_ivm", "pg_partman", "pg_prewarm",
    "pg_proctab", "pg_repack", "pg_similarity", "pg_squeeze", "pg_stat_statements", "pg_trgm", "pg_visibility",
    "pg_wait_sampling", "pgaudit", "pgcrypto", "pgfincore", "pglogical", "pgrouting", "pgrowlocks", "pgstattuple",
    "pgtap", "pgtt", "plpgsql", "plproxy", "plv8", "postgis", "postgis_raster", "postgis_sfcgal",
    "postgis_tiger_geocoder", "postgis_topology", "postgres_fdw", "prefix", "rdkit", "refint", "sslinfo",
    "tablefunc", "tcn", "temporal_tables", "tsm_system_rows", "tsm_system_time", "unaccent", "uuid-ossp", "vector",
]
CLOUDSQL_EXTENSIONS = [
    "address_standardizer", "address_standardizer_data_us", "amcheck", "anon", "autoinc", "bloom", "btree_gin",
    "btree_gist", "citext", "cube", "dblink", "dict_int", "dict_xsyn", "earthdistance", "fuzzystrmatch",
    "google_ml_integration", "hll", "hstore", "insert_username", "intagg", "intarray", "ip4r", "isn", "lo", "ltree",
    "moddatetime", "oracle_fdw", "orafce", "pageinspect", "pg_background", "pg_bigm", "pg_buffercache", "pg_cron",
    "pg_freespacemap", "pg_hint_plan", "pg_ivm", "pg_partman", "pg_prewarm", "pg_proctab", "pg_repack",
    "pg_similarity", "pg_squeeze", "pg_stat_statements", "pg_trgm", "pg_visibility", "pg_wait_sampling", "pgaudit",
    "pgcrypto", "pgfincore", "pglogical", "pgrouting", "pgrowlocks", "pgstattuple", "pgtap", "pgtt", "plpgsql",
    "plproxy", "plv8", "postgis", "postgis_raster", "postgis_sfcgal", "postgis_tiger_geocoder", "postgis_topology",
    "postgres_fdw", "prefix", "rdkit", "refint", "sslinfo", "tablefunc", "tcn", "tds_fdw", "temporal_tables",
    "tsm_system_rows", "tsm_system_time", "unaccent", "uuid-ossp", "vector",
]
# fixed values: migration targets and their limits
PG_TARGETS = [
    {"target": "ALLOYDB", "min_major": 9.4, "min_managed_major": 9.6, "max_major": 16.0, "extra": 10,
     "extensions": ALLOYDB_EXTENSIONS, "collations": BASE_COLLATIONS, "fdws": SUPPORTED_FDWS},
    {"target": "CLOUDSQL", "min_major": 9.4, "min_managed_major": 9.6, "max_major": 17.0, "extra": 10,
     "extensions": CLOUDSQL_EXTENSIONS, "collations": BASE_COLLATIONS, "fdws": SUPPORTED_FDWS},
]
MYSQL_TARGETS = [{"target": "CLOUDSQL", "min_major": 5.6, "min_managed_major": 8.0, "max_major": 8.0, "extra": 0,
                  "plugins": []}]


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------

def with_targets(df: DataFrame, targets) -> DataFrame:
    """One row per input row and target (a bounded literal list, attached by ``explode``)."""
    arr = F.array(*[F.struct(F.lit(t["target"]).alias("migration_target"),
                             F.lit(float(t["min_major"])).alias("min_major"),
                             F.lit(t.get("max_major")).cast("double").alias("max_major"),
                             F.lit(int(t.get("extra", 0))).alias("extra")) for t in targets])
    return df.withColumn("__t", F.explode(arr)).select("*", "__t.*").drop("__t")


def per_target_isin(c: Column, targets, key: str) -> Column:
    """``c`` is in the target's list (``key``), as one CASE over ``IN`` sets."""
    out = None
    for t in targets:
        cond = c.isin(*t[key]) if t[key] else F.lit(False)
        out = (F.when(F.col("migration_target") == t["target"], cond) if out is None
               else out.when(F.col("migration_target") == t["target"], cond))
    return out


def finding(df: DataFrame, rule_code: str, severity, info) -> DataFrame:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return df.select("pkey", "migration_target", F.lit(rule_code).alias("rule_code"), sev.alias("severity"),
                     info.alias("info"))


def _as_int(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("long"), F.lit(0))


# ---------------------------------------------------------------------------
# Managed source flag
# ---------------------------------------------------------------------------

def managed_flag(collections: DataFrame, extensions: DataFrame, role: str = MANAGED_ADMIN_ROLE,
                 owner_col: str = "extension_owner", super_col: str = "is_super_user") -> DataFrame:
    """Managed if an extension belongs to the admin role and that owner is a superuser."""
    m = extensions.groupBy("pkey").agg(
        F.max(F.when((F.col(owner_col) == role) & F.col(super_col), 1).otherwise(0)).alias("__m"))
    return (collections.select("pkey").distinct().join(m, "pkey", "left")
            .select("pkey", (F.coalesce(F.col("__m"), F.lit(0)) == 1).alias("is_managed")))


def managed_flag_by_plugin(collections: DataFrame, plugins: DataFrame, plugin: str = MANAGED_ADMIN_ROLE) -> DataFrame:
    """E18, MySQL form: managed if a plugin has the admin's name.  Collections without plugins are not."""
    named = plugins.where(F.col("plugin_name") == plugin).select("pkey").distinct().withColumn("__m", F.lit(True))
    return (collections.select("pkey").distinct().join(named, "pkey", "left")
            .select("pkey", F.coalesce("__m", F.lit(False)).alias("is_managed")))


# ---------------------------------------------------------------------------
# per-collection facts (one pass per source, shared by the rules)
# ---------------------------------------------------------------------------

def collection_facts(collections: DataFrame, databases: DataFrame | None = None, settings: DataFrame | None = None,
                     extensions: DataFrame | None = None, slots: DataFrame | None = None) -> DataFrame:
    """One row per collection: version, database count, managed flag, the settings the rules
    read (one conditional aggregation over the settings, not one job per setting) and the
    used replication slots.  Every source is aggregated per ``pkey`` before the joins."""
    out = collections.select("pkey").distinct()
    if databases is not None:
        out = out.join(databases.groupBy("pkey").agg(F.count(F.lit(1)).alias("db_count"),
                                                     F.min("version").alias("version")), "pkey", "left")
    if settings is not None:
        name, val = F.col("setting_name"), F.col("setting_value")

        def sv(n):
            return F.min(F.when(name == n, val))
        out = out.join(settings.groupBy("pkey").agg(
            sv("max_replication_slots").alias("s_slots"), sv("max_wal_senders").alias("s_senders"),
            sv("max_worker_processes").alias("s_workers"), sv("rds.logical_replication").alias("rds_logical"),
            F.min(F.when((name == "wal_level") & (val != "logical"), val)).alias("wal_level_bad")), "pkey", "left")
    if extensions is not None:
        out = out.join(extensions.groupBy("pkey").agg(
            F.max(F.when((F.col("extension_owner") == MANAGED_ADMIN_ROLE) & F.col("is_super_user"), 1).otherwise(0))
            .alias("__m")),
            "pkey", "left").withColumn("is_managed", F.coalesce(F.col("__m"), F.lit(0)) == 1).drop("__m")
    if slots is not None:
        out = out.join(slots.groupBy("pkey").agg(F.count(F.lit(1)).alias("used_slots")), "pkey", "left")
    if "is_managed" not in out.columns:
        out = out.withColumn("is_managed", F.lit(False))
    fills = {"db_count": F.coalesce(F.col("db_count"), F.lit(0)), "used_slots": F.coalesce(F.col("used_slots"), F.lit(0)),
             "slots": _as_int("s_slots"), "senders": _as_int("s_senders"), "workers": _as_int("s_workers")}
    for c, e in fills.items():
        src = c if c in ("db_count", "used_slots") else "s_" + c
        if src in out.columns:
            out = out.withColumn(c, e)
    return out


# ---------------------------------------------------------------------------
# Database version
# ---------------------------------------------------------------------------

def rule_database_version_pg(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    c = facts.withColumn("major", major_version("version", "9")).withColumn("minor", minor_version("version", "9"))
    t = with_targets(c, targets)
    min_minor = F.create_map(*[x for k, v in PG_MANAGED_MIN_MINOR.items() for x in (F.lit(k), F.lit(v))])[F.col("major")]
    managed_err = min_minor.isNotNull() & (F.col("minor") < min_minor)
    self_err = (~F.col("major").isin(*PG_VERSIONS) | (F.col("major") < F.col("min_major"))
                | (F.col("max_major").isNotNull() & (F.col("major") > F.col("max_major"))))
    managed = F.coalesce(F.col("is_managed"), F.lit(False))
    is_err = F.when(managed, managed_err).otherwise(self_err)
    ok = F.concat(F.lit("Version "), F.col("version"), F.lit(" is supported.  Please ensure that you selected a "
                                                              "version that meets or exceeds version "),
                  F.col("major").cast("string"), F.lit("."))
    err = F.when(managed, F.concat(F.lit("Source managed database server has unsupported minor version: ("),
                                   F.col("minor").cast("string"), F.lit(")")))\
        .otherwise(F.concat(F.lit("Migration from source database server ("), F.col("version"),
                            F.lit(") is not supported")))
    return finding(t, "DATABASE_VERSION", F.when(is_err, F.lit(ERROR)).otherwise(F.lit(PASS)),
                   F.when(is_err, err).otherwise(ok))


def rule_database_version_mysql(facts: DataFrame, targets=MYSQL_TARGETS) -> DataFrame:
    t = with_targets(facts.withColumn("major", major_version("version", "5")), targets)
    is_err = ~F.col("major").isin(*MYSQL_VERSIONS) | (F.col("major") < F.col("min_major"))
    ok = F.concat(F.lit("Version "), F.col("version"), F.lit(" is supported.  Please ensure that you selected a "
                                                              "version that meets or exceeds version "),
                  F.col("major").cast("string"), F.lit("."))
    err = F.concat(F.lit("Replication from source database server ("), F.col("version"), F.lit(") is not supported"))
    return finding(t, "DATABASE_VERSION", F.when(is_err, F.lit(ERROR)).otherwise(F.lit(PASS)),
                   F.when(is_err, err).otherwise(ok))


# ---------------------------------------------------------------------------
# Set difference against allow-lists
# ---------------------------------------------------------------------------

def _difference_rule(items: DataFrame, rule_code: str, unsupported: Column, error_severity: str, error_info: Column,
                     pass_info: str, collections: DataFrame, targets) -> DataFrame:
    """Items of a collection minus the target allow-list: one finding per unsupported item,
    one PASS per (collection, target) without any."""
    base = with_targets(collections.select("pkey").distinct(), targets)
    t = with_targets(items, targets).withColumn("__bad", unsupported)
    errors = finding(t.where(F.col("__bad")), rule_code, error_severity, error_info)
    bad_keys = t.where(F.col("__bad")).select("pkey", "migration_target").distinct()
    passes = finding(base.join(bad_keys, ["pkey", "migration_target"], "left_anti"), rule_code, PASS,
                     F.lit(pass_info))
    return errors.unionByName(passes)


def rule_collation(databases: DataFrame, targets=PG_TARGETS) -> DataFrame:
    items = databases.select("pkey", F.lower("collation_name").alias("collation")).distinct()
    supported = F.col("collation").isin(*[c.lower() for c in BASE_COLLATIONS]) | F.col("collation").rlike(
        ICU_COLLATION_REGEX)
    return _difference_rule(items, "COLLATION", ~supported, ERROR,
                            F.concat(F.lit("Unsupported collation: "), F.col("collation"),
                                     F.lit(" is not supported on this instance")),
                            "All utilized collations are supported.", databases, targets)


def rule_fdws(foreign_tables: DataFrame, collections: DataFrame, targets=PG_TARGETS) -> DataFrame:
    items = (foreign_tables.where(F.col("fdw_name").isNotNull()).groupBy("pkey", "fdw_name")
             .agg(F.countDistinct(F.concat("table_schema", "table_name")).alias("table_count")))
    return _difference_rule(items, "FDWS", ~per_target_isin(F.col("fdw_name"), targets, "fdws"), ACTION,
                            F.concat(F.lit("Unsupported FDW: detected "), F.col("table_count").cast("string"),
                                     F.lit(' "'), F.col("fdw_name"), F.lit('" foreign tables.')),
                            "All utilized foreign data wrappers are supported.", collections, targets)


def rule_plugins(plugins: DataFrame, collections: DataFrame, targets=MYSQL_TARGETS) -> DataFrame:
    """E20 over every plugin row (the reference reads a single row; we evaluate all)."""
    items = plugins.select("pkey", "plugin_name").distinct()
    return _difference_rule(items, "PLUGINS", ~per_target_isin(F.col("plugin_name"), targets, "plugins"), ERROR,
                            F.concat(F.lit("Unsupported plugin: "), F.col("plugin_name"),
                                     F.lit(" is not supported on this instance")),
                            "All utilized plugins are supported.", collections, targets)


# ---------------------------------------------------------------------------
# settings
# ---------------------------------------------------------------------------

def rule_managed_logical_replication(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    c = facts.where(F.coalesce(F.col("is_managed"), F.lit(False))) \
        .withColumn("v", F.coalesce(F.col("rds_logical"), F.lit("unset")))
    t = with_targets(c, targets)
    bad = F.col("v") != "on"
    return finding(t, "RDS_LOGICAL_REPLICATION", F.when(bad, F.lit(ACTION)).otherwise(F.lit(PASS)),
                   F.when(bad, F.concat(F.lit('`rds.logical_replication` should be set to "on" instead of ('),
                                        F.col("v"), F.lit(")")))
                   .otherwise(F.lit('`rds.logical_replication` was correctly set to "on"')))


def rule_wal_level(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    t = with_targets(facts.withColumn("v", F.col("wal_level_bad")), targets)
    bad = F.col("v").isNotNull()
    return finding(t, "WAL_LEVEL", F.when(bad, F.lit(ACTION)).otherwise(F.lit(PASS)),
                   F.when(bad, F.concat(F.lit('The `wal_level` settings should be set to "logical" instead of "'),
                                        F.col("v"), F.lit('".')))
                   .otherwise(F.lit('`wal_level` is correctly set to "logical".')))


def _band_rule(t: DataFrame, rule_code: str, have: str, need: Column, setting: str, extra_word: str) -> DataFrame:
    hv, mx = F.col(have), need + F.col("extra")
    sev = F.when(hv < need, F.lit(ACTION)).when(hv < mx, F.lit(WARNING)).otherwise(F.lit(PASS))
    h, n, m = hv.cast("string"), need.cast("string"), mx.cast("string")
    info = (F.when(hv < need, F.concat(F.lit(f"Insufficient `{setting}`: "), h, F.lit(", should be set to at least "),
                                       n, F.lit(". Up to "), F.col("extra").cast("string"),
                                       F.lit(f" additional {extra_word} might be required depending on the "
                                             "parallelism level set for migration.")))
            .when(hv < mx, F.concat(F.lit(f"`{setting}` current value: "), h,
                                    F.lit(", this might need to be increased to "), m,
                                    F.lit(" depending on the parallelism level set for migration.")))
            .otherwise(F.concat(F.lit(f"`{setting}` current value: "), h,
                                F.lit(", this meets or exceeds the maximum required value of "), m)))
    return finding(t, rule_code, sev, info)


def rule_max_replication_slots(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    """E5: required = databases + used slots; short -> ACTION, within the extra band -> WARNING."""
    f = facts if "used_slots" in facts.columns else facts.withColumn("used_slots", F.lit(0))
    return _band_rule(with_targets(f, targets), "MAX_REPLICATION_SLOTS", "slots",
                      F.col("db_count") + F.col("used_slots"), "max_replication_slots", "subscriptions")


def rule_max_worker_processes(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    return _band_rule(with_targets(facts, targets), "MAX_WORKER_PROCESSES", "workers", F.col("db_count"),
                      "max_worker_processes", "`worker_processes`")


def rule_max_wal_senders(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    """Defined by the reference but not part of its default run; call explicitly."""
    return _band_rule(with_targets(facts, targets), "MAX_WAL_SENDERS", "senders", F.col("db_count"),
                      "max_wal_senders", "`wal_senders`")


def rule_wal_senders_replication_slots(facts: DataFrame, targets=PG_TARGETS) -> DataFrame:
    t = with_targets(facts, targets)
    bad = F.col("senders") < F.col("slots")
    return finding(t, "WAL_SENDERS_REPLICATION_SLOTS", F.when(bad, F.lit(ACTION)).otherwise(F.lit(PASS)),
                   F.when(bad, F.concat(F.lit("Insufficient `max_wal_senders`: "), F.col("senders").cast("string"),
                                        F.lit(", should be set to at least the same as `max_replication_slots`: "),
                                        F.col("slots").cast("string"), F.lit(".")))
                   .otherwise(F.concat(F.lit("`max_wal_senders` current value: "), F.col("senders").cast("string"),
                                       F.lit(", this meets or exceeds the `max_replication_slots` value of "),
                                       F.col("slots").cast("string"))))


def rule_replication_role(facts: DataFrame, roles: DataFrame, targets=PG_TARGETS) -> DataFrame:
    """Self-managed collections only; no role row -> no finding."""
    r = roles.groupBy("pkey").agg(F.min("rolreplication").alias("r"))
    c = r.join(facts.where(~F.coalesce(F.col("is_managed"), F.lit(False))).select("pkey"), "pkey")
    t = with_targets(c, targets)
    bad = F.col("r") == "false"
    return finding(t, "REPLICATION_ROLE", F.when(bad, F.lit(ACTION)).otherwise(F.lit(PASS)),
                   F.when(bad, F.lit("user does not have rolreplication role."))
                   .otherwise(F.lit("user has rolreplication role.")))


# ---------------------------------------------------------------------------
# extensions
# ---------------------------------------------------------------------------

# (rule, severity) -> prefix, separator of items, separator of databases, suffix
EXTENSION_FORMATS = {("UNSUPPORTED_EXTENSIONS_NOT_MIGRATED", WARNING): ("", ",", "", ""),
                     ("EXTENSIONS_NOT_MIGRATED", WARNING): ("", ",", "", "")}


def _extension_items(extensions, rule_code: str, picked: Column, text: str, targets) -> DataFrame:
    t = with_targets(extensions, targets).where(picked)
    return items_of(t, rule_code, WARNING, F.col("extension_name"), target="migration_target",
                    opening=F.concat(F.lit("database "), F.col("database_name"), F.lit(text)), closing=";\n\n")


def _no_items(items, collections, rule_code: str, pass_info: str, targets) -> DataFrame:
    """PASS for each collection and target without an item of the rule."""
    base = with_targets(collections.select("pkey").distinct(), targets)
    hit = items.select("pkey", "migration_target").distinct()
    return finding(base.join(hit, ["pkey", "migration_target"], "left_anti"), rule_code, PASS, F.lit(pass_info))


def unsupported_extensions(extensions, collections, targets=PG_TARGETS) -> tuple[DataFrame, DataFrame]:
    """E10 as (items, passes): the extensions that a target lacks, system owners' left out."""
    picked = ~F.col("extension_owner").isin(*SUPER_ROLES) & ~per_target_isin(F.col("extension_name"), targets,
                                                                            "extensions")
    rule = "UNSUPPORTED_EXTENSIONS_NOT_MIGRATED"
    items = _extension_items(extensions, rule, picked,
                             " has unsupported extensions installed and they will not be migrated: ", targets)
    return items, _no_items(items, collections, rule, "All utilized extensions are supported.", targets)


def extensions_not_migrated(extensions, collections, targets=PG_TARGETS) -> tuple[DataFrame, DataFrame]:
    """E11 as (items, passes): extensions that no migration carries over."""
    rule = "EXTENSIONS_NOT_MIGRATED"
    items = _extension_items(extensions, rule, F.col("extension_name").isin(*NONMIGRATED_EXTENSIONS),
                             " has extensions that will not be migrated: ", targets)
    return items, _no_items(items, collections, rule, "All utilized extensions will be migrated.", targets)


def rule_unsupported_extensions(extensions, collections, targets=PG_TARGETS) -> DataFrame:
    items, passes = unsupported_extensions(extensions, collections, targets)
    return evaluate([list_findings(items, EXTENSION_FORMATS, targets), passes])


def rule_extensions_not_migrated(extensions, collections, targets=PG_TARGETS) -> DataFrame:
    items, passes = extensions_not_migrated(extensions, collections, targets)
    return evaluate([list_findings(items, EXTENSION_FORMATS, targets), passes])


# ---------------------------------------------------------------------------
# Per-database checks with the pglogical gate
# ---------------------------------------------------------------------------

PGLOGICAL_TABLE_PRIVS = [("has_tables_select_privilege", "pglogical.tables"),
                         ("has_local_node_select_privilege", "pglogical.local_node"),
                         ("has_node_select_privilege", "pglogical.node"),
                         ("has_node_interface_select_privilege", "pglogical.node_interface")]


@dataclass
class Gate:
    """``databases``: (pkey, database_name, installed, passed), one row each.  ``errors``: (pkey,
    database_name, kind_order, message), one row for each missing privilege, in no list."""
    databases: DataFrame
    errors: DataFrame


def database_gate(databases: DataFrame, extensions: DataFrame, schema_usage: DataFrame, table_privs: DataFrame,
                  missing_objects: DataFrame) -> Gate:
    """Which databases have pglogical (``installed``) and all privileges (``passed``), and each
    privilege that is missing where it is installed.  ``missing_objects`` rows carry (pkey,
    database_name, kind_order, message) for schemas / tables / views / sequences without
    privileges."""
    k = ["pkey", "database_name"]
    dbs = databases.select(*k).distinct()
    inst = (extensions.where(F.col("extension_name") == "pglogical").select(*k).distinct()
            .withColumn("installed", F.lit(True)))
    d = dbs.join(inst, k, "left").withColumn("installed", F.coalesce("installed", F.lit(False)))
    usage = schema_usage.groupBy(*k).agg(F.min(F.col("has_schema_usage_privilege").cast("int")).alias("__u"))
    privs = table_privs.groupBy(*k).agg(*[F.min(F.col(c).cast("int")).alias(c) for c, _ in PGLOGICAL_TABLE_PRIVS])
    wanted = missing_objects.groupBy(*k).agg(F.count(F.lit(1)).alias("__m"))
    msgs = [F.when(F.col("__u").isNull(), F.lit("Empty result reading pglogical schema usage privilege for the user"))
            .when(F.col("__u") == 0, F.lit("user doesn't have USAGE privilege on schema pglogical"))
            .when(F.col("__p").isNull(), F.lit("Empty result reading pglogical privileges for the user"))]
    msgs += [F.when((F.col("__u") == 1) & (F.col(c) == 0),
                    F.lit(f"user doesn't have SELECT privilege on table {tbl}")) for c, tbl in PGLOGICAL_TABLE_PRIVS]
    own = F.when(F.col("installed"), F.filter(
        F.array(*[F.struct(F.lit(i).alias("kind_order"), m.alias("message")) for i, m in enumerate(msgs)]),
        lambda e: e["message"].isNotNull())).alias("__own")
    # one row per database of the fleet, read by every per-database rule: computed once, into
    # the shared checkpoint folder
    ensure_checkpoint_dir(d.sparkSession)
    gate = (d.join(usage, k, "left").join(privs.withColumn("__p", F.lit(1)), k, "left").join(wanted, k, "left")
            .select(*k, "installed", "__m", own)
            .withColumn("passed", F.col("installed") & (F.size("__own") == 0) & F.col("__m").isNull()).checkpoint())
    installed = gate.where("installed").select(*k)
    errors = (gate.select(*k, F.explode("__own").alias("__e")).select(*k, "__e.*")
              .unionByName(missing_objects.join(installed, k)
                           .select(*k, (F.col("kind_order") + 100).alias("kind_order"), "message")))
    return Gate(gate.select(*k, "installed", "passed"), errors)


# (rule, severity) -> prefix, separator of items, separator of databases, suffix
_DB_LIST_FORMATS = {
    ("PGLOGICAL_INSTALLED", ACTION): ("`pglogical` extension is not installed on the databases: ", "", ",", "."),
    ("PGLOGICAL_INSTALLED", PASS): ("`pglogical` is installed on the databases: ", "", ",", "."),
    ("PRIVILEGES", ACTION): ("", "\n", ";\n\n", ""),
    ("PRIVILEGES", PASS): ("", "", ";\n", ""),
    ("PGLOGICAL_NODE_ALREADY_EXISTS", ACTION): ("pglogical provider node already exists on databases: ", "", ",", ""),
    ("PGLOGICAL_NODE_ALREADY_EXISTS", PASS): ("No existing pglogical provider node on the database: ", "", ",", ""),
    ("TABLES_WITH_NO_PK", WARNING): ("Some tables have limited support. Tables without primary keys were identified "
                                     "and only INSERT statements will be replicated for these tables: ", ", ", ";", ""),
    ("UNSUPPORTED_TABLES_WITH_REPLICA_IDENTITY", ACTION): (
        "Source has table(s) with both primary key and replica identity FULL or NOTHING. Please remove replica "
        "identity or change it to DEFAULT to migrate: ", ", ", ";", ""),
}
LIST_FORMATS = {**EXTENSION_FORMATS, **_DB_LIST_FORMATS}


def items_per_database(gate: Gate, provider_nodes: DataFrame, no_pk_tables: DataFrame,
                       replica_tables: DataFrame) -> DataFrame:
    """E13 - E17, one row for each database, missing privilege or table named in a finding.  A
    database failing the privilege check skips E15 - E17 (the gate column)."""
    k = ["pkey", "database_name"]
    db, d = F.col("database_name"), gate.databases
    nodes = provider_nodes.select(*k).distinct().withColumn("__node", F.lit(True))
    checked = d.where("passed").join(nodes, k, "left")
    open_dbs = d.where(~F.col("installed") | F.col("passed")).select(*k)
    table = F.concat("schema_name", F.lit("."), "table_name")
    return reduce(DataFrame.unionByName, [
        items_of(d.where(~F.col("installed")), "PGLOGICAL_INSTALLED", ACTION, db),
        items_of(d.where("installed"), "PGLOGICAL_INSTALLED", PASS, db),
        items_of(gate.errors, "PRIVILEGES", ACTION, F.col("message"), ord=F.col("kind_order"),
                 closing=F.concat(F.lit(" in database "), db)),
        items_of(d.where("passed"), "PRIVILEGES", PASS,
                 F.concat(F.lit("User has all privileges required for migration for the database "), db)),
        items_of(checked.where(F.col("__node").isNotNull()), "PGLOGICAL_NODE_ALREADY_EXISTS", ACTION, db),
        items_of(checked.where(F.col("__node").isNull()), "PGLOGICAL_NODE_ALREADY_EXISTS", PASS, db),
        items_of(no_pk_tables.join(open_dbs, k), "TABLES_WITH_NO_PK", WARNING, table,
                 opening=F.concat(F.lit("In database "), db, F.lit(", ")), closing=" don't have primary keys"),
        items_of(replica_tables.join(open_dbs, k), "UNSUPPORTED_TABLES_WITH_REPLICA_IDENTITY", ACTION, table,
                 closing=F.concat(F.lit(" in database "), db)),
    ])


def rules_per_database(gate: Gate, provider_nodes: DataFrame, no_pk_tables: DataFrame,
                       replica_tables: DataFrame, targets=PG_TARGETS) -> DataFrame:
    """E13 - E17 as findings, long lists in parts (``long_findings``)."""
    return list_findings(items_per_database(gate, provider_nodes, no_pk_tables, replica_tables), LIST_FORMATS, targets)


# ---------------------------------------------------------------------------
# Evaluate and report
# ---------------------------------------------------------------------------

def severity_rank(c="severity") -> Column:
    m = F.create_map(*[x for i, s in enumerate(SEVERITY_ORDER) for x in (F.lit(s), F.lit(i))])
    return m[F.col(c)]


def evaluate(findings) -> DataFrame:
    """Union of all rule outputs (by name).  ``part`` numbers the rows of one long text; rules
    without a list have one row, part 0."""
    return reduce(DataFrame.unionByName, [
        f.select(*FINDING_COLS, (F.col("part") if "part" in f.columns else F.lit(0)).alias("part")) for f in findings])


def report(findings: DataFrame) -> DataFrame:
    """Per collection and target, ordered by severity rank then rule code."""
    return (findings.withColumn("severity_rank", severity_rank())
            .orderBy("pkey", "migration_target", "severity_rank", "rule_code", "part", "info"))
