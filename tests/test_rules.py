"""Readiness rules on the reference's unit fixtures (severity and row count asserted)."""

from fleetscope.plans import readiness as R

TARGETS = R.PG_TARGETS


def _sev(df):
    rows = df.collect()
    return sorted({(r.migration_target, r.severity) for r in rows}), len(rows)


def test_collation(spark):
    bad = spark.createDataFrame([("pk", "d1", "unsupported-locale")], "pkey string, database_name string, collation_name string")
    sev, n = _sev(R.rule_collation(bad))
    assert sev == [("ALLOYDB", "ERROR"), ("CLOUDSQL", "ERROR")] and n == 2
    good = spark.createDataFrame([("pk", "d1", "c.utf-8")], "pkey string, database_name string, collation_name string")
    sev, n = _sev(R.rule_collation(good))
    assert sev == [("ALLOYDB", "PASS"), ("CLOUDSQL", "PASS")] and n == 2


def _managed(spark, flag=True):
    return spark.createDataFrame([("pk", flag)], "pkey string, is_managed boolean")


def _facts(spark, flag, settings=None, version=None):
    cols = spark.createDataFrame([("pk", version)], "pkey string, version string")
    f = R.collection_facts(cols, cols, settings).drop("is_managed")
    return f.join(_managed(spark, flag), "pkey")


def test_managed_logical_replication(spark):
    cols = spark.createDataFrame([("pk",)], "pkey string")
    empty = spark.createDataFrame([], "pkey string, setting_name string, setting_value string")
    sev, n = _sev(R.rule_managed_logical_replication(_facts(spark, True, empty)))
    assert {s for _, s in sev} == {"ACTION REQUIRED"} and n == 2
    on = spark.createDataFrame([("pk", "rds.logical_replication", "on")],
                               "pkey string, setting_name string, setting_value string")
    sev, n = _sev(R.rule_managed_logical_replication(_facts(spark, True, on)))
    assert {s for _, s in sev} == {"PASS"} and n == 2
    sev, n = _sev(R.rule_managed_logical_replication(_facts(spark, False, on)))
    assert n == 0


def _ext(spark, rows):
    return spark.createDataFrame(rows, "extension_name string, extension_owner string, database_name string") \
        .selectExpr("'pk' as pkey", "*")


def test_unsupported_extensions(spark):
    cols = spark.createDataFrame([("pk",)], "pkey string")
    sev, n = _sev(R.rule_unsupported_extensions(_ext(spark, [("unsupported_ext", "postgres", "postgres")]), cols))
    assert {s for _, s in sev} == {"WARNING"} and n == 2
    ok = _ext(spark, [("unsupported_ext", "alloydbadmin", "postgres"), ("pgaudit", "postgres", "postgres")])
    sev, n = _sev(R.rule_unsupported_extensions(ok, cols))
    assert {s for _, s in sev} == {"PASS"} and n == 2


def test_extensions_not_migrated(spark):
    cols = spark.createDataFrame([("pk",)], "pkey string")
    sev, n = _sev(R.rule_extensions_not_migrated(_ext(spark, [("pg_cron", "postgres", "postgres")]), cols))
    assert {s for _, s in sev} == {"WARNING"} and n == 2
    sev, n = _sev(R.rule_extensions_not_migrated(_ext(spark, [("pgAudit", "postgres", "postgres")]), cols))
    assert {s for _, s in sev} == {"PASS"} and n == 2


def test_managed_version(spark):
    sev, n = _sev(R.rule_database_version_pg(_facts(spark, True, version="10.2")))
    assert {s for _, s in sev} == {"ERROR"} and n == 2
    sev, n = _sev(R.rule_database_version_pg(_facts(spark, True, version="10.7")))
    assert {s for _, s in sev} == {"PASS"} and n == 2


def test_self_managed_version_bounds(spark):
    v = spark.createDataFrame([("a", "9.3"), ("b", "17.1")], "pkey string, version string")
    f = R.collection_facts(v, v)
    rows = {(r.pkey, r.migration_target): r.severity for r in R.rule_database_version_pg(f).collect()}
    assert rows[("a", "ALLOYDB")] == "ERROR" and rows[("a", "CLOUDSQL")] == "ERROR"
    assert rows[("b", "ALLOYDB")] == "ERROR" and rows[("b", "CLOUDSQL")] == "PASS"


def test_privilege_gate_skips_table_checks(spark):
    dbs = spark.createDataFrame([("pk", "a"), ("pk", "b")], "pkey string, database_name string")
    ext = spark.createDataFrame([("pk", "a", "pglogical", "postgres"), ("pk", "b", "pglogical", "postgres")],
                                "pkey string, database_name string, extension_name string, extension_owner string")
    usage = spark.createDataFrame([("pk", "a", True), ("pk", "b", False)],
                                  "pkey string, database_name string, has_schema_usage_privilege boolean")
    privs = spark.createDataFrame([("pk", "a", True, True, True, True)],
                                  "pkey string, database_name string, has_tables_select_privilege boolean, "
                                  "has_local_node_select_privilege boolean, has_node_select_privilege boolean, "
                                  "has_node_interface_select_privilege boolean")
    missing = spark.createDataFrame([], "pkey string, database_name string, kind_order int, message string")
    nodes = spark.createDataFrame([], "pkey string, database_name string")
    tables = spark.createDataFrame([("pk", "a", "s", "t1"), ("pk", "b", "s", "t2")],
                                   "pkey string, database_name string, schema_name string, table_name string")
    gate = R.database_gate(dbs, ext, usage, privs, missing)
    out = R.rules_per_database(gate, nodes, tables, tables.limit(0), targets=TARGETS[:1]).collect()
    by = {(r.rule_code, r.severity): r.info for r in out}
    assert "b" in by[("PRIVILEGES", "ACTION REQUIRED")]
    assert "USAGE privilege" in by[("PRIVILEGES", "ACTION REQUIRED")]
    nopk = by[("TABLES_WITH_NO_PK", "WARNING")]
    assert "s.t1" in nopk and "s.t2" not in nopk   # database b failed the gate
    assert ("PGLOGICAL_NODE_ALREADY_EXISTS", "PASS") in by


def test_validator_owner_list(spark):
    from fleetscope.operators.filters import exclude_system_schemas
    hidden = ["ANONYMOUS", "SYSBACKUP", "SYS$UMF", "GSMUSER", "ODMRSYS", "SYSDG", "SYSKM", "APEX_1", "AURORA$X", "OPS$A", "FLOWS_1"]
    shown = ["SDE", "DBA_ADM", "XGGADMIN", "APEXX", "FLOWSX", "HR", None]
    df = spark.createDataFrame([(o,) for o in hidden + shown], "owner string")
    kept = [r["owner"] for r in exclude_system_schemas(df, "owner", family="validator").collect()]
    assert kept == shown


def test_managed_needs_a_superuser(spark):
    rows = [("a", "rdsadmin", True), ("b", "rdsadmin", False), ("c", "postgres", True)]
    ext = spark.createDataFrame(rows, "pkey string, extension_owner string, is_super_user boolean")
    got = {r["pkey"]: r["is_managed"] for r in R.managed_flag(ext.select("pkey"), ext).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_patches_keep_their_own_fields(spark):
    from fleetscope.operators import inventory as inv
    xml = ("<InventoryInstance><patches><patch><patchID>1</patchID></patch><patch><patchID>2</patchID>"
           "<patchDescription>d2</patchDescription><bugs><bug><description>b</description></bug></bugs></patch></patches>"
           "</InventoryInstance>")
    got = [tuple(r) for r in inv.patch_inventory(spark.createDataFrame([("p", xml)], "pkey string, xml string")).select(
        "patch_id", "patch_descr", "bug_descr").collect()]
    assert got == [("1", None, None), ("2", "d2", "b")]


def test_nested_roles_end_in_cycles_and_stay_in_their_collection(spark):
    from fleetscope.plans import validator as V
    grants = spark.createDataFrame([("a", 3, "U", "R1"), ("a", 3, "R1", "R2"), ("a", 3, "R2", "R3"), ("a", 3, "R3", "R1"), ("a", 1, "R3", "R9"),
                                    ("a", 3, "OTHER", "DBA"), ("b", 3, "R1", "DBA"), ("b", 3, "U", "R3")],
                                   "pkey string, con_id int, grantee string, granted_role string")
    def roles(nested):
        return {tuple(r) for r in V.granted_roles(grants, "U", ("pkey", "con_id"), nested).collect()}
    assert roles(False) == {("a", 3, "R1"), ("b", 3, "R3")}
    assert roles(True) == {("a", 3, "R1"), ("a", 3, "R2"), ("a", 3, "R3"), ("b", 3, "R3")}
    own = spark.createDataFrame([("a", 3, "R3", "LOGMINING"), ("b", 3, "R1", "X")], "pkey string, con_id int, role string, privilege string")
    direct = spark.createDataFrame([("a", 3, "U", "P"), ("a", 3, "OTHER", "Q")], "pkey string, con_id int, grantee string, privilege string")
    held = V.held_privileges(direct, grants, own, "U", ("pkey", "con_id"), nested=True)
    assert {tuple(r) for r in held.collect()} == {("a", 3, "P"), ("a", 3, "R1"), ("a", 3, "R2"), ("a", 3, "R3"), ("a", 3, "LOGMINING"), ("b", 3, "R3")}
