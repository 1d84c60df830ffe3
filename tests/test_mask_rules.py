"""Rule-driven masking: positions by version, missing columns, row filters, one map for the fleet."""

import pytest

from fleetscope.operators import mask_rules as R

SCHEMA = "file string, line long, table_name string, script_version string, cells array<string>"


def lines(spark, rows):
    return spark.createDataFrame([(f"f{i}", i, t, v, c) for i, (t, v, c) in enumerate(rows)], SCHEMA)


ROWS = [
    ("columntypes", "4.3.20", ["k1", "c", "SCOTT", "EMP", "1", "s1", "m"]),
    ("columntypes", "4.3.9", ["k1", "c", "SYS", "BIN$EMP", "1", "s1", "m"]),
    ("dbsummary", "4.3.15", ["k1", "c", "DB1", "x", "UNIQ", "5", "s1", "m"]),
    ("dbsummary", "4.3.14", ["k1", "c", "DB1", "x", "UNIQ", "5", "s1", "m"]),
    ("dbsummary", "4.3.2", ["k1", "s1", "m"]),
    ("dbparameters", "4.4.0", ["k2", "1", "0", "db_name", "PROD", "PROD", "s2", "m"]),
    ("dbparameters", "4.4.0", ["k2", "1", "0", "optimizer_mode", "ALL_ROWS", "FIRST", "s2", "m"]),
    ("pdbsinfo", "4.4.0", ["k2", "1", "CDB$ROOT", "PDBX", "s2", "m"]),
    ("pdbsinfo", "4.4.0", ["k2", "1", "X", "PDBY", "s2", "m"]),
    ("pdbsopenmode", "4.4.0", ["k2", "1", "PDB$SEED", "s2", "m"]),
    ("sourcecode", "4.4.0", ["k2", "1", "EMP", "s2", "m"]),
    ("anything", "4.4.0", ["k3", "SCOTT", "s3", "m"]),
]


def test_rules_meet_the_cells_they_name(spark):
    df = lines(spark, ROWS)
    mapping = R.fleet_map(df, R.RULES_ORACLE, "salt")
    m = {r.original: (r.kind, r.masked) for r in mapping.collect()}
    assert set(m) == {"k1", "k2", "k3", "s1", "s2", "s3", "SCOTT", "EMP", "BIN$EMP", "DB1", "5", "m", "PROD", "PDBX"}
    assert m["EMP"][0] == "SCHEMA_NAME"  # the earlier rule decides
    assert m["m"][0] == "DATABASE_NAME" and m["5"][0] == "DATABASE_NAME"  # position -3 of new and of old files
    got = {r.line: r.cells for r in R.mask_lines(df, R.RULES_ORACLE, mapping, ["file", "line"]).collect()}
    def x(v):
        return m[v][1]
    assert got[0] == [x("k1"), "c", x("SCOTT"), x("EMP"), "1", x("s1"), "m"]
    assert got[1] == [x("k1"), "c", "SYS", "BIN$" + x("BIN$EMP"), "1", x("s1"), "m"]
    assert got[2] == [x("k1"), "c", x("DB1"), "x", "UNIQ", x("5"), x("s1"), "m"]
    assert got[3] == [x("k1"), "c", x("DB1"), "x", "UNIQ", "5", x("s1"), x("m")]
    assert got[4] == [x("k1"), x("s1"), x("m")]
    assert got[5] == [x("k2"), "1", "0", "db_name", x("PROD"), x("PROD"), x("s2"), "m"]
    assert got[6] == [x("k2"), "1", "0", "optimizer_mode", "ALL_ROWS", "FIRST", x("s2"), "m"]
    assert got[7][3] == x("PDBX") and got[8][3] == "PDBY" and got[9][2] == "PDB$SEED"
    assert got[11] == [x("k3"), "SCOTT", x("s3"), "m"]
    assert len({v for _, v in m.values()}) == len(m)


def test_a_missing_required_column_is_an_error(spark):
    with pytest.raises(Exception, match="missing in LinkedSrvrs"):
        R.resolve(lines(spark, [("LinkedSrvrs", "4.4.0", ["k", "a", "b"])]), R.RULES_MSSQL).collect()
    few = R.resolve(lines(spark, [("TableList", "4.4.0", ["k"] + ["x"] * 17), ("ObjectList", "4.4.0", ["k", "d", "s", "m"])]), R.RULES_MSSQL)
    assert [len(r._hits) for r in few.orderBy("line").collect()] == [5, 5]


def test_published_values_survive_a_rule_run(spark):
    df = lines(spark, ROWS)
    old = spark.createDataFrame([("EMP", "OBJECT_NAME", "OBJ_OLD", 0)], "original string, kind string, masked string, attempt int")
    m = {r.original: r.masked for r in R.fleet_map(df, R.RULES_ORACLE, "salt", existing=old).collect()}
    assert m["EMP"] == "OBJ_OLD" and m["SCOTT"].startswith("USER_")
    assert R.fleet_map(df.where("false"), R.RULES_ORACLE, "salt").count() == 0
    assert R.mask_lines(df.where("false"), R.RULES_ORACLE, R.fleet_map(df, R.RULES_ORACLE, "s"), ["file", "line"]).count() == 0


def test_rules_of_a_row_are_placed_once_a_use(spark):
    """The map and the mask each read the lines once; nothing is worked out again for a filter or a rule."""
    df = lines(spark, ROWS)
    masked = R.mask_lines(df, R.RULES_ORACLE, R.fleet_map(df, R.RULES_ORACLE, "salt"), ["file", "line"])
    plan = masked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") <= 2 and plan.count("raise_error(") <= 2


def test_odd_versions_lengths_and_cells(spark):
    rows = [("columntypes", None, ["k1", "c", None, "T", "1", "s1", "m"]), ("nothing", "x", ["k1", "s1"]),
            (None, "4.3.9", ["k2", "s2", None]), ("dbsummary", "3", ["k1", "c", "D", "s1", "m"])]
    got = {r.line: [(h.ord, h.kind, h.idx, h.plain, h.value) for h in r._hits]
           for r in R.resolve(lines(spark, rows), R.RULES_ORACLE).collect()}
    assert [h[1:] for h in got[0]] == [("PKEY", 0, True, "k1"), ("DMA_SOURCE_ID", 5, True, "s1"), ("SCHEMA_NAME", 2, True, None),
                                       ("OBJECT_NAME", 3, True, "T")]
    assert [h[1:3] for h in got[1]] == [("PKEY", 0), ("DMA_SOURCE_ID", 0)] and [h[4] for h in got[2]] == ["k2", "s2"]
    assert [h[2] for h in got[3]] == [0, 3, 2, 4]  # before 4.3.15 position -3 is -1
