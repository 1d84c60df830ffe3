"""Partitioned LOB sizing, application signatures and dependencies by class on written-out rows."""

from pyspark.sql import functions as F

from fleetscope.operators import inventory as inv
from fleetscope.plans.catalog_inventory import SPECS

KEY = "pkey string, con_id int, owner string, table_name string"


def _lob_frames(spark):
    t = ("k", 1, "APP")
    return dict(
        cols=spark.createDataFrame([(*t, "T", "C", "CLOB"), (*t, "U", "C", "BLOB"), (*t, "U", "N", "NUMBER"),
                                    ("k", 1, "SYS", "T", "C", "CLOB")], KEY + ", column_name string, data_type string"),
        tables=spark.createDataFrame([(*t, "T", 100, "YES"), (*t, "U", None, "NO")], KEY + ", num_rows long, partitioned string"),
        lobs=spark.createDataFrame([(*t, "T", "C", "L"), (*t, "U", "C", "M")], KEY + ", column_name string, segment_name string"),
        table_parts=spark.createDataFrame([(*t, "T", "P1", 0, 40), (*t, "T", "P2", 1, 0)],
                                          KEY + ", partition_name string, subpartition_count int, num_rows long"),
        table_subparts=spark.createDataFrame([(*t, "T", "P2", "S1", 10)],
                                             KEY + ", partition_name string, subpartition_name string, num_rows long"),
        lob_parts=spark.createDataFrame([(*t, "T", "L", "P1", "LP1"), (*t, "T", "L", "P2", "LP2")],
                                        KEY + ", lob_name string, partition_name string, lob_partition_name string"),
        lob_subparts=spark.createDataFrame(
            [(*t, "L", "LP2", "S1", "LS1")], "pkey string, con_id int, owner string, lob_name string, "
            "lob_partition_name string, subpartition_name string, lob_subpartition_name string"),
        segments=spark.createDataFrame([(*t, "L", "LP1", 400), (*t, "L", "LP2", 999), (*t, "L", "LS1", 50), (*t, "M", None, 7),
                                        ("k", 2, "APP", "M", None, 8)],
                                       "pkey string, con_id int, owner string, segment_name string, partition_name string, "
                                       "bytes long"))


def test_lob_segments_are_met_at_the_level_they_are_stored(spark):
    out = inv.lob_segment_sizing(**_lob_frames(spark))
    rows = {(r.table_name, r.table_partition_name): r for r in out.collect()}
    assert len(rows) == out.count() == 3
    p1, p2, u = rows["T", "P1"], rows["T", "P2"], rows["U", None]
    assert (p1.seg_partition_name, p1.seg_bytes, p1.table_avg_lob_bytes, p1.partition_avg_lob_bytes) == ("LP1", 400, 4, 10)
    assert (p2.seg_partition_name, p2.seg_bytes, p2.partition_avg_lob_bytes, p2.subpartition_avg_lob_bytes) == ("LS1", 50, 0, 5)
    assert (u.seg_name, u.seg_partition_name, u.seg_bytes, u.table_avg_lob_bytes) == ("M", None, 7, 0)
    assert u.lob_compression == "N/A"


def test_lob_joins_are_all_hash_or_merge_joins(spark, sf_small):
    plan = SPECS["d17_lob_segment_sizing"].run(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_signature_of_several_columns_needs_one_owner_with_all(spark):
    pair = {"x_owner": [("A", "C1", "NUMBER"), ("B", "C2", "DATE")]}
    cols = spark.createDataFrame(
        [("k0", "O1", "A", "C1", "NUMBER"), ("k0", "O2", "B", "C2", "DATE"),     # split over two owners
         ("k1", "O2", "A", "C1", "NUMBER"), ("k1", "O2", "B", "C2", "DATE"), ("k1", "O2", "B", "C2", "DATE"),
         ("k2", "O1", "A", "C1", "NUMBER"), ("k2", "O1", "B", "C2", "CHAR"),     # type differs
         ("k3", None, "A", None, "NUMBER")],
        "pkey string, owner string, table_name string, column_name string, data_type string")
    none = spark.createDataFrame([], "pkey string, owner string, object_name string, object_type string, view_name string, "
                                     "username string, name string, value string")
    got = inv.application_schemas(cols, cols, none, none, none, none, pair)
    assert {r.pkey: r.x_owner for r in got.collect()} == {"k0": None, "k1": "O2", "k2": None, "k3": None}
    assert {r.rds_flag for r in got.collect()} == {None}


def test_dependencies_by_class(spark):
    routine = "pkey string, schema_name string, object_name string, language string, prokind string, is_trigger boolean, " \
              "definition string"
    text = "SELECT AWS_ORACLE_EXT.To_Char(1), aws_oracle_ext.to_char(2)"
    r = spark.createDataFrame([("k", "s", "f", "sql", "p", True, text), ("k", "s", "f", "sql", "p", True, text),   # equal overload
                               ("k", "s", "f", "sql", "p", True, text + ";"), ("k", "s", "g", "plpgsql", "f", True, text),
                               ("k", "s", "h", "c", "p", True, text), ("k", "pg_catalog", "f", "sql", "p", True, text),
                               ("k", "s", "n", "sql", "p", None, None)], routine)
    one = spark.createDataFrame([("k", "s", "o", text), ("k", "s", "q", "nothing"), ("k", "aws_oracle_ext", "v", text)],
                                "pkey string, schema_name string, object_name string, definition string")
    none = one.limit(0)
    got = {(x.object_type, x.object_name, x.aws_extension_dependency): x.sct_function_reference_count
           for x in inv.conversion_dependencies(r, none, one.where(F.col("object_name") == "o"), none, one).collect()}
    low, mixed = "aws_oracle_ext.to_char", "AWS_ORACLE_EXT.To_Char"
    assert got == {("Procedures", "f", low): 4, ("Triggers", "f", low): 4, ("Triggers", "g", low): 2,
                   ("TableCheckConstraints", "o", mixed): 1, ("TableCheckConstraints", "o", low): 1,
                   ("Views", "o", mixed): 1, ("Views", "o", low): 1}


def test_the_footprint_has_every_probe(spark, sf_small):
    got = {(r.pkey, r.probe_name): r.signature_owner for r in SPECS["d32_application_footprint"].run(spark, sf_small).collect()}
    assert {n for _, n in got} == {"EBS", "SIEBEL", "PEOPLESOFT", "SAP", "SAP_SVERS", "JDE", "FIXTURE_TAB_1", "FIXTURE_TAB_42"}
    assert got["pk1", "FIXTURE_TAB_1"] == got["pk1", "EBS"] == "OWN1" and got["pk0", "FIXTURE_TAB_42"] == "OWN0"
    assert got["pk1", "SAP"] == "OWN6" and got["pk1", "JDE"] is None and len(got) == 24
