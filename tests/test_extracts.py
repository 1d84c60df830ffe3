"""Readers and file-level jobs."""

import hashlib
import os
import tempfile

import pytest

from fleetscope.sources import extracts as X


def test_read_extract_trims_and_skips_blank_lines(spark):
    d = tempfile.mkdtemp(prefix="fs-extract-")
    with open(os.path.join(d, "opdb__t__x.csv"), "w") as f:
        f.write("a|b|c\n 1 | x y |\"p|q\"\n\n2|z|\n")
    rows = X.read_extract(spark, d, "a int, b string, c string").orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, "x y", "p|q"), (2, "z", None)]


def test_key_value_split_at_first_colon(spark):
    d = tempfile.mkdtemp(prefix="fs-kv-")
    with open(os.path.join(d, "opdb__app_cloud__x.txt"), "w") as f:
        f.write("EBS : Y\nURL: http://h:80/x\nnocolon\n")
    rows = {r.key: r.value for r in X.read_key_value(spark, d).collect()}
    assert rows == {"EBS": "Y", "URL": "http://h:80/x"}


def test_file_metadata_fields_and_error(spark):
    ok = spark.createDataFrame([("/x/opdb__dbobjects__ORA_4.3.20_host1_db1_inst1_240101.csv",)], "file_name string")
    r = X.file_metadata(ok).first()
    assert (r.script_version, r.host_name, r.database_name, r.instance_name, r.date_time) == \
        ("4.3.20", "host1", "db1", "inst1", "240101")
    assert r.pkey == "host1_db1_240101" and r.collection_key == "host1_db1_inst1_240101"
    bad = spark.createDataFrame([("opdb__x__a_b.csv",)], "file_name string")
    with pytest.raises(Exception):
        X.file_metadata(bad).collect()


def test_manifest_and_completeness(spark):
    d = tempfile.mkdtemp(prefix="fs-manifest-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    X.export_extracts({"opdb__t1__run": df}, d)
    m = X.file_manifest(spark, d, "oracle").collect()
    assert m and all(len(r.md5) == 32 and r.db_type == "oracle" for r in m)
    files = spark.createDataFrame([("k1", "t1", "f1", 0), ("k1", "t1", "f2", 0), ("k1", "eoj", "f3", 0),
                                   ("k2", "t1", "f4", 0), ("k2", "t2", "f5", 0), ("k2", "eoj", "f6", 0)],
                                  "collection_key string, table_name string, file_name string, error_lines int")
    out = {r.collection_key: r for r in X.collection_completeness(files, ["t1", "t2", "eoj"]).collect()}
    assert out["k1"].status == "ERROR" and out["k1"].missing_tables == "t2" and out["k1"].duplicate_tables == "t1"
    assert out["k2"].status == "OK"


def test_manifest_of_files_above_two_gigabytes(spark):
    d = tempfile.mkdtemp(prefix="fs-manifest-")
    size = (2 << 30) + 5
    with open(os.path.join(d, "opdb__big one%20.csv"), "wb") as f:      # sparse: takes no space
        f.truncate(size)
        f.seek(size - 3)
        f.write(b"end")
    for name in ("empty.csv", "opdb__manifest__x.csv", "other.txt"):
        open(os.path.join(d, name), "w").close()
    want, block = hashlib.md5(), bytes(1 << 20)
    for _ in range(2048):
        want.update(block)
    want.update(b"\0\0end")
    got = {r.file_name.split("/")[1]: r.md5 for r in X.file_manifest(spark, d, "oracle").collect()}
    assert got == {"opdb__big one%20.csv": want.hexdigest()}      # files without bytes are not listed


def test_a_load_that_is_run_again_replaces_its_own_rows(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fs-canonical-"), "t")
    df = spark.createDataFrame([("k1", 1), ("k2", 2)], "pkey string, v int")
    for load, rows in [("a", df), ("b", df), ("a", df), ("a", df.limit(0)), ("b", df.where("v = 1"))]:
        X.append_canonical(rows, df.schema, path, load_id=load)
    got = sorted((r.pkey, r.load_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("k1", "a", 1), ("k1", "b", 1), ("k2", "a", 2), ("k2", "b", 2)]
