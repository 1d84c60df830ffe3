"""Missing privileges of all object kinds and the readiness rule that reads them."""

import duckdb
import pytest

import __spark_entry__ as entry
from fleetscope.operators import inventory as inv
from fleetscope.sources.fixtures import BASE_TABLES


def test_missing_privileges_of_every_kind(spark):
    rows = [("p", "db", o, n, t) for o, n, t in [
        ("app", "app", "SCHEMA"), ("cron", "cron", "SCHEMA"), ("pg_toast", "pg_toast", "SCHEMA"), ("app", "t1", "TABLE"),
        ("app", "t2", "TABLE"), ("cron", "job", "TABLE"), ("pglogical", "node", "TABLE"), ("app", "v", "VIEW"),
        ("information_schema", "v", "VIEW"), ("app", "s", "SEQUENCE"), ("information_schema", "s", "SEQUENCE"), ("pgx", "s", "SEQUENCE")]]
    schema = "pkey string, database_name string, owner string, object_name string, object_type string"
    grants = spark.createDataFrame([("p", "db", "app", "t1", "TABLE"), ("p", "db2", "app", "t2", "TABLE"),
                                    ("p", "db", "app", "v", "TABLE")], schema)
    missing = inv.missing_privileges_by_kind(spark.createDataFrame(rows, schema), grants)
    got = {(r["kind_order"], r["message"]) for r in inv.missing_privilege_messages(missing).collect()}
    say = "user doesn't have SELECT privilege on "
    assert got == {(1, "user doesn't have USAGE privilege on schema app"), (2, say + "table app.t2"), (2, say + "table cron.job"),
                   (3, say + "view app.v"), (4, say + "sequence app.s"), (4, say + "sequence information_schema.s"),
                   (4, say + "sequence pgx.s")}


@pytest.mark.parametrize("name", ["d39_missing_privileges_by_kind", "e14_privileges_of_objects"])
def test_against_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    df = entry.queries()[name](spark, sf_small)
    res = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert sorted(map(tuple, df.select(*res.columns).collect())) == sorted(res.fetchall()) != []
    if name.startswith("d39"):
        assert {r["object_type"] for r in df.collect()} == {"SCHEMA", "TABLE", "VIEW", "SEQUENCE"}
