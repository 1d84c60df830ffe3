"""Align integer widths of the DuckDB oracles with the Spark results.

DuckDB widens integer sums to HUGEINT and some functions return BIGINT where Spark
returns INT; values are equal but the column types differ.  This tool runs every job and
its oracle on the smallest tables, and writes ``fleetscope/plans/oracle_casts.py`` with the
casts that ``Spec.oracle_sql`` applies around the oracle query.

    python tools/gen_oracle_casts.py [--sf /root/testdata/sf0.001]
"""

from __future__ import annotations

import argparse
import os
import pprint
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fleetscope.plans import oracle_casts  # noqa: E402
from fleetscope.plans.catalog import all_specs  # noqa: E402
from fleetscope.session import get_spark  # noqa: E402
from fleetscope.sources.fixtures import BASE_TABLES  # noqa: E402

INT_SPARK = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT"}
INT_DUCK = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT"}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("prefixes", nargs="*", help="only these jobs are run anew; the others keep their casts")
    a = ap.parse_args()
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{a.sf}/{t}.parquet')")
    out = {n: c for n, c in oracle_casts.CASTS.items() if a.prefixes and not n.startswith(tuple(a.prefixes))}
    oracle_casts.CASTS.clear()
    for name, spec in all_specs().items():
        if a.prefixes and not name.startswith(tuple(a.prefixes)):
            continue
        sql = spec.oracle_sql()
        if sql is None:
            continue
        df = spec.run(spark, a.sf)
        rel = con.sql(sql)
        dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
        casts = {c: INT_SPARK[t] for c, t in df.dtypes
                 if t in INT_SPARK and dtypes.get(c) in INT_DUCK and dtypes.get(c) != INT_SPARK[t]}
        if casts:
            out[name] = casts
        other = {c: (t, dtypes.get(c)) for c, t in df.dtypes if t not in INT_SPARK}
        if a.prefixes:
            print(name, casts, other)
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "fleetscope", "plans",
                        "oracle_casts.py")
    with open(path, "w") as f:
        f.write('"""Generated by tools/gen_oracle_casts.py: integer widths applied around each DuckDB oracle\n'
                'so its column types equal the Spark result (DuckDB widens integer sums to HUGEINT)."""\n\n')
        f.write("CASTS = " + pprint.pformat(out, width=110, sort_dicts=True) + "\n")
    print(f"{len(out)} oracles with casts")
    spark.stop()


if __name__ == "__main__":
    main()
