"""A10 golden values (version strings and their parsed major / minor parts)."""

import pytest
from pyspark.sql import functions as F

from fleetscope.functions.expressions import major_version, minor_version

MINOR = [("9.4.1", 1), ("9.4", -1), ("16", -1), ("15.0.100", 0), ("14.2", 2), ("2.0", 0), ("asdf", -1)]
MAJOR = [("9.4.1", 9.4), ("9.4", 9.4), ("16", 16.0), ("15.0.100", 15.0), ("14.2", 14.0), ("2.0", 2.0), ("asdf", -1.0)]


@pytest.mark.parametrize("version,expected", MINOR)
def test_minor_version(spark, version, expected):
    row = spark.createDataFrame([(version,)], "v string").select(minor_version("v").alias("m")).first()
    assert row.m == expected


@pytest.mark.parametrize("version,expected", MAJOR)
def test_major_version(spark, version, expected):
    row = spark.createDataFrame([(version,)], "v string").select(major_version("v").alias("m")).first()
    assert row.m == expected


def test_beta_and_mysql_family(spark):
    df = spark.createDataFrame([("17beta2",), ("5.7.44",), ("8.0.36",)], "v string")
    out = df.select(major_version("v", "9").alias("pg"), major_version("v", "5").alias("my"),
                    minor_version("v", "5").alias("mym")).collect()
    assert out[0].pg == 17.0
    assert (out[1].my, out[1].mym) == (5.7, 44)
    assert (out[2].my, out[2].mym) == (8.0, 0)
    assert df.where(F.lit(True)).count() == 3
