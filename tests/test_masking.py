"""Pseudonymisation properties: same in -> same out, one-to-one after collision repair,
unmask(mask(x)) = x, exclusions and the host-name layout."""

from pyspark.sql import functions as F

from fleetscope.operators import masking as M
from fleetscope.sources.fixtures import estate

SALT = "t"


def test_identity_map_is_function_and_injective(spark, sf_small):
    t = estate(spark, sf_small, "est_tables")
    m = M.resolve_collisions(M.identity_map([(t, "owner", "SCHEMA_NAME"), (t, "table_name", "OBJECT_NAME")], SALT),
                             SALT)
    assert m.groupBy("original").count().where("count > 1").count() == 0
    assert m.groupBy("masked").count().where("count > 1").count() == 0
    assert m.where(F.col("original") == "SYS").count() == 0   # excluded owner


def test_collisions_are_numbered_in_one_pass(spark):
    def tiny(original, kind):   # 16 possible outputs for 200 originals
        return F.concat(F.lit("X"), F.substring(F.sha2(original, 256), 1, 1))

    m = spark.range(200).select(F.format_string("v%03d", "id").alias("original"), F.lit("OBJECT_NAME").alias("kind"),
                                F.lit("X0").alias("masked"), F.lit(0).alias("attempt"))
    fixed = {r.original: (r.masked, r.attempt) for r in M.resolve_collisions(m, SALT, pseudo=tiny).collect()}
    assert len(fixed) == 200 and len({x for x, _ in fixed.values()}) == 200
    groups = {}
    for original in sorted(fixed):
        masked, number = fixed[original]
        bare = masked.split("-")[0]
        assert number == groups.get(bare, 0) and masked == (f"{bare}-{number}" if number else bare)
        groups[bare] = number + 1


def test_published_pseudonyms_never_change(spark):
    schema = "original string, kind string, masked string, attempt int"
    old = spark.createDataFrame([("m", "OBJECT_NAME", "OBJ_A1", 0), ("p", "OBJECT_NAME", "OBJ_A1-1", 1), ("q", "OBJECT_NAME", "OBJ_B1-7", 7),
                                 ("h", "HOST_NAME", "db.aa-bb-cc-dd-2.com", 2)], schema)
    new = spark.createDataFrame([("a", "OBJECT_NAME", "OBJ_A1", 0), ("z", "OBJECT_NAME", "OBJ_A1", 0), ("b", "OBJECT_NAME", "OBJ_B1", 0),
                                 ("c", "OBJECT_NAME", "OBJ_C1", 0), ("i", "HOST_NAME", "db.aa-bb-cc-dd.com", 0)], schema)
    got = {r.original: r.masked for r in M.resolve_collisions(old.unionByName(new), SALT, existing=old).collect()}
    assert got == {"m": "OBJ_A1", "p": "OBJ_A1-1", "q": "OBJ_B1-7", "h": "db.aa-bb-cc-dd-2.com",
                   "a": "OBJ_A1-2", "z": "OBJ_A1-3", "b": "OBJ_B1-8", "c": "OBJ_C1", "i": "db.aa-bb-cc-dd-3.com"}
    grown = M.resolve_collisions(M.identity_map([(spark.createDataFrame([("m",), ("n",)], "v string"), "v", "OBJECT_NAME")], SALT, existing=old),
                                 SALT, existing=old)
    kept = {r.original: r.masked for r in grown.collect()}
    assert all(kept[r.original] == r.masked for r in old.collect()) and "n" in kept


def test_a_million_hosts_stay_apart(spark):
    hosts = spark.range(1_000_000).select(F.concat(F.lit("host"), "id").alias("h"))
    m = M.resolve_collisions(M.identity_map([(hosts, "h", "HOST_NAME")], SALT), SALT)
    n, distinct, most = m.agg(F.count(F.lit(1)), F.countDistinct("masked"), F.max("attempt")).first()
    assert n == distinct == 1_000_000 and most >= 1  # 26 bits of hash alone would collide thousands of times


def test_mask_unmask_roundtrip(spark, sf_small):
    t = estate(spark, sf_small, "est_tables")
    m = M.identity_map([(t, "owner", "SCHEMA_NAME"), (t, "table_name", "OBJECT_NAME")], SALT)
    masked = M.apply_mask(M.apply_mask(t, m, "owner", "SCHEMA_NAME"), m, "table_name", "OBJECT_NAME")
    assert masked.where(F.col("table_name").startswith("BIN$OBJ_")).count() == t.where(
        F.col("table_name").startswith("BIN$")).count()
    assert masked.where(F.col("owner") == "SYS").count() == t.where(F.col("owner") == "SYS").count()
    back = M.unmask(M.unmask(masked, m, "owner"), m, "table_name")
    cols = ["object_id", "owner", "table_name"]
    assert sorted(back.select(*cols).collect()) == sorted(t.select(*cols).collect())


def test_host_pseudonym_layout(spark):
    df = spark.createDataFrame([("db-host-01.example.com",), ("other",)], "h string")
    out = [r.p for r in df.select(M.host_pseudonym("h").alias("p")).collect()]
    words = M.default_wordlist()
    for p in out:
        prefix, body, domain = p.split(".")
        assert prefix in M.HOST_PREFIXES and domain in M.HOST_DOMAINS
        parts = body.split("-")
        assert len(parts) == 4 and parts[3] == words[0]
    again = [r.p for r in df.select(M.host_pseudonym("h").alias("p")).collect()]
    assert out == again


def test_owner_like_values_stay_in_every_kind(spark):
    df = spark.createDataFrame([("APEX_FOO",), ("SYS",), ("OPS$X",), ("T1",), ("BIN$T1",), (None,)], "name string")
    m = spark.createDataFrame([("T1", "OBJECT_NAME", "OBJ_1", 0)], "original string, kind string, masked string, attempt int")
    got = [r["name"] for r in M.apply_mask(df, m, "name", "OBJECT_NAME").collect()]
    assert set(got) == {"APEX_FOO", "SYS", "OPS$X", "OBJ_1", "BIN$" + M.UNMAPPED, None} and len(got) == 6


def test_hosts_in_collision_are_hashed_anew(spark):
    rows = [(f"host{i}", "HOST_NAME", "same", 0) for i in range(4)]
    m = spark.createDataFrame(rows, "original string, kind string, masked string, attempt int")
    got = {r["original"]: r["masked"] for r in M.resolve_collisions(m, "salt").collect()}
    assert got["host0"] == "same" and None not in got.values() and len(set(got.values())) == 4
