"""Catalog inventory jobs (survey section D): data types, tables, indexes,
constraints, objects, source code, storage, settings and feature probes.

All jobs are grouped by the collection key ``pkey`` first, so one run covers a
whole fleet.  Joins between catalog tables are equi-joins on (pkey, owner, name);
small sides are pre-aggregated before the join (map-side combine) so a hot
collection never fans rows into one task.  Literal lists come from
``fleetscope.params`` and are the only broadcast sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expressions import line_count, normalize_data_type
from fleetscope.operators.filters import exclude_system_schemas, is_system_schema

TABLE_KEY = ["pkey", "owner", "table_name"]

# fixed values: Oracle column types counted one by one in the type matrix (after ``(n)`` -> ``(x)``)
LISTED_TYPES = ["ANYDATA", "BFILE", "BINARY_DOUBLE", "BINARY_FLOAT", "BLOB", "CFILE", "CHAR", "CLOB", "DATE",
                "FLOAT", "INTERVAL DAY(x) TO SECOND(x)", "INTERVAL YEAR(x) TO MONTH", "JSON", "LONG RAW", "LONG",
                "MLSLABEL", "NCHAR VARYING", "NCHAR", "NCLOB", "NUMBER", "NVARCHAR2", "RAW", "ROWID",
                "TIME(x) WITH TIME ZONE", "TIME(x)", "TIMESTAMP(x) WITH LOCAL TIME ZONE", "TIMESTAMP(x) WITH TIME ZONE",
                "TIMESTAMP(x)", "UNDEFINED", "UROWID", "VARCHAR(x)", "VARCHAR2", "XMLTYPE"]

# fixed values: constraint type letters -> matrix column
CONSTRAINT_COLUMNS = [("P", "pk"), ("U", "uk"), ("C", "ck"), ("R", "ri"), ("V", "vwck"), ("O", "vwro"),
                      ("H", "hashexpr"), ("F", "refcolcons"), ("S", "suplog")]

# fixed values: compression classes of the storage rollup
COMPRESSION_CLASSES = [("basic", ["BASIC"]), ("oltp", ["OLTP", "ADVANCED"]), ("query_low", ["QUERY LOW"]),
                       ("query_high", ["QUERY HIGH"]), ("archive_low", ["ARCHIVE LOW"]),
                       ("archive_high", ["ARCHIVE HIGH"])]

# fixed values: built-in (owner, trigger) pairs left out of the trigger count
BUILTIN_TRIGGERS = [("SYS", "XDB_PI_TRIG"), ("SYS", "DELETE_ENTRIES"), ("SYS", "OJDS$ROLE_TRIGGER$"),
                    ("SYS", "DBMS_SET_PDB"), ("MDSYS", "SDO_TOPO_DROP_FTBL"), ("MDSYS", "SDO_GEOR_BDDL_TRIGGER"),
                    ("MDSYS", "SDO_GEOR_ADDL_TRIGGER"), ("MDSYS", "SDO_NETWORK_DROP_USER"),
                    ("MDSYS", "SDO_ST_SYN_CREATE"), ("MDSYS", "SDO_DROP_USER"), ("GSMADMIN_INTERNAL", "GSMLOGOFF"),
                    ("SYSMAN", "MGMT_STARTUP"), ("SYS", "AW_TRUNC_TRG"), ("SYS", "AW_REN_TRG"),
                    ("SYS", "AW_DROP_TRG")]

# fixed values: source-code line probes (LIKE patterns on the lower-cased line; ``_`` is a wildcard)
SOURCE_PROBES = {"utl": "%utl_%", "dbms": "%dbms_%", "exec_im": "%execute%immediate%", "dbms_sql": "%dbms_sql%"}


def union_all(frames, distinct: bool = False) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.distinct() if distinct else out


def _count() -> Column:
    return F.count(F.lit(1))


# D1 -------------------------------------------------------------------------
def data_type_counts(cols: DataFrame, objects: DataFrame | None = None, keys=("pkey", "owner")) -> DataFrame:
    """Columns per (normalized) data type, without system owners; with ``objects`` only columns
    of existing tables count.  Columns are counted per table first, so the distinct table count
    is a count of those rows."""
    c = exclude_system_schemas(cols, "owner").withColumn("data_type", normalize_data_type("data_type"))
    per_table = c.groupBy(*dict.fromkeys([*keys, *TABLE_KEY, "data_type"])).agg(_count().alias("__n"))
    if objects is not None:
        per_table = per_table.join(objects.select(*TABLE_KEY), on=TABLE_KEY, how="left_semi")
    return per_table.groupBy(*keys, "data_type").agg(F.sum("__n").alias("column_count"), _count().alias("table_count"))


# D2 -------------------------------------------------------------------------
def data_type_matrix(cols: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """One row per table: a 0/1 sum per listed type, SPATIAL (unlisted type owned by MDSYS)
    and USER_DEFINED (unlisted type with another, non-null owner); without system owners."""
    c = exclude_system_schemas(cols, "owner").withColumn("data_type", normalize_data_type("data_type"))
    if objects is not None:
        c = c.join(objects.select(*TABLE_KEY), on=TABLE_KEY, how="left_semi")
    dt, own = F.col("data_type"), F.col("data_type_owner")
    unlisted = ~dt.isin(*LISTED_TYPES)
    cells = [F.sum(F.when(dt == t, 1).otherwise(0)).alias(type_column(t)) for t in LISTED_TYPES]
    cells.append(F.sum(F.when(unlisted & (own == "MDSYS"), 1).otherwise(0)).alias("spatial_col_count"))
    cells.append(F.sum(F.when(unlisted & (own != "MDSYS"), 1).otherwise(0)).alias("user_defined_col_count"))
    return c.groupBy(*TABLE_KEY).agg(*cells)


def type_column(t: str) -> str:
    import re
    return re.sub(r"[^a-z0-9]+", "_", t.lower().replace("(x)", "")).strip("_") + "_col_count"


# D3 / D4 ----------------------------------------------------------------------
def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column when the frame has it, else a typed null (older catalog versions)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype).alias(name)


def _flagged(df: DataFrame, kind: str) -> DataFrame:
    return exclude_system_schemas(df, "owner").select(*TABLE_KEY, F.lit(kind).alias("table_kind"),
                     F.when(col_or_null(df, "partitioned") == "YES", "YES").otherwise("NO").alias("partitioned"),
                     F.coalesce(col_or_null(df, "temporary"), F.lit("N")).alias("temporary"),
                     col_or_null(df, "iot_type").alias("iot_type"))


def table_type_counts(tables: DataFrame, xml_tables: DataFrame, object_tables: DataFrame) -> DataFrame:
    """Three sources (relational, XML, object tables) with literal kinds, each grouped."""
    parts = [_flagged(df, k).groupBy("pkey", "owner", "table_kind", "partitioned", "temporary", "iot_type")
             .agg(_count().alias("table_count"))
             for df, k in ((tables, "RELATIONAL"), (xml_tables, "XML"), (object_tables, "OBJECT"))]
    return union_all(parts)


def table_type_detail(tables: DataFrame, xml_tables: DataFrame, object_tables: DataFrame,
                      partitions: DataFrame, subpartitions: DataFrame) -> DataFrame:
    """Per-table form: the three sources, left-joined to partition method / count and to the
    counted sub-partitions (pre-aggregated before the join)."""
    base = union_all([_flagged(df, k) for df, k in
                      ((tables, "RELATIONAL"), (xml_tables, "XML"), (object_tables, "OBJECT"))])
    sub = subpartitions.groupBy(*TABLE_KEY).agg(_count().alias("subpartition_count"))
    return (base.join(partitions.select(*TABLE_KEY, "partitioning_type", "partition_count"), on=TABLE_KEY, how="left")
            .join(sub, on=TABLE_KEY, how="left"))


# D5 / D6 ----------------------------------------------------------------------
def index_type_detail(idx: DataFrame) -> DataFrame:
    return exclude_system_schemas(idx, "owner").select("pkey", "owner", "table_name", "index_name", "index_type", "uniqueness",
                      F.when(F.col("ityp_owner").isNotNull(), "Y").otherwise("N").alias("custom_index_type"))


def index_type_counts(idx: DataFrame) -> DataFrame:
    """Indexes grouped by their attributes; custom = an index type owner exists."""
    return (index_type_detail(idx).groupBy("pkey", "owner", "index_type", "uniqueness", "custom_index_type")
            .agg(_count().alias("index_count")))


def indexes_per_table(idx: DataFrame) -> DataFrame:
    """Histogram of indexes per table with percent = round(100 * ratio_to_report) per
    collection.  The collection total is a grouped sum joined back (no unpartitioned window)."""
    per_table = exclude_system_schemas(idx, "owner").groupBy(*TABLE_KEY).agg(_count().alias("index_count"))
    hist = per_table.groupBy("pkey", "index_count").agg(_count().alias("table_count"))
    total = hist.groupBy("pkey").agg(F.sum("table_count").alias("__total"))
    return (hist.join(total, on="pkey")
            .withColumn("pct", F.round(F.lit(100.0) * F.col("table_count") / F.col("__total")))
            .drop("__total"))


# D7 / D8 ----------------------------------------------------------------------
def constraint_matrix(tables: DataFrame, cons: DataFrame) -> DataFrame:
    """Tables left-joined to constraints: one column per type (null when absent, not 0) and
    ``total_cons`` counting joined rows, so a table without constraints shows 1."""
    j = exclude_system_schemas(tables, "owner").select(*TABLE_KEY).join(cons.select(*TABLE_KEY, "constraint_type"), on=TABLE_KEY, how="left")
    cells = [F.sum(F.when(F.col("constraint_type") == t, 1)).alias(name) for t, name in CONSTRAINT_COLUMNS]
    return j.groupBy(*TABLE_KEY).agg(*cells, _count().alias("total_cons"))


def constraint_summary_by_owner(tables: DataFrame, cons: DataFrame) -> DataFrame:
    m = constraint_matrix(tables, cons)
    sums = [F.sum(name).alias(name) for _, name in CONSTRAINT_COLUMNS]
    return m.groupBy("pkey", "owner").agg(F.countDistinct("table_name").alias("table_count"), *sums,
                                          F.sum("total_cons").alias("total_cons"))


# D9 / D10 ---------------------------------------------------------------------
def _visible_objects(objs: DataFrame, syns: DataFrame, family: str = "oracle") -> DataFrame:
    """Objects without recycle-bin names, synonyms of PUBLIC that start with ``/`` or resolve to
    a system owner, and system owners (directories owned by SYS are kept).  Private synonyms
    stay."""
    public = (F.col("owner") == "PUBLIC") & (F.col("object_type") == "SYNONYM")
    seen = (~F.coalesce(is_system_schema("owner", family), F.lit(False))
            | ((F.col("object_type") == "DIRECTORY") & (F.col("owner") == "SYS")))
    o = objs.where(~F.col("object_name").like("BIN$%") & seen & ~(public & F.col("object_name").startswith("/")))
    to_system = (exclude_system_schemas(syns.where(F.col("owner") == "PUBLIC"), "table_owner", family=family, keep=False)
                 .select("pkey", "owner", F.col("synonym_name").alias("object_name"), F.lit("SYNONYM").alias("object_type")))
    return o.join(to_system, on=["pkey", "owner", "object_name", "object_type"], how="left_anti")


def object_counts(objs: DataFrame, syns: DataFrame) -> DataFrame:
    return (_visible_objects(objs, syns).groupBy("pkey", "owner", "object_type")
            .agg(_count().alias("object_count")))


def object_names(objs: DataFrame, syns: DataFrame, source: DataFrame) -> DataFrame:
    """Row-level form of ``object_counts`` with the largest source line per object and the
    name quoted."""
    lines = source.groupBy("pkey", "owner", F.col("name").alias("object_name")).agg(F.max("line").alias("lines"))
    return (_visible_objects(objs, syns).join(lines, on=["pkey", "owner", "object_name"], how="left")
            .select("pkey", "owner", F.concat(F.lit('"'), "object_name", F.lit('"')).alias("object_name"),
                    "object_type", "lines"))


# D11 ---------------------------------------------------------------------------
def schema_objects(tables: DataFrame, views: DataFrame, indexes: DataFrame, constraints: DataFrame,
                   triggers: DataFrame, routines: DataFrame, distinct: bool = False) -> DataFrame:
    """Six object kinds with category and type; triggers that implement constraints are
    left out (anti-join).  ``distinct=True`` is the MySQL ``union`` form."""
    trg = triggers.join(constraints.select("pkey", "owner", F.col("constraint_name").alias("object_name")),
                        on=["pkey", "owner", "object_name"], how="left_anti")
    parts = [
        tables.select("pkey", "owner", "object_name", F.lit("TABLE").alias("object_category"), "object_type"),
        views.select("pkey", "owner", "object_name", F.lit("VIEW").alias("object_category"), "object_type"),
        indexes.select("pkey", "owner", "object_name", F.lit("INDEX").alias("object_category"), "object_type"),
        constraints.select("pkey", "owner", F.col("constraint_name").alias("object_name"),
                           F.lit("CONSTRAINT").alias("object_category"), "object_type"),
        trg.select("pkey", "owner", "object_name", F.lit("TRIGGER").alias("object_category"), "object_type"),
        routines.select("pkey", "owner", "object_name", F.lit("ROUTINE").alias("object_category"), "object_type"),
    ]
    return union_all(parts, distinct=distinct)


# D12 / D13 ----------------------------------------------------------------------
def schema_details(schemas: DataFrame, tables: DataFrame, views: DataFrame, funcs: DataFrame,
                   system_owners=("SYS",)) -> DataFrame:
    """Per schema: counts and sizes of tables, views and functions (zero when absent) and a
    system flag; each side is aggregated before the left join."""
    k = ["pkey", "owner"]
    t = tables.groupBy(*k).agg(_count().alias("table_count"), F.sum("bytes").alias("table_bytes"))
    v = views.groupBy(*k).agg(_count().alias("view_count"))
    f = funcs.groupBy(*k).agg(_count().alias("function_count"), F.sum("bytes").alias("function_bytes"))
    out = schemas.select(*k).distinct().join(t, on=k, how="left").join(v, on=k, how="left").join(f, on=k, how="left")
    for c in ("table_count", "table_bytes", "view_count", "function_count", "function_bytes"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out.withColumn("is_system", F.when(F.col("owner").isin(*system_owners), "Y").otherwise("N"))


def table_details_pg(objs: DataFrame, stat: DataFrame, io: DataFrame, foreign: DataFrame) -> DataFrame:
    """Three left joins on the object id; block counters null -> 0, other stats stay null."""
    k = ["pkey", "object_id"]
    out = objs.join(stat, on=k, how="left").join(io, on=k, how="left").join(foreign, on=k, how="left")
    for c in ("heap_blks_read", "heap_blks_hit"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


# D14 / D15 ----------------------------------------------------------------------
def table_details_mysql(tables: DataFrame, partitions: DataFrame, stats: DataFrame) -> DataFrame:
    """has_primary_key: some index whose every column is unique and not nullable (``having
    sum = count``).  A table with two such indexes appears twice (the reference's join
    fan-out is kept).  Index counts are rows of the statistics table."""
    ik = TABLE_KEY + ["index_name"]
    good = F.when((F.col("non_unique") == 0) & (F.col("nullable") != "YES"), 1).otherwise(0)
    pk = (stats.groupBy(*ik).agg(F.sum(good).alias("__good"), _count().alias("__n"))
          .where(F.col("__good") == F.col("__n")).select(*TABLE_KEY, F.lit("YES").alias("__pk")))
    idx = stats.groupBy(*TABLE_KEY).agg(_count().alias("index_count"))
    parts = partitions.groupBy(*TABLE_KEY).agg(_count().alias("partition_count"))
    return (tables.join(pk, on=TABLE_KEY, how="left").join(idx, on=TABLE_KEY, how="left")
            .join(parts, on=TABLE_KEY, how="left")
            .withColumn("has_primary_key", F.coalesce(F.col("__pk"), F.lit("NO")))
            .withColumn("index_count", F.coalesce(F.col("index_count"), F.lit(0)))
            .withColumn("partition_count", F.coalesce(F.col("partition_count"), F.lit(0)))
            .drop("__pk"))


def database_rollup(details: DataFrame) -> DataFrame:
    """Per schema: total / InnoDB / other sums of tables, rows, data, index and total bytes."""
    inno = F.upper(F.col("engine")) == "INNODB"
    aggs = []
    for name, c in (("tables", F.lit(1)), ("rows", F.col("num_rows")), ("data_bytes", F.col("data_bytes")),
                    ("index_bytes", F.col("index_bytes")), ("total_bytes", F.col("data_bytes") + F.col("index_bytes")),
                    ("indexes", F.col("index_count"))):
        aggs += [F.sum(c).alias(f"total_{name}"), F.sum(F.when(inno, c).otherwise(0)).alias(f"innodb_{name}"),
                 F.sum(F.when(~inno, c).otherwise(0)).alias(f"other_{name}")]
    return details.groupBy("pkey", "owner").agg(*aggs)


# D16 ------------------------------------------------------------------------------
def compression_by_type(tables: DataFrame, partitions: DataFrame, subpartitions: DataFrame,
                        segments: DataFrame) -> DataFrame:
    """GB per owner and compression class from three segment joins: tables with their
    unpartitioned segment, partitions and sub-partitions by table and partition name.  Each level
    is summed and rounded up per (owner, class) by itself, then the levels are added; BASIC maps
    ENABLED to 0 and other classes to null.  System owners are left out."""
    seg = segments.select("pkey", "owner", "segment_name", F.col("partition_name").alias("part"), "bytes")

    def level(df, number, part_col=None):
        d = exclude_system_schemas(df.where(F.col("compression") == "ENABLED"), "owner").select(
            "pkey", "owner", F.col("table_name").alias("segment_name"), "compress_for",
            *([F.col(part_col).alias("part")] if part_col else []), F.lit(number).alias("level"))
        if part_col:
            return d.join(seg, on=["pkey", "owner", "segment_name", "part"], how="inner")
        return d.join(seg.where("part is null"), on=["pkey", "owner", "segment_name"], how="inner")

    u = union_all([x.select("pkey", "owner", "compress_for", "level", "bytes") for x in (
        level(tables, 1), level(partitions, 2, "partition_name"), level(subpartitions, 3, "subpartition_name"))])
    g = u.groupBy("pkey", "owner", "compress_for", "level").agg(
        (F.sum("bytes") / F.lit(1073741824.0)).alias("gbytes"))
    cf, gb = F.col("compress_for"), F.col("gbytes")
    cells = []
    for name, members in COMPRESSION_CLASSES:
        if name == "basic":
            v = F.when(cf == "BASIC", gb).when(cf == "ENABLED", F.lit(0.0))
        else:
            v = F.when(cf.isin(*members), gb).otherwise(F.lit(0.0))
        cells.append(F.floor(F.sum(F.ceil(v))).alias(name))
    cells.append(F.floor(F.sum(F.ceil(gb))).alias("total_gb"))
    return g.groupBy("pkey", "owner").agg(*cells)


# D17 ------------------------------------------------------------------------------
def lob_sizing(cols: DataFrame, tables: DataFrame, lobs: DataFrame, segments: DataFrame) -> DataFrame:
    """LOB columns of tables (inner x2) with their segment bytes (left).  The segment match
    uses the partition name only for partitioned LOBs (conditional equi-join, no cartesian)."""
    c = exclude_system_schemas(cols, "owner").where(F.col("data_type").like("%LOB%")).select(*TABLE_KEY, "column_name")
    t = tables.select(*TABLE_KEY, "num_rows", "partitioned")
    lb = lobs.select(*TABLE_KEY, "column_name", "segment_name", "partition_name")
    base = c.join(t, on=TABLE_KEY).join(lb, on=TABLE_KEY + ["column_name"])
    s = segments.select("pkey", F.col("owner").alias("s_owner"), F.col("segment_name").alias("s_segment"),
                        F.col("partition_name").alias("s_partition"), F.col("bytes"))
    cond = ((base.pkey == s.pkey) & (base.owner == s.s_owner) & (base.segment_name == s.s_segment)
            & F.when(base.partitioned == "YES", base.partition_name == s.s_partition)
            .otherwise(s.s_partition.isNull()))
    j = base.join(s, on=cond, how="left").drop(s.pkey)
    g = j.groupBy(*TABLE_KEY, "column_name", "num_rows").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("lob_bytes"))
    return g.withColumn("avg_bytes_per_row", F.when(F.col("num_rows") == 0, F.lit(0.0))
                        .otherwise(F.round(F.col("lob_bytes") / F.col("num_rows"), 2)))


def _or_na(df: DataFrame, column: str) -> Column:
    """A catalog column that older database versions lack: 'N/A' there."""
    return F.col(column) if column in df.columns else F.lit("N/A")


def lob_segment_sizing(cols: DataFrame, tables: DataFrame, lobs: DataFrame, table_parts: DataFrame,
                       table_subparts: DataFrame, lob_parts: DataFrame, lob_subparts: DataFrame,
                       segments: DataFrame) -> DataFrame:
    """One row for each segment of a LOB column of a table, partition or sub-partition.

    LOB columns meet their table and LOB (inner), then by left joins the table's partitions
    and sub-partitions, the LOB's own, and the segment.  Which name the segment goes by depends
    on the level the LOB is stored at; that name is a column of the left side before the join
    (null on neither side), so every join is an equi-join that hash or sort-merge plans and
    skew splitting can take, and none is a nested loop.  Averages divide by the rows of the
    respective level, 0 where it has none; a missing segment leaves them null.
    ``segment_created``, ``compression`` and ``deduplication`` may be missing from a frame."""
    db = ["pkey", "con_id"]
    key = [*db, "owner", "table_name"]
    c = exclude_system_schemas(cols, "owner").where(F.col("data_type").like("%LOB%")).select(*key, "column_name", "data_type")
    t = tables.select(*key, F.col("num_rows").alias("table_num_rows"), "partitioned",
                      _or_na(tables, "segment_created").alias("table_seg_created"))
    lb = lobs.select(*key, "column_name", F.col("segment_name").alias("lob_seg_name"),
                     _or_na(lobs, "compression").alias("lob_compression"),
                     _or_na(lobs, "deduplication").alias("lob_deduplication"))
    tp = table_parts.select(*key, F.col("partition_name").alias("table_partition_name"), "subpartition_count",
                            F.col("num_rows").alias("partition_num_rows"),
                            _or_na(table_parts, "segment_created").alias("table_partition_seg_created"))
    ts = table_subparts.select(*key, F.col("partition_name").alias("table_partition_name"),
                               F.col("subpartition_name").alias("table_subpartition_name"),
                               F.col("num_rows").alias("subpartition_num_rows"),
                               _or_na(table_subparts, "segment_created").alias("table_subpartition_created"))
    lp = lob_parts.select(*key, F.col("lob_name").alias("lob_seg_name"),
                          F.col("partition_name").alias("table_partition_name"), "lob_partition_name",
                          _or_na(lob_parts, "segment_created").alias("lob_partition_seg_created"),
                          _or_na(lob_parts, "compression").alias("lob_partition_compression"),
                          _or_na(lob_parts, "deduplication").alias("lob_partition_deduplication"))
    ls = lob_subparts.select(*db, "owner", F.col("lob_name").alias("lob_seg_name"), "lob_partition_name",
                             F.col("subpartition_name").alias("table_subpartition_name"), "lob_subpartition_name",
                             _or_na(lob_subparts, "segment_created").alias("lob_subpartition_seg_created"),
                             _or_na(lob_subparts, "compression").alias("lob_subpartition_compression"),
                             _or_na(lob_subparts, "deduplication").alias("lob_subpartition_deduplication"))
    sg = segments.select(*db, "owner", F.col("segment_name").alias("lob_seg_name"),
                         F.coalesce("partition_name", F.lit("-")).alias("__place"), F.lit(True).alias("__found"),
                         F.col("partition_name").alias("seg_partition_name"), F.col("bytes").alias("seg_bytes"))
    stored_as = F.coalesce("lob_subpartition_name", "lob_partition_name", F.lit("-"))
    rows = (c.join(t, key).join(lb, [*key, "column_name"]).join(tp, key, "left")
            .join(ts, [*key, "table_partition_name"], "left")
            .join(lp, [*key, "lob_seg_name", "table_partition_name"], "left")
            .join(ls, [*db, "owner", "lob_seg_name", "lob_partition_name", "table_subpartition_name"], "left")
            .withColumn("__place", stored_as)
            .join(sg, [*db, "owner", "lob_seg_name", "__place"], "left"))

    def average(n: str) -> Column:
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.round(F.col("seg_bytes") / F.col(n))).otherwise(F.lit(0.0))

    return rows.select(
        *key, "table_num_rows", "table_seg_created", "partitioned", "column_name", "data_type", "table_partition_name",
        "table_partition_seg_created", "partition_num_rows", "lob_partition_name", "lob_partition_seg_created",
        "subpartition_count", "table_subpartition_name", "table_subpartition_created", "subpartition_num_rows",
        "lob_subpartition_name", "lob_subpartition_seg_created", "lob_seg_name",
        F.when(F.col("__found"), F.col("lob_seg_name")).alias("seg_name"), "seg_partition_name", "lob_compression",
        "lob_partition_compression", "lob_subpartition_compression", "lob_deduplication",
        "lob_partition_deduplication", "lob_subpartition_deduplication", "seg_bytes",
        average("table_num_rows").alias("table_avg_lob_bytes"),
        average("partition_num_rows").alias("partition_avg_lob_bytes"),
        average("subpartition_num_rows").alias("subpartition_avg_lob_bytes"))


# D18 ------------------------------------------------------------------------------
def space_by_segment_type(segs: DataFrame) -> DataFrame:
    """Whole GB per owner and segment type, without system owners."""
    return exclude_system_schemas(segs, "owner").groupBy("pkey", "owner", "segment_type").agg(
        F.round(F.sum("bytes") / F.lit(1073741824.0)).alias("gb"))


def system_tablespace_segments(segs: DataFrame) -> DataFrame:
    user = exclude_system_schemas(segs, "owner")
    return (user.where(F.col("tablespace_name").isin("SYSTEM", "SYSAUX"))
            .groupBy("pkey", "owner", "segment_type", "tablespace_name").agg(_count().alias("segment_count")))


# D19 / D20 --------------------------------------------------------------------------
def trigger_counts(trgs: DataFrame, builtin: DataFrame) -> DataFrame:
    """Enabled DATABASE / SCHEMA triggers without the built-in (owner, name) pairs."""
    t = trgs.where(F.trim("base_object_type").isin("DATABASE", "SCHEMA") & (F.col("status") == "ENABLED"))
    t = t.join(builtin, on=["owner", "trigger_name"], how="left_anti")
    return (t.groupBy("pkey", "owner", "trigger_type", "triggering_event", "base_object_type")
            .agg(_count().alias("trigger_count")))


def link_counts(links: DataFrame) -> DataFrame:
    return (links.where(F.col("username").isNotNull()).groupBy("pkey", "owner")
            .agg(_count().alias("link_count")))


def application_counts(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("pkey", "application_name").agg(_count().alias("connection_count"))


def user_counts(users: DataFrame) -> DataFrame:
    return users.groupBy("pkey", "host").agg(_count().alias("user_count"))


# D21 / D22 / D23 -----------------------------------------------------------------------
def source_lines(defs: DataFrame, text_col: str = "definition") -> DataFrame:
    """Whole definitions -> one row per line with its 1-based number (``posexplode``)."""
    return defs.select("pkey", "owner", F.col("object_id").cast("string").alias("name"), "type",
                       F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "text")) \
        .withColumn("line", F.col("pos") + 1).drop("pos")


def source_code_by_object(lines: DataFrame) -> DataFrame:
    """Per object: max(line) and counts of lines matching the probes."""
    lt = F.lower(F.col("text"))
    hit = {k: lt.like(p) for k, p in SOURCE_PROBES.items()}
    return lines.groupBy("pkey", "owner", "name", "type").agg(
        F.max("line").alias("nr_lines"),
        F.count(F.when(hit["utl"], 1)).alias("count_utl"),
        F.count(F.when(hit["dbms"], 1)).alias("count_dbms"),
        F.count(F.when(hit["dbms"] & hit["utl"], 1)).alias("count_dbms_utl"),
        F.count(F.when(hit["exec_im"], 1)).alias("count_exec_im"),
        F.count(F.when(hit["dbms_sql"], 1)).alias("count_dbms_sql"),
        _count().alias("count_total"))


def source_code_metrics(lines: DataFrame) -> DataFrame:
    """Per-object metrics summed by owner and type."""
    o = source_code_by_object(lines)
    return o.groupBy("pkey", "owner", "type").agg(
        F.sum("nr_lines").alias("sum_nr_lines"), _count().alias("qt_objs"),
        F.sum("count_utl").alias("sum_nr_lines_w_utl"), F.sum("count_dbms").alias("sum_nr_lines_w_dbms"),
        F.sum("count_exec_im").alias("count_exec_im"), F.sum("count_dbms_sql").alias("count_dbms_sql"),
        F.sum("count_dbms_utl").alias("sum_nr_lines_w_dbms_utl"), F.sum("count_total").alias("sum_count_total"))


def routine_details(procs: DataFrame, languages: DataFrame, system_schemas=("pg_catalog", "information_schema")) -> DataFrame:
    """Kind label, characters, lines (pg form), security and a system flag."""
    kind = (F.when(F.col("prokind") == "f", "FUNCTION").when(F.col("prokind") == "p", "PROCEDURE")
            .when(F.col("prokind") == "a", "AGGREGATE_FUNCTION").when(F.col("prokind") == "w", "WINDOW_FUNCTION")
            .otherwise("UNCATEGORIZED_PROCEDURE"))
    return (procs.join(languages, on="lang_code", how="left")
            .select("pkey", "owner", "object_id", kind.alias("object_kind"), "language_name",
                    F.length("definition").alias("num_chars"), line_count("definition", "pg").alias("num_lines"),
                    F.when(F.col("security_definer"), "definer").otherwise("invoker").alias("security"),
                    F.when(F.col("owner").isin(*system_schemas), True).otherwise(False).alias("is_system")))


def dialect_dependencies(defs: DataFrame, pattern: str, text_col: str = "definition",
                         keys=("pkey", "owner", "object_kind", "object_id")) -> DataFrame:
    """Definitions matching a case-insensitive regex -> one row per (object, matched text) with
    its count; classes are merged with a distinct union."""
    keys = list(keys)
    rx = "(?i)" + pattern
    m = (defs.where(F.col(text_col).rlike(rx))
         .select(*keys, F.explode(F.regexp_extract_all(F.col(text_col), F.lit(rx), 0)).alias("matched")))
    return m.groupBy(*keys, "matched").agg(_count().alias("match_count"))


# fixed value: names of the Oracle compatibility schema that a schema conversion leaves in definitions
CONVERSION_PATTERN = 'aws_oracle_ext[.][a-z]*[_,a-z,$,"]*'
_CONVERSION_SCHEMAS = ("pg_catalog", "information_schema", "aws_oracle_ext")


def conversion_dependencies(routines: DataFrame, defaults: DataFrame, checks: DataFrame, indexes: DataFrame,
                            views: DataFrame, pattern: str = CONVERSION_PATTERN) -> DataFrame:
    """Names of the compatibility schema in six classes of objects, with their count per object.

    ``defaults``, ``checks``, ``indexes`` and ``views`` hold (pkey, schema_name, object_name,
    definition), ``routines`` also language, prokind and is_trigger.  A text is searched once:
    a routine that is both a procedure and a trigger function gets its two classes after the
    search.  Routines count in SQL and PL/pgSQL only, in lower case, equal texts of overloaded
    names once; the other classes keep the case of the match.  Definitions that are null or
    name nothing give no row."""
    cols = ["pkey", "schema_name", "object_language", "object_name", "classes", "text"]
    kind = F.col("prokind")
    classes = F.filter(F.array(F.when(~kind.isin("a", "w", "f"), F.lit("Procedures")),
                               F.when(~kind.isin("a", "w") & F.col("is_trigger"), F.lit("Triggers"))),
                       lambda c: c.isNotNull())
    found = (routines.where(~F.col("schema_name").isin(*_CONVERSION_SCHEMAS) & F.col("language").isin("sql", "plpgsql"))
             .select("pkey", "schema_name", F.col("language").alias("object_language"), "object_name",
                     classes.alias("classes"), F.lower("definition").alias("text"))
             .where(F.size("classes") > 0).where(F.col("text").rlike("(?i)" + pattern)).distinct())
    for frame, label in ((defaults, "TableDefaultConstraints"), (checks, "TableCheckConstraints"),
                         (indexes, "TableIndexesAsFunctions"),
                         (views.where(F.col("schema_name") != "aws_oracle_ext"), "Views")):
        found = found.unionByName(frame.where(F.col("definition").rlike("(?i)" + pattern)).select(
            "pkey", "schema_name", F.lit("N/A").alias("object_language"), "object_name",
            F.array(F.lit(label)).alias("classes"), F.col("definition").alias("text")).select(*cols))
    matches = F.regexp_extract_all("text", F.lit("(?i)" + pattern), F.lit(0))
    return (found.select("pkey", "schema_name", "object_language", "object_name", "classes",
                         F.explode(matches).alias("aws_extension_dependency"))
            .groupBy("pkey", "schema_name", "object_language", "classes", "object_name", "aws_extension_dependency")
            .agg(_count().alias("sct_function_reference_count"))
            .withColumn("object_type", F.explode("classes"))
            .groupBy("pkey", "schema_name", "object_language", "object_type", "object_name", "aws_extension_dependency")
            .agg(F.sum("sct_function_reference_count").alias("sct_function_reference_count")))


# D24 - D27 ------------------------------------------------------------------------------
def index_details_pg(idx: DataFrame, tabs: DataFrame, access: DataFrame, io: DataFrame, stat: DataFrame) -> DataFrame:
    """Indexes x tables x access methods (inner), io and usage stats (left); at least one
    statistics side must be present."""
    ik = ["pkey", "owner", "index_name"]
    j = (idx.join(tabs.select(*TABLE_KEY, "object_id"), on=TABLE_KEY)
         .join(access, on="index_type")
         .join(io, on=ik, how="left").join(stat, on=ik, how="left"))
    return j.where(F.col("idx_blks_read").isNotNull() | F.col("idx_scan").isNotNull())


def table_list_mssql(tables: DataFrame, partitions: DataFrame) -> DataFrame:
    """Partitions of heap / clustered / columnstore indexes pre-aggregated per table:
    count, rows, compression ('Mixed' when several) and MB = round(pages * 8 / 1024, 2)."""
    p = partitions.where(F.col("index_type_code").isin(0, 1, 5))
    agg = p.groupBy(*TABLE_KEY).agg(
        _count().alias("partition_count"), F.sum("rows").alias("row_count"),
        F.countDistinct("data_compression").alias("__nc"), F.min("data_compression").alias("__c"),
        F.sum("pages").alias("__pages"))
    agg = (agg.withColumn("data_compression", F.when(F.col("__nc") > 1, "Mixed").otherwise(F.col("__c")))
           .withColumn("size_mb", F.round(F.col("__pages") * 8 / F.lit(1024.0), 2)).drop("__nc", "__c", "__pages"))
    return tables.select(*TABLE_KEY).join(agg, on=TABLE_KEY, how="inner")


def index_list_mssql(idx: DataFrame, idx_cols: DataFrame, fulltext: DataFrame) -> DataFrame:
    """Key / partition / included ordinals summed per index, MB, computed-column and view
    flags; full-text indexes added with a distinct union."""
    ik = TABLE_KEY + ["index_name"]
    cols = idx_cols.groupBy(*ik).agg(
        F.sum("key_ordinal").alias("key_ordinal_sum"), F.sum("partition_ordinal").alias("partition_ordinal_sum"),
        F.sum(F.when(F.col("is_included"), 1).otherwise(0)).alias("included_columns"),
        F.max(F.when(F.col("is_computed"), 1).otherwise(0)).alias("has_computed_column"))
    base = (idx.join(cols, on=ik, how="left")
            .select(*ik, "index_type", F.round(F.col("pages") * 8 / F.lit(1024.0), 2).alias("size_mb"),
                    "key_ordinal_sum", "partition_ordinal_sum", "included_columns", "has_computed_column",
                    F.col("is_view")))
    ft = fulltext.select(*ik, F.lit("FULLTEXT").alias("index_type"), F.lit(0.0).alias("size_mb"),
                         F.lit(None).cast("long").alias("key_ordinal_sum"),
                         F.lit(None).cast("long").alias("partition_ordinal_sum"),
                         F.lit(0).cast("long").alias("included_columns"), F.lit(0).alias("has_computed_column"),
                         F.col("is_view"))
    return base.unionByName(ft).distinct()


def object_list_mssql(sources) -> DataFrame:
    """Distinct union of the object sources, then count and lines of code per object name.  A
    definition is shuffled as its digest and line count, not as text."""
    u = union_all([s.select("pkey", "owner", "object_type", "object_name", F.sha2("definition", 256).alias("digest"),
                            line_count("definition", "mssql").alias("lines")) for s in sources], distinct=True)
    return u.groupBy("pkey", "owner", "object_type", "object_name").agg(
        _count().alias("object_count"), F.sum("lines").alias("lines_of_code"))


# D28 / D29 / D30 ---------------------------------------------------------------------------
def database_sizes(files: DataFrame) -> DataFrame:
    return files.groupBy("pkey", "database_name", "file_type", "recovery_model").agg(
        F.round(F.sum(F.col("pages") / F.lit(128.0)), 2).alias("size_mb"))


def volume_usage(volumes: DataFrame) -> DataFrame:
    v = volumes.select("pkey", "volume_mount_point", "total_bytes", "available_bytes").distinct()
    return v.select("pkey", "volume_mount_point",
                    F.round(F.col("total_bytes") / F.lit(1073741824.0), 2).alias("total_gb"),
                    F.round(F.col("available_bytes") / F.lit(1073741824.0), 2).alias("free_gb"),
                    F.round(F.when(F.col("total_bytes") == 0, F.lit(0.0))
                            .otherwise(F.lit(100.0) * F.col("available_bytes") / F.col("total_bytes")), 2)
                    .alias("free_pct"))


def managed_database_size(samples: DataFrame) -> DataFrame:
    """Latest (max) size per database, then summed per collection."""
    per_db = samples.groupBy("pkey", "database_name").agg(F.max("size_mb").alias("size_mb"))
    return per_db.groupBy("pkey").agg(F.round(F.sum("size_mb"), 2).alias("total_size_mb"),
                                      F.count(F.lit(1)).alias("database_count"))


def container_memory(sga: DataFrame, pga: DataFrame, containers: DataFrame) -> DataFrame:
    """SGA and PGA per container and instance, each summed before the two left joins to the
    distinct containers plus the root."""
    k = ["pkey", "instance_number", "con_name"]
    s = sga.groupBy(*k).agg(F.sum("bytes").alias("sga_bytes"))
    p = pga.groupBy(*k).agg(F.sum("bytes").alias("pga_bytes"))
    roots = containers.select("pkey", "instance_number").distinct().withColumn("con_name", F.lit("CDB$ROOT"))
    allc = containers.select(*k).unionByName(roots).distinct()
    return allc.join(s, on=k, how="left").join(p, on=k, how="left")


def database_summary(tables: DataFrame, indexes: DataFrame, columns: DataFrame, cons: DataFrame,
                     settings: DataFrame) -> DataFrame:
    """One row per collection: one aggregate per input, joined on ``pkey``."""
    t = tables.groupBy("pkey").agg(_count().alias("table_count"),
                                   F.round(F.sum("bytes") / F.lit(1073741824.0), 3).alias("table_gb"))
    i = indexes.groupBy("pkey").agg(_count().alias("index_count"),
                                    F.round(F.sum("bytes") / F.lit(1048576.0), 3).alias("index_mb"))
    c = columns.groupBy("pkey").agg(_count().alias("column_count"))
    k = cons.groupBy("pkey").agg(_count().alias("constraint_count"))
    s = settings.groupBy("pkey").agg(F.max(F.when(F.col("setting_name") == "wal_level", F.col("setting_value")))
                                     .alias("wal_level"))
    keys = union_all([d.select("pkey") for d in (t, i, c, k, s)], distinct=True)
    return (keys.join(t, "pkey", "left").join(i, "pkey", "left").join(c, "pkey", "left")
            .join(k, "pkey", "left").join(s, "pkey", "left"))


# D31 - D34 -------------------------------------------------------------------------------
def calculated_metrics_pg(tables: DataFrame, extensions: DataFrame, supported_extensions) -> DataFrame:
    """EAV rows per collection: distinct counts of tables and foreign tables, extensions split
    into supported / unsupported (``stack`` unpivot of one grouped row)."""
    t = tables.groupBy("pkey").agg(
        F.countDistinct(F.when(F.col("relkind").isin("r", "p"), F.concat_ws(".", "owner", "table_name")))
        .alias("TABLE_COUNT"),
        F.countDistinct(F.when(F.col("relkind") == "f", F.concat_ws(".", "owner", "table_name")))
        .alias("FOREIGN_TABLE_COUNT"))
    sup = F.col("extension_name").isin(*supported_extensions)
    e = extensions.groupBy("pkey").agg(
        F.countDistinct(F.when(sup, F.col("extension_name"))).alias("SUPPORTED_EXTENSION_COUNT"),
        F.countDistinct(F.when(~sup, F.col("extension_name"))).alias("UNSUPPORTED_EXTENSION_COUNT"))
    w = t.join(e, on="pkey", how="full")
    names = ["TABLE_COUNT", "FOREIGN_TABLE_COUNT", "SUPPORTED_EXTENSION_COUNT", "UNSUPPORTED_EXTENSION_COUNT"]
    stack = "stack({n}, {args}) as (metric_name, metric_value)".format(
        n=len(names), args=", ".join(f"'{c}', cast(coalesce({c}, 0) as string)" for c in names))
    return w.select("pkey", F.expr(stack))


# fixed values: MySQL plugin probes (metric name, LIKE pattern on the upper-cased plugin name)
MYSQL_PLUGIN_PROBES = [("MYSQLX_PLUGIN", "%MYSQLX%"), ("MEMCACHED_PLUGIN", "%MEMCACHED%"), ("CLONE_PLUGIN", "%CLONE%"),
                       ("KEYRING_PLUGIN", "%KEYRING%"), ("VALIDATE_PASSWORD_PLUGIN", "%VALIDATE_PASSWORD%"),
                       ("THREAD_POOL_PLUGIN", "%THREAD_POOL%"), ("FIREWALL_PLUGIN", "%FIREWALL%")]


def calculated_metrics_mysql(tables: DataFrame, plugins: DataFrame, versions: DataFrame) -> DataFrame:
    """D31 (MySQL): EAV rows per collection - sizes and counts of tables split InnoDB / other,
    tables without a primary key, plugin flags (``sum(like) > 0``), MariaDB flag and the
    version number (``x.y.z`` kept, otherwise the first two parts + ``.0``).  One grouped
    row per input, joined on the collection key, then unpivoted; final ``distinct``."""
    inno = F.upper(F.col("engine")) == "INNODB"
    t = tables.groupBy("pkey").agg(
        F.sum("data_bytes").alias("TABLE_SIZE"),
        F.sum(F.when(inno, F.col("data_bytes")).otherwise(0)).alias("TABLE_INNODB_SIZE"),
        F.sum(F.when(~inno, F.col("data_bytes")).otherwise(0)).alias("TABLE_NO_INNODB_SIZE"),
        F.count(F.lit(1)).alias("TABLE_COUNT"),
        F.sum(F.when(inno, 1).otherwise(0)).alias("TABLE_INNODB_COUNT"),
        F.sum(F.when(~inno, 1).otherwise(0)).alias("TABLE_NO_INNODB_COUNT"),
        F.sum(F.when(F.col("has_primary_key") == "NO", 1).otherwise(0)).alias("TABLE_NO_PK_COUNT"))
    up = F.upper(F.col("plugin_name"))
    p = plugins.groupBy("pkey").agg(*[F.when(F.sum(F.when(up.like(pat), 1).otherwise(0)) > 0, 1).otherwise(0).alias(n)
                                      for n, pat in MYSQL_PLUGIN_PROBES])
    v = versions.groupBy("pkey").agg(F.min("version").alias("__v")).select(
        "pkey", F.when(F.upper("__v").like("%MARIADB%"), 1).otherwise(0).alias("IS_MARIADB"),
        F.when(F.col("__v").rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$"), F.col("__v"))
        .otherwise(F.concat(F.substring_index("__v", ".", 2), F.lit(".0"))).alias("VERSION_NUM"))
    w = t.join(p, "pkey", "full").join(v, "pkey", "full")
    names = (["IS_MARIADB", "TABLE_SIZE", "TABLE_INNODB_SIZE", "TABLE_NO_INNODB_SIZE", "TABLE_COUNT",
              "TABLE_INNODB_COUNT", "TABLE_NO_INNODB_COUNT", "TABLE_NO_PK_COUNT"]
             + [n for n, _ in MYSQL_PLUGIN_PROBES] + ["VERSION_NUM"])
    stack = "stack({n}, {args}) as (variable_name, variable_value)".format(
        n=len(names), args=", ".join(f"'{c}', cast({c} as string)" for c in names))
    return (w.select("pkey", F.lit("CALCULATED_METRIC").alias("variable_category"), F.expr(stack))
            .where(F.col("variable_value").isNotNull()).distinct())


def application_footprint_lines(footprint: DataFrame) -> DataFrame:
    """D32 key-value output form: one ``NAME: value`` line per probe and collection."""
    return footprint.select("pkey", F.concat(F.col("probe_name"), F.lit(": "),
                                             F.coalesce(F.col("signature_owner"), F.lit(""))).alias("line"))


def application_footprint(objects: DataFrame, probes) -> DataFrame:
    """Packaged-application probes ``[(probe_name, signature_table), ...]``: per collection the
    owner of the signature object and 'Y' when it exists, else null; key-value output (one
    row per collection and probe) from one grouped row with a conditional ``max`` per probe."""
    cells = [F.max(F.when(F.col("table_name") == t, F.col("owner"))).alias(f"p{i}") for i, (_, t) in enumerate(probes)]
    g = objects.groupBy("pkey").agg(*cells)
    stack = "stack({n}, {args}) as (probe_name, signature_owner)".format(
        n=len(probes), args=", ".join(f"'{name}', p{i}" for i, (name, _) in enumerate(probes)))
    return (g.select("pkey", F.expr(stack))
            .withColumn("present", F.when(F.col("signature_owner").isNotNull(), F.lit("Y"))))


# fixed values: columns (table, column, type) by which a packaged application is known
APPLICATION_SIGNATURES = {
    "ebs_owner": [("FND_PRODUCT_GROUPS", "RELEASE_NAME", "VARCHAR2")],
    "siebel_owner": [("S_REPOSITORY", "ROW_ID", "VARCHAR2")],
    "psft_owner": [("PSSTATUS", "TOOLSREL", "VARCHAR2")],
    "sap_owner": [("DD02T", "DDLANGUAGE", "VARCHAR2")],
}


def application_schemas(collections: DataFrame, cols: DataFrame, objects: DataFrame, views: DataFrame, users: DataFrame,
                        settings: DataFrame, signatures=None) -> DataFrame:
    """One row per collection: owner of each packaged application and 'Y' for each platform found.

    An application is present where one owner has every column of its signature, so the match is
    a division: the columns an owner has are OR-ed into one bit mask (combined before the
    shuffle) and compared with the signature's mask.  Of several owners the first by name
    counts.  Columns of other tables are left out at the scan.  Platform probes are conditional
    aggregates over objects; two of them also need a setting (the prefix of common users) or
    a user.  Nothing found is null."""
    signatures = APPLICATION_SIGNATURES if signatures is None else signatures
    wanted = sorted({column for members in signatures.values() for column in members})
    bit = {column: i for i, column in enumerate(wanted)}
    if len(wanted) > 63:
        raise ValueError("signatures name more than 63 columns")
    mine = F.lit(0).cast("long")
    for table, column, data_type in wanted:
        mine = F.when((F.col("table_name") == table) & (F.col("column_name") == column) & (F.col("data_type") == data_type),
                      F.lit(1 << bit[table, column, data_type]).cast("long")).otherwise(mine)
    owners = (cols.where(F.col("table_name").isin(sorted({w[0] for w in wanted}))).withColumn("__bits", mine)
              .where(F.col("__bits") != 0).groupBy("pkey", "owner").agg(F.bit_or("__bits").alias("__bits")))
    masks = {name: sum(1 << bit[m] for m in set(members)) for name, members in signatures.items()}
    apps = owners.groupBy("pkey").agg(*[
        F.min(F.when(F.col("__bits").bitwiseAND(F.lit(m).cast("long")) == m, F.col("owner"))).alias(n)
        for n, m in masks.items()])
    prefix = (settings.where(F.col("name") == "common_user_prefix").groupBy("pkey").agg(F.min("value").alias("__prefix")))
    apex_user = (users.where(F.col("username") == "apex_public_user").select("pkey").distinct()
                 .withColumn("__apex", F.lit(True)))
    name, yes = F.col("object_name"), F.lit("Y")
    found = (objects.where(name.isin("RDAADMIN_UTIL", "DBMS_CLOUD", "WWV_FLOW")).join(prefix, "pkey", "left")
             .join(apex_user, "pkey", "left").groupBy("pkey").agg(
                 F.max(F.when((name == "RDAADMIN_UTIL") & (F.col("owner") == "RDSADMIN"), yes)).alias("rds_flag"),
                 F.max(F.when((name == "DBMS_CLOUD") & (F.col("owner") == F.concat("__prefix", F.lit("CLOUD$SERVICE"))),
                              yes)).alias("dbms_cloud_pkg_installed"),
                 F.max(F.when((name == "WWV_FLOW") & (F.col("object_type") == "PACKAGE") & F.col("__apex"), yes))
                 .alias("apex_installed")))
    autonomous = (views.where(F.col("view_name") == "OCI_AUTONOMOUS_DATABASES").select("pkey").distinct()
                  .withColumn("oci_autonomous_flag", yes))
    out = collections.select("pkey").distinct()
    for part in (apps, found, autonomous):
        out = out.join(part, "pkey", "left")
    return out.select("pkey", *signatures, "rds_flag", "oci_autonomous_flag", "dbms_cloud_pkg_installed", "apex_installed")


def feature_usage(objects: DataFrame, features) -> DataFrame:
    """(feature, used 0/1, count) per collection: one grouped row with a conditional count per
    feature, unpivoted, so features without objects still get a 0 row."""
    cells = [F.count(F.when(F.expr(cond), 1)).alias(f"f{i}") for i, (_, cond) in enumerate(features)]
    g = objects.groupBy("pkey").agg(*cells)
    stack = "stack({n}, {args}) as (feature_name, object_count)".format(
        n=len(features), args=", ".join(f"'{name}', f{i}" for i, (name, _) in enumerate(features)))
    return (g.select("pkey", F.expr(stack))
            .withColumn("is_used", F.when(F.col("object_count") > 0, 1).otherwise(0)))


# fixed values: database permissions the managed target does not support
UNSUPPORTED_PERMISSIONS = ["ADMINISTER BULK OPERATIONS", "ALTER ANY CREDENTIAL", "ALTER ANY EVENT NOTIFICATION",
                           "ALTER ANY EVENT SESSION", "ALTER RESOURCES", "ALTER SETTINGS", "AUTHENTICATE SERVER",
                           "CONTROL SERVER", "CREATE DDL EVENT NOTIFICATION", "CREATE ENDPOINT",
                           "CREATE TRACE EVENT NOTIFICATION", "EXTERNAL ACCESS ASSEMBLY", "SHUTDOWN",
                           "EXTERNAL ASSEMBLIES", "CREATE ASSEMBLY"]


def unsupported_permissions(perms: DataFrame) -> DataFrame:
    """D33 (permissions part): unsupported permissions granted to principals other than
    ``NT SERVICE\\`` service accounts, counted by permission name per database as
    (feature, 1, count)."""
    p = perms.where(~F.col("principal_name").startswith("NT SERVICE\\")
                    & F.col("permission_name").isin(*UNSUPPORTED_PERMISSIONS))
    return (p.groupBy("pkey", "database_name", F.col("permission_name").alias("feature_name"))
            .agg(F.count(F.lit(1)).alias("object_count"))
            .withColumn("is_used", F.when(F.col("object_count") > 0, 1).otherwise(0)))


def unsupported_settings(cfg: DataFrame, allow: DataFrame) -> DataFrame:
    """Settings whose lower-cased name is not allowed and whose value is not 0."""
    c = cfg.withColumn("__name", F.lower("setting_name"))
    return (c.join(allow.select(F.lower("setting_name").alias("__name")), on="__name", how="left_anti")
            .where(F.col("setting_value") != "0").drop("__name"))


def database_features(databases: DataFrame, policies: DataFrame, file_tables: DataFrame,
                      permissions: DataFrame) -> DataFrame:
    """D33 of one SQL Server estate: enabled security policies (``SP``) and file tables for every
    database, 0 where it has none or its version knows none, and a row for each unsupported
    permission granted.  Each input is counted per database before the one join."""
    k = ["pkey", "database_name"]
    probes = [("SP", policies), ("IsFileTablesEnabled", file_tables)]
    counted = None
    for name, frame in probes:
        part = frame.where(F.col("is_enabled") == 1).select(*k, F.lit(name).alias("feature_name"))
        counted = part if counted is None else counted.unionByName(part)
    counted = counted.groupBy(*k, "feature_name").agg(_count().alias("__n"))
    wanted = databases.select(*k).distinct().withColumn("feature_name", F.explode(F.array(*[F.lit(n) for n, _ in probes])))
    rows = wanted.join(counted, [*k, "feature_name"], "left").select(
        *k, "feature_name", F.coalesce("__n", F.lit(0)).cast("long").alias("object_count"))
    rows = rows.withColumn("is_used", F.when(F.col("object_count") > 0, 1).otherwise(0))
    return rows.unionByName(unsupported_permissions(permissions))


# fixed values: server configurations that the managed target lets a user set
SUPPORTED_FLAGS = [
    "recovery interval (min)", "locks", "remote access", "default language", "remote login timeout (s)",
    "disallow results from triggers", "ft notify bandwidth (min)", "fill factor (%)", "max server memory (mb)",
    "query wait (s)", "default full-text language", "access check cache quota", "affinity mask",
    "external scripts enabled", "ft crawl bandwidth (min)", "default trace enabled", "access check cache bucket count",
    "two digit year cutoff", "max worker threads", "query governor cost limit", "nested triggers",
    "cross db ownership chaining", "optimize for ad hoc workloads", "automatic soft-numa disabled",
    "transform noise words", "contained database authentication", "ft notify bandwidth (max)",
    "cost threshold for parallelism", "max text repl size (b)", "index create memory (kb)",
    "remote query timeout (s)", "ft crawl bandwidth (max)", "agent xps", "cursor threshold", "user options",
    "user connections", "ph timeout (s)",
]


def unsupported_flags(cfg: DataFrame, supported=SUPPORTED_FLAGS) -> DataFrame:
    """Server configurations in use (``value_in_use`` other than 0) that the target does not
    support, any case of the name; a filter at the scan, no join.  Null names and values
    give no row."""
    return cfg.where(~F.lower("setting_name").isin(*supported) & (F.col("value_in_use") != 0))


# D35 - D39 -------------------------------------------------------------------------------
PATCH_SCHEMA = ("patches struct<patch: array<struct<patchID: string, uniquePatchID: string, patchDescription: string, "
                "patchType: string, appliedDate: string, bugs: struct<bug: array<struct<description: string>>>>>>")


def patch_inventory(xml: DataFrame, xml_col: str = "xml") -> DataFrame:
    """One row per patch of an inventory document, with the description of its first bug.  The
    document is parsed once; a child that a patch lacks is null in that patch's row."""
    parsed = F.from_xml(F.col(xml_col), PATCH_SCHEMA)
    p = xml.select("pkey", F.explode(parsed["patches"]["patch"]).alias("p")).select("pkey", "p.*")
    return p.select("pkey", F.col("patchID").alias("patch_id"), F.col("uniquePatchID").alias("unique_patch_id"),
                    F.col("patchDescription").alias("patch_descr"), F.col("patchType").alias("patch_type"),
                    F.col("appliedDate").alias("applied_date"), F.get(F.col("bugs")["bug"], F.lit(0))["description"].alias("bug_descr"))


def session_connections(sessions: DataFrame, conns: DataFrame, current_session: int) -> DataFrame:
    """Sessions joined to their connections on the session id, excluding the collector's own."""
    return (sessions.where(F.col("session_id") != current_session)
            .join(conns, on=["pkey", "session_id"], how="inner"))


def settings_config(global_vars: DataFrame, session_vars: DataFrame, status: DataFrame) -> DataFrame:
    """Globals and session variables not among the globals (anti-join) as ALL_VARIABLES, and
    status rows; names upper-cased, key material and the full-text syntax dropped, final
    distinct."""
    g = global_vars.select("pkey", F.upper("variable_name").alias("variable_name"), "variable_value") \
        .withColumn("variable_category", F.lit("ALL_VARIABLES"))
    s = (session_vars.select("pkey", F.upper("variable_name").alias("variable_name"), "variable_value")
         .join(g.select("pkey", "variable_name"), on=["pkey", "variable_name"], how="left_anti")
         .withColumn("variable_category", F.lit("ALL_VARIABLES")))
    st = status.select("pkey", F.upper("variable_name").alias("variable_name"), "variable_value") \
        .withColumn("variable_category", F.lit("GLOBAL_STATUS"))
    u = union_all([g, s, st])
    u = u.where((F.col("variable_name") != "FT_BOOLEAN_SYNTAX") & ~F.col("variable_name").like("%PUBLIC_KEY") & ~F.col("variable_name").like("%PRIVATE_KEY"))
    return u.distinct()


def no_primary_key(tables: DataFrame, cons: DataFrame) -> DataFrame:
    """Permanent user tables without a primary-key constraint (anti-join; the constraint side
    has no nulls in its key, so this equals the tuple ``not in``)."""
    t = exclude_system_schemas(tables.where((F.col("temporary") == "N") & F.col("relkind").isin("r", "p")),
                               "owner")
    pks = cons.where(F.col("constraint_type") == "P").select(*TABLE_KEY).where(
        F.col("owner").isNotNull() & F.col("table_name").isNotNull())
    return t.select(*TABLE_KEY).join(pks, on=TABLE_KEY, how="left_anti")


def replica_identity_conflicts(tables: DataFrame, cons: DataFrame) -> DataFrame:
    """Tables that have a primary key and replica identity ``f`` (full) or ``n`` (nothing)."""
    pks = cons.where(F.col("constraint_type") == "P").select(*TABLE_KEY).distinct()
    return (tables.where(F.col("replica_identity").isin("f", "n")).join(pks, on=TABLE_KEY, how="inner")
            .select(*TABLE_KEY, "replica_identity"))


def missing_privileges(objects: DataFrame, grants: DataFrame, kind: str, excluded_schemas) -> DataFrame:
    """Objects of ``kind`` the collecting user holds no privilege on (anti-join); excluded
    schemas differ per kind."""
    o = objects.where(F.col("object_type") == kind).where(~F.col("owner").isin(*excluded_schemas))
    return o.join(grants.select("pkey", "owner", "object_name").distinct(), on=["pkey", "owner", "object_name"],
                  how="left_anti").select("pkey", "owner", "object_name", "object_type")


_NO_USER_SCHEMAS = ("information_schema", "pglogical", "pglogical_origin")
#: Object kind, privilege wanted, schemas left out (besides all named pg_...).
PRIVILEGE_KINDS = [("SCHEMA", "USAGE", (*_NO_USER_SCHEMAS, "cron", "pgbouncer", "google_vacuum_mgmt")),
                   ("TABLE", "SELECT", _NO_USER_SCHEMAS), ("VIEW", "SELECT", _NO_USER_SCHEMAS),
                   ("SEQUENCE", "SELECT", ("pglogical", "pglogical_origin"))]


def missing_privileges_by_kind(objects: DataFrame, grants: DataFrame, kinds=PRIVILEGE_KINDS) -> DataFrame:
    """``missing_privileges`` of all ``kinds`` in one anti-join, for each database; a schema is its
    own owner."""
    key = ["pkey", "database_name", "owner", "object_name", "object_type"]
    checked = F.lit(False)
    for kind, _, excluded in kinds:
        checked = checked | ((F.col("object_type") == kind) & ~F.col("owner").isin(*excluded))
    return (objects.where(checked & ~F.col("owner").startswith("pg_")).select(*key).distinct()
            .join(grants.select(*key).distinct(), on=key, how="left_anti"))


def missing_privilege_messages(missing: DataFrame, kinds=PRIVILEGE_KINDS) -> DataFrame:
    """(pkey, database_name, kind_order, message) of ``missing_privileges_by_kind``, as E14 reads them."""
    order, message = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, (kind, privilege, _) in enumerate(kinds):
        named = F.col("owner") if kind == "SCHEMA" else F.concat("owner", F.lit("."), "object_name")
        own = F.col("object_type") == kind
        order = F.when(own, i + 1).otherwise(order)
        message = F.when(own, F.concat(F.lit(f"user doesn't have {privilege} privilege on {kind.lower()} "), named)).otherwise(message)
    return missing.select("pkey", "database_name", order.alias("kind_order"), message.alias("message"))
