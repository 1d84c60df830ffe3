"""Registered jobs of sections A (sources / sinks) and G (pseudonymisation) with oracles."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from fleetscope.functions.expressions import major_version, normalize_timestamp
from fleetscope.plans.catalog_rules import major_sql
from fleetscope.operators import mask_rules as R
from fleetscope.operators import masking as M
from fleetscope.plans.spec import Spec
from fleetscope.session import checkpoint_path
from fleetscope.sources import extracts as X

SALT = "fleet-salt"
MAJOR_PG = major_sql("version", "9")

TABLES_SCHEMA = StructType([
    StructField("pkey", StringType()), StructField("owner", StringType()), StructField("table_name", StringType()),
    StructField("object_id", LongType()), StructField("num_rows", IntegerType()), StructField("bytes", LongType()),
    StructField("temporary", StringType()), StructField("iot_type", StringType()), StructField("engine", StringType()),
    StructField("relkind", StringType()), StructField("compress_for", StringType()),
])
TABLE_COLS = [f.name for f in TABLES_SCHEMA.fields]
EST_TABLES = "select " + ", ".join(TABLE_COLS) + " from est_tables"


# --- SQL twins of the pseudonym expressions (oracle side) ------------------------------------
def _hex_to_int(hexexpr: str) -> str:
    return f"cast(('0x' || {hexexpr}) as bigint)"


def host_sql(v: str) -> str:
    h = f"md5({v})"
    le = _hex_to_int(f"substr({h}, 7, 2) || substr({h}, 5, 2) || substr({h}, 3, 2) || substr({h}, 1, 2)")
    words = "[" + ", ".join(f"'{w}'" for w in M.default_wordlist()) + "]"
    pre = "[" + ", ".join(f"'{p}'" for p in M.HOST_PREFIXES) + "]"
    dom = "[" + ", ".join(f"'{d}'" for d in M.HOST_DOMAINS) + "]"
    return (f"({pre}[({le} & 7) + 1] || '.' || {words}[(({le} >> 6) & 1023) + 1] || '-' || "
            f"{words}[(({le} >> 16) & 1023) + 1] || '-' || {words}[(({le} >> 26) & 1023) + 1] || '-' || "
            f"{words}[1] || '.' || {dom}[(({le} >> 3) & 7) + 1])")


def keyed_sql(v: str, kind: str, attempt: str = "'0'") -> str:
    prefix, n_letters, n_digits = M.FORMATS[kind]
    h = f"sha256(concat_ws('|', '{SALT}', '{kind}', {v}, {attempt}))"
    out = f"'{prefix}' || upper(translate(substr({h}, 1, {n_letters}), '0123456789abcdef', 'abcdefghijklmnop'))"
    if n_digits:
        out += f" || lpad(cast({_hex_to_int(f'substr({h}, 33, 8)')} % {10 ** n_digits} as varchar), {n_digits}, '0')"
    return f"({out})"


def excluded_sql(v: str, kind: str) -> str:
    if kind == "SCHEMA_NAME":
        lst = ", ".join(f"'{s}'" for s in M.SKIP_SCHEMAS)
        pre = " or ".join(f"starts_with({v}, '{p}')" for p in M.SKIP_SCHEMA_PREFIXES)
        return f"coalesce({v} in ({lst}) or {pre}, false)"
    if kind == "DATABASE_NAME":
        return f"coalesce({v} in ({', '.join(repr(s) for s in M.SYSTEM_DATABASES)}), false)"
    return "false"


def pseudo_sql(v: str, kind: str) -> str:
    return host_sql(v) if kind == "HOST_NAME" else keyed_sql(v, kind)


MAP_SOURCES = [("tables", "owner", "SCHEMA_NAME"), ("tables", "table_name", "OBJECT_NAME"),
               ("cust", "c_name", "HOST_NAME")]
MAP_SQL = "with cand as (" + "\nunion all\n".join(
    f"select distinct {c} as original, '{k}' as kind, {i} as ord from {t} where {c} is not null and not {excluded_sql(c, k)}"
    for i, (t, c, k) in enumerate(MAP_SOURCES)) + """),
firsts as (select original, arg_min(kind, ord) as kind from cand group by original)
select original, kind, case """ + " ".join(
    f"when kind = '{k}' then {pseudo_sql('original', k)}" for _, _, k in MAP_SOURCES) + " end as masked, 0 as attempt from firsts"


def _map(tables, cust):
    return M.identity_map([(tables, "owner", "SCHEMA_NAME"), (tables, "table_name", "OBJECT_NAME"),
                           (cust, "c_name", "HOST_NAME")], SALT)


def _masked_tables(tables, cust):
    m = _map(tables, cust)
    return M.apply_mask(M.apply_mask(tables, m, "owner", "SCHEMA_NAME"), m, "table_name", "OBJECT_NAME")


def _apply_sql(col: str, kind: str, alias: str) -> str:
    return (f"case when t.{col} is null then null when {excluded_sql('t.' + col, 'SCHEMA_NAME')} "
            f"or {excluded_sql('t.' + col, kind)} then t.{col} else "
            f"(case when starts_with(t.{col}, 'BIN$') then 'BIN$' else '' end) || coalesce({alias}.masked, '{M.UNMAPPED}') end")


G_INPUTS = {"tables": EST_TABLES, "cust": "select c_custkey, c_name from customer"}

FILE_NAMES = """select pkey, database_name, concat('opdb__dbobjects__ORA_4.3.', cast(length(database_name) as string), '_host',
  pkey, '_', database_name, '_ORCL', substr(pkey, 3), '_20240101', cast(length(database_name) as string), '.csv') as file_name
from est_databases"""


# lines of three landed files in two script versions, cells joined by the delimiter
RULE_LINES = """select concat('f', cast(object_id % 50 as string)) as file, object_id as line,
  case object_id % 3 when 0 then 'columntypes' when 1 then 'dbsummary' else 'dbparameters' end as table_name,
  case when object_id % 2 = 0 then '4.3.9' else '4.3.20' end as script_version,
  case object_id % 3 when 0 then concat_ws('|', pkey, 'con', owner, table_name, 'NUMBER', 'src1', 'man')
    when 1 then concat_ws('|', pkey, 'con', engine, 'x', owner, compress_for, 'src2', concat('man', pkey))
    else concat_ws('|', pkey, '1', '0', case when object_id % 5 = 0 then 'db_name' else 'cursor_sharing' end, engine, relkind, 'src1', 'man')
  end as text from est_tables"""


def _cells(lines):
    return lines.withColumn("cells", F.split("text", "[|]"))


def _rule_map(lines):
    return R.fleet_map(_cells(lines), R.RULES_ORACLE, SALT)


def _rule_lines(lines):
    df = _cells(lines)
    masked = R.mask_lines(df, R.RULES_ORACLE, _rule_map(lines), ["file", "line"])
    return masked.select("file", "line", "table_name", F.array_join("cells", "|").alias("text"))


# the positions of these files written out: (order, kind, index, row filter, condition)
_RULE_HITS = "\nunion all\n".join(
    f"select file, line, {order} as ord, '{kind}' as kind, {idx} as idx, {plain} as plain, c[{idx} + 1] as v from cut where {condition}"
    for order, (kind, idx, plain, condition) in enumerate([
        ("PKEY", "0", "true", "true"), ("DMA_SOURCE_ID", "(len(c) - 2)", "true", "true"),
        ("SCHEMA_NAME", "2", "true", "table_name = 'columntypes'"), ("OBJECT_NAME", "3", "true", "table_name = 'columntypes'"),
        ("DATABASE_NAME", "2", "true", "table_name = 'dbsummary'"),
        ("DATABASE_NAME", "7", "true", "table_name = 'dbsummary' and script_version = '4.3.9'"),
        ("DATABASE_NAME", "5", "true", "table_name = 'dbsummary' and script_version = '4.3.20'"),
        ("PARAMETER_VALUE", "4", "false", "table_name = 'dbparameters' and c[4] = 'db_name'"),
        ("PARAMETER_VALUE", "5", "false", "table_name = 'dbparameters' and c[4] = 'db_name'")]))
_RULE_CTES = f"""with cut as (select *, string_split(text, '|') as c from lines),
hits as ({_RULE_HITS}),
firsts as (select v as original, arg_min(kind, ord) as kind from hits where not (kind = 'SCHEMA_NAME' and {excluded_sql('v', 'SCHEMA_NAME')}) group by v),
mapped as (select original, kind, case kind """ + " ".join(
    f"when '{k}' then {keyed_sql('original', k)}"
    for k in ("PKEY", "DMA_SOURCE_ID", "SCHEMA_NAME", "OBJECT_NAME", "DATABASE_NAME", "PARAMETER_VALUE")) + """ end as masked, 0 as attempt from firsts)"""


def _scratch(spark, name):
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _a1_files(spark, tables):
    path = _scratch(spark, "extracts")
    X.export_extracts({"opdb__tables__run": tables}, path)
    return X.read_extract(spark, os.path.join(path, "opdb__tables__run"), TABLES_SCHEMA)


def _a5(spark, tables):
    path = _scratch(spark, "canonical")
    for load, rows in [("tables", tables.where(F.col("relkind").isin("r", "p"))),
                       ("others", tables.where(~F.col("relkind").isin("r", "p")).drop("iot_type", "engine")),
                       ("tables", tables.where(F.col("relkind").isin("r", "p")))]:     # a load that is run again
        X.append_canonical(rows, TABLES_SCHEMA, path, load_id=load)
    return spark.read.parquet(path).select(*TABLE_COLS)


def _a6(spark, tables, idx):
    path = _scratch(spark, "export")
    X.export_extracts({"opdb__tables__run": tables, "opdb__indexes__run": idx}, path)
    t = spark.read.options(**X.CSV_OPTIONS).csv(os.path.join(path, "opdb__tables__run"))
    i = spark.read.options(**X.CSV_OPTIONS).csv(os.path.join(path, "opdb__indexes__run"))
    return (t.select(F.lit("tables").alias("table_name")).unionByName(i.select(F.lit("indexes").alias("table_name")))
            .groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count")))


def _a6_content(spark, tables):
    path = _scratch(spark, "export-content")
    X.export_extracts({"opdb__tables__run": tables}, path)
    return spark.read.options(**X.CSV_OPTIONS).schema(tables.schema).csv(os.path.join(path, "opdb__tables__run"))


# one file a collection with its lines in order: the digest follows from the table alone
_LINES = "concat_ws('|', owner, table_name, cast(object_id as string), cast(num_rows as string), relkind)"


def _a7_digests(spark, lines):
    path = _scratch(spark, "manifest-digests")
    (lines.repartition("pkey").sortWithinPartitions("pkey", "line").write.partitionBy("pkey").text(path))
    return X.file_manifest(spark, path, "oracle", pattern="*.txt", block_bytes=1 << 12).select(
        F.regexp_extract("file_name", "pkey=([^/]+)/", 1).alias("pkey"), "db_type", "md5")


def _a7(spark, tables, idx):
    path = _scratch(spark, "manifest")
    X.export_extracts({"opdb__tables__run": tables, "opdb__indexes__run": idx}, path)
    return X.file_manifest(spark, path, "oracle")


EXPECTED = ["pglogical", "pg_cron", "plpgsql", "hstore", "unsupported_ext", "eoj"]
COMPLETENESS_FILES = """select concat(pkey, '_', database_name) as collection_key, extension_name as table_name,
  concat(pkey, '_', database_name, '__', extension_name, case when extension_owner = 'alloydbadmin' then '_2' else '' end,
         '.csv') as file_name,
  case when extension_owner = 'rdsadmin' then 1 else 0 end as error_lines
from est_extensions
union all
select distinct concat(pkey, '_', database_name), 'eoj', concat(pkey, '_', database_name, '__eoj.csv'), 0
from est_extensions where database_name <> 'db3'"""

TS_SQL = """select o_orderkey, case o_orderkey % 5
  when 0 then concat(lpad(cast(extract(day from o_orderdate) as string), 2, '0'), '.',
    lpad(cast(extract(month from o_orderdate) as string), 2, '0'), '.', cast(extract(year from o_orderdate) as string), ' 10:11:12')
  when 1 then concat(lpad(cast(extract(month from o_orderdate) as string), 2, '0'), '-',
    lpad(cast(extract(day from o_orderdate) as string), 2, '0'), '-', cast(extract(year from o_orderdate) as string), ' 10:11:12')
  when 2 then concat(cast(extract(year from o_orderdate) as string), '-', lpad(cast(extract(month from o_orderdate) as string), 2, '0'),
    '-', lpad(cast(extract(day from o_orderdate) as string), 2, '0'), ' 10:11:12')
  when 3 then concat(cast(extract(year from o_orderdate) as string), '-', lpad(cast(extract(month from o_orderdate) as string), 2, '0'),
    '-', lpad(cast(extract(day from o_orderdate) as string), 2, '0'), ' 10:11:12.345')
  else o_orderpriority end as raw_ts
from orders"""


SPECS: dict[str, Spec] = {
    # --- A -------------------------------------------------------------------------------------
    "a1_read_extract": Spec(
        build=lambda lines: X.parse_extract_lines(lines, "line", TABLES_SCHEMA),
        inputs={"lines": "select concat_ws(' | ', pkey, owner, table_name, cast(object_id as string), "
                         "cast(num_rows as string), cast(bytes as string), temporary, coalesce(iot_type, ''), engine, "
                         "relkind, compress_for) as line from est_tables"},
        oracle=EST_TABLES),
    "a1_read_extract_files": Spec(build=_a1_files, inputs={"tables": EST_TABLES}, oracle=EST_TABLES, needs_spark=True),
    "a2_read_key_value": Spec(
        build=lambda lines: X.parse_key_value(lines, "line"),
        inputs={"lines": "select concat(setting_name, ' : ', setting_value, ' :x') as line from est_settings"},
        oracle="select trim(split_part(line, ':', 1)) as key, trim(substr(line, strpos(line, ':') + 1)) as value from lines"),
    "a3_file_metadata": Spec(
        build=lambda files: X.file_metadata(files, "file_name"),
        inputs={"files": "select file_name from (" + FILE_NAMES + ") x"},
        oracle="""with s as (select *, regexp_replace(file_name, '\\.[^.]*$', '') as stem from files),
t as (select *, string_split(substr(substr(stem, strpos(stem, '__') + 2), strpos(substr(stem, strpos(stem, '__') + 2), '__') + 2), '_') as f from s)
select file_name, f[2] as script_version, f[3] as host_name, f[4] as database_name,
  f[5] as instance_name, f[6] as date_time, concat_ws('_', f[3], f[4], f[6]) as pkey,
  concat_ws('_', f[3], f[4], f[5], f[6]) as collection_key, string_split(stem, '_')[2] as database_type from t"""),
    "a4_canonicalize": Spec(
        build=lambda v1, v2: X.canonicalize([v1, v2], TABLES_SCHEMA),
        inputs={"v1": "select * from est_tables where relkind in ('r', 'p')",
                "v2": "select pkey, owner, table_name, object_id, num_rows, bytes, temporary, relkind, compress_for "
                      "from est_tables where relkind not in ('r', 'p')"},
        oracle="""select pkey, owner, table_name, object_id, num_rows, bytes, temporary, iot_type, engine, relkind, compress_for
from v1 union all
select pkey, owner, table_name, object_id, num_rows, bytes, temporary, null, null, relkind, compress_for from v2"""),
    "a4_canonicalize_by_version": Spec(
        build=lambda v12, v13, vbase, versions: X.canonicalize_by_version(
            {"12": v12, "13": v13, "base": vbase}, versions.withColumn("major", major_version("version", "9")),
            TABLES_SCHEMA),
        inputs={"v12": "select pkey, owner, table_name, object_id, num_rows, bytes, temporary, relkind, compress_for "
                       "from est_tables",
                "v13": "select pkey, owner, table_name, object_id, num_rows, bytes, temporary, iot_type, relkind, "
                       "compress_for from est_tables",
                "vbase": "select * from est_tables",
                "versions": "select pkey, min(version) as version from est_databases group by pkey"},
        oracle=f"""with v as (select pkey, {MAJOR_PG} as major from versions),
pick as (select distinct pkey, case when major > 13 then 'base' when major = 13 then '13' else '12' end as variant from v)
select t.pkey, owner, table_name, object_id, num_rows, bytes, temporary, null as iot_type, null as engine, relkind,
  compress_for from v12 t join pick p on t.pkey = p.pkey and p.variant = '12'
union all select t.pkey, owner, table_name, object_id, num_rows, bytes, temporary, iot_type, null, relkind, compress_for
  from v13 t join pick p on t.pkey = p.pkey and p.variant = '13'
union all select t.pkey, owner, table_name, object_id, num_rows, bytes, temporary, iot_type, engine, relkind, compress_for
  from vbase t join pick p on t.pkey = p.pkey and p.variant = 'base'"""),
    "a5_append_canonical": Spec(
        build=_a5, inputs={"tables": EST_TABLES}, needs_spark=True,
        oracle="""select pkey, owner, table_name, object_id, num_rows, bytes, temporary, iot_type, engine, relkind, compress_for
from tables where relkind in ('r', 'p') union all
select pkey, owner, table_name, object_id, num_rows, bytes, temporary, null, null, relkind, compress_for
from tables where relkind not in ('r', 'p')"""),
    "a6_export_extracts": Spec(
        build=_a6, inputs={"tables": EST_TABLES, "idx": "select * from est_indexes"}, needs_spark=True,
        oracle="select 'tables' as table_name, count(*) as row_count from tables union all "
               "select 'indexes', count(*) from idx"),
    "a7_file_manifest": Spec(build=_a7, inputs={"tables": EST_TABLES, "idx": "select * from est_indexes"},
                             needs_spark=True),
    "a6_export_content": Spec(build=_a6_content, inputs={"tables": EST_TABLES}, needs_spark=True,
                              oracle="select * from tables"),
    "a7_manifest_digests": Spec(
        build=_a7_digests, inputs={"lines": f"select pkey, {_LINES} as line from est_tables"}, needs_spark=True,
        oracle="select pkey, 'oracle' as db_type, md5(string_agg(line, chr(10) order by line) || chr(10)) as md5 "
               "from lines group by pkey"),
    "a8_collection_completeness": Spec(
        build=lambda files: X.collection_completeness(files, EXPECTED),
        inputs={"files": COMPLETENESS_FILES},
        oracle=f"""with pt as (select collection_key, table_name, count(distinct file_name) as n_files,
    sum(error_lines) as error_lines from files group by all),
keys as (select distinct collection_key from files),
want as (select collection_key, unnest([{', '.join(repr(t) for t in EXPECTED)}]) as table_name from keys),
miss as (select collection_key, string_agg(table_name, ',' order by table_name) as missing_tables from want w
  where not exists (select 1 from pt where pt.collection_key = w.collection_key and pt.table_name = w.table_name)
  group by collection_key),
g as (select collection_key, coalesce(string_agg(case when n_files > 1 then table_name end, ',' order by table_name), '')
    as duplicate_tables, max(case when table_name = 'eoj' then 1 else 0 end) = 0 as end_marker_missing,
    sum(error_lines) as error_lines from pt group by collection_key)
select g.collection_key, g.duplicate_tables, g.error_lines, coalesce(m.missing_tables, '') as missing_tables,
  g.end_marker_missing, case when coalesce(m.missing_tables, '') <> '' or g.duplicate_tables <> '' or g.end_marker_missing
    or g.error_lines > 0 then 'ERROR' else 'OK' end as status
from g left join miss m on g.collection_key = m.collection_key"""),
    "a9_normalize_timestamp": Spec(
        build=lambda t: t.select("o_orderkey", "raw_ts", normalize_timestamp("raw_ts").alias("normalized_ts")),
        inputs={"t": TS_SQL},
        oracle="""select o_orderkey, raw_ts, case
  when regexp_matches(raw_ts, '^(\\d{2})\\.(\\d{2})\\.(\\d{4})(.*)$') then regexp_replace(raw_ts, '^(\\d{2})\\.(\\d{2})\\.(\\d{4})(.*)$', '\\1/\\2/\\3\\4')
  when regexp_matches(raw_ts, '^(\\d{2})-(\\d{2})-(\\d{4})(.*)$') then regexp_replace(raw_ts, '^(\\d{2})-(\\d{2})-(\\d{4})(.*)$', '\\1/\\2/\\3\\4')
  when regexp_matches(raw_ts, '^(\\d{4})-(\\d{2})-(\\d{2})(.*)$') then
    case when regexp_matches(raw_ts, '\\.\\d+$') then regexp_replace(raw_ts, '^(\\d{4})-(\\d{2})-(\\d{2})(.*)$', '\\2/\\3/\\1\\4')
    else regexp_replace(raw_ts, '^(\\d{4})-(\\d{2})-(\\d{2})(.*)$', '\\2/\\3/\\1\\4') || '.000' end
  else raw_ts end as normalized_ts from t"""),
    # --- G -------------------------------------------------------------------------------------
    "g1_identity_map": Spec(build=_map, inputs=G_INPUTS, oracle=MAP_SQL),
    "g2_apply_mask": Spec(
        build=_masked_tables, inputs=G_INPUTS,
        oracle=f"""with m as ({MAP_SQL})
select t.pkey, {_apply_sql('owner', 'SCHEMA_NAME', 'mo')} as owner, {_apply_sql('table_name', 'OBJECT_NAME', 'mt')} as table_name,
  {', '.join('t.' + c for c in TABLE_COLS if c not in ('pkey', 'owner', 'table_name'))}
from tables t left join m mo on t.owner = mo.original left join m mt on t.table_name = mt.original"""),
    "g1_mask_rules": Spec(build=_rule_map, inputs={"lines": RULE_LINES},
                          oracle=f"{_RULE_CTES} select original, kind, masked, attempt from mapped"),
    "g2_mask_rules": Spec(
        build=_rule_lines, inputs={"lines": RULE_LINES},
        oracle=f"""{_RULE_CTES},
cells as (select file, line, table_name, unnest(range(len(c))) as idx, unnest(c) as cell from cut),
new as (select file, line, idx, arg_min(case when starts_with(v, 'BIN$') and plain then 'BIN$' else '' end || coalesce(masked, '{M.UNMAPPED}'), ord) as text
  from hits left join mapped on v = original where not (plain and {excluded_sql('v', 'SCHEMA_NAME')}) group by file, line, idx)
select file, line, table_name, string_agg(coalesce(new.text, cell), '|' order by idx) as text
from cells left join new using (file, line, idx) group by file, line, table_name"""),
    "g3_host_pseudonym": Spec(
        build=lambda cust: cust.select("c_custkey", "c_name", M.host_pseudonym("c_name").alias("host_name")),
        inputs={"cust": G_INPUTS["cust"]},
        oracle=f"select c_custkey, c_name, {host_sql('c_name')} as host_name from cust"),
    "g4_random_pseudonym": Spec(
        build=lambda t: t.select("object_id", M.keyed_pseudonym("owner", "SCHEMA_NAME", SALT).alias("user_mask"),
                                 M.keyed_pseudonym("table_name", "OBJECT_NAME", SALT).alias("object_mask"),
                                 M.keyed_pseudonym("pkey", "DATABASE_NAME", SALT).alias("db_mask"),
                                 M.keyed_pseudonym("engine", "INSTANCE_NAME", SALT).alias("inst_mask"),
                                 M.keyed_pseudonym("compress_for", "PARAMETER_VALUE", SALT).alias("param_mask")),
        inputs={"t": EST_TABLES},
        oracle=f"""select object_id, {keyed_sql('owner', 'SCHEMA_NAME')} as user_mask, {keyed_sql('table_name', 'OBJECT_NAME')}
  as object_mask, {keyed_sql('pkey', 'DATABASE_NAME')} as db_mask, {keyed_sql('engine', 'INSTANCE_NAME')} as inst_mask,
  {keyed_sql('compress_for', 'PARAMETER_VALUE')} as param_mask from t"""),
    # the keyed pseudonyms of this data never collide, so the repaired map must equal the map
    # (the repair itself is exercised with a tiny pseudonym space in tests/test_masking.py)
    "g5_resolve_collisions": Spec(
        build=lambda tables, cust: M.resolve_collisions(_map(tables, cust), SALT), inputs=G_INPUTS, oracle=MAP_SQL),
    "g6_mask_exclusions": Spec(
        build=lambda t, d: t.select(F.col("owner").alias("name"), M.is_excluded("owner", "SCHEMA_NAME").alias("excluded"))
        .unionByName(d.select(F.col("database_name").alias("name"),
                              M.is_excluded("database_name", "DATABASE_NAME").alias("excluded"))).distinct(),
        inputs={"t": "select owner from est_tables union all select 'APEX_0401' union all select 'OPS$X'",
                "d": "select database_name from est_databases union all select 'tempdb' union all select 'CDB$ROOT'"},
        oracle=f"""select distinct * from (select owner as name, {excluded_sql('owner', 'SCHEMA_NAME')} as excluded from t
union all select database_name, {excluded_sql('database_name', 'DATABASE_NAME')} from d) x"""),
    "g7_row_filter_mask": Spec(
        build=lambda p: M.row_filter_mask(p, M.identity_map([(p, "value", "PARAMETER_VALUE")], SALT), "value",
                                          ["pkey", "name", "value"]),
        inputs={"p": """select pkey, case setting_name when 'wal_level' then 'db_name' when 'max_wal_senders'
  then 'service_names' else setting_name end as name, setting_value as value from est_settings"""},
        oracle=f"""with m as (select distinct value as original, {keyed_sql('value', 'PARAMETER_VALUE')} as masked from p
  where value is not null)
select p.pkey, p.name, case when p.pkey in ({', '.join(repr(n) for n in M.PARAMS_TO_MASK)})
  or p.name in ({', '.join(repr(n) for n in M.PARAMS_TO_MASK)}) or p.value in ({', '.join(repr(n) for n in M.PARAMS_TO_MASK)})
  then coalesce(m.masked, '{M.UNMAPPED}') else p.value end as value
from p left join m on p.value = m.original"""),
    "g8_mask_file_name": Spec(
        build=lambda files: X.file_metadata(files, "file_name").select(
            "file_name", M.mask_file_name("file_name", F.col("collection_key"), F.concat_ws(
                "_", M.host_pseudonym("host_name"), M.keyed_pseudonym("database_name", "DATABASE_NAME", SALT),
                M.keyed_pseudonym("instance_name", "INSTANCE_NAME", SALT), F.col("date_time"))).alias("masked_file_name")),
        inputs={"files": "select file_name from (" + FILE_NAMES + ") x"},
        oracle=f"""with s as (select *, regexp_replace(file_name, '\\.[^.]*$', '') as stem from files),
t as (select *, string_split(substr(substr(stem, strpos(stem, '__') + 2), strpos(substr(stem, strpos(stem, '__') + 2), '__') + 2), '_') as f from s)
select file_name, replace(file_name, concat_ws('_', f[3], f[4], f[5], f[6]),
  concat_ws('_', {host_sql('f[3]')}, {keyed_sql('f[4]', 'DATABASE_NAME')}, {keyed_sql('f[5]', 'INSTANCE_NAME')}, f[6]))
  as masked_file_name from t"""),
    "g9_key_table": Spec(build=lambda tables, cust: M.key_table(_map(tables, cust)), inputs=G_INPUTS,
                         oracle="select original, masked, kind from (" + MAP_SQL + ") x"),
    "g9_unmask_roundtrip": Spec(
        build=lambda tables, cust: M.unmask(M.unmask(_masked_tables(tables, cust), _map(tables, cust), "owner"),
                                            _map(tables, cust), "table_name"),
        inputs=G_INPUTS, oracle=EST_TABLES),
}
