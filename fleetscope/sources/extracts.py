"""Sources, sinks and file-level jobs (survey section A).

Extracts are pipe-delimited text with one header line; every reader takes an
explicit schema (no inference).  File listings come from Spark's ``binaryFile``
source; per-file facts (name, digest) are columns of one DataFrame, so a fleet
of collections is checked in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
CSV_OPTIONS = {"sep": "|", "quote": '"', "header": "true", "ignoreLeadingWhiteSpace": "true",
               "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE", "timestampNTZFormat": TS_NTZ_FORMAT}


# A1 ----------------------------------------------------------------------------------
def read_extract(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Pipe-delimited extract with header; whitespace around each ``|`` removed, blank lines
    dropped (the CSV source skips them)."""
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def parse_extract_lines(df: DataFrame, line_col: str, schema: StructType | str) -> DataFrame:
    """The same parsing for extract lines already held in a text column (``from_csv``)."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")
    opts = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    parsed = df.where(F.trim(F.col(line_col)) != "").select(F.from_csv(F.col(line_col), ddl, opts).alias("__r"))
    return parsed.select("__r.*")


# A2 ----------------------------------------------------------------------------------
def parse_key_value(df: DataFrame, line_col: str = "value") -> DataFrame:
    """``KEY: VALUE`` lines: split at the first colon (the rest keeps its colons), both trimmed."""
    parts = F.split(F.col(line_col), ":", 2)
    return (df.where(F.size(parts) >= 2)
            .select(F.trim(parts.getItem(0)).alias("key"), F.trim(parts.getItem(1)).alias("value")))


def read_key_value(spark: SparkSession, path: str) -> DataFrame:
    return parse_key_value(spark.read.text(path))


# A3 / G8 -------------------------------------------------------------------------------
def file_metadata(df: DataFrame, path_col: str = "file_name") -> DataFrame:
    """Stem -> text after the 2nd ``__`` -> ``_`` fields 1..5 = script_version, host, database,
    instance, date_time; pkey = host_database_datetime; collection_key =
    host_database_instance_datetime; database_type = 2nd ``_`` token of the stem.  Too few
    fields raise an error."""
    name = F.element_at(F.split(F.col(path_col), "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    tail = F.element_at(F.split(stem, "__", 3), -1)
    f = F.split(tail, "_")
    ok = F.size(f) >= 6
    fld = [F.when(ok, f.getItem(i)).otherwise(F.raise_error(F.concat(F.lit("Could not determine metadata from file "),
                                                                     F.col(path_col)))) for i in range(1, 6)]
    return df.select(
        "*",
        fld[0].alias("script_version"), fld[1].alias("host_name"), fld[2].alias("database_name"),
        fld[3].alias("instance_name"), fld[4].alias("date_time"),
        F.concat_ws("_", fld[1], fld[2], fld[4]).alias("pkey"),
        F.concat_ws("_", fld[1], fld[2], fld[3], fld[4]).alias("collection_key"),
        F.get(F.split(stem, "_"), 1).alias("database_type"),
    )


# A4 / A5 / A6 ---------------------------------------------------------------------------
def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name (absent ones as typed nulls) and cast."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols)


def canonicalize(frames, schema: StructType) -> DataFrame:
    """A4: version-specific frames -> one canonical frame (``union all`` by name; columns absent
    in older versions are null)."""
    return reduce(DataFrame.unionByName, [conform(f, schema) for f in frames])


def version_variant(major, family: str = "postgres") -> Column:
    """A4 variant choice from the major version: Postgres > 13 -> ``base``, 13 -> ``13``,
    else ``12``; MySQL 5.x -> ``5`` else ``base``; background-writer stats < 17 -> ``lt17``
    else ``ge17``."""
    m = F.col(major) if isinstance(major, str) else major
    if family == "postgres":
        return F.when(m > 13, F.lit("base")).when(m == 13, F.lit("13")).otherwise(F.lit("12"))
    if family == "mysql":
        return F.when(F.floor(m) == 5, F.lit("5")).otherwise(F.lit("base"))
    if family == "bg_writer":
        return F.when(m < 17, F.lit("lt17")).otherwise(F.lit("ge17"))
    raise ValueError(family)


def canonicalize_by_version(variants: dict, versions: DataFrame, schema: StructType, family: str = "postgres",
                            major_col: str = "major") -> DataFrame:
    """A4 with version dispatch: ``variants`` maps a variant label to the rows extracted with
    that variant's query; each collection keeps only the rows of the variant its version
    selects (an equi-join on (pkey, variant), no per-collection driver logic)."""
    tagged = reduce(DataFrame.unionByName,
                    [conform(df, schema).withColumn("__variant", F.lit(label)) for label, df in variants.items()])
    pick = versions.select("pkey", version_variant(major_col, family).alias("__variant")).distinct()
    return tagged.join(pick, ["pkey", "__variant"], "inner").drop("__variant")


def append_canonical(df: DataFrame, schema: StructType, path: str, partition_by=("pkey",),
                     load_id: str | None = None) -> None:
    """A5: insert by column name into the canonical table (unknown columns null); an empty
    input writes nothing.  Partitioned by collection so later jobs prune by ``pkey``.

    Rows are rebalanced by collection first: small collections share a task, a large one is
    split, and no task writes a file into every folder.  With ``load_id`` the rows go to a
    folder of that load in each collection, which a rerun of the load replaces, so a job that
    was stopped half way is run again without doubling rows; without it rows are appended."""
    out = conform(df, schema).hint("rebalance", *[F.col(c) for c in partition_by])
    if load_id is None:
        out.write.mode("append").partitionBy(*partition_by).parquet(path)
        return
    (out.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "load_id").parquet(path))


def export_extracts(tables: dict, path: str, sep: str = "|") -> None:
    """Each table to its own folder of delimited files with a header line."""
    for name, df in tables.items():
        (df.write.mode("overwrite").option("sep", sep).option("header", "true")
         .option("timestampNTZFormat", TS_NTZ_FORMAT).csv(f"{path}/{name}"))


# A7 / A8 ------------------------------------------------------------------------------
def _file_digests(block_bytes: int):
    """Arrow batches of paths -> (path, MD5 of the file), one block of a file in memory at a time."""
    def run(batches):
        import hashlib
        import re
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        def digest(path):
            local = re.match("(?:file:)?/+(?P<path>.*)", path)
            if local:
                files, name = fs.LocalFileSystem(), "/" + local["path"]
            else:
                files, name = fs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", path), safe=":/@=+,~"))
            total = hashlib.md5(usedforsecurity=False)
            try:
                with files.open_input_file(name) as source:
                    while block := source.read(block_bytes):
                        total.update(block)
            except FileNotFoundError:      # gone since it was listed
                return None
            return total.hexdigest()

        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(p) for p in paths], pa.string())],
                                             names=["path", "md5"])
    return run


def file_manifest(spark: SparkSession, path: str, db_type: str, pattern: str = "*.csv",
                  block_bytes: int = 8 << 20) -> DataFrame:
    """One row per file: database type, MD5 of the content, file name; the manifest itself
    and performance-counter logs are skipped.

    Spark lists the files and packs them into tasks by size; the contents never become values
    of a column (which end at 2 GB) but are read block by block, so a task needs the memory
    of one block whatever the size of a file.  A file that has gone has no digest: 'N/A'.  Files
    of no bytes (extracts have a header line) are not part of Spark's listing and get no row."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(path).select("path"))
    name = F.element_at(F.split("path", "/"), -1)
    rel = F.regexp_replace("path", "^.*?/([^/]+/[^/]+)$", "$1")
    listed = files.where(~name.contains("opdb__manifest") & ~name.contains("opdb__perfMonLog_")
                         & ~name.contains("SQLServerDataSet"))
    return (listed.mapInArrow(_file_digests(block_bytes), "path string, md5 string")
            .select(F.lit(db_type).alias("db_type"), F.coalesce("md5", F.lit("N/A")).alias("md5"), rel.alias("file_name")))


def collection_completeness(files: DataFrame, expected, end_marker: str = "eoj") -> DataFrame:
    """Per collection - expected tables without a file, tables with more than one file,
    missing end-of-job marker and error lines; any of them -> status ERROR.  ``files`` has
    (collection_key, table_name, file_name, error_lines); the expected list is a bounded
    literal exploded per collection (no cross join)."""
    per_table = files.groupBy("collection_key", "table_name").agg(
        F.countDistinct("file_name").alias("n_files"), F.sum("error_lines").alias("error_lines"))
    keys = files.select("collection_key").distinct()
    want = keys.select("collection_key", F.explode(F.array(*[F.lit(t) for t in expected])).alias("table_name"))
    missing = (want.join(per_table, ["collection_key", "table_name"], "left_anti")
               .groupBy("collection_key")
               .agg(F.array_sort(F.collect_list("table_name")).alias("missing_tables")))
    g = per_table.groupBy("collection_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("n_files") > 1, F.col("table_name")))).alias("duplicate_tables"),
        F.max(F.when(F.col("table_name") == end_marker, 1).otherwise(0)).alias("__eoj"),
        F.sum("error_lines").alias("error_lines"))
    out = g.join(missing, "collection_key", "left").withColumn(
        "missing_tables", F.coalesce(F.col("missing_tables"), F.array().cast("array<string>")))
    out = out.withColumn("end_marker_missing", F.col("__eoj") == 0).drop("__eoj")
    bad = ((F.size("missing_tables") > 0) | (F.size("duplicate_tables") > 0) | F.col("end_marker_missing")
           | (F.col("error_lines") > 0))
    return out.withColumn("status", F.when(bad, F.lit("ERROR")).otherwise(F.lit("OK"))) \
        .withColumn("missing_tables", F.array_join("missing_tables", ",")) \
        .withColumn("duplicate_tables", F.array_join("duplicate_tables", ","))


def error_line_count(lines: DataFrame, col: str = "value", pattern: str = "(ORA-[0-9]+|SP2-[0-9]+|ERROR)") -> Column:
    """Error lines in a landed text file (a column expression over its lines)."""
    return F.sum(F.when(F.col(col).rlike(pattern), 1).otherwise(0))
