"""Pseudonymisation of landed collections (survey section G).

The reference draws random pseudonyms in one process and keeps a shared
dictionary.  Here every pseudonym is a keyed hash of the original value
(``sha2(salt || kind || value || attempt)``), so all partitions agree on the
same mapping without a shared map; the identity map is still materialised as a
DataFrame (original -> masked) for collision repair, reversal and audit.

* ``identity_map``: distinct values per rule -> pseudonym; the first rule that
  sees a value wins (``min_by`` over the rule order, partial aggregation).
* ``resolve_collisions``: originals that share a pseudonym are numbered within their
  group in one pass; published pseudonyms never change.
* ``apply_mask`` / ``unmask``: equi-joins on the value (AQE picks broadcast when
  the map is small; nothing is hinted because the map grows with the fleet).
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED = "~~UNMAPPED~~"
# fixed values: host name prefixes and domains of the host pseudonym
HOST_PREFIXES = ["db", "db", "srv", "desktop", "laptop", "lt", "email", "web"]
HOST_DOMAINS = ["com", "com", "com", "com", "biz", "info", "net", "org"]
# fixed values: system databases left unmasked
SYSTEM_DATABASES = ["master", "model", "msdb", "tempdb", "PDB$SEED", "CDB$ROOT"]
# fixed values: built-in Oracle schemas left unmasked (plus the prefixes below)
SKIP_SCHEMAS = [
    "ANONYMOUS", "APPQOSSYS", "AUDSYS", "AURORA$JIS$UTILITY$", "AURORA$ORB$UNAUTHENTICATED", "CSMIG", "CTXSYS",
    "DBA_ADM", "DBMS_PRIVILEGE_CAPTURE", "DBSFWUSER", "DBSNMP", "DIP", "DMSYS", "DVF", "DVSYS", "EXFSYS",
    "GSMADMIN_INTERNAL", "GSMCATUSER", "GSMUSER", "LBACSYS", "MDDATA", "MDSYS", "MGDSYS", "MGMT_VIEW", "MTMSYS", "ODM",
    "ODM_MTR", "OJVMSYS", "OLAPSYS", "ORACLE_OCM", "ORDDATA", "ORDPLUGINS", "ORDSYS", "OSE$HTTP$ADMIN", "OUTLN",
    "OWBSYS", "OWBSYS_AUDIT", "PERFSTAT", "SDE", "SI_INFORMTN_SCHEMA", "SPATIAL_CSW_ADMIN_USR",
    "SPATIAL_WFS_ADMIN_USR", "SQLTXADMIN", "SQLTXPLAIN", "STRMADMIN", "SYS", "SYSBACKUP", "SYSDG", "SYSKM", "SYSMAN",
    "SYSTEM", "TRACESRV", "TSMSYS", "WEBSYS", "WKPROXY", "WKSYS", "WK_PROXY", "WK_TEST", "WMSYS", "XDB", "XS$NULL",
]
SKIP_SCHEMA_PREFIXES = ["APEX_", "FLOWS_", "OPS$"]
# fixed values: Oracle parameters whose rows are masked (row filter of the parameter extract)
PARAMS_TO_MASK = [
    "cdb_cluster_name", "dg_broker_config_file1", "dg_broker_config_file2", "diagnostic_dest", "background_dump_dest",
    "user_dump_dest", "core_dump_dest", "audit_file_dest", "db_name", "db_unique_name", "db_domain", "instance_name",
    "dispatchers", "local_listener", "remote_listener", "connection_brokers", "log_archive_config",
    "db_create_file_dest", "db_create_online_log_dest_1", "db_recovery_file_dest", "undo_tablespace",
    "log_archive_dest_3", "log_archive_dest_4", "service_names", "control_files", "log_archive_dest_1", "spfile",
]

# pseudonym layouts: kind -> (prefix, letters, digits)
FORMATS = {
    "DATABASE_NAME": ("DB-", 8, 0),
    "INSTANCE_NAME": ("INST-", 8, 0),
    "SCHEMA_NAME": ("USER_", 6, 3),
    "OBJECT_NAME": ("OBJ_", 12, 3),
    "PARAMETER_VALUE": ("PARAM_", 12, 3),
    "PKEY": ("PKEY_", 12, 3),
    "DMA_SOURCE_ID": ("SRC_", 12, 3),
}


def default_wordlist(size: int = 1024) -> list[str]:
    """Word list of the host pseudonym, built by rule: consonant-vowel syllable pairs in
    lexicographic order.  Pass the reference's published list to ``host_pseudonym`` to
    reproduce its host names exactly."""
    consonants, vowels = "bcdfghjklmnprstv", "aeiou"
    syll = [c + v for c, v in itertools.product(consonants, vowels)]
    words = ["".join(p) for p in itertools.product(syll, syll)]
    return words[:size]


def host_pseudonym(c, words: list[str] | None = None) -> Column:
    """MD5 -> first 4 bytes as a little-endian integer -> 3 bits prefix, 3 bits domain,
    then four 10-bit word picks (only 26 bits remain, so the 4th word is always word 0)."""
    words = words or default_wordlist()
    col = F.col(c) if isinstance(c, str) else c
    h = F.md5(col)
    le = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
    v = F.conv(le, 16, 10).cast("long")
    pre = F.array(*[F.lit(p) for p in HOST_PREFIXES])
    dom = F.array(*[F.lit(d) for d in HOST_DOMAINS])
    wl = F.array(*[F.lit(w) for w in words])

    def pick(arr, shift, mask):
        return F.element_at(arr, (F.shiftrightunsigned(v, shift).bitwiseAND(mask) + 1).cast("int"))

    body = F.concat_ws("-", pick(wl, 6, 1023), pick(wl, 16, 1023), pick(wl, 26, 1023), pick(wl, 36, 1023))
    return F.concat(pick(pre, 0, 7), F.lit("."), body, F.lit("."), pick(dom, 3, 7))


def keyed_pseudonym(c, kind: str, salt: str, attempt=0) -> Column:
    """G4 (re-aimed): ``prefix + letters + digits`` derived from ``sha2(salt|kind|value|attempt)``;
    letters come from the hex digits mapped onto a-p, digits from the next 32 bits."""
    prefix, n_letters, n_digits = FORMATS[kind]
    col = F.col(c) if isinstance(c, str) else c
    att = F.lit(attempt) if not isinstance(attempt, Column) else attempt
    h = F.sha2(F.concat_ws("|", F.lit(salt), F.lit(kind), col, att.cast("string")), 256)
    letters = F.upper(F.translate(F.substring(h, 1, n_letters), "0123456789abcdef", "abcdefghijklmnop"))
    out = F.concat(F.lit(prefix), letters)
    if n_digits:
        num = F.pmod(F.conv(F.substring(h, 33, 8), 16, 10).cast("long"), F.lit(10 ** n_digits))
        out = F.concat(out, F.lpad(num.cast("string"), n_digits, "0"))
    return F.when(col.isNull(), F.lit(None)).otherwise(out)


def is_excluded(c, kind: str) -> Column:
    """Values left as they are (system schemas and prefixes; system databases)."""
    col = F.col(c) if isinstance(c, str) else c
    if kind == "SCHEMA_NAME":
        cond = col.isin(*SKIP_SCHEMAS)
        for p in SKIP_SCHEMA_PREFIXES:
            cond = cond | col.startswith(p)
        return F.coalesce(cond, F.lit(False))
    if kind == "DATABASE_NAME":
        return F.coalesce(col.isin(*SYSTEM_DATABASES), F.lit(False))
    return F.lit(False)


def is_left_alone(c, kind: str) -> Column:
    """Values that masking never replaces: owner-like ones in every kind of column, and system
    databases in columns of databases."""
    return is_excluded(c, "SCHEMA_NAME") | is_excluded(c, kind)


def pseudonym(c, kind: str, salt: str, attempt=0, words=None) -> Column:
    if kind == "HOST_NAME":
        return host_pseudonym(c, words)
    return keyed_pseudonym(c, kind, salt, attempt)


def identity_map(sources, salt: str, existing: DataFrame | None = None) -> DataFrame:
    """G1: ``sources`` = ordered ``[(df, column, kind), ...]``.  Distinct values (excluded
    values dropped) -> masked; the first rule that sees a value wins and values already in
    ``existing`` keep their mapping.  Output: (original, kind, masked, attempt)."""
    parts = []
    for order, (df, col, kind) in enumerate(sources):
        parts.append(df.select(F.col(col).alias("original")).where(F.col("original").isNotNull())
                     .where(~is_excluded("original", kind)).distinct()
                     .withColumn("kind", F.lit(kind)).withColumn("__order", F.lit(order)))
    cand = reduce(DataFrame.unionByName, parts)
    first = cand.groupBy("original").agg(F.min_by("kind", "__order").alias("kind"))
    if existing is not None:
        first = first.join(existing.select("original"), "original", "left_anti")
    kinds = {k for _, _, k in sources}
    masked = None
    for k in kinds:
        e = pseudonym(F.col("original"), k, salt)
        masked = F.when(F.col("kind") == k, e) if masked is None else masked.when(F.col("kind") == k, e)
    out = first.withColumn("masked", masked).withColumn("attempt", F.lit(0))
    if existing is not None:
        out = existing.select("original", "kind", "masked", "attempt").unionByName(out)
    return out


#: The number that tells apart originals with one pseudonym, at the end or before a host's domain.
_NUMBERED = r"-[0-9]+($|\.[a-z]+$)"


def resolve_collisions(mapping: DataFrame, salt: str, existing: DataFrame | None = None, pseudo=None) -> DataFrame:
    """One masked value for each original, in one pass.

    Originals with the same pseudonym form a group (a keyed hash makes groups of a few).  What
    ``existing`` has published stays as it is and comes first; of the others the smallest
    original keeps the bare pseudonym where nobody published it, each further one gets the next
    free number of its group (``OBJ_..-1``; before the domain of a host).  Bare pseudonyms end
    in no ``-number``, so numbered ones meet only within their group: no rounds, no limit, and
    new values never change old ones.  ``attempt`` is the number.  ``pseudo(original, kind)``
    overrides the generator."""
    from pyspark.sql import Window

    old = mapping.select("original").limit(0) if existing is None else existing.select("original").distinct()
    m = mapping.join(old.withColumn("__old", F.lit(True)), "original", "left").withColumn("__old", F.coalesce("__old", F.lit(False)))
    if pseudo is not None:
        m = m.withColumn("masked", F.when(F.col("__old"), F.col("masked")).otherwise(pseudo(F.col("original"), F.col("kind"))))
    m = m.withColumn("__base", F.when(F.col("__old"), F.regexp_replace("masked", _NUMBERED, "$1")).otherwise(F.col("masked")))
    number = F.coalesce(F.regexp_extract("masked", "-([0-9]+)(?:$|[.][a-z]+$)", 1).try_cast("int"), F.lit(0))
    group = Window.partitionBy("__base")
    taken = F.max(F.when(F.col("__old"), number)).over(group)
    place = F.row_number().over(Window.partitionBy("__base", "__old").orderBy("original"))
    m = m.withColumn("__n", F.when(F.col("__old"), number).otherwise(place + F.coalesce(taken, F.lit(-1))))
    host = F.regexp_replace("__base", "([.][a-z]+)$", F.concat(F.lit("-"), F.col("__n").cast("string"), F.lit("$1")))
    renamed = F.when((F.col("kind") == "HOST_NAME") & F.col("__base").rlike("[.][a-z]+$"), host).otherwise(F.concat_ws("-", "__base", "__n"))
    new = ~F.col("__old")
    return m.select("original", "kind", F.when(new & (F.col("__n") > 0), renamed).otherwise(F.col("masked")).alias("masked"),
                    F.when(new, F.col("__n").cast("int")).otherwise(F.col("attempt")).alias("attempt"))


def apply_mask(df: DataFrame, mapping: DataFrame, col: str, kind: str) -> DataFrame:
    """Replace ``col`` through the map; unmapped -> ``~~UNMAPPED~~``; a ``BIN$`` value keeps
    ``BIN$`` in front of its masked value; owner-like values stay as they are whatever the kind,
    system databases in columns of databases."""
    m = mapping.select(F.col("original").alias("__o"), F.col("masked").alias("__m"))
    j = df.join(m, df[col] == m["__o"], "left")
    prefix = F.when(F.col(col).startswith("BIN$"), F.lit("BIN$")).otherwise(F.lit(""))
    new = (F.when(F.col(col).isNull(), F.lit(None))
           .when(is_left_alone(col, kind), F.col(col))
           .otherwise(F.concat(prefix, F.coalesce(F.col("__m"), F.lit(UNMAPPED)))))
    return j.withColumn(col, new).drop("__o", "__m")


def row_filter_mask(df: DataFrame, mapping: DataFrame, col: str, cells, names=PARAMS_TO_MASK) -> DataFrame:
    """Mask ``col`` only on rows where any of ``cells`` equals a listed parameter name."""
    hit = F.arrays_overlap(F.array(*[F.col(c).cast("string") for c in cells]), F.array(*[F.lit(n) for n in names]))
    m = mapping.select(F.col("original").alias("__o"), F.col("masked").alias("__m"))
    j = df.join(m, df[col] == m["__o"], "left")
    return (j.withColumn(col, F.when(F.coalesce(hit, F.lit(False)), F.coalesce(F.col("__m"), F.lit(UNMAPPED)))
                         .otherwise(F.col(col)))
            .drop("__o", "__m"))


def mask_file_name(c, old_key, new_key) -> Column:
    """The collection key inside a file name replaced by its masked key."""
    col = F.col(c) if isinstance(c, str) else c
    return F.replace(col, old_key if isinstance(old_key, Column) else F.lit(old_key),
                     new_key if isinstance(new_key, Column) else F.lit(new_key))


def key_table(mapping: DataFrame) -> DataFrame:
    """The owner's ORIGINAL -> MASKED key table, sorted by the original value."""
    return mapping.select("original", "masked", "kind").orderBy("original")


def unmask(df: DataFrame, mapping: DataFrame, col: str) -> DataFrame:
    """G9 reverse: masked -> original through the key table (``BIN$`` prefix kept)."""
    m = mapping.select(F.col("masked").alias("__m"), F.col("original").alias("__o"))
    stripped = F.when(F.col(col).startswith("BIN$"), F.substring(F.col(col), 5, 1 << 30)).otherwise(F.col(col))
    j = df.withColumn("__k", stripped).join(m, F.col("__k") == F.col("__m"), "left")
    back = F.when(F.col("__o").isNull(), F.col(col)).otherwise(F.col("__o"))
    return j.withColumn(col, back).drop("__k", "__m", "__o")
