"""Rule-driven masking of landed files (survey G1/G2): which cells of which file are masked.

A rule names a file's table (``*``: every file), a column position (negative: from the end), the
kind of pseudonym, whether the column may be missing, and optionally texts of which the row must
hold one.  Positions are resolved for each row from its length and its script version: files
written before 4.3.15 lack two trailing columns, so positions before the last two move by two.
Rules are looked up by table from one literal, all files of a fleet and of all versions go
through one projection, and the first rule that meets a value decides its kind in the one map of
the fleet.  A required column that a row lacks is an error, as is a rule set's own rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.operators import masking as M


@dataclass(frozen=True)
class MaskRule:
    kind: str
    table: str
    position: int
    missing_ok: bool = True
    only: tuple[str, ...] = ()


def _rules(kind: str, missing_ok: bool, **positions) -> list[MaskRule]:
    return [MaskRule(kind, table, p, missing_ok) for table, at in positions.items() for p in at]


def _required(kind: str, **positions) -> list[MaskRule]:
    return _rules(kind, False, **positions)


def _optional(kind: str, **positions) -> list[MaskRule]:
    return _rules(kind, True, **positions)


# fixed values: columns masked in collections of each source, in the order in which they apply
RULES_MSSQL = [
    MaskRule("PKEY", "*", 0, False),
    *_required("DMA_SOURCE_ID", BlockFeatures=[-2], ColumnDatatypes=[-2], CompInstalled=[-2],
               DatabaseLevelBlockFeatures=[-2], DbClusterNodes=[-2]),
    *_optional("DMA_SOURCE_ID", DbMachineSpecs=[1]),
    *_required("DMA_SOURCE_ID", DbServerConfig=[-2], DbServerFlags=[-2], DbSizes=[4], DbccTrace=[-2],
               DiskVolInfo=[-2], DmvPerfmon=[-2]),
    *_optional("DMA_SOURCE_ID", IndexList=[18]),
    *_required("DMA_SOURCE_ID", LinkedSrvrs=[-2], ObjectList=[-2]),
    *_optional("DMA_SOURCE_ID", PerfCounter=[25]),
    *_required("DMA_SOURCE_ID", PerfMonData=[25], ServerProps=[-2], TableList=[17], TranLogBkupCountByHourByDay=[-2],
               TranLogBkupSizeByHourByDay=[-2], UserConnections=[18]),
    *_optional("DATABASE_NAME", ColumnDatatypes=[1]), *_optional("SCHEMA_NAME", ColumnDatatypes=[2]),
    *_optional("OBJECT_NAME", ColumnDatatypes=[3]), *_optional("HOST_NAME", CompInstalled=[1]),
    *_optional("INSTANCE_NAME", CompInstalled=[2]), *_optional("DATABASE_NAME", DatabaseLevelBlockFeatures=[1]),
    *_optional("HOST_NAME", DbClusterNodes=[1], DbMachineSpecs=[3]), *_optional("DATABASE_NAME", DbSizes=[1], IndexList=[1]),
    *_optional("SCHEMA_NAME", IndexList=[2]), *_optional("OBJECT_NAME", IndexList=[3, 4]),
    *_required("DATABASE_NAME", LinkedSrvrs=[1, 4]), *_optional("DATABASE_NAME", ObjectList=[1]),
    *_optional("SCHEMA_NAME", ObjectList=[2]), *_optional("OBJECT_NAME", ObjectList=[3, 8]),
    *_optional("SCHEMA_NAME", PerfCounter=[1]), *_optional("DATABASE_NAME", TableList=[1]),
    *_optional("SCHEMA_NAME", TableList=[2]), *_optional("OBJECT_NAME", TableList=[3]),
    *_optional("DATABASE_NAME", UserConnections=[1]), *_optional("HOST_NAME", UserConnections=[3]),
    *_optional("SCHEMA_NAME", UserConnections=[4, 5]), *_required("HOST_NAME", UserConnections=[14]),
    *_required("SCHEMA_NAME", UserConnections=[15]),
    MaskRule("HOST_NAME", "ServerProps", 2, False, ("ServerName",)), MaskRule("HOST_NAME", "ServerProps", 2, False, ("MachineName",)),
]
RULES_ORACLE = [
    MaskRule("PKEY", "*", 0, False), MaskRule("DMA_SOURCE_ID", "*", -2, False),
    *_optional("SCHEMA_NAME", columntypes=[2], compressbytype=[2], datatypes=[2], dbobjectnames=[2], dbobjects=[2], dblinks=[2],
               dtlsourcecode=[2], exttab=[2], indextypedtl=[2], indextypes=[2], lobsizing=[2], mviewtypes=[2], sourcecode=[2],
               tableconstraints=[2], tablesnopk=[2], tabletypedtl=[2], tabletypes=[2], triggers=[2], usedspacedetails=[2],
               usrsegatt=[2], app_cloud=[1], app_cloud_pdb=[1]),
    *_optional("OBJECT_NAME", columntypes=[3], dbobjectnames=[3], dtlsourcecode=[3], indextypedtl=[12, 13],
               lobsizing=[3, 7, 9, 12, 15, 18, 20, 21, 22]),
    *_optional("HOST_NAME", opkeylog=[3]), *_optional("DATABASE_NAME", opkeylog=[4, 5]), *_optional("SCHEMA_NAME", users=[2]),
    *_optional("INSTANCE_NAME", dbinstances=[2]), *_optional("HOST_NAME", dbinstances=[3]),
    *_optional("DATABASE_NAME", dbsummary=[2, -3]), MaskRule("DATABASE_NAME", "pdbsinfo", 3, True, ("CDB$ROOT",)),
    *_optional("DATABASE_NAME", pdbsopenmode=[2]), *_optional("HOST_NAME", sourceconn=[4, 5, 6]),
    *_optional("OBJECT_NAME", tableconstraints=[3], tabletypedtl=[3]), *_optional("HOST_NAME", DbMachineSpecs=[3]),
    MaskRule("PARAMETER_VALUE", "dbparameters", 4, True, tuple(M.PARAMS_TO_MASK)),
    MaskRule("PARAMETER_VALUE", "dbparameters", 5, True, tuple(M.PARAMS_TO_MASK)),
]
# fixed value: the first script version whose files end in the two source columns
SHIFTED_BEFORE = (4, 3, 15)


def _literal(rules: list[MaskRule], old: bool) -> Column:
    """The rules of the row's ``table_name``, with their places in new or ``old`` files; those of
    every file where a table has no own."""
    def one(order, r):
        only = F.array(*[F.lit(v) for v in r.only]).cast("array<string>") if r.only else F.lit(None).cast("array<string>")
        at = r.position + (2 if old and r.position < -2 else 0)
        return F.struct(F.lit(order).alias("ord"), F.lit(r.kind).alias("kind"), F.lit(at).alias("pos"),
                        F.lit(r.missing_ok).alias("ok"), only.alias("only"))

    def of(table):
        return F.array(*[one(i, r) for i, r in enumerate(rules) if r.table in ("*", table)])
    tables = sorted({r.table for r in rules} - {"*"})
    known = F.create_map(*[x for t in tables for x in (F.lit(t), of(t))])
    return F.coalesce(F.try_element_at(known, F.col("table_name")), of("*"))


def resolve(lines: DataFrame, rules: list[MaskRule]) -> DataFrame:
    """``lines`` (table_name, script_version, cells, ...) with ``_hits``: for each rule that meets
    the row a struct (ord, kind, idx, plain, value); plain rules have no row filter.

    Version and table choose one constant list of rules a row; each rule is placed once, in one
    pass over that list, and nothing of the row is worked out again for each rule."""
    version = F.transform(F.regexp_extract_all("script_version", F.lit("[0-9]+"), F.lit(0)), lambda x: x.cast("int"))
    is_old = F.coalesce(version < F.array(*[F.lit(v) for v in SHIFTED_BEFORE]), F.lit(False))
    size = F.size("cells")
    message = F.concat(F.lit("a column to mask is missing in "), F.coalesce("table_name", F.lit("?")), F.lit(", cells: "), size.cast("string"))

    def place(r):
        idx = F.when(r["pos"] < 0, r["pos"] + size).otherwise(r["pos"])
        checked = F.when((idx >= 0) & (idx < size), idx).when(~r["ok"], F.raise_error(message).cast("int"))
        return F.struct(r["ord"].alias("ord"), r["kind"].alias("kind"), checked.alias("idx"), r["only"].alias("only"))

    def met(x):
        return x["idx"].isNotNull() & (x["only"].isNull() | F.coalesce(F.arrays_overlap(x["only"], F.col("cells")), F.lit(False)))

    def hit(x):
        return F.struct(x["ord"].alias("ord"), x["kind"].alias("kind"), x["idx"].alias("idx"), x["only"].isNull().alias("plain"),
                        F.get(F.col("cells"), x["idx"]).alias("value"))
    chosen = F.when(is_old, _literal(rules, True)).otherwise(_literal(rules, False))
    return lines.withColumn("_hits", F.transform(F.filter(F.transform(chosen, place), met), hit))


def _hits(lines: DataFrame, rules: list[MaskRule], keys: list[str]) -> DataFrame:
    """A row for each cell to mask that has a value.  The outer form: for the inner one Spark adds a
    filter on the array's size, which places all rules of the row a second time."""
    hits = resolve(lines, rules).select(*keys, F.explode_outer("_hits").alias("h"))
    return hits.select(*keys, "h.*").where("value is not null")


def fleet_map(lines: DataFrame, rules: list[MaskRule], salt: str, existing: DataFrame | None = None) -> DataFrame:
    """G1: (original, kind, masked, attempt) over all files; one masked value for each original."""
    hit = _hits(lines, rules, [])
    system = (F.col("kind") == "DATABASE_NAME") & M.is_excluded("value", "DATABASE_NAME")
    owner = (F.col("kind") == "SCHEMA_NAME") & M.is_excluded("value", "SCHEMA_NAME")
    first = hit.where(~system & ~owner).groupBy(F.col("value").alias("original")).agg(F.min_by("kind", "ord").alias("kind"))
    if existing is not None:
        first = first.join(existing.select("original"), "original", "left_anti")
    masked = F.when(F.col("kind") == "HOST_NAME", M.host_pseudonym("original"))
    for kind in M.FORMATS:
        masked = masked.when(F.col("kind") == kind, M.keyed_pseudonym("original", kind, salt))
    out = first.withColumn("masked", masked).withColumn("attempt", F.lit(0))
    if existing is not None:
        out = existing.select("original", "kind", "masked", "attempt").unionByName(out)
    return M.resolve_collisions(out, salt, existing)


def mask_lines(lines: DataFrame, rules: list[MaskRule], mapping: DataFrame, keys: list[str]) -> DataFrame:
    """``lines`` with masked ``cells``.  ``keys`` tell rows apart.  Cells to mask meet the map
    by value (one row an original; hot values are split by adaptive execution), then come
    back to their row, at most one entry a rule.  System databases, and owner-like values under
    rules without a row filter, stay; ``BIN$`` stays in front."""
    hit = _hits(lines, rules, keys)
    stays = ((F.col("kind") == "DATABASE_NAME") & M.is_excluded("value", "DATABASE_NAME")) | (F.col("plain") & M.is_excluded("value", "SCHEMA_NAME"))
    m = mapping.select(F.col("original").alias("_o"), F.col("masked").alias("_m"))
    prefix = F.when(F.col("plain") & F.col("value").startswith("BIN$"), "BIN$").otherwise("")
    new = hit.where(~stays).join(m, F.col("value") == F.col("_o"), "left").select(
        *keys, F.struct("ord", "idx", F.concat(prefix, F.coalesce("_m", F.lit(M.UNMAPPED))).alias("text")).alias("_new"))
    new = new.groupBy(*keys).agg(F.array_sort(F.collect_list("_new")).alias("_new"))
    cells = F.transform("cells", lambda c, i: F.coalesce(F.get(F.filter(F.col("_new"), lambda x: x["idx"] == i), F.lit(0))["text"], c))
    joined = lines.join(new, keys, "left")
    return joined.withColumn("cells", F.when(F.col("_new").isNull(), F.col("cells")).otherwise(cells)).drop("_new")
