"""Operator 12 - Merkle manifest of a dataset, climbed by a recursive query.

Every row is a leaf: the SHA-256 of its fields, each as ``-`` (null) or ``<UTF-8 bytes>:<value>``.
Within a group (``source``) leaves ascend by id; runs of ``FAN`` consecutive nodes are hashed
(as hex text) to their parent until one node is left, the group's subroot; the subroots, ordered
by group (null first), likewise give the root.

Levels are built bottom up, one aggregation a level with at most ``FAN`` rows a parent, and
stored as parent-linked node rows (tree, level, idx, hash, children, link to the parent, place in
its run).  A recursive common table expression then ascends from the leaves: a step joins the
climbing rows with the node above them, folds the received hashes into it and appends the
siblings.  From the second level on the leaves of one run share all siblings, so a climbing row
stands for a run of up to ``FAN`` leaves, with one proof for all of them and one folded hash for
all that fold alike so far (leaves received as built); ids stay behind and are joined again at
the top.  Digests are binary until the end.  A tree of n leaves takes log16(n) steps, and hot groups are
spread like others: places come from a range partitioning, parents from (tree, idx), and a node
near the root, which all rows pass, is stored once for every ``SHARE`` runs below it.

Cases: null ids come first; equal ids of a group are ordered by leaf hash, so repeated rows are
leaves each; a null or empty field and a very long text are hashed like any other; a lone leaf is
its group's subroot and a lone subroot the root; without siblings the proof is the hash of the
empty text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import numbered, stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Tree number of the tree over the groups' subroots.
TOP = -1
#: A node that more than so many runs pass is stored several times and met by hash.
SHARE = FAN ** 3
_LINK = ("up_tree", "up_level", "up_idx", "up_pos")
_NODE = ("tree long, level int, idx long, n long, children binary, hash binary, "
         "up_tree long, up_level int, up_idx long, up_pos int, up_shares long, shares long")


def leaf_hash(fields: list[Column]) -> Column:
    """Binary SHA-256 of the fields."""
    def one(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(one, fields)), 256))


def _digest(content: str) -> str:
    """SQL: binary SHA-256 of binary digests written as hex text one after another."""
    return f"unhex(sha2(lower(hex({content})), 256))"


#: SQL: the digests in c before and after the p-th, and f in its place.
_AROUND = "substr({c}, 1, 32 * {p}), {f} substr({c}, 32 * {p} + 33)"


def _joined(array: str, item: str = "x") -> str:
    """SQL: the binary items of an array one after another."""
    return f"aggregate({array}, cast('' as binary), (a, x) -> concat(a, {item}))"


#: In a group's tree a node of level k has at most FAN ** (k - 1) runs: up to this level one copy does.
_SINGLE = 4


def _linked(nodes: DataFrame, trees: int) -> DataFrame:
    """The link to the parent: within the tree, from a subroot into the tree over the subroots,
    none at the root.  ``n`` is the number of nodes on the node's level of its tree; ``above`` the
    runs below the parent of the tree's subroot, or in the tree over subroots of the node."""
    inside, above = "n > 1", f"tree >= 0 and {trees} > 1"
    shares = f"cast(pow({FAN}, greatest(level + 1 - {_SINGLE}, 0)) as bigint)"
    return nodes.selectExpr(
        "*", f"case when {inside} then tree when {above} then {TOP} end as up_tree",
        f"case when {inside} then level + 1 when {above} then 1 end as up_level",
        f"case when {inside} then idx div {FAN} when {above} then tree div {FAN} end as up_idx",
        f"cast(case when {inside} then idx % {FAN} when {above} then tree % {FAN} end as int) as up_pos",
        f"case when {inside} and tree >= 0 then {shares} when {inside} or {above} then (above + {SHARE - 1}) div {SHARE} end as up_shares")


def _parents(nodes: DataFrame) -> DataFrame:
    """One level up: (tree, level, idx, n, children, hash) of every run of ``nodes``."""
    runs = nodes.where("n > 1").groupBy("tree", "level", F.expr(f"idx div {FAN}").alias("run")).agg(
        F.expr("array_sort(collect_list(struct(idx, hash)))").alias("items"), F.max("n").alias("n"), F.max("above").alias("above"))
    return runs.selectExpr("tree", "level + 1 as level", "run as idx", f"(n + {FAN - 1}) div {FAN} as n", "above",
                           f"{_joined('items', 'x.hash')} as children").selectExpr("*", f"{_digest('children')} as hash")


def _levels(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """All levels above ``nodes``, whose largest tree has ``most`` of them, each stored."""
    out = []
    while most > 1:
        nodes = stored(_parents(nodes), name)
        out.append(nodes)
        most = -(-most // FAN)
    return out


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          received: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(runs, nodes, steps): the leaves in runs of up to ``FAN``, the stored node rows above the
    runs, and the longest way from a run to the root.

    ``received`` names fields that have other values in the copy under test; a leaf then also
    carries the hash of the row as received."""
    spark = docs.sparkSession
    columns = {f: F.col(f"`{f}`") for f in fields}
    got = leaf_hash([(received or {}).get(f, c) for f, c in columns.items()])
    leaves = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("grp"),
                         leaf_hash(list(columns.values())).alias("leaf"), (got if received else F.lit(None).cast("binary")).alias("got"))
    leaves = stored(leaves.withColumn("got", F.coalesce("got", "leaf")), "merkle-leaves")
    placed = numbered(leaves, [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("got")], "place")
    placed = stored(placed, "merkle-places")
    groups = placed.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stored(numbered(groups, [F.col("grp").asc_nulls_first()], "tree"), "merkle-groups")
    trees, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()

    beside = Window.partitionBy(F.floor(F.col("tree") / FAN))
    g = groups.select(F.col("grp").alias("g"), "first", "n", "tree", F.sum(F.expr(f"(n + {FAN - 1}) div {FAN}")).over(beside).alias("above"))
    idx = F.col("place") - F.col("first")
    runs = placed.join(g, F.col("grp").eqNullSafe(F.col("g"))).groupBy("tree", F.floor(idx / FAN).alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "leaf", "got"))).alias("docs"), F.max("n").alias("leaves"), F.max("above").alias("above"))
    lone = "leaves = 1"
    first = _digest("concat(" + _AROUND.format(c="children", p="i", f="d.got,") + ")")
    runs = runs.selectExpr("tree", "idx", "leaves", "above", "docs", f"{_joined('docs', 'x.leaf')} as children")
    runs = runs.selectExpr("tree", f"case when {lone} then 0 else 1 end as level", "idx", f"(leaves + {FAN - 1}) div {FAN} as n", "above",
                           "transform(docs, d -> d.id) as ids", "children",
                           f"case when {lone} then children else {_digest('children')} end as hash",
                           f"case when {lone} then transform(docs, d -> d.got) else transform(docs, (d, i) -> {first}) end as folds")
    runs = runs.withColumn("values", F.array_distinct("folds")).selectExpr(
        "tree", "level", "idx", "n", "above", "ids", "children", "hash", "values",
        "transform(folds, f -> cast(array_position(values, f) as int)) as which")
    runs = stored(_linked(runs, trees), "merkle-runs")

    own = ["tree", "level", "idx", "n", "above", "hash"]
    bottom = runs.select(*own)
    inner = _levels(bottom, -(-(most or 0) // FAN), "merkle-level")
    subroots = bottom.where("n = 1")
    for level in inner:
        subroots = subroots.unionByName(level.where("n = 1").select(*own))
    # over the subroots ``above`` is summed exactly: each node's siblings share their parent's sum
    upper, level, left = [], subroots.selectExpr(f"cast({TOP} as bigint) as tree", "0 as level", "tree as idx", f"{trees}L as n", "above", "hash"), trees
    while left > 1:
        level = _parents(level)
        beside = Window.partitionBy("level", F.floor(F.col("idx") / FAN))
        level = stored(level.withColumn("shares", F.expr(f"(above + {SHARE - 1}) div {SHARE}")).withColumn("above", F.sum("above").over(beside)), "merkle-top")
        upper.append(level)
        left = -(-left // FAN)
    nodes = spark.createDataFrame([], _NODE)
    for level in inner:
        single = F.expr(f"cast(pow({FAN}, greatest(level - {_SINGLE}, 0)) as bigint)")
        nodes = nodes.unionByName(_linked(level, trees).withColumn("shares", single).drop("above"))
    for level in upper:
        nodes = nodes.unionByName(_linked(level, trees).drop("above"))
    nodes = nodes.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).drop("shares")
    return runs, stored(nodes, "merkle-nodes"), len(inner) + len(upper)


def climb(runs: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """Every run (tree, idx) at the root: subroot, root, proof above the run, its folded hashes.

    The recursion's own bound on rows is lifted while it runs: its result has runs x steps rows."""
    spark = runs.sparkSession
    bound = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(bound)
    step = _digest("concat(" + _AROUND.format(c="n.children", p="c.up_pos", f="v,") + ")")
    siblings = _AROUND.format(c="n.children", p="c.up_pos", f="")
    query = f"""
      with recursive climb(tree, idx, subroot, root, proof, values, up_tree, up_level, up_idx, up_pos, up_shares)
      max recursion level {steps + 2} as (
        select tree, idx, case when n = 1 then hash end, hash, cast('' as binary), values,
          up_tree, up_level, up_idx, up_pos, up_shares
        from {{runs}}
        union all
        select c.tree, c.idx, case when n.tree >= 0 and n.n = 1 then n.hash else c.subroot end, n.hash,
          concat(c.proof, {siblings}), transform(c.values, v -> {step}),
          n.up_tree, n.up_level, n.up_idx, n.up_pos, n.up_shares
        from climb c join {{nodes}} n on c.up_tree = n.tree and c.up_level = n.level and c.up_idx = n.idx
          and pmod(xxhash64(c.tree, c.idx), c.up_shares) = n.share)
      select tree, idx, subroot, root, proof, values from climb where up_tree is null"""
    spark.conf.set(bound, "-1")
    try:
        return stored(spark.sql(query, runs=runs, nodes=nodes), "merkle-climb")
    finally:
        spark.conf.set(bound, before)


def audit(docs: DataFrame, received: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS,
          id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """One row a leaf: id, leaf, subroot, root, proof_sha256 of the data as built (hex text),
    folded_root from the row as received and the original siblings, verified."""
    runs, nodes, steps = build(docs, fields, id_col, group_col, received)
    tops = climb(runs, nodes, steps).withColumnRenamed("values", "folded")
    rows = runs.select("tree", "idx", "ids", "children", "which").join(tops, ["tree", "idx"]).select(
        "children", "subroot", "root", "proof", "folded", F.posexplode(F.arrays_zip("ids", "which")).alias("i", "row"))
    rows = rows.selectExpr("row.ids as id", "substr(children, 32 * i + 1, 32) as leaf", "subroot", "root", "folded[row.which - 1] as folded",
                           "concat(" + _AROUND.format(c="children", p="i", f="") + ", proof) as proof")
    def text(c):
        return F.lower(F.hex(c))
    return rows.select(F.col("id").alias(id_col), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                       F.sha2(text("proof"), 256).alias("proof_sha256"), text("folded").alias("folded_root"),
                       (F.col("folded") == F.col("root")).alias("verified"))
