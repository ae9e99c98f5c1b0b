"""Merkle manifest of a table: a tree of digests per group, one tree over the groups, and proofs.

A leaf is the SHA-256 of a row's framed columns. The leaves of a group ascend by id and are
hashed two by two, level after level, a last one without a partner alone, until one is left: the
group's root. The roots of all groups, in the order of the group values, null first, are
hashed in the same way into the root of the table.

Trees are built ``STRIDE`` levels at a time: one group of 2 ** STRIDE neighbours is gathered,
and the levels above it are computed in it. Positions come from one sort into ranges and the
counts of each range, so no group of rows, however large, meets in one task.

Proofs are found by pointer jumping. Each node starts with the segment of one step, its sibling,
and a pointer to its parent. A self-join of the nodes gives each one the pointer of the node it
points at and the segment of that node after its own, so that the distance doubles each round,
and a tree of any height takes the logarithm of its height in rounds. Nodes at heights that no
pointer can name any more are left out on the way. A target of distance d has at most 2 ** d nodes
below it, and there are as many fewer targets; they are broadcast once their bytes, counted, are
within ``BROADCAST_BYTES``.

All of it is built-in functions.

Defined cases: a null column counts as '-', an empty text as '0:'. A null id comes before all others
and is never tampered with. Rows that agree in id lie in the order of their leaves, so repeated
rows have one leaf each and proofs of their own. An empty table has no rows and no root. A group of one
row has the leaf itself as its root, a table of one group the group's root. Columns that are not named are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import partitions, read_table
from wardline.session import materialize

# Levels that are built at once.
STRIDE = 10
# Targets of a round that may be broadcast, in bytes of their rows.
BROADCAST_BYTES = 16_000_000
# Groups of leaves in one range of positions, as far as their table may be broadcast.
BROADCAST_RUNS = 100_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree over the groups; names of the others start with one of these.
TOP, NULL_GROUP, GROUP = "", "-", "="

STEP = "struct<left:binary,right:binary>"


@dataclass(frozen=True)
class Manifest:
    """A table's trees: ``leaves`` (id, run, tree, node, digest, altered), ``nodes`` (tree, node, level, digest, step,
    up_tree, up_node) of all but the root, ``groups`` (run, tree, subroot), the tree that the root is the root of, the
    root, and the most steps from a leaf to it; without rows the two are None."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root_tree: str | None
    root: str | None
    height: int


# --- digests ---


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(framed, values)), 256))


def _parent(left: str, right: str) -> str:
    return f"unhex(sha2(concat(lower(hex({left})), coalesce(lower(hex({right})), '')), 256))"


def folded(leaf: str, path: str) -> Column:
    """The digest at the end of a path: the leaf hashed with one sibling after the other."""
    step = "unhex(sha2(concat(coalesce(lower(hex(s.left)), ''), lower(hex(d)), coalesce(lower(hex(s.right)), '')), 256))"
    return F.expr(f"aggregate({path}, {leaf}, (d, s) -> {step})")


def siblings(path: str) -> Column:
    """The digests of a path as one text, from the leaf up."""
    return F.expr(f"concat_ws('', transform({path}, s -> coalesce(lower(hex(s.left)), lower(hex(s.right)), '')))")


# --- trees ---


def build_manifest(
    rows: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: Sequence[str] = FIELDS,
    altered: dict[str, Column] | None = None,
) -> Manifest:
    """The trees of ``rows``. ``altered`` gives other values for some of the ``fields``, for a second
    digest of each row (column ``altered`` of the leaves) to be checked against the proof of the first."""
    given = {c: F.col(f"`{c}`") for c in fields}
    other = given | (altered or {})
    group = F.col(f"`{group_col}`").cast("string")
    leaves = rows.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.concat(F.lit(GROUP), group), F.lit(NULL_GROUP)).alias("tree"),
        row_digest(list(given.values())).alias("digest"),
        row_digest(list(other.values())).alias("altered"),
        # Tells repeated rows apart, so that any number of them spreads over ranges.
        F.monotonically_increasing_id().alias("place"),
    )
    leaves = _numbered(materialize(leaves, "merkle-rows"), ["id", "digest", "place"], ["id", "digest", "altered"])
    tall = leaves.agg(F.max("height")).first()[0]
    if tall is None:
        empty = rows.sparkSession.createDataFrame([], "run bigint, tree string, subroot binary")
        return Manifest(leaves, _no_nodes(rows.sparkSession), empty, None, None, 0)
    inner, roots = _levels(leaves.select("tree", "height", "position", "digest"), tall)

    # Group roots are the leaves of the tree over the groups, in the order of their names.
    top = _numbered(roots.selectExpr(f"'{TOP}' as tree", "tree as name", "digest"), ["name"], ["name", "digest"])
    top_height = top.agg(F.max("height")).first()[0]
    top_inner, top_roots = _levels(top.select("tree", "height", "position", "digest"), top_height)
    root = top_roots.select(F.lower(F.hex("digest"))).first()[0]
    root_tree = TOP if top_height else top.first()["name"]

    # A group's root is one node, the last of its own tree and a leaf of the tree over the groups.
    joints = (
        top_inner.where("level = 0")
        .join(top.select("name", F.expr(_node("height", "position")).alias("node")), "node")
        .select(F.col("name").alias("tree"), F.lit(1).cast("bigint").alias("node"), "digest", "step", F.col("node").alias("at"))
    )
    joints = joints.join(leaves.groupBy("tree").agg(F.first("height").alias("level")), "tree")
    parent = F.shiftright("node", 1)
    nodes = (
        inner.withColumns({"up_tree": F.col("tree"), "up_node": parent})
        .unionByName(top_inner.where("level > 0").withColumns({"up_tree": F.col("tree"), "up_node": parent}))
        .unionByName(joints.withColumns({"up_tree": F.lit(TOP), "up_node": F.shiftright("at", 1)}).drop("at"))
    )
    runs = leaves.select("run", "tree").distinct()
    groups = runs.join(roots.withColumnRenamed("digest", "subroot"), "tree")
    return Manifest(leaves, materialize(nodes, "merkle-nodes"), materialize(groups, "merkle-groups"), root_tree, root, tall + top_height)


def _node(height: str, position: str) -> str:
    """The number of a leaf in its tree: the root is 1, and half a node's number, rounded down, is its parent's."""
    return f"shiftleft(1L, {height}) + {position}"


def _numbered(rows: DataFrame, order: list[str], kept: list[str]) -> DataFrame:
    """Rows with position in their tree, the tree's height, and the run: the range of the sort that they lie in."""
    spark = rows.sparkSession
    columns = ["tree", *order]
    placed = (
        rows.repartitionByRange(partitions(spark), *columns)
        .sortWithinPartitions(*columns)
        .select("tree", *kept, F.monotonically_increasing_id().alias("at"))
    )
    # Ranges come from a sample, so what they gave is written once.
    placed = materialize(placed, "merkle-ranges").withColumn("run", F.shiftright("at", 33))
    # One row for each range and tree in it: as many as ranges and trees together.
    runs = placed.groupBy("run", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = materialize(runs, "merkle-runs")
    # The least number of levels whose power of two covers the leaves.
    height = F.when(F.col("size") == 1, 0).otherwise(F.length(F.bin(F.col("size") - 1)))
    runs = _running_counts(runs).withColumn("height", height)
    runs = runs.select("run", "tree", "first", "before", "height")
    numbered = placed.join(F.broadcast(runs) if runs.count() <= BROADCAST_RUNS else runs, ["run", "tree"])
    position = F.col("before") + F.col("at") - F.col("first")
    numbered = numbered.select(
        "run", "tree", "height", position.alias("position"), *[c for c in kept if c != "tree"]
    )
    return materialize(numbered, "merkle-leaves")


def _running_counts(runs: DataFrame) -> DataFrame:
    """Rows of the tree in earlier ranges, and in all. A tree lies in as many rows as ranges have some of it."""
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    return runs.withColumns({"before": F.coalesce(before, F.lit(0)), "size": F.sum("n").over(tree)})


def _levels(leaves: DataFrame, tall: int) -> tuple[DataFrame, DataFrame]:
    """All nodes that have a parent (tree, node, level, digest, step), and the roots (tree, digest)."""
    nodes, roots, base, current = [], [], 0, leaves
    while True:
        steps = f"least({STRIDE}, height - {base})"
        gathered = (
            current.groupBy("tree", F.shiftright("position", STRIDE).alias("chunk"))
            .agg(F.first("height").alias("height"), F.sort_array(F.collect_list(F.struct("position", "digest"))).alias("found"))
            .selectExpr("tree", "chunk", "height", f"{steps} as steps", "transform(found, f -> f.digest) as digests")
            .selectExpr("*", f"{_all_levels('digests', 'steps')} as levels")
        )
        gathered = materialize(gathered.drop("digests"), "merkle-levels")
        number = f"shiftleft(1L, height - {base} - t) + shiftleft(chunk, {STRIDE} - t) + j"
        step = "named_struct('left', if(j % 2 = 1, get(level, j - 1), null), 'right', if(j % 2 = 0, get(level, j + 1), null))"
        row = f"named_struct('node', {number}, 'level', cast({base} + t as int), 'digest', d, 'step', {step})"
        per_level = f"transform(slice(levels, 1, steps), (level, t) -> transform(level, (d, j) -> {row}))"
        nodes.append(gathered.selectExpr("tree", f"inline(flatten({per_level}))"))
        last = gathered.selectExpr("tree", "chunk", "height", "steps", "element_at(levels, -1) as last")
        roots.append(last.where(f"height <= {base + STRIDE}").selectExpr("tree", "last[0] as digest"))
        base += STRIDE
        if tall <= base:
            break
        current = last.where(f"height > {base}").selectExpr("tree", "height", "chunk as position", "last[0] as digest")
    all_nodes, all_roots = nodes[0], roots[0]
    for more, ends in zip(nodes[1:], roots[1:]):
        all_nodes, all_roots = all_nodes.unionByName(more), all_roots.unionByName(ends)
    return all_nodes, all_roots


def _all_levels(digests: str, steps: str) -> str:
    """The digests and the ``steps`` levels above them, as a list of lists."""
    last = "element_at(done, -1)"
    pair = _parent(f"get({last}, 2 * i)", f"get({last}, 2 * i + 1)")
    level = f"transform(sequence(0, cast((size({last}) + 1) div 2 as int) - 1), i -> {pair})"
    rounds = f"if({steps} < 1, cast(array() as array<int>), sequence(1, {steps}))"
    start = f"cast(array({digests}) as array<array<binary>>)"
    return f"aggregate({rounds}, {start}, (done, t) -> concat(done, array({level})))"


def _no_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], f"tree string, node bigint, level int, digest binary, step {STEP}, up_tree string, up_node bigint"
    )


# --- proofs ---


def proofs(manifest: Manifest, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per leaf: id, digest, altered, run, tree, and path, the siblings from the leaf to the root of the table."""
    spark = manifest.leaves.sparkSession
    leaf = F.struct("id", "run", F.col("digest").alias("digest"), "altered").alias("leaf")
    numbered = manifest.leaves.select(leaf, "tree", F.expr(_node("height", "position")).alias("node"))
    if manifest.root is None:
        return numbered.selectExpr("leaf.*", "tree", f"cast(array() as array<{STEP}>) as path")
    steps = manifest.nodes.select("tree", "node", "level", F.array("step").alias("path"), "up_tree", "up_node")
    walked = materialize(numbered.join(steps, ["tree", "node"], "full_outer"), "merkle-walk")
    # A node without a pointer is the root; one that points at the root has arrived.
    arrived = F.col("up_node").isNull() | ((F.col("up_node") == 1) & (F.col("up_tree") == manifest.root_tree))
    distance = 1
    while distance < manifest.height:
        targets = walked.where(F.col("leaf").isNull() & F.col("up_node").isNotNull()).select(
            F.col("tree").alias("up_tree"),
            F.col("node").alias("up_node"),
            F.col("path").alias("further"),
            F.col("up_tree").alias("next_tree"),
            F.col("up_node").alias("next_node"),
        )
        if targets.count() * (64 + 40 * distance) <= broadcast_bytes:
            targets = F.broadcast(targets)
        stays = walked.where(arrived)
        moved = (
            walked.where(~arrived)
            .join(targets, ["up_tree", "up_node"])
            .select(
                "tree", "node", "leaf", "level", F.concat("path", "further").alias("path"),
                F.col("next_tree").alias("up_tree"), F.col("next_node").alias("up_node"),
            )
        )
        distance *= 2
        # Pointers from leaves name heights that are multiples of the distance, or nodes above the groups.
        useful = F.col("leaf").isNotNull() | (F.col("tree") == TOP) | (F.col("level") % distance == 0)
        walked = materialize(stays.unionByName(moved).where(useful), "merkle-walk")
    return walked.where(F.col("leaf").isNotNull()).selectExpr(
        "leaf.*", "tree", f"coalesce(path, cast(array() as array<{STEP}>)) as path"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    decimal = F.col("doc_id").cast("string")
    tampered = (F.crc32(decimal.cast("binary")) % 7 == 0) & F.col("doc_id").isNotNull()
    n_chars = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    manifest = build_manifest(docs, altered={"n_chars": n_chars})
    return verified_rows(manifest)


def verified_rows(manifest: Manifest) -> DataFrame:
    """One row per leaf: its digest, its group's root, the root, a digest of its proof, and what the altered row
    folds to under that proof."""
    groups = manifest.groups
    if groups.count() <= BROADCAST_RUNS:
        groups = F.broadcast(groups)
    rows = proofs(manifest).join(groups, ["run", "tree"])
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        F.sha2(siblings("path"), 256).alias("proof_sha256"),
        F.lower(F.hex(folded("altered", "path"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_framed(value: str) -> str:
    return f"coalesce(strlen(({value})::varchar) || ':' || ({value})::varchar, '-')"


def _sql_leaf(**other: str) -> str:
    return "sha256(" + " || ".join(_sql_framed(other.get(c, c)) for c in FIELDS) + ")"


# The checksum of the id's digits, bit by bit.
_SQL_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                             lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""

_SQL_LEVELS = """
  select grp, level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' order by place))
  from {0} where n > 1 group by grp, level, place // 2
"""

OP11_SQL = f"""
with recursive rows as (
  select doc_id, coalesce('=' || lang, '-') as grp, {_sql_leaf()} as leaf,
         {_sql_leaf(n_chars=f"n_chars + case when {_SQL_CRC32} % 7 = 0 then 1 else 0 end")} as altered
  from documents
),
leaves as (
  select *, row_number() over (order by grp, doc_id nulls first, leaf) as id,
         row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as place,
         count(*) over (partition by grp) as n
  from rows
),
grown(grp, level, place, n, digest) as (
  select grp, 0, place, n, leaf from leaves union all {_SQL_LEVELS.format("grown")}
),
groups as (
  select grp, digest as subroot, row_number() over (order by grp) - 1 as place, count(*) over () as n from grown where n = 1
),
top(grp, level, place, n, digest) as (
  select '', 0, place, n, subroot from groups union all {_SQL_LEVELS.format("top")}
),
nodes as (select * from grown union all select * from top),
climb(id, grp, level, place, n, folded, proof) as (
  select id, grp, 0, place, n, altered, '' from leaves
  union all
  select c.id, case when c.n > 1 then c.grp else '' end, case when c.n > 1 then c.level + 1 else 0 end,
         case when c.n > 1 then c.place // 2 else g.place end, case when c.n > 1 then (c.n + 1) // 2 else g.n end,
         case when c.n = 1 then c.folded when c.place % 2 = 1 then sha256(s.digest || c.folded)
              else sha256(c.folded || coalesce(s.digest, '')) end,
         c.proof || case when c.n > 1 then coalesce(s.digest, '') else '' end
  from climb c left join groups g on g.grp = c.grp
       left join nodes s on s.grp = c.grp and s.level = c.level and s.place = xor(c.place, 1)
  where c.n > 1 or c.grp <> ''
)
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256, folded as folded_root, folded = digest as verified
from leaves join groups using (grp) join climb using (id), (select digest from top where n = 1)
where climb.grp = '' and climb.n = 1
"""
