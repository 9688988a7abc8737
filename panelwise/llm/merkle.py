"""A Merkle tree over a table, and per row the proof that climbs from its leaf to the root.

Each row is a leaf; the leaves of a group (say, a language) form a binary tree, and the groups' roots form the top
tree. *Building* goes up ``STRIDE`` levels at a time: nodes are gathered in tiles of 2^STRIDE neighbours, all levels
of a tile are hashed in one expression, and each node of the tile is stored as a row that links to its ancestor at the
tile's top and lists the siblings met on the way. *Climbing* is one recursive query over these rows: it
starts from every leaf with the hash as it is now (of a changed row, if it was tampered with), follows the parent link,
appends the siblings to the proof and folds them into the hash. A row is intact exactly if the fold ends in the root.

What is shuffled are digests, never texts. Leaves get their place by a range sort with counted offsets, so neither a
group nor the table is ever in one task; a tile has at most 2^STRIDE rows. The rows above the leaves (a
thousandth of them per step) are broadcast if their measured size allows; beyond that each is stored once for every so many leaves under it, and the
join's keys stay even although all leaves end at one root.

Nulls: a null column is hashed as ``-``; rows with a null group form a group of their own, the first. Null ids come
first in their group and are never changed. Rows with the same id stand in the order of their leaves; identical rows are leaves of their own.
Empty and long texts are ordinary values. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwise.llm.common import Scratch
from panelwise.runtime import MAX_BROADCAST_BYTES, col

#: Levels that one node row and one step of the recursion climb.
STRIDE = 10
#: The tree of the groups' roots; the groups' trees are numbered from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

@dataclass
class Manifest:
    """``leaves``: one row per document; ``nodes``: the rows above them; ``subroots``: (tree, group, subroot); the root, None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    n_nodes: int
    n_trees: int


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values in a row, each ``-`` if null, else its bytes' count, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def ranked(scratch: Scratch, df: DataFrame, order: Sequence[str], place: str) -> DataFrame:
    """``df`` with its rows' numbers by ``order``, nulls first. The rows are range-sorted and staged; the ranges' counts give the offsets.

    Equal rows are dealt to several ranges, too; their order among each other means nothing.
    """
    names = [col(c) for c in order]
    dealt = df.withColumn("_salt", F.monotonically_increasing_id())
    spread = dealt.repartitionByRange(*names, F.col("_salt")).sortWithinPartitions(*names, "_salt").drop("_salt")
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = scratch.stage(spread.withColumns({"_part": F.spark_partition_id(), "_nth": nth}))
    counts = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return staged.join(F.broadcast(offsets), "_part").select(*[col(c) for c in df.columns], (F.col("_before") + F.col("_nth")).alias(place))


def _hashed(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(left, F.coalesce(right, F.lit(""))), 256)


def _tiles(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Tiles of the nodes (tree, pos, n, digest, leaves, payload) of one step.

    ``own`` holds the nodes, ``rows`` the digests of all levels of the tile, ``leaves`` is the number of leaves below.
    ``n`` is the number of the tree's nodes in this step; a tree of one node has no levels left.
    """
    levels = F.when(F.col("n") <= 1, 0).otherwise(F.least(F.lit(STRIDE), F.length(F.bin(F.col("n") - 1))))
    gathered = nodes.groupBy("tree", F.shiftright("pos", STRIDE).alias("tile"), "n").agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "leaves", *payload))).alias("own"), F.sum("leaves").alias("leaves")
    )

    def above(row: Column) -> Column:
        """Every two neighbours become their hash; the last one alone, if their number is odd."""
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(row) - 1) / 2).cast("int")), lambda i: _hashed(row[i * 2], F.get(row, i * 2 + 1)))

    first = F.array(F.transform("own", lambda x: x["digest"]))
    rounds = F.slice(F.sequence(F.lit(1), F.lit(STRIDE)), F.lit(1), levels)
    return gathered.withColumn("rows", F.aggregate(rounds, first, lambda rows, _: F.concat(rows, F.array(above(F.element_at(rows, -1))))))


def _linked(tiles: DataFrame, step: int, payload: Sequence[str]) -> DataFrame:
    """One row per node of the tiles: the siblings up to the tile's top, and the link to the row of the ancestor there.

    ``top`` is the ancestor's digest, in the first row of each tile only.
    """
    one = tiles.select("tree", "n", "tile", "rows", F.col("leaves").alias("up_leaves"), F.posexplode("own").alias("_i", "_own"))

    def met(j: int) -> Column:
        place = F.shiftright("_i", j)
        return F.struct((place.bitwiseAND(F.lit(1)) == 1).alias("left"), F.unhex(F.get(F.get("rows", F.lit(j)), place.bitwiseXOR(F.lit(1)))).alias("digest"))

    last = F.col("n") <= (1 << STRIDE)  # the ancestor is the tree's root
    return one.select(
        "tree", F.lit(step).alias("step"), F.col("_own.pos").alias("pos"), F.col("_own.digest").alias("digest"), F.col("_own.leaves").alias("leaves"),
        F.slice(F.array(*[met(j) for j in range(STRIDE)]), F.lit(1), F.size("rows") - 1).alias("siblings"),
        F.when(last & (F.col("tree") == TOP), F.lit(None)).when(last, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(last, F.lit(0)).otherwise(F.lit(step + 1)).alias("up_step"),
        F.when(last, F.col("tree")).otherwise(F.col("tile")).cast("long").alias("up_pos"),
        "up_leaves", "n", F.when(F.col("_i") == 0, F.element_at("rows", -1)[0]).alias("top"),
        *[F.col(f"_own.{p}").alias(p) for p in payload],
    )


def _grow(scratch: Scratch, nodes: DataFrame, most: int, payload: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """All node rows of some trees, step by step, and each tree's root as (tree, digest, leaves). ``most``: nodes of the largest tree."""
    steps, roots = [], []
    while not steps or most > 1:
        now = payload if not steps else []
        linked = scratch.stage(_linked(_tiles(nodes, now), len(steps), now), "zstd")
        tops = linked.filter(F.col("top").isNotNull())
        steps.append(linked)
        roots.append(tops.filter(F.col("n") <= (1 << STRIDE)).select("tree", F.col("top").alias("digest"), F.col("up_leaves").alias("leaves")))
        larger = tops.filter(F.col("n") > (1 << STRIDE))
        nodes = larger.select("tree", F.shiftright("pos", STRIDE).alias("pos"), F.ceil(F.col("n") / (1 << STRIDE)).cast("long").alias("n"), F.col("top").alias("digest"), F.col("up_leaves").alias("leaves"))
        most = -(-most >> STRIDE) if most > (1 << STRIDE) else 0
    return steps, reduce(DataFrame.unionByName, roots)


def build(
    docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, changed: Mapping[str, Column] | None = None, where: Column | None = None
) -> Manifest:
    """The manifest of ``docs``. Rows for which ``where`` holds also get the leaf that they have with the columns in ``changed`` replaced.

    Trees are numbered in the order of the groups, null first. A leaf hashes ``fields`` in this order.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    now = leaf_digest([col(f) for f in fields])
    then = leaf_digest([(changed or {}).get(f, col(f)) for f in fields])
    tampered = F.lit(None).cast("string") if where is None else F.when(where, then)
    # Texts are read here only.
    digests = scratch.stage(docs.select(col(doc_id).alias("id"), col(group).alias("grp"), now.alias("digest"), tampered.alias("tampered")), "zstd")
    placed = ranked(scratch, digests, ["grp", "id", "digest"], "place")
    groups = scratch.stage(placed.groupBy("grp").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")))
    trees = scratch.stage(ranked(scratch, groups, ["grp"], "tree"))
    most, n_trees, width = trees.agg(F.max("n"), F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length(F.col("grp").cast("string")), F.lit(0)) + 64)).first()
    side = trees.withColumnRenamed("grp", "_grp")
    side = F.broadcast(side) if (width or 0) <= MAX_BROADCAST_BYTES else side
    one = F.lit(1).cast("long").alias("leaves")
    leaves = placed.join(side, F.col("grp").eqNullSafe(F.col("_grp"))).select("tree", (F.col("place") - F.col("first")).alias("pos"), "n", "digest", one, "id", "tampered")
    steps, roots = _grow(scratch, leaves, most or 0, ["id", "tampered"])
    under = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).cast("long").alias("n"), "digest", "leaves")
    tops, root = _grow(scratch, under, n_trees, [])
    nodes = reduce(DataFrame.unionByName, [*steps[1:], *tops])
    found = root.first()
    subroots = scratch.stage(trees.select("tree", "grp").join(roots.select("tree", F.col("digest").alias("subroot")), "tree"))
    return Manifest(steps[0], nodes, subroots, found and found["digest"], nodes.count(), n_trees)


def _climbed(folded: str, proof: str, siblings: str) -> str:
    """SQL: the hash and the proof after the siblings of one node row."""
    other = "lower(hex(s.digest))"
    step = f"sha2(case when s.digest is null then h when s.left then concat({other}, h) else concat(h, {other}) end, 256)"
    return f"aggregate({siblings}, {folded}, (h, s) -> {step}) as folded, aggregate({siblings}, {proof}, (p, s) -> concat(p, coalesce(s.digest, x''))) as proof"


def climb(manifest: Manifest, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per leaf (doc_id, leaf, tree, proof, folded): the siblings' digests up to the root, 32 bytes each, and the fold of the leaf as it is now.

    Lifts the session's limit on the rows of a recursive query, which is there for endless ones: this one takes as
    many rounds as the trees have steps.
    """
    spark = manifest.leaves.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    small = manifest.n_nodes * (64 * STRIDE + 128) <= max_bytes
    # Beyond a broadcast a row above many leaves is stored as often as they fill a tile, so that each copy meets a tile's leaves.
    copies = "1L" if small else f"shiftright({{0}} - 1, {STRIDE}) + 1"
    nodes = manifest.nodes.select("tree", "step", "pos", "siblings", "up_tree", "up_step", "up_pos", "up_leaves", F.expr(f"explode(sequence(0L, {copies.format('leaves')} - 1))").alias("copy"))
    query = f"""
        with recursive climb(id, leaf, home, tile, up_tree, up_step, up_pos, up_leaves, folded, proof) as (
            select id, digest, tree, shiftright(pos, {STRIDE}), up_tree, up_step, up_pos, up_leaves, {_climbed("coalesce(tampered, digest)", "x''", "siblings")}
            from {{leaves}}
            union all
            select {"/*+ broadcast(n) */" if small else ""} c.id, c.leaf, c.home, c.tile, n.up_tree, n.up_step, n.up_pos, n.up_leaves, {_climbed("c.folded", "c.proof", "n.siblings")}
            from climb c join {{nodes}} n
                on n.tree = c.up_tree and n.step = c.up_step and n.pos = c.up_pos and n.copy = pmod(xxhash64(c.home, c.tile), {copies.format("c.up_leaves")})
        )
        select id as doc_id, leaf, home as tree, proof, folded from climb where up_tree is null
    """
    return spark.sql(query, leaves=manifest.leaves, nodes=nodes)


def verify(manifest: Manifest, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per leaf (doc_id, leaf, subroot, root, proof, folded_root, verified)."""
    trees = manifest.subroots.select("tree", "subroot")
    trees = F.broadcast(trees) if manifest.n_trees * 128 <= max_bytes else trees
    root = F.lit(manifest.root).cast("string")
    return climb(manifest, max_bytes).join(trees, "tree").select("doc_id", "leaf", "subroot", root.alias("root"), "proof", F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))
