"""Merkle manifest of a dataset: one root, and for every row a proof against it.

A leaf is the SHA-256 of a row's fields.  The leaves of a tree (one tree for
each value of a column) stand in the order of a key; while several nodes
remain, every 16 consecutive ones become the hash of their joined digests.
What remains is the tree's subroot.  The subroots, in the order of the trees'
names (null first, bytewise), form one more tree, whose top is the root.  A
proof lists for each level the digests left and right of the node.

Method: a node's rank in its tree is written as digits of base 16.  Blocks of
``16 ** DIGITS`` consecutive leaves are rolled up by grouping the lowest digit
away, then the next, each parent keeping its children as nested structs; all
groupings of a block use one shuffle by block.  The tops of the blocks are the
nodes of the next tier, until a tree has one block.  On the way down a tier's
blocks are exploded level by level; each explode adds a level to the proof,
and a block meets the proof of its top by grouping both under the block's
number, so no step joins on the leaves.

Scale: a block is bounded by its digits, and every level is bounded by a
sixteenth of the one below, so no tree, however large, meets in one task.
Ranks come from a range shuffle of (tree, key, leaf, row number), which splits
a tree or a key that holds most rows, and from row counts of its partitions.
Leaves and each tier are written to the shared folder.  The driver sees one
number, the size of the largest tree.

Defined cases: null fields are hashed as ``-``; null keys come first; rows
equal in tree and key stand in the order of their leaves, and equal leaves in
any order, which changes no digest.  A null tree name is a tree of its own.  An
empty table gives an empty result.  Columns are read by name into a struct, so
extra columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BASE_BITS = 4
BASE = 1 << BASE_BITS
DIGITS = 3


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(value.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return digest(F.concat(*map(field_text, fields)))


def with_ranks(nodes: DataFrame, tree: list[str], order: list[str], name: str) -> DataFrame:
    """``nodes`` written, with ``n_rank``, the place from 0 in its tree by ``order``, and ``n_size``, the tree's size.

    ``tree`` and ``order`` name columns; rows equal in both may come in any order.
    """
    numbered = written(nodes.withColumn("n_row", F.monotonically_increasing_id()), f"{name}-rows")
    sorted_rows = written(
        numbered.repartitionByRange(*tree, *order, "n_row").sortWithinPartitions(*tree, *order, "n_row")
        .withColumns({"n_part": F.spark_partition_id(), "n_at": F.monotonically_increasing_id()}).drop("n_row"),
        f"{name}-sorted")
    parts = sorted_rows.groupBy(*tree, "n_part").agg(F.count(F.lit(1)).alias("p_rows"), F.min("n_at").alias("p_first"))
    whole = Window.partitionBy(*tree) if tree else Window.partitionBy(F.lit(0))
    # As many rows as partitions for the largest tree, one for a small tree.
    offsets = written(parts.select(
        *[F.col(t).alias(f"p_{t}") for t in tree], F.col("n_part").alias("p_part"),
        (F.coalesce(F.sum("p_rows").over(whole.orderBy("n_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("p_first")).alias("p_shift"),
        F.sum("p_rows").over(whole).alias("n_size")), f"{name}-parts")
    same = reduce(lambda a, b: a & b, [F.col(t).eqNullSafe(F.col(f"p_{t}")) for t in tree],
                  F.col("n_part") == F.col("p_part"))
    return (sorted_rows.join(offsets, same).withColumn("n_rank", F.col("n_at") + F.col("p_shift"))
            .drop("n_part", "n_at", "p_part", "p_shift", *[f"p_{t}" for t in tree]))


def _rolled(nodes: DataFrame, tree: list[str], digits: int) -> DataFrame:
    """Blocks of ``nodes`` (tree, n_rank, n_levels, n_hash, n_load): tree, n_block, n_levels, b_hash, b_kids.

    ``n_levels`` is the number of levels that the tree still has above the nodes.
    """
    block = F.shiftright("n_rank", BASE_BITS * digits)
    places = [F.shiftright("n_rank", BASE_BITS * d).bitwiseAND(F.lit(BASE - 1)).cast("tinyint").alias(f"d{d}")
              for d in range(digits)]
    level = nodes.select(*tree, block.alias("n_block"), *places, "n_levels",
                         F.struct(F.col("n_hash").alias("h"), F.col("n_load").alias("kids")).alias("node"))
    level = level.repartition(*tree, "n_block")
    for d in range(digits):
        higher = [f"d{e}" for e in range(digits - 1, d, -1)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{d}").alias("d"), F.col("node").alias("node"))))
        # A level above the tree's top hashes nothing; its only child passes through.
        grouped = level.groupBy(*tree, "n_block", "n_levels", *higher).agg(kids.alias("kids"))
        joined = F.array_join(F.transform("kids", lambda k: k["node"]["h"]), "")
        node_hash = F.when(F.col("n_levels") > d, digest(joined)).otherwise(F.col("kids")[0]["node"]["h"])
        level = grouped.select(*tree, "n_block", "n_levels", *higher,
                               F.struct(node_hash.alias("h"), F.transform("kids", lambda k: k["node"]).alias("kids"))
                               .alias("node"))
    return level.select(*tree, "n_block", "n_levels", F.col("node.h").alias("b_hash"), F.col("node.kids").alias("b_kids"))


def _unrolled(blocks: DataFrame, tree: list[str], digits: int) -> DataFrame:
    """The nodes of ``blocks`` that have ``above``, the proof of the block's top: tree, n_rank, n_hash, n_load, proof.

    A proof is an array of (left, right) texts of joined digests, lowest level first.
    """
    level = blocks.select(*tree, F.col("n_block").alias("n_rank"), "n_levels", "above", F.col("b_kids").alias("kids"))
    for d in reversed(range(digits)):
        opened = level.select(*tree, "n_rank", "n_levels", "above",
                              F.transform("kids", lambda k: k["h"]).alias("run"), F.posexplode("kids").alias("i", "kid"))
        beside = F.struct(F.array_join(F.slice("run", F.lit(1), F.col("i")), "").alias("left"),
                          F.array_join(F.slice("run", F.col("i") + 2, F.lit(BASE)), "").alias("right"))
        level = opened.select(
            *tree, (F.col("n_rank") * BASE + F.col("i")).alias("n_rank"), "n_levels",
            F.when(F.col("n_levels") > d, F.concat(F.array(beside), "above")).otherwise(F.col("above")).alias("above"),
            F.col("kid.h").alias("n_hash"), F.col("kid.kids").alias("kids"))
    return level.select(*tree, "n_rank", "n_hash", F.col("kids").alias("n_load"), F.col("above").alias("proof"))


def _levels(size: int) -> int:
    """Levels above ``size`` leaves."""
    levels, reach = 0, 1
    while reach < size:
        levels, reach = levels + 1, reach * BASE
    return levels


def _levels_of(size: Column, most: int) -> Column:
    """``_levels`` of a column whose largest value has ``most`` levels."""
    return reduce(lambda a, b: a + b, [(size > BASE ** e).cast("int") for e in range(most)], F.lit(0))


def forest_proofs(nodes: DataFrame, tree: list[str], order: list[str], above, digits: int = DIGITS,
                  name: str = "merkle") -> DataFrame:
    """(tree columns, n_hash, n_load, proof, subroot and what ``above`` adds) of every node.

    ``nodes`` has the tree columns, those of ``order``, ``n_hash`` and ``n_load``.
    ``above`` gets the tops (tree columns, n_hash) and returns them with
    ``proof``, the levels above them, and columns that every node is to carry.
    """
    ranked = with_ranks(nodes, tree, order, name)
    most = _levels(ranked.agg(F.max("n_size")).first()[0] or 0)
    level = ranked.select(*tree, "n_rank", "n_hash", "n_load", _levels_of(F.col("n_size"), most).alias("n_levels"))
    tiers = []
    for tier in range(max(1, -(-most // digits))):
        blocks = written(_rolled(level, tree, digits), f"{name}-tier")
        tiers.append(blocks)
        level = blocks.select(*tree, F.col("n_block").alias("n_rank"), F.col("b_hash").alias("n_hash"),
                              F.lit(None).cast("boolean").alias("n_load"),
                              F.greatest(F.col("n_levels") - digits, F.lit(0)).alias("n_levels"))
    # The last tier has one block for each tree: its top.
    down = above(level.select(*tree, "n_hash")).withColumns({"n_rank": F.lit(0).cast("long"), "subroot": F.col("n_hash")})
    carried = [c for c in down.columns if c not in {*tree, "n_rank", "n_hash", "n_load", "proof"}]
    for blocks in reversed(tiers):
        tops = down.select(*tree, F.col("n_rank").alias("n_block"), F.struct("proof", *carried).alias("top"))
        met = (blocks.withColumn("body", F.struct("n_levels", "b_kids")).select(*tree, "n_block", "body")
               .unionByName(tops, allowMissingColumns=True).groupBy(*tree, "n_block")
               .agg(F.first("body", ignorenulls=True).alias("body"), F.first("top", ignorenulls=True).alias("top")))
        opened = _unrolled(met.select(*tree, "n_block", "body.*", F.col("top.proof").alias("above"),
                                      F.struct(*[F.col(f"top.{c}").alias(c) for c in carried]).alias("n_top")),
                           [*tree, "n_top"], digits)
        down = opened.select(*tree, "n_rank", "n_hash", "n_load", "proof", "n_top.*")
        if blocks is not tiers[0]:
            down = written(down, f"{name}-proofs")
    return down.drop("n_rank")


def manifest(docs: DataFrame, key: str = "doc_id", tree: str = "source", fields: tuple[str, ...] = FIELDS,
             carry: Column | None = None, digits: int = DIGITS) -> DataFrame:
    """(m_key, m_tree, m_leaf, m_subroot, m_root, m_proof, m_carry) of every row of ``docs``.

    ``m_proof`` is an array of (left, right), the joined digests beside the
    node, level by level from the leaf to the root.  ``carry`` is an expression
    of the row that its manifest row keeps.
    """
    leaves = docs.select(F.col(tree).cast("string").alias("m_tree"), F.col(key).alias("m_key"),
                         leaf_digest(*[F.col(f) for f in fields]).alias("n_hash"),
                         F.struct(F.col(key).alias("key"),
                                  (F.lit(None).cast("string") if carry is None else carry).alias("carry"))
                         .alias("n_load"))

    def tops_of_trees(tops: DataFrame) -> DataFrame:
        named = tops.select("m_tree", "n_hash", F.struct("m_tree").alias("n_load"))
        found = forest_proofs(named, [], ["m_tree"], lambda top: top.select(
            "n_hash", F.array().cast("array<struct<left:string,right:string>>").alias("proof"),
            F.col("n_hash").alias("root")), digits, "merkle-roots")
        return found.select(F.col("n_load.m_tree").alias("m_tree"), "n_hash", "proof", "root")

    found = forest_proofs(leaves, ["m_tree"], ["m_key", "n_hash"], tops_of_trees, digits)
    return found.select(F.col("n_load.key").alias("m_key"), "m_tree", F.col("n_hash").alias("m_leaf"),
                        F.col("subroot").alias("m_subroot"), F.col("root").alias("m_root"),
                        F.col("proof").alias("m_proof"), F.col("n_load.carry").alias("m_carry"))


def proof_text(proof: Column) -> Column:
    """All sibling digests of a proof, joined in order."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))
