"""SimHash near-duplicates, linked through BK-trees.

A document's fingerprint has bit b set if over half of its word shingles'
XXH64 hashes have it set.  Documents link when their fingerprints differ in at
most ``radius`` bits; a document's component is the smallest id it reaches.

Method: equal fingerprints are one class from the start.  The 64 bits are cut
into blocks; two fingerprints within ``radius`` bits agree on all bits of at
least ``blocks - radius`` blocks, so they meet in the shard of some choice of
that many blocks.  Each shard is held as a BK-tree, whose children are keyed
by their integer Hamming distance to the parent, and a search follows only
the edges within the radius.  Trees reach their queries by shuffle: a
broadcast of every shard's tree would pass all fingerprints through the
driver.

Scale: there are ``choose(blocks, blocks - radius)`` shard keys per class, and
the number of blocks grows with the number of classes so that a shard of
random fingerprints stays small.  A shard over ``SHARD_CAP`` classes (near
copies share most blocks) is cut into parts; every pair of parts meets in a
task of its own, one part as the tree and the other as the queries, so no
task grows with the shard.  A task returns the links of a spanning forest, at
most one per class, not all pairs.  Components come from alternating large-
and small-star steps, each written to the shared folder.  The driver sees
counts only.

Defined cases: a text of fewer words than a shingle is one shingle, a null or
wordless text has the fingerprint zero and links like any other.  Repeated
rows keep their rows.  A null id never is a component's smallest id; if a
component has no other, its id is null.  An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import written

SHINGLE_WORDS = 4
RADIUS = 4
SHARD_CAP = 512
SHARD_TARGET = 64


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one UTF-8 text; ASCII letters count as lower case."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(b" ".join(tokens), 42)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    stops = (ends[words - 1:] - 1).tolist()
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)),
                         dtype=np.uint64, count=len(starts))
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 words: int = SHINGLE_WORDS, row: str | None = None) -> DataFrame:
    """(f_id, f_print) of every row, the fingerprint as a signed long; with the column ``row`` also f_row."""
    def run(batches):
        for batch in batches:
            prints = [_signed(fingerprint(t or b"", words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, type=pa.int64()), *batch.columns[2:]],
                names=["f_id", "f_print", *batch.schema.names[2:]])

    numbers = [] if row is None else [F.col(row).cast("long").alias("f_row")]
    rows = docs.select(F.col(key).cast("long").alias("f_id"), F.col(text).cast("binary").alias("f_text"), *numbers)
    return rows.mapInArrow(run, "f_id bigint, f_print bigint" + (", f_row bigint" if numbers else ""))


def block_plan(classes: int, radius: int = RADIUS, target: int = SHARD_TARGET) -> list[int]:
    """Bit masks of the shard keys for so many classes: every choice of ``blocks - radius`` blocks."""
    for chosen in range(1, 5):
        blocks = chosen + radius
        if classes <= target << (64 * chosen // blocks):
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(pick) for pick in combinations(masks, chosen)]


class BKTree:
    """Fingerprints under the Hamming metric; ``children[n]`` maps a distance to a child of node n."""

    def __init__(self, values):
        self.values, self.children = [], []
        for value in values:
            self.add(value)

    def add(self, value: int) -> None:
        values, children = self.values, self.children
        new = len(values)
        values.append(value)
        children.append({})
        node = 0
        while new:
            distance = (values[node] ^ value).bit_count()
            below = children[node].get(distance)
            if below is None:
                children[node][distance] = new
                return
            node = below

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` bits from ``value``."""
        found, open_nodes = [], [0] if self.values else []
        values, children = self.values, self.children
        while open_nodes:
            node = open_nodes.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            low, high = distance - radius, distance + radius
            for edge, child in children[node].items():
                if low <= edge <= high:
                    open_nodes.append(child)
        return found


def forest_links(tree_side: list[tuple[int, int]], query_side: list[tuple[int, int]] | None,
                 radius: int) -> list[tuple[int, int]]:
    """(root id, id) links that connect exactly the pairs (id, print) within the radius.

    ``query_side`` None: the pairs within ``tree_side``; else those between the two sides.
    """
    tree = BKTree([p for _, p in tree_side])
    rows = tree_side if query_side is None else tree_side + query_side
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = 0 if query_side is None else len(tree_side)
    for at in range(first, len(rows)):
        for node in tree.within(rows[at][1], radius):
            a, b = root(at), root(node)
            if a != b:
                if rows[b][0] < rows[a][0]:
                    a, b = b, a
                parent[b] = a
    return [(rows[r][0], rows[at][0]) for at in range(len(rows)) if (r := root(at)) != at]


def shard_links(classes: DataFrame, radius: int = RADIUS, cap: int = SHARD_CAP,
                target: int = SHARD_TARGET) -> DataFrame:
    """(a, b) links, a < b, between the fingerprints ``f_print`` of the table of distinct ones."""
    masks = block_plan(classes.count(), radius, target)
    keys = F.array(*[
        F.struct(F.lit(i).alias("m"), F.col("f_print").bitwiseAND(F.lit(_signed(mask))).alias("v"))
        for i, mask in enumerate(masks)])
    members = classes.select("f_print", F.explode(keys).alias("k")).select(
        F.col("k.m").alias("h_mask"), F.col("k.v").alias("h_value"), "f_print")
    large = written(
        members.groupBy("h_mask", "h_value").agg(F.count(F.lit(1)).alias("h_size")).where(F.col("h_size") > cap)
        .select(F.col("h_mask").alias("l_mask"), F.col("h_value").alias("l_value"),
                F.ceil(F.col("h_size") / cap).cast("int").alias("l_parts")), "simhash-large-shards")
    sized = (members.join(large, (F.col("h_mask") == F.col("l_mask")) & (F.col("h_value") == F.col("l_value")), "left")
             .withColumn("h_parts", F.coalesce("l_parts", F.lit(1)))
             .withColumn("h_own", F.pmod(F.xxhash64("f_print"), F.col("h_parts")).cast("int")))
    # A part meets itself and every other part: as tree (side 0) with later parts, as query (side 1) with earlier.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("h_parts") - 1),
        lambda other: F.struct(F.least(other, F.col("h_own")).alias("t"), F.greatest(other, F.col("h_own")).alias("q"),
                               (other < F.col("h_own")).cast("int").alias("side")))
    dealt = (sized.select("h_mask", "h_value", "f_print", F.explode(meets).alias("h"))
             .select("h_mask", "h_value", F.col("h.t").alias("h_t"), F.col("h.q").alias("h_q"),
                     F.col("h.side").alias("h_side"), "f_print"))
    group = ["h_mask", "h_value", "h_t", "h_q"]
    sorted_rows = dealt.repartition(*group).sortWithinPartitions(*group, "h_side")

    def run(batches):
        now, sides = None, ([], [])
        links: list[tuple[int, int]] = []

        def close():
            if now is not None:
                links.extend(forest_links(sides[0], None if now[2] == now[3] else sides[1], radius))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for mask, value, t, q, side, print_ in zip(*columns):
                if now != (mask, value, t, q):
                    close()
                    now, sides = (mask, value, t, q), ([], [])
                sides[side].append((print_, print_ & 0xFFFFFFFFFFFFFFFF))
            if len(links) > 20000:
                yield _pairs(links)
                links = []
        close()
        yield _pairs(links)

    return sorted_rows.mapInArrow(run, "a bigint, b bigint").distinct()


def _pairs(links):
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in links], type=pa.int64()) for i in (0, 1)], names=["a", "b"])


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the least node it reaches.

    The least neighbours are written before they are joined to the links, so
    that the join of a node with very many links can be split.
    """
    edges = written(links, "simhash-links")
    state = _state(edges)
    while True:
        # Large star: every larger neighbour of a node points to the node's least neighbour (or itself).
        both = edges.union(edges.select("b", "a"))
        least = written(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "simhash-least")
        large = written(both.join(least, F.col("a") == F.col("n")).where(F.col("b") > F.col("a"))
                        .select(F.col("m").alias("a"), "b").distinct(), "simhash-star")
        # Small star: every smaller neighbour of a node, and the node, point to its least neighbour.
        down = written(large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m")), "simhash-least")
        joined = large.join(down, F.col("b") == F.col("n")).select(
            "m", F.explode(F.array("a", "b")).alias("b")).where(F.col("m") < F.col("b"))
        edges = written(joined.select(F.col("m").alias("a"), "b").distinct(), "simhash-star")
        before, state = state, _state(edges)
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    radius: int = RADIUS, cap: int = SHARD_CAP, target: int = SHARD_TARGET) -> DataFrame:
    """(f_id, f_print, f_component) of every row of ``docs``."""
    prints = written(fingerprints(docs, key, text, words), "simhash-prints")
    classes = written(prints.groupBy("f_print").agg(F.min("f_id").alias("least_id")), "simhash-classes")
    roots = components(shard_links(classes.select("f_print"), radius, cap, target))
    linked = written(classes.join(roots, F.col("f_print") == F.col("node")).select("node", "root", "least_id"),
                     "simhash-linked")
    least = written(linked.groupBy(F.col("root").alias("l_root")).agg(F.min("least_id").alias("l_id")),
                    "simhash-roots")
    named = linked.join(least, F.col("root") == F.col("l_root")).select("node", "l_id")
    named = written(classes.join(named, F.col("f_print") == F.col("node"), "left").select(
        F.col("f_print").alias("c_print"), F.when(F.col("node").isNull(), F.col("least_id"))
        .otherwise(F.col("l_id")).alias("f_component")), "simhash-components")
    return (prints.join(named, F.col("f_print") == F.col("c_print"), "left")
            .select("f_id", "f_print", "f_component"))


def hex_print(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def first_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, cap: int = SHARD_CAP,
                  target: int = SHARD_TARGET, unnamed_stay: bool = True) -> DataFrame:
    """``docs`` without its near duplicates: of each component one row stays.

    It is a row of the smallest id, of repeated rows of that id the first as
    the table is read; rows of one id whose texts differ are told apart.  Rows
    without an id come after all others, and with ``unnamed_stay`` all stay.
    """
    # Written, so that a row has the same number wherever it is read.
    rows = written(docs.select(F.monotonically_increasing_id().alias("r_number"), F.struct("*").alias("r_row")),
                   "simhash-rows")
    prints = fingerprints(rows, "r_row.doc_id", "r_row.text", words, "r_number")
    first = F.min(F.struct(F.col("f_id").isNull().alias("unnamed"), F.col("f_id").alias("id"),
                           F.col("f_row").alias("row")))
    classes = written(prints.groupBy("f_print").agg(first.alias("c_first")), "simhash-classes")
    roots = components(shard_links(classes.select("f_print"), radius, cap, target))
    kept = written(classes.join(roots, F.col("f_print") == F.col("node"), "left")
                   .groupBy(F.coalesce("root", "f_print").alias("k_root")).agg(F.min("c_first").alias("k_first"))
                   .select(F.col("k_first.row").alias("k_number")), "simhash-kept")
    unnamed = F.col("r_row.doc_id").isNull()
    named = rows.where(~unnamed) if unnamed_stay else rows
    left = named.join(kept.hint("merge"), F.col("r_number") == F.col("k_number"), "leftsemi").select("r_row.*")
    return left.unionByName(rows.where(unnamed).select("r_row.*")) if unnamed_stay else left
