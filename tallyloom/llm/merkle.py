"""A Merkle manifest of a dataset: leaves, a tree for each source, one over all sources, and a proof for each row.

Nodes are joined in runs of FAN consecutive ones. Rows find their places by a range partitioning and the counts of its parts,
so that a large source needs no task of its own. Its leaves then form aligned blocks of FAN ** LEVELS, each one task's work
at most: a stack hashes the block to its root, and the roots are the leaves of the next, much smaller tree.

Proofs are made by traversal: within a block the runs that a leaf needs are kept for each level while a stack for each level
builds the run that comes next, one leaf a step. So the state of a traversal is FAN nodes a level and stack, whatever the
block's size. The path above the block is the same for all of its leaves and is joined to the block before its proofs are
made; proofs never cross the network."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, map_in_arrow, written

#: Nodes of a run, and levels of an aligned block.
FAN, LEVELS = 16, 3
#: Paths of blocks or sources that are broadcast at most: some 10 MB, as a path has up to 15 digests a level.
FEW_PATHS = 2_000

PATH = "places array<int>, siblings array<string>"


def digest_of(fields: list[Column]) -> Column:
    """Of each field `-` if null, else its UTF-8 byte count, a colon and its value, one after the other: SHA-256 in hex."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def folded(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and its proof give."""
    step = lambda node, x: F.sha2(F.concat(F.substring(x["siblings"], F.lit(1), 64 * x["place"]), node, F.substring(x["siblings"], 64 * x["place"] + 1, F.length(x["siblings"]))), 256)
    return F.aggregate(F.arrays_zip(places.alias("place"), siblings.alias("siblings")), leaf, step)


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows (with a column tree) with pos, their place within the tree from 0, and n, the tree's number of rows."""
    rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).alias("part")
    parts = rows.groupBy("tree", part).agg(F.min("at").alias("first_at"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", "first_at", before.alias("before"), F.sum("rows").over(tree).alias("n"))
    joined = rows.withColumn("part", part).join(broadcast_if_small(parts), ["tree", "part"])
    return joined.withColumn("pos", F.col("at") - F.col("first_at") + F.col("before")).drop("part", "first_at", "before", "at")


def height(n: int, most: int = LEVELS) -> int:
    """Levels above a block's nodes, of a tree with n nodes."""
    h = 0
    while h < most and FAN**h < n:
        h += 1
    return h


def joined(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class Stack:
    """Treehash: takes leaves one by one and keeps the nodes of a level, with one open run for each level below it."""

    def __init__(self, level: int):
        self.level, self.runs, self.nodes = level, [[] for _ in range(level)], []

    def push(self, node: str, at: int = 0) -> None:
        while at < self.level:
            run = self.runs[at]
            run.append(node)
            if len(run) < FAN:
                return
            self.runs[at], node, at = [], joined(run), at + 1
        self.nodes.append(node)

    def finish(self) -> list[str]:
        """Closes runs that have fewer nodes than FAN; the nodes of the level."""
        for at in range(self.level):
            if self.runs[at]:
                run, self.runs[at] = self.runs[at], []
                self.push(joined(run), at + 1)
        return self.nodes


def block_root(leaves: list[str], levels: int) -> str:
    stack = Stack(levels)
    for leaf in leaves:
        stack.push(leaf)
    return stack.finish()[0]


def traversal(leaves: list[str], levels: int) -> Iterator[tuple[list[int], list[str]]]:
    """For each leaf of a block in turn: its place in the run of each level, and the other nodes of these runs."""
    spans = [FAN ** (k + 1) for k in range(levels)]
    current = []
    for k, span in enumerate(spans):
        stack = Stack(k)
        for leaf in leaves[:span]:
            stack.push(leaf)
        current.append(stack.finish())
    coming = [Stack(k) for k in range(levels)]
    for i in range(len(leaves)):
        places, siblings = [], []
        for k, span in enumerate(spans):
            place = i % span // (span // FAN)
            run = current[k]
            places.append(place)
            siblings.append("".join(run[:place]) + "".join(run[place + 1 :]))
        yield places, siblings
        for k, span in enumerate(spans):
            ahead = i + span
            if ahead < len(leaves):
                coming[k].push(leaves[ahead])
            if (i + 1) % span == 0:
                current[k], coming[k] = coming[k].finish(), Stack(k)


def packed(nodes: DataFrame, carry: list[str], name: str, levels: int) -> DataFrame:
    """One row for each block: tree, block, n and its nodes in order."""
    nodes = nodes.groupBy("tree", "n", F.call_function("div", F.col("pos"), F.lit(FAN**levels)).alias("block"))
    return written(nodes.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", *carry))).alias("nodes")), name)


def block_roots(blocks: DataFrame, levels: int) -> DataFrame:
    """tree, block, n and the digest of each block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = [block_root(leaves, height(n, levels)) for leaves, n in zip(b.column("leaves").to_pylist(), b.column("n").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("block"), b.column("n"), pa.array(roots, pa.string())], ["tree", "block", "n", "digest"])

    leaves = blocks.select("tree", "block", "n", F.col("nodes.digest").alias("leaves"))
    return map_in_arrow(leaves, run, "tree string, block long, n long, digest string")


def expanded(blocks: DataFrame, carry: dict[str, str], levels: int) -> DataFrame:
    """A row for each node of blocks (tree, nodes, n, root and the path above, as far as there is one), with its whole path."""
    kept = ["digest", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in ("tree", "n", "places", "siblings", "root")}
                nodes = b.column("nodes")[r].values
                leaves = nodes.field("digest").to_pylist()
                above, beside = row["places"] or [], row["siblings"] or []
                places, siblings, done = [], [], 0
                for i, (own, others) in enumerate(traversal(leaves, height(row["n"], levels)), 1):
                    places.append(own + above)
                    siblings.append(others + beside)
                    if len(places) == 512 or i == len(leaves):
                        m = len(places)
                        own_columns = [nodes.field(c).slice(done, m) for c in kept]
                        same = [pa.array([row["tree"]] * m, pa.string()), pa.array([row["root"]] * m, pa.string())]
                        paths = [pa.array(places, pa.list_(pa.int32())), pa.array(siblings, pa.list_(pa.string()))]
                        yield pa.RecordBatch.from_arrays([*same, *own_columns, *paths], ["tree", "root", *kept, "places", "siblings"])
                        places, siblings, done = [], [], done + m

    schema = ", ".join(["tree string, root string, digest string", *(f"{c} {kind}" for c, kind in carry.items()), PATH])
    return map_in_arrow(blocks.select("tree", "n", "nodes", "places", "siblings", "root"), run, schema)


def climbed(nodes: DataFrame, carry: list[str], name: str, levels: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of nodes (tree, pos, n, digest) with the path above each block and the tree's root; and tree and root."""
    blocks = packed(nodes, carry, f"{name}-blocks", levels)
    roots = written(block_roots(blocks, levels), f"{name}-roots")
    tops = roots.where(F.col("n") <= FAN**levels).select("tree", F.col("digest").alias("root"))
    parents = roots.where(F.col("n") > FAN**levels).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / FAN**levels).alias("n"), "digest")
    paths = tops.select("tree", F.lit(0).cast("long").alias("block"), "root", F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<string>").alias("siblings"))
    if not parents.isEmpty():
        upper, upper_tops = climbed(parents.withColumn("block", F.col("pos")), ["block"], f"{name}-up", levels)
        above = written(expanded(upper, {"block": "long"}, levels), f"{name}-paths")
        paths = paths.unionByName(above.select("tree", "block", "root", "places", "siblings"))
        tops = tops.unionByName(upper_tops)
    return blocks.join(broadcast_if_small(paths, FEW_PATHS), ["tree", "block"]), tops


def proofs(rows: DataFrame, source: str, order: list[str], leaf: Column, carry: dict[str, Column], levels: int = LEVELS) -> DataFrame:
    """For each row: leaf, the carried columns, subroot (its source's), root (all sources'), and its proof from leaf to root:
    places (of the node in the run of each level) and siblings (the run's other nodes, their hex digests as one string).

    Rows ascend within a source by the columns `order`, then by leaf; nulls come first. Sources ascend bytewise, null first.
    A lone row is its source's subroot, a lone subroot the root: their proofs have no level. In a run of one the node has no
    siblings and is hashed alone. Rows that are repeated are leaves of their own. An empty table gives no rows."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    own = rows.select(key.alias("tree"), leaf.alias("digest"), *(F.col(c).alias(f"by_{k}") for k, c in enumerate(order)), *(c.alias(f"c_{name}") for name, c in carry.items()))
    kinds = {name: kind for name, kind in own.dtypes if name.startswith("c_")}
    nodes = placed(own, [*(f"by_{k}" for k in range(len(order))), "digest"], "merkle-leaves")
    blocks, tops = climbed(nodes, list(kinds), "merkle", levels)
    sources = placed(tops.select(F.lit("").alias("tree"), F.col("tree").alias("source_key"), F.col("root").alias("digest")), ["source_key"], "merkle-sources")
    over, _ = climbed(sources, ["source_key"], "merkle-top", levels)
    over = written(expanded(over, {"source_key": "string"}, levels), "merkle-top-paths")
    over = over.select(F.col("source_key").alias("tree"), F.col("root").alias("whole"), F.col("places").alias("over_places"), F.col("siblings").alias("over_siblings"))
    both = lambda a, b: F.concat(F.coalesce(F.col(a), F.expr("array()")), F.col(b)).alias(a)
    ready = blocks.join(broadcast_if_small(over, FEW_PATHS), "tree").select(
        "tree", "n", "nodes", both("places", "over_places"), both("siblings", "over_siblings"), F.concat_ws(",", "root", "whole").alias("root")
    )
    roots = F.split("root", ",")
    return expanded(ready, kinds, levels).select(
        *(F.col(f"c_{name}").alias(name) for name in carry), F.col("digest").alias("leaf"), roots[0].alias("subroot"), roots[1].alias("root"), "places", "siblings"
    )


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs of documents (doc_id, source, lang, n_chars, text; other columns don't matter), held against tampered rows:
    where 5 divides the CRC-32 of the decimal doc_id, A-Z of the text are lower-cased. Null ids and null texts aren't touched.
    doc_id, leaf, subroot, root, proof_sha256 of the untampered rows; folded_root from the shown leaf; verified."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    columns = [F.col(c) for c in fields]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = F.when(touched, digest_of([*columns[:-1], lowered]))
    made = proofs(docs, "source", ["doc_id"], digest_of(columns), {"doc_id": F.col("doc_id"), "shown": shown}, levels)
    root = folded(F.coalesce("shown", "leaf"), F.col("places"), F.col("siblings"))
    made = made.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), root.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))
