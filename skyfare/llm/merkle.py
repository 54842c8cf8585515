"""A Merkle manifest of a dataset: one tree of digests per language, and one over the languages' roots.

A tree is cut into blocks, aligned subtrees of `height` levels: the leaves' blocks first, then blocks over
their roots, and so on until one block is left. Blocks are built by tasks of their own, whatever the size of
a tree, and are written as a table, one row per block. Within a block the nodes are stored in van Emde Boas
order: the subtree is split at half its height, the top half comes first, then each bottom subtree, and each
of these is laid out likewise. A path from a leaf to the root so touches few stretches of memory at any size
of cache, and a node's place follows from its depth and index alone, for building as for finding siblings.

Proofs are made from the top down: a block gets the steps above its root from the block over it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyfare.llm.common import held
from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold

HEIGHT = 8
WIDTH = 64  # of a digest as hex text
TAMPERED_OF = 7


def address(levels: int, depth: int, index):
    """Place of node `index` of `depth` (root: 0) in the van Emde Boas layout of a full tree of `levels` levels."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = depth - top
    subtree, within = index >> below, index & ((1 << below) - 1)
    bottom = levels - top
    return (1 << top) - 1 + subtree * ((1 << bottom) - 1) + address(bottom, below, within)


@cache
def places(levels: int) -> tuple[list[int], ...]:
    """The addresses of all nodes, by depth."""
    return tuple(address(levels, depth, np.arange(1 << depth)).tolist() for depth in range(levels))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class Block:
    """`size` digests under one root, `height` levels below it: the nodes as one text in van Emde Boas order."""

    nodes: str
    height: int
    size: int

    @staticmethod
    def of(digests: str, height: int) -> Block:
        size = len(digests) // WIDTH
        at = places(height + 1)
        cells = [" " * WIDTH] * ((2 << height) - 1)
        row = [digests[i : i + WIDTH] for i in range(0, len(digests), WIDTH)]
        for depth in range(height, -1, -1):
            for i, value in zip(at[depth], row, strict=False):
                cells[i] = value
            row = [digest("".join(row[i : i + 2])) for i in range(0, len(row), 2)]
        return Block("".join(cells), height, size)

    def node(self, depth: int, index: int) -> str:
        at = places(self.height + 1)[depth][index] * WIDTH
        return self.nodes[at : at + WIDTH]

    def leaf(self, index: int) -> str:
        return self.node(self.height, index)

    def steps(self, index: int) -> list[str]:
        """The way from a leaf up to the block's root: L or R and the sibling on that side, - without one."""
        found = []
        for depth in range(self.height, 0, -1):
            beside = index ^ 1
            there = beside < -(-self.size >> (self.height - depth))
            found.append(("L" if index & 1 else "R") + self.node(depth, beside) if there else "-")
            index >>= 1
        return found


def split_steps(path: str) -> list[str]:
    steps, i = [], 0
    while i < len(path):
        end = i + (1 if path[i] == "-" else 1 + WIDTH)
        steps.append(path[i:end])
        i = end
    return steps


def fold(value: str, steps: list[str]) -> str:
    """The root that a digest and the steps above it lead to."""
    for step in steps:
        value = digest(value if step == "-" else step[1:] + value if step[0] == "L" else value + step[1:])
    return value


def positioned(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` (tree, ...) with pos, the place of a row in its tree by `order`, and n, the rows of its tree.

    Rows are sorted in ranges, and numbered from the counts of the ranges before theirs. Rows that agree in
    `order` are told apart by their place in the written table, so many of them are many ranges.
    """
    written = held(nodes, "merkle-nodes")
    place = written.metadataColumn("_metadata")
    rows = written.withColumn("tie", F.xxhash64(place["file_path"], place["row_index"]))
    keys = ["tree", *order, "tie"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    ranged = held(ranged.drop("tie"), "merkle-sorted").withColumn("run", F.shiftright("at", 33))
    counted = ranged.groupBy("tree", "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = counted.select(
        "tree", "run", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"), F.sum("rows").over(tree).alias("n")
    )
    joined = lookup_join(ranged, hold(runs, "merkle-runs"), {"tree": "tree", "run": "run"}, salt_by=["at"])
    return joined.withColumn("pos", F.expr("at - first + base")).drop("at", "run", "first", "base")


def _built(digests: pd.Series, heights: pd.Series) -> pd.Series:
    return pd.Series([Block.of(d, h).nodes for d, h in zip(digests, heights, strict=True)])


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Rows (tree, n, block, height, size, nodes, items) of nodes (tree, n, pos, node, item)."""
    in_block = F.sort_array(F.collect_list(F.struct("pos", "node", "item")))
    grouped = nodes.groupBy("tree", "n", F.shiftright("pos", height).alias("block")).agg(in_block.alias("rows"))
    # the last block of a tree is as low as its nodes allow: (n - 1) in binary has so many digits
    low = F.expr(f"CASE WHEN n > {1 << height} THEN {height} WHEN n > 1 THEN length(bin(n - 1)) ELSE 0 END")
    return grouped.select(
        "tree",
        "n",
        "block",
        low.alias("height"),
        F.size("rows").alias("size"),
        F.array_join("rows.node", "").alias("digests"),
        F.col("rows.item").alias("items"),
    ).select("tree", "n", "block", "height", "size", F.pandas_udf(_built, "string")("digests", "height").alias("nodes"), "items")


@dataclass(frozen=True)
class Forest:
    """Trees as tables of blocks, one per level of blocks from the leaves up, and (tree, root)."""

    levels: list[DataFrame]
    roots: DataFrame


def build_forest(nodes: DataFrame, height: int = HEIGHT) -> Forest:
    """The trees over `nodes` (tree, n, pos, node, item); item is what the leaf stands for, of any type."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots, many = [], [], 1 << height
    while largest:
        blocks = held(_blocks(nodes, height), "merkle-blocks")
        levels.append(blocks)
        root = F.substring("nodes", 1, WIDTH)
        roots.append(blocks.where(F.col("n") <= many).select("tree", root.alias("root")))
        nodes = blocks.where(F.col("n") > many).select(
            "tree", F.expr(f"(n + {many - 1}) DIV {many}").alias("n"), F.col("block").alias("pos"), root.alias("node"), F.lit(None).cast("int").alias("item")
        )
        largest = -(-largest // many) if largest > many else 0
    found = roots[0] if roots else nodes.select("tree", F.col("node").alias("root"))
    for more in roots[1:]:
        found = found.unionByName(more)
    return Forest(levels, found)


_PATH = "tree string, pos bigint, path string, root string"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every node under a block the steps from it to the root of all."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            block = Block(r["nodes"], r["height"], r["size"])
            first = r["block"] << r["height"]  # a block beside others is of full height
            out += [(r["tree"], first + i, "".join(block.steps(i)) + r["path"], r["root"]) for i in range(block.size)]
        yield _batch(out, ("tree", pa.string()), ("pos", pa.int64()), ("path", pa.string()), ("root", pa.string()))


def _batch(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def leaf_blocks(forest: Forest, tops: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The blocks of the leaves with `path`, the steps from the block's root to the root of all, and `root`,
    that of their tree. `tops` (tree, path, root) has the steps above each tree."""
    tops = hold(tops, "merkle-tops")
    above, found = None, None
    for blocks in reversed(forest.levels):
        last = F.col("n") <= (1 << height)
        found = lookup_join(blocks.where(last), tops, {"tree": "tree"}, how="inner", salt_by=["block"])
        if above is not None:
            over = hold(above.withColumnRenamed("pos", "block"), "merkle-paths")
            inner = lookup_join(blocks.where(~last), over, {"tree": "tree", "block": "block"}, how="inner", salt_by=["block"])
            found = found.unionByName(inner.select(*found.columns))
        above = found.drop("items").mapInArrow(_paths, _PATH)
    return found


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, node, forged): each row's digest, and that of the row tampered with, where it is."""
    one_more = (docs["n_chars"].cast("decimal(20,0)") + 1).cast("decimal(20,0)")

    def leaf(n_chars: Column) -> Column:
        fields = [_field(c) for c in (docs["doc_id"], docs["source"], docs["lang"], n_chars, docs["text"])]
        return F.sha2(F.concat(*fields).cast("binary"), 256)

    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % TAMPERED_OF == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), docs["lang"].cast("string")), F.lit("")).alias("tree"),  # null before all others
        docs["doc_id"].cast("bigint").alias("doc_id"),
        leaf(docs["n_chars"]).alias("node"),
        F.when(tampered & docs["n_chars"].isNotNull(), leaf(one_more)).alias("forged"),
    )


@dataclass(frozen=True)
class Manifest:
    """Trees of the languages (item: doc_id, forged), the tree over them (item: language), and the root of all."""

    languages: Forest
    top: Forest
    root: str | None
    height: int


def build_manifest(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    rows = positioned(leaves(docs), ["doc_id", "node"])
    languages = build_forest(rows.select("tree", "n", "pos", "node", F.struct("doc_id", "forged").alias("item")), height)
    subroots = languages.roots.select(F.lit("").alias("tree"), F.col("tree").alias("language"), F.col("root").alias("node"))
    over = positioned(subroots, ["language"])
    top = build_forest(over.select("tree", "n", "pos", "node", F.col("language").alias("item")), height)
    first = top.roots.first()
    return Manifest(languages, top, first.root if first else None, height)


def _language_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            block = Block(r["nodes"], r["height"], r["size"])
            out += [(name, "".join(block.steps(i)) + r["path"], block.leaf(i)) for i, name in enumerate(r["items"])]
        yield _batch(out, ("tree", pa.string()), ("path", pa.string()), ("root", pa.string()))


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            block, above = Block(r["nodes"], r["height"], r["size"]), split_steps(r["path"])
            beyond = "".join(s[1:] for s in above)
            roots: dict[str, str] = {}  # where the roots that leaves of this block lead to lead on to
            for i, item in enumerate(r["items"]):
                steps = block.steps(i)
                here = fold(item["forged"] or block.leaf(i), steps)
                if here not in roots:
                    roots[here] = fold(here, above)
                siblings = "".join(s[1:] for s in steps) + beyond
                out.append((item["doc_id"], block.leaf(i), r["root"], siblings, roots[here]))
        yield _batch(
            out, ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("siblings", pa.string()), ("folded_root", pa.string())
        )


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, siblings, folded_root) per document: its siblings' digests from the leaf up, as one text."""
    spark = manifest.top.roots.sparkSession
    above_all = spark.createDataFrame([("", "", manifest.root)], "tree string, path string, root string")
    tops = leaf_blocks(manifest.top, above_all, manifest.height).mapInArrow(_language_steps, "tree string, path string, root string")
    blocks = leaf_blocks(manifest.languages, tops, manifest.height)
    return blocks.mapInArrow(_proofs, "doc_id bigint, leaf string, subroot string, siblings string, folded_root string")


def verified_documents(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of `docs` (doc_id, source, lang, n_chars, text).

    Any column may be null (its field is then `-`), texts may be empty or of any length. Rows without a
    language form the first tree, rows without a doc_id come first in theirs. Rows that share a doc_id are
    ordered by their digest; equal rows have equal digests and each is a leaf. A row is tampered with where
    the CRC-32 of its doc_id is a multiple of seven, so never without one. An empty table has no root and
    gives an empty result; other columns are not looked at.
    """
    manifest = build_manifest(docs, height)
    if manifest.root is None:
        empty = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], empty)
    found = proofs(manifest)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(manifest.root).alias("root"),
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == manifest.root).alias("verified"),
    )
