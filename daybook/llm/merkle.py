"""Operator 11: a Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf: the hash of its fields. The leaves of a group (here: a language) ascend by key; every
`FANOUT` consecutive nodes, in the last run maybe fewer, become their hash, until one node is left: the
group's root. The groups' roots, in order, are the leaves of one more tree, whose root names the dataset.
A row's proof is the siblings of its path.

The tree isn't climbed and descended again. Leaves lie in aligned blocks of FANOUT ** `BLOCK_LEVELS`. A task
hashes the subtrees of its blocks; then the blocks swap: in round r the blocks whose numbers differ in the
r-th digit (base FANOUT) alone send one another the root of their subtree of that round, and every one hashes
the parent for itself. After the last round each block has the siblings of all its ancestors, so the proofs of its
leaves are complete, and no node was ever sent down. (In a last run, which has fewer blocks, each block serves
several partners.) A round shuffles one small row for each block and partner; a block holds FANOUT **
BLOCK_LEVELS leaves at most, however large its group is.

Ranks come from one range-partitioned sort by group and key, written once, and a running count over its
partitions; a group that holds most rows lies in most partitions. Nothing is collected but the number of
blocks of the largest group.

Nulls: a null field is written as `-`; null groups are a group of their own, the first one; null keys come
first. Empty texts are values of length 0; texts of any length are hashed whole. Rows with equal keys lie in
the order of their leaf hashes, equal rows are leaves each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

FANOUT = 8
BLOCK_LEVELS = 4
#: What crc32 of the decimal doc_id must be divisible by for a row to be tampered with in `verified`.
TAMPERED = 3


@dataclass(frozen=True)
class Shape:
    """Of a tree: children of a node, and levels that a task climbs in its blocks."""

    fanout: int = FANOUT
    levels: int = BLOCK_LEVELS

    @property
    def block(self) -> int:
        return self.fanout ** self.levels

    def parents(self, nodes: list[str]) -> list[str]:
        return [hashlib.sha256("".join(nodes[k:k + self.fanout]).encode()).hexdigest() for k in range(0, len(nodes), self.fanout)]

    def climbed(self, nodes: list[str], whole: bool) -> list[list[str]]:
        """The levels of a block's tree, its nodes first: up to one node if the block is the whole tree, else up
        to the level that all blocks reach (a node alone becomes its own hash)."""
        out = [nodes]
        while len(out) <= self.levels and (not whole or len(out[-1]) > 1):
            out.append(self.parents(out[-1]))
        return out


def digest(parts: Column) -> Column:
    """Lowercase hex sha256 of a string."""
    return F.sha2(parts, 256)


def field(col: Column) -> Column:
    """`-` for a null, else the UTF-8 byte count, `:` and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(cols: list[Column]) -> Column:
    return digest(F.concat(*map(field, cols)))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(leaves: DataFrame) -> DataFrame:
    """leaves (grp, key, leaf, ...) with `rank`, the place in the group's order from 0, and `n`, its size."""
    rows = leaves.repartitionByRange("grp", "key", "leaf").sortWithinPartitions("grp", "key", "leaf")
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "leaves")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("grp", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    # a row for each partition and group in it
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("grp", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(Window.partitionBy("grp")).alias("n"))
    runs = runs.withColumnsRenamed({"grp": "_grp", "_part": "_own"})
    met = rows.join(runs, rows["_part"].eqNullSafe(runs["_own"]) & rows["grp"].eqNullSafe(runs["_grp"]))
    return met.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_at", "_part", "_own", "_grp", "_first", "_before")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows with `grp`, `block` and `rank` dealt by block, a block's rows together and in order."""
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "rank")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block; only one block's rows are held."""
    rows = (r for b in batches for r in b.to_pylist())
    for _, own in groupby(rows, key=lambda r: (r["grp"], r["block"])):
        yield list(own)


def block_roots(rows: DataFrame, shape: Shape) -> DataFrame:
    """grp, block, n_blocks, node: the root of each block's subtree."""
    size = shape.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _by_block(batches):
            n_blocks = -(-own[0]["n"] // size)
            top = shape.climbed([r["leaf"] for r in own], n_blocks == 1)[-1][0]
            yield pa.RecordBatch.from_pydict({
                "grp": pa.array([own[0]["grp"]], pa.string()), "block": pa.array([own[0]["block"]], pa.int64()),
                "n_blocks": pa.array([n_blocks], pa.int64()), "node": pa.array([top], pa.string())})

    own = rows.select("grp", F.floor(F.col("rank") / size).alias("block"), "rank", "n", "leaf")
    return _in_blocks(own).mapInArrow(run, "grp string, block long, n_blocks long, node string")


def _round(blocks: DataFrame, fanout: int, r: int) -> DataFrame:
    """One exchange. Every block has `node`, the root of its subtree of fanout ** r blocks; it gets the roots
    of its siblings there, appends them to its path, and hashes the parent."""
    width = fanout ** r
    n, block = F.col("n_blocks"), F.col("block")
    going_on = n > width  # a smaller group's tree has ended
    run = F.floor(block / width)
    held = F.least(F.lit(width), n - run * width)  # blocks under this node
    last = F.ceil(n / width) - 1
    first = F.floor(run / fanout) * fanout
    siblings = F.when(going_on, F.sequence(first, F.least(first + fanout - 1, last))).otherwise(F.array(run))

    def partners(sibling: Column) -> Column:
        """The blocks under `sibling` that this block sends its node to: those in its own place,
        and, if few blocks are under its node, those that many places further."""
        theirs = F.least(F.lit(width), n - sibling * width)
        low = block - run * width
        return F.when(sibling == run, F.array(block)).when(
            low < theirs, F.transform(F.sequence(low, theirs - 1, held), lambda x: sibling * width + x)).otherwise(
            F.array().cast("array<bigint>"))

    sent = blocks.select("grp", "n_blocks", run.alias("run"), "node", "block", "lefts", "rights",
                         F.explode(F.flatten(F.transform(siblings, partners))).alias("to"))
    mine = F.col("block") == F.col("to")  # a block's own path stays with it
    got = sent.groupBy("grp", "to").agg(
        F.first("n_blocks").alias("n_blocks"), F.array_sort(F.collect_list(F.struct("run", "node"))).alias("nodes"),
        F.max(F.when(mine, F.struct("run", "node", "lefts", "rights"))).alias("own"))
    left = F.concat_ws("", F.transform(F.filter("nodes", lambda x: x["run"] < F.col("own.run")), lambda x: x["node"]))
    right = F.concat_ws("", F.transform(F.filter("nodes", lambda x: x["run"] > F.col("own.run")), lambda x: x["node"]))
    whole = F.concat_ws("", F.transform("nodes", lambda x: x["node"]))
    on = F.col("n_blocks") > width
    return got.select(
        "grp", F.col("to").alias("block"), "n_blocks", F.when(on, digest(whole)).otherwise(F.col("own.node")).alias("node"),
        F.when(on, F.concat("own.lefts", F.array(left))).otherwise(F.col("own.lefts")).alias("lefts"),
        F.when(on, F.concat("own.rights", F.array(right))).otherwise(F.col("own.rights")).alias("rights"))


def butterfly(roots: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """grp, block, n_blocks, node (the group's root), and the path from the block's root up to it."""
    none = F.array().cast("array<string>")
    blocks = written(roots.withColumns({"lefts": none, "rights": none}), "blocks")
    most = blocks.agg(F.max("n_blocks")).first()[0] or 0
    r = 0
    while fanout ** r < most:
        blocks = written(_round(blocks, fanout, r), "blocks")
        r += 1
    return blocks


def _paths(rows: list[dict], upper: dict, shape: Shape) -> Iterator[tuple[list[str], list[str]]]:
    """(lefts, rights) of each leaf of a block, from the leaves up to the tree's root."""
    levels = shape.climbed([r["leaf"] for r in rows], not upper["more"])
    siblings: list[list[tuple[str, str]]] = []
    for nodes in levels[:-1]:
        own = []
        for k in range(0, len(nodes), shape.fanout):
            run = nodes[k:k + shape.fanout]
            own += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        siblings.append(own)
    for i in range(len(rows)):
        path, at = [], i
        for own in siblings:
            path.append(own[at])
            at //= shape.fanout
        yield ([x for x, _ in path] + upper["lefts"], [x for _, x in path] + upper["rights"])


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and the siblings of its path give."""
    for a, b in zip(lefts, rights, strict=True):
        node = hashlib.sha256(f"{a}{node}{b}".encode()).hexdigest()
    return node


def with_paths(rows: DataFrame, blocks: DataFrame, shape: Shape, use: Callable[[dict, list[str], list[str], dict], tuple],
               schema: str, carry: tuple[str, ...]) -> DataFrame:
    """use(row, lefts, rights, block's row) for every leaf, with the whole path to the root that `blocks`
    lead to; the results as rows of `schema`. A block's path travels as a row ahead of its leaves."""
    own = rows.select("grp", F.floor(F.col("rank") / shape.block).alias("block"), "rank", "leaf", *carry)
    heads = blocks.select("grp", "block", F.lit(-1).cast("long").alias("rank"), "node", "lefts", "rights",
                          (F.col("n_blocks") > 1).alias("more"))
    both = _in_blocks(own.unionByName(heads, allowMissingColumns=True))
    columns = [x.split() for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, *leaves in _by_block(batches):
            out = [use(row, lefts, rights, head) for row, (lefts, rights) in zip(leaves, _paths(leaves, head, shape), strict=True)]
            yield pa.RecordBatch.from_pydict({name: pa.array(x, kinds[kind]) for x, (name, kind) in
                                              zip(zip(*out, strict=True), columns, strict=True)})

    return both.mapInArrow(run, schema)


def _dataset_paths(blocks: DataFrame, shape: Shape) -> DataFrame:
    """`blocks` whose paths go on from their group's root to the dataset's, which becomes their node."""
    tops = blocks.where("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("node").alias("leaf"))
    rows = written(ranked(tops), "groups")
    upper = butterfly(block_roots(rows, shape), shape.fanout)
    paths = with_paths(rows, upper, shape, lambda row, lefts, rights, head: (row["key"], head["node"], lefts, rights),
                       "key string, root string, lefts array<string>, rights array<string>", ("key",))
    paths = paths.select(F.col("key").alias("_key"), "root", F.col("lefts").alias("_lefts"), F.col("rights").alias("_rights"))
    met = blocks.join(paths, F.col("grp").eqNullSafe(F.col("_key")))
    return met.select("grp", "block", "n_blocks", F.concat("lefts", "_lefts").alias("lefts"),
                      F.concat("rights", "_rights").alias("rights"), F.col("node").alias("subroot"), F.col("root").alias("node"))


def manifest(docs: DataFrame, *, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id",
             group: str = "lang", check: dict[str, Column] | None = None, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """key (long), leaf, subroot, root, proof_sha256 (of all siblings of the path) for every row, and
    folded_root, verified: the root that the row as given by `check` (columns to put in the place of fields; none: the
    row itself) leads to with the same siblings, and whether it is the dataset's."""
    check = check or {}
    now = leaf([F.col(c) for c in fields])
    given = leaf([check.get(c, F.col(c)) for c in fields])
    leaves = docs.select(F.col(group).cast("string").alias("grp"), F.col(key).cast("long").alias("key"), now.alias("leaf"),
                         given.alias("given"))
    rows = written(ranked(leaves), "ranked")
    blocks = _dataset_paths(butterfly(block_roots(rows, shape), shape.fanout), shape)
    heads = blocks.withColumn("node", F.concat_ws(",", "subroot", "node")).drop("subroot")

    def prove(row: dict, lefts: list[str], rights: list[str], head: dict) -> tuple:
        subroot, root = head["node"].split(",")
        proof = hashlib.sha256("".join([x for pair in zip(lefts, rights, strict=True) for x in pair]).encode()).hexdigest()
        folded = fold(row["given"], lefts, rights)
        return row["key"], row["leaf"], subroot, root, proof, folded, folded == root

    out = with_paths(rows, heads, shape, prove, "key long, leaf string, subroot string, root string, proof_sha256 string, "
                     "folded_root string, verified boolean", ("key", "given"))
    return out.withColumnRenamed("key", key)


def tampered(docs: DataFrame) -> dict[str, Column]:
    """Where TAMPERED divides crc32 of the decimal doc_id, the text with A-Z lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return {"text": F.when(hit, ascii_lower(F.col("text"))).otherwise(F.col("text"))}
