"""A Merkle manifest of a dataset, with versions for tampered rows.

Every row is a leaf: a SHA-256 of its columns. In each group (the source) the leaves
stand in the order of their id, and every ``FANOUT`` consecutive nodes hash to one above
until a single one, the subroot, is left; the subroots, in the order of their groups,
are hashed up to the root in the same way.

No group meets in one task. Positions come from a sort by range; runs of ``FANOUT ** levels``
consecutive leaves are aligned blocks, and each block is a
subtree of its own that one task builds. The block roots are the leaves of the next round,
so a group of n leaves takes log(n) / levels rounds.

A block is a persistent tree: tampering with a leaf makes a version of it that shares
all untouched nodes and copies the leaf's ancestors only. Above the block the
version goes on, distributed: each block knows the siblings on its way to the root
(found once for the block, not for each version), and each version folds its own hash up
along them. A leaf's proof is the hash of all its siblings, level by level to the root.

Defined results: a null in a column is ``-`` in the leaf; null groups come first, null
ids first in their group; rows of one id in a group stand in the order of their leaf
hashes, and rows equal in all columns one after the other; a null or empty text cannot be
tampered with; texts of any length are hashed whole, by Spark; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, ranked

FANOUT = 3
#: Levels that one task builds: blocks of FANOUT ** LEVELS leaves.
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ a persistent tree


class Tree:
    """The nodes of a block, level by level from its leaves; ``levels`` is how far it is hashed up."""

    def __init__(self, leaves: list[str], levels: int):
        self.rows = [leaves]
        for _ in range(levels):
            below = self.rows[-1]
            self.rows.append([h(*below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])

    def node(self, level: int, at: int) -> str:
        return self.rows[level][at]

    @property
    def top(self) -> int:
        return len(self.rows) - 1

    def root(self) -> str:
        return self.node(self.top, 0)

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """For each level what stands to the left and to the right of the leaf's ancestor in its run."""
        out = []
        for level in range(self.top):
            first = at - at % FANOUT
            last = min(first + FANOUT, len(self.rows[level]))
            out.append(("".join(self.rows[level][first:at]), "".join(self.rows[level][at + 1 : last])))
            at //= FANOUT
        return out

    def version(self, at: int, leaf: str) -> Version:
        return Version(self, at, leaf)


class Version:
    """A tree with one leaf replaced: copies of the leaf's ancestors, all else shared with ``base``."""

    def __init__(self, base: Tree, at: int, leaf: str):
        self.base, self.copied = base, {(0, at): leaf}
        for level in range(base.top):
            first = at - at % FANOUT
            last = min(first + FANOUT, len(base.rows[level]))
            above = h(*(self.node(level, i) for i in range(first, last)))
            at //= FANOUT
            self.copied[level + 1, at] = above

    def node(self, level: int, at: int) -> str:
        return self.copied.get((level, at)) or self.base.node(level, at)

    def root(self) -> str:
        return self.node(self.base.top, 0)


# ------------------------------------------------------------------ leaves


def _part(value: F.Column) -> F.Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, F.Column]) -> F.Column:
    return F.sha2(F.concat(*[_part(columns[c]) for c in COLUMNS]), 256)


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, id, leaf, ...) with ``grp_rank`` (its group's place), ``pos`` (in the group, from 0) and ``n`` (the group's size).

    Sorted by range, so a group may lie in many partitions and is never in one task."""
    order = [F.col("grp").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("at")]
    d = leaves.withColumn("at", F.monotonically_increasing_id())
    d = keep(d.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    sums = d.groupBy("part", "grp").agg(F.count("*").alias("_n"))  # rows: partitions and groups together
    groups = ranked(keep(sums.groupBy("grp").agg(F.sum("_n").alias("n"))), [F.col("grp").asc_nulls_first()], "grp_rank")
    groups = keep(groups.withColumnRenamed("grp", "_g"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    sums = sums.join(groups, F.col("grp").eqNullSafe(F.col("_g"))).select(F.col("part").alias("_part"), "_g", "grp_rank", "n", "_before")
    d = d.join(keep(sums), (F.col("part") == F.col("_part")) & F.col("grp").eqNullSafe(F.col("_g")))
    inside = F.row_number().over(Window.partitionBy("part", "grp").orderBy(*order)) - 1
    return d.withColumn("pos", F.col("_before") + inside).drop("part", "_part", "_g", "_before", "at")


# ------------------------------------------------------------------ rounds

_SIBLINGS = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
PATH = "array<struct<l:string,r:string>>"


def _tree(t: pa.Table, levels: int) -> tuple[pa.Table, Tree]:
    """A block's rows by position, and its tree: hashed up as long as several nodes of its group remain, at most ``levels``."""
    t, n, up = t.sort_by("pos"), t.column("n")[0].as_py(), 0
    while n > 1 and up < levels:
        n, up = -(-n // FANOUT), up + 1
    return t, Tree(t.column("node").to_pylist(), up)


def _roots(levels: int):
    def run(t: pa.Table) -> pa.Table:
        t, tree = _tree(t, levels)
        left = -(-t.column("n")[0].as_py() // FANOUT**tree.top)
        return pa.table({"tree": t.column("tree")[:1], "pos": t.column("block")[:1], "node": pa.array([tree.root()]), "n": pa.array([left], pa.int64())})

    return run


def _paths(levels: int):
    """Siblings of each node of a block up to the end of its tree."""

    def run(t: pa.Table, above: pa.Table) -> pa.Table:
        t, tree = _tree(t, levels)
        up, top = above.column("path")[0].as_py(), above.column("top")[0].as_py()
        path = [[*({"l": l, "r": r} for l, r in tree.siblings(k)), *up] for k in range(t.num_rows)]
        return pa.table({"tree": t.column("tree"), "pos": t.column("pos"), "path": pa.array(path, _SIBLINGS), "top": pa.array([top] * t.num_rows)})

    return run


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**levels))


def block_roots(blocks: DataFrame, levels: int) -> DataFrame:
    """The roots of the blocks of ``blocks`` (tree, block, pos, node, n), which are the next round's nodes."""
    rows = blocks.select("tree", "block", "pos", "node", "n")
    return keep(rows.groupBy("tree", "block").applyInArrow(_roots(levels), "tree long, pos long, node string, n long"))


def climb(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """For each node (tree, pos, node, n) its way up: ``path`` (siblings left and right of each level) and ``top``, the tree's root."""
    if nodes.filter("n > 1").isEmpty():
        return nodes.select("tree", "pos", F.array().cast(PATH).alias("path"), F.col("node").alias("top"))
    blocks = _blocks(nodes, levels)
    up = keep(climb(block_roots(blocks, levels), levels)).withColumnRenamed("pos", "block")  # every block has its root there
    return blocks.groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(_paths(levels), f"tree long, pos long, path {PATH}, top string")


# ------------------------------------------------------------------ the operator


def _proofs(levels: int):
    """Proofs of a block's leaves, and versions of it folded up to the root."""

    def run(t: pa.Table, above: pa.Table) -> pa.Table:
        t, tree = _tree(t, levels)
        up = above.column("path")[0].as_py()
        last = "".join(s["l"] + s["r"] for s in up)
        root, subroot = above.column("root")[0].as_py(), above.column("subroot")[0].as_py()
        proofs, folded = [], []
        for k, tampered in enumerate(t.column("tampered").to_pylist()):
            proofs.append(h(*(l + r for l, r in tree.siblings(k)), last))
            node = (tree.version(k, tampered) if tampered is not None else tree).root()
            for s in up:
                node = h(s["l"], node, s["r"])
            folded.append(node)
        return pa.table({"doc_id": t.column("doc_id"), "leaf": t.column("node"), "subroot": pa.array([subroot] * len(proofs)), "root": pa.array([root] * len(proofs)),
                         "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded), "verified": pa.array([f == root for f in folded])})

    return run


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, tampered: F.Column, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row.

    ``tampered``: the text that the row's version has instead of its own, null for no version.
    """
    columns = {c: F.col(c) for c in COLUMNS}
    version = F.when(tampered.isNotNull(), leaf_hash({**columns, "text": tampered}))
    leaves = docs.select(F.col("source").alias("grp"), F.col("doc_id").cast("long").alias("id"), leaf_hash(columns).alias("leaf"), version.alias("tampered"))
    d = positions(leaves).select(F.col("grp_rank").alias("tree"), "pos", F.col("id").alias("doc_id"), F.col("leaf").alias("node"), "tampered", "n")
    d = keep(_blocks(d, levels))

    up = keep(climb(block_roots(d, levels), levels))  # per block: to its group's subroot
    # the subroots are the leaves of one more tree, in the order of the groups
    sub = keep(up.groupBy("tree").agg(F.first("top").alias("node")))
    trees = keep(climb(sub.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "node", F.lit(sub.count()).cast("long").alias("n")), levels))
    trees = trees.select(F.col("pos").alias("tree"), F.col("path").alias("last"), F.col("top").alias("root"))
    up = keep(up.join(trees, "tree").select("tree", F.col("pos").alias("block"), F.concat("path", "last").alias("path"), F.col("top").alias("subroot"), "root"))
    return d.groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(_proofs(levels), OUT)


def without_newlines(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs``, where line feeds are deleted from the text of every row whose doc_id has an even crc32."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return manifest(docs, F.when(even, F.translate("text", "\n", "")), levels)
