"""Shards by a hierarchical weighted hash tree, with DataFrame operations only.

A tree of regions, racks and shards; at each level every child draws
``-ln(u) / weight`` with u hashed from the document's id and the child's name, and
the least draw wins (so a child is chosen in proportion to its weight, and a
change of one weight moves rows only into or out of that child). A tree grows by
a region of one rack with one shard: no weight of an older subtree changes, so
rows move into the new shard alone.

Slots number a shard's rows without gaps. A shard's rows never meet in one task (see
``common.running``), nor do those of one doc_id (or of none): rows are spread by all that
is returned of them, and rows equal in that are counted map-side, numbered in blocks of
``BLOCK`` and only then written out again.

Defined results: the law is ``key``: doc_id and the tree decide, rows with equal or
with null doc_id share a shard; a null text counts no bytes (its crc32 is that of
no bytes); a text of any length is one row of three numbers; repeated rows have a slot each;
reruns agree; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, running

SEED, OVERHEAD = 7, 16
RACKS_PER_REGION, SHARDS_PER_RACK = 2, 4
#: Equal rows that are numbered together.
BLOCK = 4096


@dataclass(frozen=True)
class Tree:
    """regions: for each region its racks, for each rack its shards' (number, weight)."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def of(cls, shards: int, racks: int = RACKS_PER_REGION, per_rack: int = SHARDS_PER_RACK) -> Tree:
        numbers = [(i, 1.0) for i in range(shards)]
        rack = [tuple(numbers[i : i + per_rack]) for i in range(0, shards, per_rack)]
        return cls(tuple(tuple(rack[i : i + racks]) for i in range(0, len(rack), racks)))

    def size(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> Tree:
        return Tree((*self.regions, (((self.size(), weight),),)))

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """For each inner node its children and their weights; shards are named s<number>."""
        out: dict[str, list[tuple[str, float]]] = {"": []}
        for i, region in enumerate(self.regions):
            out[""].append((f"r{i}", sum(w for rack in region for _, w in rack)))
            out[f"r{i}"] = []
            for j, rack in enumerate(region):
                out[f"r{i}"].append((f"r{i}.{j}", sum(w for _, w in rack)))
                out[f"r{i}.{j}"] = [(f"s{n}", w) for n, w in rack]
        return out


def draw(tree: Tree, doc_id: F.Column) -> F.Column:
    """The number of the shard that the descent from the root ends in."""
    nodes = F.create_map(*[
        x for name, kids in tree.children().items()
        for x in (F.lit(name), F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(w)).alias("weight")) for k, w in kids]))])

    def pick(parent: F.Column) -> F.Column:
        def one(child: F.Column) -> F.Column:
            u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), doc_id, child["name"]), 11) + 0.5) / float(1 << 53)
            return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))
        return F.array_min(F.transform(F.element_at(nodes, parent), one))["name"]

    return F.substring(pick(pick(pick(F.lit("")))), 2, 9).cast("int")


def shard(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    row = ["doc_id", "size", "text_crc32"]
    blocks = d.groupBy(*row).agg(F.count("*").alias("_n")).withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BLOCK).cast("long"))))
    blocks = keep(blocks.withColumn("_n", F.least(F.col("_n") - F.col("_at"), F.lit(BLOCK).cast("long"))))
    blocks = running(blocks.withColumn("shard", draw(tree, F.col("doc_id"))), "shard", [*row, "_at"], "_n", "_first")
    blocks = blocks.withColumn("grown_shard", draw(tree.grown(), F.col("doc_id")))
    d = blocks.withColumn("slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)))
    return d.select(*row, F.lit("key").alias("law"), "shard", "slot", "grown_shard")
