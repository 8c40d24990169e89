"""Iterative link ranking (PageRank) on an edge DataFrame.

Semantics kept by default (undamped, no teleport): the initial vector
gives 1/N to each of the N pages that have out-links; each round every
page sends rank/out_degree to each distinct out-neighbour, and the new
vector holds exactly the pages that received something. Pages without
in-links vanish after round 1; sinks receive rank and lose it next round.
With ``damping=b`` a received page gets (1-b)/N + b * sum.

Scale design
------------
* Edges are deduplicated once, kept until their degrees are counted, and
  joined with the out-degree once; the weighted edge table is
  loop-invariant, hash-partitioned on ``(src, salt)`` (without hubs: on
  ``src``) and cached, so rounds never reshuffle edges.
* Hub pages are salted: the edges of a page with d > ``edges_per_slice``
  out-links are spread over ``ceil(d / edges_per_slice)`` salts by a hash of
  the destination, so one page's edges never form one task. The hub table
  (at most edges / edges_per_slice rows) is joined to the edges at build and
  to the rank vector in each round; other pages have salt 0. A graph
  without hubs has no salts and none of these joins.
* A round is: ranks x hub table -> join with the cached, co-partitioned
  edges -> partial and final sum by destination. Hot destinations are
  combined map-side.
* Every ``checkpoint_every`` rounds the vector is written to the reliable
  checkpoint folder, which bounds plan size and recomputation after an
  executor loss.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

EDGES_PER_SLICE = 200_000


def distinct_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct (src, dst); self-links stay."""
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    """(src, out_degree) over distinct edges."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def initial_ranks(degrees: DataFrame, n_pages: int) -> DataFrame:
    """P5: 1/N for each page with out-links."""
    return degrees.select(F.col("src").alias("id"), (F.lit(1.0) / F.lit(float(n_pages))).alias("rank"))


def contributions(weighted: DataFrame, ranks: DataFrame) -> DataFrame:
    """P6+P7: (src, dst, contribution) for every edge of a ranked page."""
    r = ranks.select(F.col("id").alias("src"), "rank")
    return weighted.join(r, "src").select("src", "dst", (F.col("rank") / F.col("out_degree")).alias("contribution"))


@dataclass
class LinkGraph:
    """Loop-invariant side of the iteration, built once when it is first asked for, and cached."""

    edges: DataFrame
    edges_per_slice: int = EDGES_PER_SLICE
    partitions: int | None = None

    @cached_property
    def nodes(self) -> DataFrame:
        """(src, out_degree): one row per page with out-links, kept; the edge build, the hub table and the initial vector read it."""
        return out_degree(self.edges).cache()

    @cached_property
    def n_pages(self) -> int:
        """Pages with out-links = rows of the cached per-page table."""
        return self.nodes.count()

    @cached_property
    def hubs(self) -> DataFrame:
        """(src, n_salt) of the pages with more than ``edges_per_slice`` out-links, so at most edges / edges_per_slice rows,
        which make a table of known size: its joins need not shuffle the other side."""
        n_salt = F.ceil(F.col("out_degree") / F.lit(float(self.edges_per_slice))).cast("int")
        found = self.nodes.withColumn("n_salt", n_salt).filter("n_salt > 1").select("src", "n_salt")
        return self.edges.sparkSession.createDataFrame(found.collect(), found.schema)

    @cached_property
    def _keys(self) -> list[str]:
        """What edges are dealt by: a graph without hubs needs no salts."""
        return ["src", "salt"] if self.hubs.take(1) else ["src"]

    @cached_property
    def weighted(self) -> DataFrame:
        """(src, dst, salt, out_degree), the salt where there are hubs."""
        # the distinct edges are computed once for the degrees and for this table, and let go when it stands
        known = self.edges.storageLevel
        given = known.useMemory or known.useDisk
        kept = self.edges if given else self.edges.cache()
        parts = self.partitions or int(self.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        e = kept.select("src", "dst")
        if "salt" in self._keys:
            salt = F.pmod(F.xxhash64("dst"), F.coalesce("n_salt", F.lit(1))).cast("int")
            e = e.join(self.hubs, "src", "left").select("src", "dst", salt.alias("salt"))
        degrees = self._salted(self.nodes.select("src", F.col("out_degree").cast("double").alias("out_degree")))
        w = e.repartition(parts, *self._keys).join(degrees, self._keys).cache()
        if not given:
            w.count()
            kept.unpersist()
        return w

    def _salted(self, pages: DataFrame) -> DataFrame:
        """One row of ``pages`` (src, ...) for each salt of its page."""
        if "salt" not in self._keys:
            return pages
        salts = F.sequence(F.lit(0), F.coalesce("n_salt", F.lit(1)) - 1)
        return pages.join(self.hubs, "src", "left").withColumn("salt", F.explode(salts)).drop("n_salt")

    def unpersist(self) -> None:
        """Release the cached tables (after the result has been used)."""
        for name in ("weighted", "nodes"):
            if name in self.__dict__:
                self.__dict__[name].unpersist()

    def initial(self) -> DataFrame:
        """Initial vector: (id, rank)."""
        return initial_ranks(self.nodes, self.n_pages)

    def step(self, ranks: DataFrame, damping: float | None = None) -> DataFrame:
        """One round: (id, rank) -> (id, rank)."""
        weighted = self.weighted
        salted = self._salted(ranks.select(F.col("id").alias("src"), "rank"))
        joined = weighted.join(salted, self._keys)
        got = joined.groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") / F.col("out_degree")).alias("rank"))
        if damping is not None:
            b = float(damping)
            got = got.select("id", (F.lit((1.0 - b) / self.n_pages) + F.lit(b) * F.col("rank")).alias("rank"))
        return got

    def run(self, iterations: int = 10, damping: float | None = None,
            checkpoint_every: int = 2) -> DataFrame:
        """Fixed number of rounds, no convergence test; (id, rank)."""
        if iterations > 0:
            self.weighted  # first: it keeps the edges while the degrees are counted
        r = self.initial()
        for i in range(1, iterations + 1):
            r = self.step(r, damping)
            if checkpoint_every and i % checkpoint_every == 0 and i < iterations:
                r = cut_lineage(r)
        return r


def pagerank(edges: DataFrame, iterations: int = 10, damping: float | None = None,
             src: str = "src", dst: str = "dst", checkpoint_every: int = 2) -> DataFrame:
    """P2-P10 end to end: (id, rank) after ``iterations`` rounds."""
    g = LinkGraph(distinct_edges(edges, src, dst))
    return g.run(iterations, damping, checkpoint_every)
