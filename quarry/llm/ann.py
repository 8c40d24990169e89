"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

A tree of centroids is fitted on a bounded sample (``SAMPLE`` vectors chosen by a hash
of vec_id) and every vector is dealt to a leaf. A query walks the tree through a
priority queue: the node with the largest inner product of query and centroid
is opened next, and leaves are visited in the order in which they come up.

How many leaves is calibrated: for ``CALIBRATION`` queries (chosen by a hash) the true
nearest are found among all vectors, in one pass, and the visits are widened
until ``RECALL`` of them would have been met; every query visits at least as many leaves
as hold the wanted number of vectors. Leaves are cut into blocks of at most about
``BLOCK`` vectors; a task holds one block and the queries that visit it stream
past. Scores are exact inner products in double precision.

Each length of vectors has a tree and visits of its own, searched by the queries of that
length.

Defined results: vectors that are null, zero, hold null or non-finite components or have
a null vec_id take no part; with fewer candidates (of the query's length) than wanted a query has fewer rows; equal scores go by vec_id; of rows with equal
vec_id the least vector is the query, and none of them is its candidate; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep
from .vectors import kmeans, lengths, matrix, sample, square_distances, usable

SAMPLE, BRANCHES, DEPTH = 8192, 4, 3
CALIBRATION, RECALL = 128, 0.97
BLOCK, QUERIES = 8192, 128


@dataclass
class Node:
    centre: np.ndarray
    children: list[Node]
    leaf: int = -1


class Tree:
    def __init__(self, x: np.ndarray, branches: int = BRANCHES, depth: int = DEPTH, seed: int = 8):
        self.g, self.leaves = np.random.default_rng(seed), 0
        self.root = self._grow(x, branches, depth)

    def _grow(self, x, branches, depth) -> Node:
        node = Node(x.mean(axis=0), [])
        if depth and len(x) > branches:
            near = square_distances(x, centres := kmeans(x, branches, 10, self.g)).argmin(axis=1)
            parts = [x[near == k] for k in range(len(centres)) if (near == k).any()]
            if len(parts) > 1:
                node.children = [self._grow(p, branches, depth - 1) for p in parts]
                return node
        node.leaf, self.leaves = self.leaves, self.leaves + 1
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every level."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node.leaf >= 0:
                out[rows] = node.leaf
                continue
            near = square_distances(x[rows], np.array([c.centre for c in node.children])).argmin(axis=1)
            todo += [(c, rows[near == k]) for k, c in enumerate(node.children) if (near == k).any()]
        return out

    def order(self, query: np.ndarray):
        """Leaves as the priority queue brings them up."""
        n, queue = 0, [(-float(query @ self.root.centre), 0, self.root)]
        while queue:
            _, _, node = heapq.heappop(queue)
            if node.leaf >= 0:
                yield node.leaf
            for c in node.children:
                n += 1
                heapq.heappush(queue, (-float(query @ c.centre), n, c))

    def visits(self, query: np.ndarray, least: int, sizes: np.ndarray, wanted: int) -> list[int]:
        """The first ``least`` leaves, and more until they hold ``wanted`` vectors."""
        out, held = [], 0
        for leaf in self.order(query):
            if len(out) >= least and held >= wanted:
                break
            out.append(leaf)
            held += int(sizes[leaf])
        return out


def _nearest(q_ids, q, ids, x, k):
    """For each query its ``k`` best rows of x: query index, row, exact score."""
    q, x = q.astype(np.float64), x.astype(np.float64)
    score = q @ x.T
    score[q_ids[:, None] == ids] = -np.inf
    slack = 1e-9 * np.abs(q).sum(axis=1, keepdims=True) * np.abs(x).max(initial=0)
    if score.shape[1] > k:
        limit = np.partition(score, -k, axis=1)[:, -k, None] - slack
        i, j = np.nonzero((score >= limit) & (score > -np.inf))
    else:
        i, j = np.nonzero(score > -np.inf)
    parts = [(x[j[a : a + 50_000]] * q[i[a : a + 50_000]]).sum(axis=1) for a in range(0, len(i), 50_000)]
    s = np.concatenate(parts) if parts else np.zeros(0)
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    return i[nth < k], j[nth < k], s[nth < k]


def _leaves(tree):
    def run(batches):
        for batch in batches:
            leaf = tree.value.assign(matrix(batch.column(1)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    return run


def _visits(sent):
    def run(batches):
        tree, least, sizes, blocks, wanted = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                row, leaf, block = [], [], []
                for i, q in enumerate(matrix(part.column(1)).astype(np.float64)):
                    for v in tree.visits(q, least, sizes, wanted):
                        for b in range(int(blocks[v])):
                            row.append(i)
                            leaf.append(v)
                            block.append(b)
                out = part.take(pa.array(row, pa.int64()))
                n = len(row)
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(block, pa.int32()), pa.array(np.ones(n, np.int32)), *out.columns],
                                                 names=["leaf", "block", "role", "vec_id", "embedding"])

    return run


def _search(k: int):
    """Rows sorted by (leaf, block, role): a block's vectors, then the queries in turn."""

    def run(batches):
        now, ids, x = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [np.asarray(batch.column(c)) for c in range(3)]
            change = np.append(True, np.any([np.diff(c) != 0 for c in keys], axis=0))
            cut = np.append(np.flatnonzero(change), batch.num_rows).tolist()
            for a, b in zip(cut[:-1], cut[1:]):
                key, part = (keys[0][a], keys[1][a]), batch.slice(a, b - a)
                if key != now:
                    now, ids, x = key, [], []
                if keys[2][a] == 0:
                    ids.append(np.asarray(part.column(3)))
                    x.append(matrix(part.column(4)))
                    continue
                if not ids:
                    continue
                if len(ids) > 1:
                    ids, x = [np.concatenate(ids)], [np.concatenate(x)]
                for c in range(0, part.num_rows, QUERIES):
                    q_ids, q = np.asarray(part.column(3))[c : c + QUERIES], matrix(part.column(4).slice(c, QUERIES))
                    i, j, s = _nearest(q_ids, q, ids[0], x[0], k)
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(ids[0][j]), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _true_nearest(rows: DataFrame, queries: list, k: int) -> list:
    """The ``k`` nearest of a bounded list of queries among all rows, with their leaves."""
    q_ids, q = np.array([r[0] for r in queries]), np.array([r[1] for r in queries])
    sent = rows.sparkSession.sparkContext.broadcast((q_ids, q))

    def run(batches):
        q_ids, q = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                ids, leaf = np.asarray(part.column(0)), np.asarray(part.column(2))
                i, j, s = _nearest(q_ids, q, ids, matrix(part.column(1)), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(ids[j]), pa.array(s), pa.array(leaf[j])], names=["query_id", "vec_id", "score", "leaf"])

    return _best(rows.select("vec_id", "embedding", "leaf").mapInArrow(run, "query_id long, vec_id long, score double, leaf int"), k).collect()


def calibrate(tree: Tree, rows: DataFrame, queries: DataFrame, k: int, recall: float = RECALL) -> int:
    """Leaves to visit so that ``recall`` of the true nearest are met."""
    some = queries.orderBy(F.xxhash64(F.lit(18), "vec_id"), "vec_id").limit(CALIBRATION).collect()
    if not some:
        return 1
    place = {r[0]: {leaf: n for n, leaf in enumerate(tree.order(np.array(r[1], np.float64)))} for r in some}
    at = sorted(place[r.query_id][r.leaf] for r in _true_nearest(rows, some, k))
    return at[max(0, int(np.ceil(recall * len(at))) - 1)] + 1 if at else 1


def _of_length(fine: DataFrame, queries: DataFrame, kind: str, k: int) -> DataFrame:
    """query_id, vec_id, score of vectors and queries of one length: each visited block's best."""
    spark = fine.sparkSession
    tree = Tree(sample(fine, "vec_id", "embedding", SAMPLE, 8))
    leaves = keep(fine.mapInArrow(_leaves(spark.sparkContext.broadcast(tree)), f"vec_id long, embedding {kind}, leaf int"))
    sizes = np.zeros(tree.leaves, np.int64)
    for r in leaves.groupBy("leaf").count().collect():  # one row per leaf of the tree
        sizes[r[0]] = r[1]
    blocks = np.maximum(1, -(-sizes // BLOCK))
    least = calibrate(tree, leaves, queries, k)
    cut = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "leaf int, blocks int")
    held = leaves.join(F.broadcast(cut), "leaf").select(
        "leaf", F.pmod(F.xxhash64(F.lit(28), "vec_id"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("role"), "vec_id", "embedding")
    sent = spark.sparkContext.broadcast((tree, least, sizes, blocks, k + 1))
    asked = queries.mapInArrow(_visits(sent), f"leaf int, block int, role int, vec_id long, embedding {kind}")
    both = held.union(asked).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "role")
    return both.mapInArrow(_search(k), "query_id long, vec_id long, score double")


def search(embeddings: DataFrame, is_query: F.Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its ``k`` nearest found by inner product."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = rows.filter(usable("embedding") & F.col("vec_id").isNotNull())
    kind = embeddings.schema["embedding"].dataType.simpleString()
    queries = keep(fine.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    found = embeddings.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for n in lengths(fine, "embedding"):
        same = F.size("embedding") == n
        found = found.union(_of_length(fine.filter(same), queries.filter(same), kind, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
