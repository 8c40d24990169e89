"""Near-duplicate vectors by product quantisation: cosine >= 0.9.

1. Equal vectors become one class, named by its smallest vec_id.
2. Coarse centroids and, for the residuals, codebooks of eight subspaces are
   fitted on a bounded sample (``SAMPLE`` classes chosen by a hash of vec_id). Every
   class is encoded: its list, eight codes, and the length of its coding error.
3. Inverted lists are packed into shelves of about ``SHELF`` vectors; a longer
   list is cut by hash. A vector visits a shelf (of higher number than its own) if
   one of its lists can hold a vector near enough: a point of another list lies
   beyond the plane between the two centroids, so lists whose plane is farther
   than the radius are skipped. These probes are sufficient: they lose nothing.
4. In a shelf, distances come from tables of the visitor's products with all code
   words. By the triangle inequality a pair whose distance is above the
   radius plus the coding error cannot link; what remains is reranked
   with the exact cosine in double precision.
5. A shelf emits numbers of links and a spanning forest of its links, at most as
   many rows as vectors took part, never its pairs. Components join the forests.

Steps 2 to 4 run once for each length of vectors, so all of equal length are compared.

Defined results: vectors that are null, zero, or hold null or non-finite components link
with nothing, nor do vectors of different lengths; a null vec_id links with nothing and
is kept; rows with equal vec_id are vectors of their own under one name (also of
different lengths: components then join); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, keep
from .vectors import kmeans, lengths, matrix, sample, square_distances, unit, usable

COSINE = 0.9
SAMPLE, LISTS, PARTS, WORDS = 8192, 64, 8, 256
SHELF, VISITORS = 8192, 128
_RADIUS = np.sqrt(2 - 2 * COSINE)
_SLACK = 1e-4  # of single precision distances


@dataclass
class Quantiser:
    centres: np.ndarray
    books: list[np.ndarray]  # for each subspace its code words
    width: int  # of a subspace; the last one is padded with zeros

    @classmethod
    def fit(cls, x: np.ndarray, seed: int = 3) -> Quantiser:
        g = np.random.default_rng(seed)
        x = unit(x)
        centres = kmeans(x, LISTS, 10, g)
        width = -(-x.shape[1] // PARTS)
        rest = cls._pad(x - centres[square_distances(x, centres).argmin(axis=1)], width)
        return cls(centres, [kmeans(np.ascontiguousarray(rest[:, m * width : (m + 1) * width]), WORDS, 8, g) for m in range(PARTS)], width)

    @staticmethod
    def _pad(x: np.ndarray, width: int) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, width * PARTS - x.shape[1])))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of unit vectors."""
        near = square_distances(x, self.centres).argmin(axis=1)
        rest = self._pad(x - self.centres[near], self.width)
        w = self.width
        return near, np.stack([square_distances(rest[:, m * w : (m + 1) * w], b).argmin(axis=1) for m, b in enumerate(self.books)], axis=1)

    def coded(self, near: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The points that codes stand for."""
        rest = np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)[:, : self.centres.shape[1]]
        return self.centres[near] + rest

    def products(self, x: np.ndarray) -> list[np.ndarray]:
        """For each subspace -2 times the products of its code words with ``x`` (words x rows)."""
        x, w = self._pad(x, self.width), self.width
        return [np.ascontiguousarray(-2 * b @ x[:, m * w : (m + 1) * w].T, np.float32) for m, b in enumerate(self.books)]

    def probes(self, x: np.ndarray) -> np.ndarray:
        """Which lists can hold a vector within the radius (rows x lists)."""
        d = square_distances(x, self.centres)
        own = d.argmin(axis=1)
        apart = np.sqrt(square_distances(self.centres, self.centres))[own]
        return (d - d[np.arange(len(x)), own][:, None]) <= 2 * apart * (_RADIUS + 1e-9) + 1e-9


@dataclass
class Shelves:
    """Each list's first shelf and the number of shelves it is cut into."""

    first: np.ndarray
    cut: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Shelves:
        first, cut, shelf, room = [], [], -1, 0
        for n in counts.tolist():
            parts = max(1, -(-n // SHELF))
            if parts > 1 or n > room or shelf < 0:
                shelf, room = shelf + 1, SHELF
            first.append(shelf)
            cut.append(parts)
            room = 0 if parts > 1 else room - n
            shelf += parts - 1
        return cls(np.array(first), np.array(cut))


def _encode(sent):
    def run(batches):
        for batch in batches:
            x = matrix(batch.column(2))
            near, codes = sent.value.encode(unit(x)) if len(x) else (np.zeros(0, int), np.zeros((0, PARTS), int))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32()), pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())],
                                             names=[*batch.schema.names, "list", "codes"])

    return run


def _place(sent, shelves):
    """Members at their shelf (role 0), and visits to higher shelves (role 1)."""

    def run(batches):
        first, cut = shelves.value.first, shelves.value.cut
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column(2)))
            near, spread = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            home = first[near] + spread % cut[near]
            probes = sent.value.probes(x)
            rows, shelf = [np.arange(len(x))], [home]
            role = [np.zeros(len(x), np.int64)]
            total = int((first + cut).max())
            may = np.zeros((len(x), total), bool)
            for k in range(len(first)):
                may[:, first[k] : first[k] + cut[k]] |= probes[:, k : k + 1]
            r, s = np.nonzero(may & (np.arange(total) > home[:, None]))
            rows.append(r)
            shelf.append(s)
            role.append(np.ones(len(r), np.int64))
            at = np.concatenate(rows)
            out = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shelf), pa.int32()), pa.array(np.concatenate(role), pa.int32()), *out.columns[:5]],
                                             names=["shelf", "role", "vec_id", "copies", "embedding", "list", "codes"])

    return run


class _Shelf:
    """The members of one shelf, and the links found so far."""

    def __init__(self, q: Quantiser, ids, copies, x, near, codes):
        self.q, self.ids, self.copies = q, ids, copies
        self.raw = x.astype(np.float64)
        self.norm = np.sqrt((self.raw * self.raw).sum(axis=1))
        u = unit(x)
        self.near, self.codes = near, codes
        point = q.coded(near, codes)
        error = np.sqrt(((u - point) ** 2).sum(axis=1))
        self.most = ((_RADIUS + error) ** 2 + _SLACK).astype(np.float32)
        self.own = (point * point).sum(axis=1).astype(np.float32)  # of |x|^2 - 2 x.p + |p|^2
        self.from_centre = q.centres[near]
        self.links, self.group = np.zeros(len(ids), np.int64), np.arange(len(ids))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def visit(self, ids, copies, x, first: int | None = None):
        """Compare with visitors; ``first``: they are members themselves, from this one on."""
        raw, u = x.astype(np.float64), unit(x)
        acc = np.ascontiguousarray((self.own[:, None] + 1 - 2 * (u @ self.q.centres.T).T[self.near]).astype(np.float32))
        part = np.empty_like(acc)
        for m, table in enumerate(self.q.products(u)):
            acc += np.take(table, self.codes[:, m], axis=0, out=part, mode="clip")
        j, i = np.nonzero(acc <= self.most[:, None])
        if first is not None:
            later = j > i + first
            j, i = j[later], i[later]
        norm = np.sqrt((raw * raw).sum(axis=1))
        keep_j, keep_i = [], []
        for a in range(0, len(j), 50_000):
            jj, ii = j[a : a + 50_000], i[a : a + 50_000]
            near = (self.raw[jj] * raw[ii]).sum(axis=1) / (self.norm[jj] * norm[ii]) >= COSINE
            keep_j.append(jj[near])
            keep_i.append(ii[near])
        if not keep_j:
            return np.zeros(len(ids), np.int64)
        j, i = np.concatenate(keep_j), np.concatenate(keep_i)
        self.links += np.bincount(j, weights=copies[i], minlength=len(self.ids)).astype(np.int64)
        # one edge from each visitor to each group of members that it links with joins them all
        pair, at = np.unique(i * len(self.ids) + self.group[j], return_index=True)
        self.edges.append((ids[i[at]], self.ids[j[at]]))
        visitor, group = np.divmod(pair, len(self.ids))
        if first is not None:  # a member: its own group joins too
            visitor, group = np.append(visitor, i[at]), np.append(group, self.group[i[at] + first])
        for v in np.unique(visitor):
            g = np.unique(self.group[group[visitor == v]])
            if len(g) > 1:
                self.group[np.isin(self.group, g[1:])] = g[0]
        return np.bincount(i, weights=self.copies[j], minlength=len(ids)).astype(np.int64)


def _link(sent):
    """Rows sorted by (shelf, role): a shelf's members, then its visitors in turn."""

    def found(ids, links, edges):
        a = np.concatenate([ids, *(e[0] for e in edges)])
        b = np.concatenate([np.full(len(ids), -1), *(e[1] for e in edges)])
        n = np.concatenate([links, np.zeros(len(a) - len(ids), np.int64)])
        some = (n > 0) | (np.arange(len(a)) >= len(ids))
        return pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(b[some]), pa.array(n[some]), pa.array(np.arange(len(a))[some] >= len(ids))], names=["a", "b", "n", "edge"])

    def unpack(t):
        codes = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint8).reshape(len(t), PARTS)
        return np.asarray(t.column(2)), np.asarray(t.column(3)), matrix(pa.concat_arrays(t.column(4).chunks)), np.asarray(t.column(5)), codes

    def opened(waiting):
        ids, copies, x, near, codes = unpack(pa.Table.from_batches(waiting))
        shelf = _Shelf(sent.value, ids, copies, x, near, codes)
        for a in range(0, len(ids), VISITORS):
            b = a + VISITORS
            shelf.links[a:b] += shelf.visit(ids[a:b], copies[a:b], x[a:b], a)
        return shelf

    def closed(shelf):
        return found(shelf.ids, shelf.links, shelf.edges)

    def run(batches):
        now, waiting, shelf = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, role = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cut = np.flatnonzero(np.append(True, (np.diff(number) != 0) | (np.diff(role) != 0))).tolist() + [batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:]):
                if number[a] != now:
                    if waiting or shelf:
                        yield closed(shelf or opened(waiting))
                    now, waiting, shelf = number[a], [], None
                if role[a] == 0:
                    waiting.append(batch.slice(a, b - a))
                    continue
                if not waiting and shelf is None:
                    continue  # a shelf of empty lists
                shelf = shelf or opened(waiting)
                waiting = []
                for k in range(a, b, VISITORS):
                    ids, copies, x, *_ = unpack(pa.Table.from_batches([batch.slice(k, min(VISITORS, b - k))]))
                    links = shelf.visit(ids, copies, x)
                    yield found(ids, links, [])
        if waiting or shelf:
            yield closed(shelf or opened(waiting))

    return run


def _found(classes: DataFrame, kind: str) -> DataFrame:
    """a, b, n, edge: numbers of links and spanning forests of classes of one length."""
    spark = classes.sparkSession
    sent = spark.sparkContext.broadcast(Quantiser.fit(sample(classes, "vec_id", "embedding", SAMPLE, 3)))
    columns = f"vec_id long, copies long, embedding {kind}"
    coded = keep(classes.mapInArrow(_encode(sent), f"{columns}, list int, codes binary"))
    counts = np.zeros(len(sent.value.centres), np.int64)
    for r in coded.groupBy("list").count().collect():  # one row per list
        counts[r[0]] = r[1]
    shelves = spark.sparkContext.broadcast(Shelves.of(counts))
    spread = F.shiftrightunsigned(F.xxhash64(F.lit(4), "vec_id"), 1).alias("spread")
    placed = coded.select("*", spread).mapInArrow(_place(sent, shelves), f"shelf int, role int, {columns}, list int, codes binary")
    return keep(placed.repartition("shelf").sortWithinPartitions("shelf", "role").mapInArrow(_link(sent), "a long, b long, n long, edge boolean"))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = rows.filter(usable("embedding") & F.col("vec_id").isNotNull())
    classes = keep(fine.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")).select("vec_id", "copies", "embedding"))
    kind = embeddings.schema["embedding"].dataType.simpleString()
    found = embeddings.sparkSession.createDataFrame([], "a long, b long, n long, edge boolean, k int")
    for k in lengths(classes, "embedding"):
        found = found.union(_found(classes.filter(F.size("embedding") == k), kind).withColumn("k", F.lit(k)))
    comp = keep(components(found.filter("edge").select("a", "b")))
    links = found.filter("not edge").groupBy("a", F.col("k").alias("_k")).agg(F.sum("n").alias("n"))
    of_class = classes.select("vec_id", "copies", F.size("embedding").alias("k"))
    of_class = of_class.join(links, (F.col("vec_id") == F.col("a")) & (F.col("k") == F.col("_k")), "left").join(comp, F.col("vec_id") == F.col("node"), "left")
    of_class = of_class.select(F.col("vec_id").alias("class"), "k", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    named = fine.join(classes.select("embedding", F.col("vec_id").alias("class")), "embedding").select("vec_id", "class", F.size("embedding").alias("k"))
    linked = named.join(of_class, ["class", "k"]).select("vec_id", "n_links", "component_id")
    rest = rows.filter(~usable("embedding") | F.col("vec_id").isNull())
    out = linked.union(rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
