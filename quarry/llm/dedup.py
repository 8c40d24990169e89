"""Near-duplicate documents by b-bit MinHash (five-word shingles, Jaccard >= 0.75).

1. One pass over the texts gives each document its distinct shingle hashes'
   count, a 128-bit key of the whole set, 128 minima folded into 32 band keys,
   and the low four bits of the minima as packed bit planes.
2. Documents with equal sets become one class, named by its smallest doc_id.
3. Classes that share a band key form a bucket. Each member is compared with
   the bucket's smallest member, so candidates stay linear in the bucket (and
   first only with the smallest of all these); buckets whose members are then
   still in different components are compared block by block, only across
   components and never inside the bucket's largest one. No pair list of a bucket
   is made before the signatures have judged it.
4. Signatures are compared by counting differing positions (XOR and OR of the
   planes, bit counts) corrected for chance collisions; pairs far below the
   threshold go. The rest are confirmed on the full shingle sets.
5. Components of the confirmed links.

Defined results: a null or empty text (or one without words) has an empty set
and links with nothing; fewer than five words are one shingle; repeated rows are
copies; a doc_id that stands on different texts has a row, and a component, for each
of them; rows with a null doc_id are returned with a null component and kept; very
long texts are shingled whole, in windows of bytes; ties are broken by the smaller
doc_id, then by the text's hash; an empty table gives an empty result; other columns
are not read.

A pair at similarity 0.75 misses every band with probability 5e-6, and fails
the signature test with probability below 1e-6; more similar pairs less often.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, keep, list_array, map_texts, mix, row_slices, signed, text_bytes, word_hashes

WORDS = 5
PERMUTATIONS, BAND_ROWS, BITS = 128, 4, 4
PERCENT = 75
#: Pairs with more differing positions are dropped: 5.4 standard deviations above
#: what similarity 0.75 gives (0.25 * 15/16 of 128 positions: 30, deviation 4.8).
MOST_DIFFERENT = 56
#: Members of a block whose signatures are compared, and whose texts are, with the
#: latter's shingles in all (a longer text is a block by itself).
SIGNATURE_BLOCK, BLOCK, BLOCK_SHINGLES = 4096, 512, 500_000
#: Members of a hub that one task confirms.
STAR = 256

_rng = np.random.default_rng(5)
_MULT = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

FEATURES = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>, planes array<long>"


def shingle_sets(col: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted (empty without words)."""
    data, offs = text_bytes(col)
    for lo, hi in row_slices(offs):
        h, ptr = word_hashes(data, offs[lo : hi + 1])
        n = len(h)
        windows = np.zeros(max(0, n - WORDS + 1), np.uint64)
        for k in range(WORDS):
            windows += h[k : n - WORDS + 1 + k] * _PLACE[k]
        windows = mix(windows)
        for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(windows[a : b - WORDS + 1])
            elif b > a:  # the whole sequence; the length keeps it apart from five words
                yield mix((h[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def minima(shingles: np.ndarray, step: int = 2048) -> np.ndarray:
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), step):
        np.minimum(low, (shingles[a : a + step, None] * _MULT + _ADD).min(axis=0), out=low)
    return low


def planes(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima: for each bit 128 positions as two words (rows x 8)."""
    low = mix(low)
    bits = [np.packbits((low >> np.uint64(k)) & np.uint64(1) != 0, axis=1) for k in range(BITS)]
    return np.ascontiguousarray(np.concatenate(bits, axis=1)).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    bands = low.reshape(len(low), -1, BAND_ROWS)
    key = (bands * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(bands.shape[1], dtype=np.uint64)
    return mix(key)


def _features(batches):
    for batch in batches:
        sets = shingle_sets(batch.column(1))
        for at in range(0, batch.num_rows, 2000):
            ids = batch.column(0).slice(at, 2000)
            n, a, b, low = [], [], [], []
            for _, u in zip(range(len(ids)), sets):
                n.append(len(u))
                a.append(mix(u).sum(dtype=np.uint64))
                b.append(np.bitwise_xor.reduce(mix(u ^ _MULT[0])) if len(u) else np.uint64(0))
                low.append(minima(u))
            low = np.array(low)
            keys = band_keys(low)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), batch.column(2).slice(at, 2000), pa.array(n, pa.int64()), pa.array(signed(np.array(a, np.uint64))),
                 pa.array(signed(np.array(b, np.uint64))), list_array(signed(keys), keys.shape[1]),
                 list_array(planes(low), 2 * BITS)],
                names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands", "planes"])


def features(docs: DataFrame) -> DataFrame:
    """Hash of the text, set size, set key, band keys and packed signature of each document."""
    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key()), _features, FEATURES)


def text_key() -> F.Column:
    """With doc_id, names a text."""
    return F.xxhash64("text").alias("text_key")


def differing(a: str, b: str) -> F.Column:
    """Positions in which two packed signatures differ."""
    total = F.lit(0)
    for word in range(PERMUTATIONS // 64):
        any_bit = None
        for bit in range(BITS):
            k = bit * (PERMUTATIONS // 64) + word
            x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
            any_bit = x if any_bit is None else any_bit.bitwiseOR(x)
        total = total + F.bit_count(any_bit)
    return total


def estimate(differ: F.Column) -> F.Column:
    """Similarity from differing positions, corrected for chance collisions of the kept bits."""
    chance = 2.0**-BITS
    return (1 - differ / PERMUTATIONS - chance) / (1 - chance)


# ------------------------------------------------------------------ confirming


def _runs(batches, keys: int):
    """Consecutive rows with equal first ``keys`` columns, as (key, table of one batch's part)."""
    for batch in batches:
        cols = [np.asarray(batch.column(k)) for k in range(keys)]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        at = np.append(np.flatnonzero(change), batch.num_rows).tolist()
        for a, b in zip(at[:-1], at[1:]):
            yield tuple(int(c[a]) for c in cols), batch.slice(a, b - a)


def _confirm(batches):
    """Rows sorted by (hub, salt, role): first the hub's text, then its members'."""
    now, heads = None, []
    for key, part in _runs(batches, 2):
        if key != now:
            now, heads = key, []
        found = []
        for role, doc, u in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), shingle_sets(part.column(4))):
            if role == 0:
                heads = heads or [u]  # a repeated row brings the same text again
                continue
            for h in heads:
                common = len(np.intersect1d(h, u, assume_unique=True))
                if common and 100 * common >= PERCENT * (len(h) + len(u) - common):
                    found.append(doc)
                    break
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(found), pa.int64()), pa.array(found, pa.int64())], names=["a", "b"])


@dataclass
class Texts:
    """The documents, and for each node the doc_id and text_key of a text that has its set."""

    docs: DataFrame
    names: DataFrame

    def of(self, rows: DataFrame, node: str) -> DataFrame:
        """``rows`` with the text of ``node``. The number of rows has no bound, so they
        are never broadcast: the plan is the same merge join at every size. Of rows that
        repeat a text one is taken for each node by the readers of the result."""
        text = self.docs.select(F.col("doc_id").cast("long").alias("_id"), text_key().alias("_key"), F.col("text").alias("_text"))
        named = rows.join(self.names.select(F.col("node").alias(node), F.col("doc_id").alias("_doc"), F.col("text_key").alias("_name")), node)
        return text.hint("merge").join(named, (F.col("_id") == F.col("_doc")) & (F.col("_key") == F.col("_name"))).drop("_id", "_key", "_doc", "_name")


def confirm(pairs: DataFrame, texts: Texts) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets are similar enough.

    Members stream past their hub's set; a hub with many members is dealt to
    several tasks, each with a copy of the hub's text.
    """
    pairs = keep(pairs)
    many = keep(pairs.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") > STAR))  # a row for STAR pairs at most
    p = pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.coalesce("n", F.lit(1)) / STAR)).alias("salt"))
    heads = p.select("a", "salt").distinct().select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("id"))
    rows = heads.union(p.select("a", "salt", F.lit(1), "b"))
    rows = texts.of(rows, "id").select("a", "salt", "role", "id", "_text")
    return map_texts(rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role"), _confirm, "a long, b long").distinct()


# ------------------------------------------------------------------ mixed buckets


def _segments(batches, keys: int):
    """(key, table) of all consecutive rows with equal first ``keys`` columns."""
    now, held = None, []
    for key, part in _runs(batches, keys):
        if key != now and held:
            yield now, pa.Table.from_batches(held)
            held = []
        now = key
        held.append(part)
    if held:
        yield now, pa.Table.from_batches(held)


def _sides(key, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of blocks x and y of a segment (the same rows if they are one block)."""
    return np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])


def _close(batches):
    """Of each segment (key, x, y) the members with a close signature in another component."""
    for key, t in _segments(batches, 3):
        block, node, comp = (t.column(k).to_numpy() for k in (3, 4, 5))
        sig = t.column(6).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        left, right = _sides(key, block)
        some = np.zeros(len(node), bool)
        for i in left.tolist():
            other = right[comp[right] != comp[i]]
            x = sig[other] ^ sig[i]
            differ = np.zeros(len(x), np.int64)
            for w in range(PERMUTATIONS // 64):
                differ += np.bitwise_count(np.bitwise_or.reduce(x[:, w :: PERMUTATIONS // 64], axis=1))
            near = other[differ <= MOST_DIFFERENT]
            if len(near):
                some[i] = True
                some[near] = True
        if some.any():
            yield pa.RecordBatch.from_arrays([c.combine_chunks() for c in t.select(range(6)).filter(pa.array(some)).columns],
                                             names=["key", "x", "y", "block", "node", "component"])


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of ``left`` with those of ``right``."""
    shingle = np.concatenate([sets[j] for j in right])
    owner = np.repeat(np.arange(len(right)), [len(sets[j]) for j in right])
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    out = np.empty((len(left), len(right)), np.int64)
    for k, i in enumerate(left.tolist()):
        a, b = np.searchsorted(shingle, sets[i]), np.searchsorted(shingle, sets[i], "right")
        n = b - a
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        out[k] = np.bincount(owner[at], minlength=len(right))
    return out


def _linked(batches):
    """Confirmed links between components in each segment, as a spanning forest."""
    for key, t in _segments(batches, 3):
        block, node, comp = (t.column(k).to_numpy().copy() for k in (3, 4, 5))
        sets = list(shingle_sets(t.column(6)))
        left, right = _sides(key, block)
        if not len(left) or not len(right):
            continue
        size, a, b = np.array([len(u) for u in sets]), [], []
        for part in np.array_split(left, -(-len(left) // 64)):
            common = _overlaps(sets, part, right)
            i, j = np.nonzero(100 * common >= PERCENT * (size[part][:, None] + size[right] - common))
            for m, n in zip(part[i].tolist(), right[j].tolist()):
                if comp[m] != comp[n]:
                    a.append(node[m])
                    b.append(node[n])
                    comp[comp == comp[n]] = comp[m]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _blocked(m: DataFrame, most: int, shingles: int | None = None) -> DataFrame:
    """Rows of ``m`` (key, node, component, n_shingles, ...) in pairs of blocks x and y.

    Only buckets of several components; members of a bucket's largest component (big)
    meet the others only, these meet all. A bucket with few others makes rows in
    proportion to its size.
    """
    parts = m.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    b = parts.groupBy("key").agg(F.max(F.struct("n", "component", "s")).alias("big"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("parts"))
    blocks = lambda n, s: F.greatest(F.ceil(n / most), F.ceil(s / shingles) if shingles else F.lit(1), F.lit(1)).cast("int")
    b = keep(b.filter("parts > 1").select("key", F.col("big.component").alias("largest"), blocks(F.col("big.n"), F.col("big.s")).alias("bigs"),
                                          blocks(F.col("n") - F.col("big.n"), F.col("s") - F.col("big.s")).alias("smalls")))
    m = m.join(b, "key")
    big, h = F.col("component") == F.col("largest"), F.xxhash64("node")
    m = m.withColumn("block", F.when(big, F.col("smalls") + F.pmod(h, F.col("bigs"))).otherwise(F.pmod(h, F.col("smalls"))).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("smalls") + F.when(big, 0).otherwise(F.col("bigs")) - 1)))
    return m.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))


def across_components(members: DataFrame, comp: DataFrame, sigs: DataFrame, texts: Texts) -> DataFrame:
    """Links between different components in the same bucket."""
    m = members.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    m = _blocked(keep(m.select("key", "node", "component", F.lit(0).alias("n_shingles"))), SIGNATURE_BLOCK)
    m = m.join(sigs.select("node", "planes"), "node").select("key", "x", "y", "block", "node", "component", "planes")
    columns = "key long, x int, y int, block int, node long, component long"
    near = m.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(_close, columns)
    near = keep(near.select("key", "node", "component").distinct().join(sigs.select("node", "n_shingles"), "node"))
    rows = texts.of(_blocked(near, BLOCK, BLOCK_SHINGLES), "node").select("key", "x", "y", "block", "node", "component", "_text")
    return map_texts(rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y"), _linked, "a long, b long")


# ------------------------------------------------------------------ the operator


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, text_class, stays: whether this text is the one that stands for its component.

    Nodes are distinct sets (not documents: a doc_id may stand on several texts),
    numbered as they are written to the shared folder.
    """
    feats = keep(features(docs))
    full = feats.filter("doc_id is not null and n_shingles > 0")
    key = ["n_shingles", "set_a", "set_b"]
    first = full.groupBy(*key).agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    nodes = keep(first.select(F.monotonically_increasing_id().alias("node"), *key, "first.doc_id", "first.text_key", "bands", "planes"))

    texts = Texts(docs, nodes.select("node", "doc_id", "text_key"))
    sigs = nodes.select("node", "planes", "n_shingles")
    postings = nodes.select("node", F.explode("bands").alias("key"))
    buckets = postings.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("key", "hub")
    members = keep(postings.join(buckets, "key").select("key", "node", "hub"))
    stars = members.filter("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = (stars.join(sigs.select(F.col("node").alias("a"), F.col("planes").alias("pa")), "a")
             .join(sigs.select(F.col("node").alias("b"), F.col("planes").alias("pb")), "b")
             .filter(differing("pa", "pb") <= MOST_DIFFERENT).select("a", "b"))
    # each member with the smallest of its buckets' smallest members; what that
    # connects needs no further comparison
    links = keep(confirm(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), texts))
    comp = keep(components(links))
    more = keep(across_components(members, comp, sigs, texts))
    if not more.isEmpty():
        comp = keep(components(links.union(more)))

    named = nodes.select("node", *key, F.struct("doc_id", "text_key").alias("first")).join(comp, "node", "left").withColumn("root", F.coalesce("component", "node"))
    named = keep(named.select("root", *key, "first"))
    roots = keep(named.groupBy("root").agg(F.min("first").alias("least")))
    named = keep(named.join(roots, "root").select(*key, F.col("first.doc_id").alias("text_class"), "least"))
    linked = full.select("doc_id", "text_key", *key).join(named, key)
    linked = linked.select("doc_id", "text_key", "n_shingles", F.col("least.doc_id").alias("component_id"), "text_class",
                           (F.struct("doc_id", "text_key") == F.col("least")).alias("stays"))
    alone = feats.filter("doc_id is null or n_shingles = 0").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("text_class"), F.lit(True))
    return linked.union(alone)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_class (smallest doc_id of equal sets)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return groups(docs).select("doc_id", "n_shingles", "component_id", kept, "text_class")
