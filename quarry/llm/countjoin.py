"""Sharded count joins: documents scored by joining their n-grams with the counts of a model.

The model is an interpolated modified Kneser-Ney bigram model of texts, counted with
DataFrame operations and turned into one table (key, value) of sums that add up to a score. With back(v) the
weight that context v leaves to the lower order (1 for an unknown v) and low(w) the lower order's probability,

    log p(w | v) = log back(v) + log low(w) + delta(v, w),

where delta is 0 for a pair that was never counted. So a text's score is the sum, over its words and pairs of
words, of a value that depends on this word or pair alone, and joins by key give it:

* Words and pairs that the model has never seen need no join: a filter of fixed size (``FILTER_BITS``, built in the
  shards, sent to every task) tells most of them, an unknown word's value is added at once. What the filter lets pass
  by mistake the join tells; a model of any size is scored alike, only more is sent.
* A batch of documents becomes sorted distinct keys, each with the documents of the batch that hold it and how
  often (pre-aggregated), cut by hash into shards (``SHARDS``, more for a larger model). What is shuffled is one block for each batch and shard.
* The table lies in the same shards, as sorted blocks. Shards are salted: each has as many copies as the
  shuffle has partitions for it (a table of more than ``SALT_KEYS`` keys one), and a batch goes to one of them, so neither a frequent word nor the
  number of documents makes a hot task.
* A task merges its shard's sorted keys with those of each batch and passes on one number per
  document; the numbers of a batch are added up where its ids and token counts arrive.

The table is made and the texts are scored in ``ROUNDS``, so the disk holds the shuffle files of a part of them, and what
only served the fit is given back.

A batch is named by its partition and place, so ``docs`` must come in the same order when a lost task runs
again (as scans and kept tables do).

Defined results: a null text is an empty text (one end token); a text of any length is cut into words in windows
and is at most one batch by itself; repeated rows are scored one by one; an empty table gives an empty result; a
model of no texts gives every token probability 1; further columns are those the caller names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, map_texts, mix, release, signed
from .ngram import START, _bigram_key, _by_shard, _discounts, _pack, _tokens, _unpack

#: The least number of shards; it is doubled while a shard would hold more than ``SHARD_KEYS`` keys of the table.
SHARDS, SHARD_KEYS = 16, 1 << 23
#: Bits of the filter of known keys (8 MB), and how many of them a key sets in its shard's part.
FILTER_BITS, PROBES = 1 << 26, 4
BATCH_TOKENS, BATCH_DOCS = 1_500_000, 1 << 15
#: Keys of the table that make one block.
BLOCK_KEYS = 1 << 18
TABLE, WORDS, PAIRS, SUMS, ROWS = 0, 1, 2, 3, 4
#: Keys that the copies of a table may add up to; a larger table has one copy (and shards enough for many tasks).
SALT_KEYS = 1 << 23
#: Parts in which the table is made (by shard) and the texts are scored (by hash), one after the other: only the shuffle files
#: of one lie on the disks at a time.
ROUNDS = 4
_START = int(START.astype(np.int64))


@dataclass
class Counted:
    """table: (shard, keys, block) of the sorted keys and their values; ``unknown``: value of an unknown word;
    ``start``: of every text; ``tokens``: how many were counted, ends too; ``known``: the filter of the table's keys;
    ``shards``: how many the keys are cut into; ``keys``: how many there are."""

    table: DataFrame
    unknown: float
    start: float
    tokens: int
    known: np.ndarray
    shards: int
    keys: int


# ------------------------------------------------------------------ the model


def _pairs(batches):
    """(key, v, w, n): the distinct pairs of a batch, the first of a text with START, the last with END."""
    for batch in batches:
        for _, w, v, _ in _tokens(batch.column(0)):
            key, first, n = np.unique(_bigram_key(v, w), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(signed(v[first])), pa.array(signed(w[first])), pa.array(n)], names=["key", "v", "w", "n"])


def _blocks(batches):
    """Rows (shard, key, value) sorted by these become blocks."""
    for batch in batches:
        shard, key, value = (np.asarray(batch.column(k)) for k in range(3))
        cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, int)
        for a, b in zip(cut, np.append(cut[1:], len(shard))):
            for lo in range(a, b, BLOCK_KEYS):
                hi = min(lo + BLOCK_KEYS, b)
                raw = np.ascontiguousarray(key[lo:hi]).tobytes() + np.ascontiguousarray(value[lo:hi]).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[lo])], pa.int32()), pa.array([hi - lo], pa.int64()), pa.array([raw], pa.binary())], names=["shard", "keys", "block"])


def _probes(key: np.ndarray, shards: int):
    """Bits of signed keys, in the parts of their shards."""
    part = FILTER_BITS // shards
    base = (key % shards) * part
    for j in range(PROBES):
        yield base + (mix(key.view(np.uint64) + np.uint64(j + 1)) % np.uint64(part)).astype(np.int64)


def _known(shards: int):
    """The parts of the filter that blocks make; a task may hold several shards."""
    size = FILTER_BITS // shards // 8

    def run(batches):
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, n, block in zip(*(batch.column(k) for k in range(3))):
                s = s.as_py()
                bits = parts.setdefault(s, np.zeros(size, np.uint8))
                for at in _probes(np.frombuffer(block.as_buffer(), np.int64, n.as_py()), shards):
                    np.bitwise_or.at(bits, (at >> 3) - s * size, np.left_shift(1, at & 7).astype(np.uint8))
        for s, bits in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["shard", "bits"])

    return run


def _in_filter(known: np.ndarray, key: np.ndarray, shards: int) -> np.ndarray:
    out = np.ones(len(key), bool)
    for at in _probes(key, shards):
        out &= (known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


def fit(texts: DataFrame) -> Counted:
    """Count the ``text`` column of all of ``texts``."""
    pairs = map_texts(texts.select("text"), _pairs, "key long, v long, w long, n long")
    pairs = keep(pairs.groupBy("key", "v", "w").agg(F.sum("n").alias("n")), clean=True)
    few = [F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4)]
    total = pairs.agg(F.count("*"), F.sum("n"), *few).first()
    distinct, tokens = total[0], total[1] or 0
    d = _discounts(np.array([x or 0 for x in total[2:]]))
    # map-side sums: a frequent word is one row per task
    after = pairs.groupBy(F.col("v").alias("word")).agg(
        F.sum("n").alias("c"), sum((F.sum(F.when(k, x).otherwise(0.0)) for k, x in zip((F.col("n") == 1, F.col("n") == 2, F.col("n") > 2), d)), F.lit(0.0)).alias("cut"))
    before = pairs.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("contexts"))
    counted = words = keep(after.join(before, "word", "full"), clean=True)
    few = [F.sum((F.col("contexts") == k).cast("long")) for k in (1, 2, 3, 4)]
    w = words.agg(F.count("contexts"), *few, F.sum((F.col("contexts") > 2).cast("long"))).first()
    vocabulary, of = w[0], [x or 0 for x in w[1:]]
    shards = SHARDS
    while distinct + vocabulary > shards * SHARD_KEYS:
        shards *= 2
    low = _discounts(np.array(of[:4]))
    rest = (low[0] * of[0] + low[1] * of[1] + low[2] * of[4]) / distinct if distinct else 1.0
    floor = rest / (vocabulary + 1)
    cut = F.when(F.col("contexts") > 2, low[2]).when(F.col("contexts") == 2, low[1]).otherwise(low[0])
    lower = F.when(F.col("contexts") > 0, F.greatest(F.col("contexts") - cut, F.lit(0.0)) / F.lit(max(1, distinct))).otherwise(0.0) + F.lit(floor)
    words = words.select("word", lower.alias("low"), (F.col("cut") / F.col("c")).alias("back"), "c")
    back = F.coalesce(F.log10("back"), F.lit(0.0))
    of_word = words.filter(F.col("word") != _START).select(F.col("word").alias("key"), (F.log10("low") + back).alias("value"))
    j = pairs.join(words.select(F.col("word").alias("v"), "back", "c"), "v").join(words.select(F.col("word").alias("w"), "low"), "w")
    cut = F.when(F.col("n") > 2, d[2]).when(F.col("n") == 2, d[1]).otherwise(d[0])
    p = F.greatest(F.col("n") - cut, F.lit(0.0)) / F.col("c") + F.col("back") * F.col("low")
    of_pair = j.select("key", (F.log10(F.least(p, F.lit(1.0))) - F.log10("back") - F.log10("low")).alias("value"))
    table = of_word.union(of_pair).withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    tables = []
    for r in range(min(ROUNDS, shards)):
        part = table.filter(F.pmod("key", F.lit(shards)) % ROUNDS == r)
        part = part.repartition(shards, "shard").sortWithinPartitions("shard", "key").select("shard", "key", "value")
        tables.append(keep(part.mapInArrow(_blocks, "shard int, keys long, block binary"), clean=True))
    table = reduce(DataFrame.union, tables)
    known = np.zeros(FILTER_BITS // 8, np.uint8)
    size = len(known) // shards
    for r in map_texts(table, _known(shards), "shard int, bits binary").collect():  # parts of a filter of fixed size
        known[r.shard * size : (r.shard + 1) * size] |= np.frombuffer(r.bits, np.uint8)
    start = words.filter(F.col("word") == _START).select(F.log10("back")).first()
    release(pairs, counted)
    return Counted(table, float(np.log10(min(floor, 1.0))) if distinct else 0.0, start[0] if start else 0.0, tokens, known, shards, distinct + vocabulary)


# ------------------------------------------------------------------ the join

_JOIN = "shard int, salt int, batch long, kind int, docs long, keys long, held long, block binary"


def _row(shard, salt, batch, kind, docs, keys, held, block):
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    values = (shard, salt, batch, kind, docs, keys, held, block)
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _JOIN.split(", ")])


def _press(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def _held(key: np.ndarray, doc: np.ndarray):
    """Sorted distinct keys, how many documents hold each; and for each of these, the document and how often."""
    if not len(key):
        return key, doc, doc, doc
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
    times = np.diff(np.append(first, len(key)))
    key, doc = key[first], doc[first]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[head], np.diff(np.append(head, len(key))), doc, times


def _cut(shards: int, salts: int, spread: int, names: list[str], known, unknown: float):
    """Batches of documents as blocks of their keys by shard, and as rows without their texts, with the score of unknown words."""

    def blocks(held, place):
        number = (TaskContext.get().partitionId() << 32) + place
        tokens, before, doc = (np.concatenate(c) for c in zip(*(h[:3] for h in held)))
        docs = sum(h[3].num_rows for h in held)
        score = np.zeros(docs)
        for kind, key in ((WORDS, tokens), (PAIRS, _bigram_key(before, tokens))):
            key = signed(key)
            seen = _in_filter(known.value, key, shards)
            if kind == WORDS:
                score += np.bincount(doc[~seen], minlength=docs) * unknown
            key, runs, at, times = _held(key[seen], doc[seen])
            starts = np.cumsum(runs) - runs
            for s, i in _by_shard(key % shards, shards):
                n = runs[i]
                # the places of all holders of the keys i, one key after the other
                of = np.repeat(starts[i] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield _row(s, place % salts, number, kind, docs, len(i), len(of), _press(_pack((key[i].view(np.uint64), 8), (n, 4), (at[of], 2), (times[of], 4))))
        rows = pa.Table.from_batches([h[3] for h in held]).combine_chunks().append_column("score", pa.array(score))
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as w:
            w.write_table(rows)
        yield _row(shards, number % spread, number, ROWS, docs, 0, 0, out.getvalue().to_pybytes())

    def run(batches):
        held, n, docs, place = [], 0, 0, 0
        for batch in batches:
            for lo, tokens, before, ends in _tokens(batch.column(len(names))):
                for a in range(0, len(ends), BATCH_DOCS):
                    b = min(a + BATCH_DOCS, len(ends))
                    if held and (n >= BATCH_TOKENS or docs + b - a > BATCH_DOCS):
                        yield from blocks(held, place)
                        held, n, docs, place = [], 0, 0, place + 1
                    first, last = (int(ends[a - 1]) if a else 0), int(ends[b - 1])
                    length = np.diff(np.append(first, ends[a:b]))
                    part = batch.slice(lo + a, b - a)
                    part = pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(length)], names=[*names, "n_tokens"])
                    held.append((tokens[first:last], before[first:last], np.repeat(np.arange(docs, docs + b - a), length), part))
                    n, docs = n + last - first, docs + b - a
        if held:
            yield from blocks(held, place)

    return run


def _fields(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield (*(batch.column(k)[i].as_py() for k in range(7)), batch.column(7)[i].as_buffer())


def _joined(unknown: float):
    """Merge the keys of each batch with the table of their shard: a sum for each document."""

    def run(batches):
        now, blocks, keys, values, of, total = None, [], None, None, None, None
        for shard, salt, batch, kind, docs, n, held, block in _fields(batches):
            if of is not None and (shard, salt, batch) != of:
                yield _row(*of, SUMS, len(total), 0, 0, total.tobytes())
                of = None
            if kind == ROWS:
                yield _row(shard, salt, batch, kind, docs, n, held, block.to_pybytes())
                continue
            if (shard, salt) != now:
                now, blocks, keys = (shard, salt), [], None
            if kind == TABLE:
                blocks.append((np.frombuffer(block, np.int64, n), np.frombuffer(block, np.float64, n, 8 * n)))
                continue
            if keys is None:  # blocks are ranges of keys
                blocks.sort(key=lambda b: b[0][0])
                keys, values = (np.concatenate([b[k] for b in blocks] or [np.zeros(0, t)]) for k, t in ((0, np.int64), (1, np.float64)))
                blocks = []
            if of is None:
                of, total = (shard, salt, batch), np.zeros(docs)
            block = pa.decompress(block, n * 12 + held * 6, codec="zstd")
            key, runs, doc, times = _unpack(block, (n, 8), (n, 4), (held, 2), (held, 4))
            key, value = signed(key), np.full(n, unknown if kind == WORDS else 0.0)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[at] == key
                value[hit] = values[at[hit]]
            total += np.bincount(doc.astype(np.int64), np.repeat(value, runs.astype(np.int64)) * times, docs)
        if of is not None:
            yield _row(*of, SUMS, len(total), 0, 0, total.tobytes())

    return run


def _added(start: float):
    """Add up the sums of each batch in the order of the shards, beside its rows."""

    def run(batches):
        now, total = None, None
        for _, _, batch, kind, docs, _, _, block in _fields(batches):
            if batch != now:
                now, total = batch, np.full(docs, start)
            if kind == SUMS:
                total = total + np.frombuffer(block, np.float64)
                continue
            at = 0
            for rows in pa.ipc.open_stream(block):
                score = np.asarray(rows.column(rows.num_columns - 1)) + total[at : at + rows.num_rows]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(score)], names=rows.schema.names)
                at += rows.num_rows

    return run


def score(docs: DataFrame, model: Counted, columns: list[F.Column]) -> DataFrame:
    """``columns`` with n_tokens and score (log10 of the probability) of each whole text."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, min(width // model.shards, SALT_KEYS // max(1, model.keys)))
    rows = docs.select(*columns, F.col("text").alias("_text"))
    names = rows.columns[:-1]
    known = spark.sparkContext.broadcast(model.known)  # FILTER_BITS, whatever the model's size
    none = F.lit(0).cast("long")
    table = model.table.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(-1).cast("long").alias("batch"),
                               F.lit(TABLE).alias("kind"), none.alias("docs"), "keys", none.alias("held"), "block")
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())]
    scored = []
    for r in range(ROUNDS):
        part = rows.filter(F.pmod(F.xxhash64(*rows.columns), F.lit(ROUNDS)) == r)
        sent = map_texts(part, _cut(model.shards, salts, width, names, known, model.unknown), _JOIN)
        met = sent.union(table).repartition(width, "shard", "salt").sortWithinPartitions("shard", "salt", "batch", "kind")
        met = map_texts(met, _joined(model.unknown), _JOIN)
        met = met.repartition(width, "batch").sortWithinPartitions("batch", "kind", "shard")
        scored.append(keep(map_texts(met, _added(model.start), T.StructType([*rows.schema[:-1], *new])), clean=True))
    return reduce(DataFrame.union, scored)
