"""Interpolated modified Kneser-Ney bigram models: counted in Spark, stored as sorted
hash arrays, memory-mapped by the tasks that score.

Counting: each batch of texts becomes sorted arrays of its distinct bigrams and
words with their counts, cut by hash into shards (so what is shuffled is one
block per batch and shard, not a row per n-gram). A shard's task merges its
blocks, writes the sorted keys and counts to a file in the shared folder, and
passes on what the words need: how many contexts precede each word, and how many
followers of each context were seen once, twice, more often. A second round of
shards merges these with the word counts. The bigrams of a frequent word are spread
over 64 shards by their second word, so no word makes a hot shard.

Scoring: tasks memory-map the shards and look up the sorted distinct words and
bigrams of a batch. Nothing is collected but a few numbers per shard. The shared
folder (``spark.checkpoint.dir``) must be mounted on all executors.

Tokens are words (A-Z lower-cased) and one end per text; a word is its 64-bit hash,
in bigrams the upper 48 bits of it. Defined results: a null text is an empty text:
one end token; repeated rows count as often as they stand; a null doc_id is not held
out; without training rows every token has probability 1; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, map_texts, mix, row_slices, shared_folder, text_bytes, word_hashes
from .langid import held_out

START, END = (mix(np.array([n], np.uint64))[0] for n in (101, 102))
_PART = np.uint64(16)  # a word's hash without its lower 16 bits stands for it in bigrams
_SPREAD = np.uint64(63)
_BIGRAM = np.uint64(0x9FB21C651E98DF25)
BATCH_BYTES = 6 << 20
#: Tokens that are counted together before they are cut into shards.
BATCH_TOKENS = 1_500_000
COUNTS, FOLLOWERS, CONTEXTS = 0, 1, 2


# ------------------------------------------------------------------ arrays as blocks


def _pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Byte planes of unsigned columns (the lower ``width`` bytes of each): zeros compress away."""
    return b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for c, w in columns)


def _unpack(block, *shape: tuple[int, int]) -> list[np.ndarray]:
    """The columns of a block, from their (length, width)."""
    raw, at, out = np.frombuffer(block, np.uint8), 0, []
    for n, w in shape:
        full = np.zeros((n, 8), np.uint8)
        full[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(full.view("<u8").reshape(n))
        at += n * w
    return out


def _merge(keys: list[np.ndarray], *values: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted distinct keys, and the sums of each value."""
    k = np.concatenate(keys)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, int)
    return [k[first], *(np.add.reduceat(np.concatenate(v)[order], first) if len(k) else np.zeros(0, np.uint64) for v in values)]


def _bigram_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _BIGRAM + w)


def _bigram_shard(v: np.ndarray, w: np.ndarray, shards: int) -> np.ndarray:
    return mix(v * _BIGRAM + (w & _SPREAD) + np.uint64(1)) % np.uint64(shards)


def _word_shard(part: np.ndarray, shards: int) -> np.ndarray:
    return mix(part) % np.uint64(shards)


def _by_shard(shard: np.ndarray, shards: int):
    """(shard, indices) of those present, indices in their old order."""
    order = np.argsort(shard.astype(np.int32), kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
    for s in range(shards):
        if cut[s] < cut[s + 1]:
            yield s, order[cut[s] : cut[s + 1]]


def _tokens(col: pa.Array):
    """For slices of rows: first row, tokens and their contexts, end of each row."""
    data, offs = text_bytes(col)
    for lo, hi in row_slices(offs, BATCH_BYTES):
        words, ptr = word_hashes(data, offs[lo : hi + 1])
        rows = hi - lo
        tokens = np.insert(words, ptr[1:], END)
        last = ptr[1:] + np.arange(rows)
        before = np.append(START, tokens[:-1])
        before[last[:-1] + 1] = START
        yield lo, tokens, before, last + 1


# ------------------------------------------------------------------ counting


def _count(shards: int):
    def blocks(tokens, before, texts):
        v, w = before >> _PART, tokens >> _PART
        _, first, n = np.unique(_bigram_key(v, w), return_index=True, return_counts=True)
        v, w, n = v[first], w[first], n.astype(np.uint64)
        order = np.lexsort((w, v))
        v, w, n = v[order], w[order], n[order]
        for s, i in _by_shard(_bigram_shard(v, w, shards), shards):
            head = np.flatnonzero(np.append(True, v[i][1:] != v[i][:-1]))
            run_length = np.diff(np.append(head, len(i))).astype(np.uint64)
            yield _row(s, FOLLOWERS, len(head), len(i), _pack((v[i][head], 6), (run_length, 4), (w[i], 6), (n[i], 4)))
        word, n = np.unique(np.concatenate([tokens, np.full(texts, START)]), return_counts=True)
        for s, i in _by_shard(_word_shard(word >> _PART, shards), shards):
            yield _row(s, COUNTS, len(i), 0, _pack((word[i], 8), (n[i], 8)))

    def run(batches):
        held, texts = [], 0
        for batch in batches:
            for _, tokens, before, ends in _tokens(batch.column(0)):
                held.append((tokens, before))
                texts += len(ends)
                if sum(len(t) for t, _ in held) >= BATCH_TOKENS:
                    yield from blocks(*map(np.concatenate, zip(*held)), texts)
                    held, texts = [], 0
        if held:
            yield from blocks(*map(np.concatenate, zip(*held)), texts)

    return run


_BLOCKS = "shard int, kind int, a long, b long, block binary"


def _row(shard, kind, a, b, block):
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([a], pa.int64()), pa.array([b], pa.int64()), pa.array([block], pa.binary())],
        names=["shard", "kind", "a", "b", "block"])


def _shards_of(batches):
    """(shard, its rows) from rows sorted by shard."""
    now, rows = None, []
    for batch in batches:
        for s, kind, a, b, block in zip(*(batch.column(k) for k in range(5))):
            if s.as_py() != now:
                if rows:
                    yield now, rows
                now, rows = s.as_py(), []
            rows.append((kind.as_py(), a.as_py(), b.as_py(), block.as_buffer()))
    if rows:
        yield now, rows


def _write(path: str, *arrays: np.ndarray) -> None:
    """All at once: a task that runs twice leaves one whole file."""
    part = f"{path}.{os.getpid()}.{np.random.default_rng().integers(1 << 60)}"
    with open(part, "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data)
    os.replace(part, path)


def _counts_of_counts(n: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5].astype(np.uint64)


def _bigrams(folder: str, shards: int):
    """Merge a shard's bigrams, write them, pass on what the words need."""

    def run(batches):
        for s, rows in _shards_of(batches):
            vs, ws, ns = [], [], []
            for _, a, b, block in rows:
                head, length, w, n = _unpack(block, (a, 6), (a, 4), (b, 6), (b, 4))
                vs.append(np.repeat(head, length.astype(np.int64)))
                ws.append(w)
                ns.append(n)
            v, w = np.concatenate(vs), np.concatenate(ws)
            key = _bigram_key(v, w)
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n = np.add.reduceat(np.concatenate(ns)[order], first)
            key, v, w = key[first], v[order][first], w[order][first]
            big = n >= 255
            _write(f"{folder}/bigrams-{s}", key, key[big], n[big], np.minimum(n, 255).astype(np.uint8))
            yield _row(s, FOLLOWERS, len(key), int(big.sum()), _counts_of_counts(n).tobytes())
            word, *seen = _merge([v], [(n == 1).astype(np.uint64)], [(n == 2).astype(np.uint64)], [(n > 2).astype(np.uint64)])
            for t, i in _by_shard(_word_shard(word, shards), shards):
                yield _row(t, CONTEXTS, len(i), 0, _pack((word[i], 6), *((x[i], 4) for x in seen)))
            word, before = np.unique(w, return_counts=True)
            for t, i in _by_shard(_word_shard(word, shards), shards):
                yield _row(t, COUNTS, len(i), 0, _pack((word[i], 6), (before[i], 4)))

    return run


def _words(folder: str, discounts: list[float]):
    """Merge a shard's words: count, weight of the lower order after it, contexts before it."""

    def run(batches):
        for s, rows in _shards_of(batches):
            count, after, before = ([], []), ([], [], [], []), ([], [])
            for kind, a, b, block in rows:
                into, widths = {(COUNTS, 0): (count, (8, 8)), (CONTEXTS, 0): (after, (6, 4, 4, 4)), (COUNTS, 1): (before, (6, 4))}[kind, b]
                for column, x in zip(into, _unpack(block, *((a, width) for width in widths))):
                    column.append(x)
            none = [np.zeros(0, np.uint64)]
            word, n = _merge(*(c or none for c in count))
            part, *seen = _merge(*(c or none for c in after))
            preceded, contexts = _merge(*(c or none for c in before))

            def at(keys, values, word=word):
                if not len(keys):
                    return np.zeros(len(word))
                i = np.minimum(np.searchsorted(keys, word >> _PART), len(keys) - 1)
                return np.where(keys[i] == word >> _PART, values[i], 0).astype(float)

            left = sum(d * at(part, x) for d, x in zip(discounts, seen)) / np.maximum(n, 1)
            contexts = at(preceded, contexts).astype(np.uint64)
            _write(f"{folder}/words-{s}", word, n, left.astype(np.float32), contexts.astype(np.uint32))
            real = word != START
            stats = np.concatenate([_counts_of_counts(contexts[contexts > 0]), np.array([int((contexts > 2).sum()), int(contexts.sum()), int(n[real].sum()), int(real.sum())], np.uint64)])
            yield _row(s, COUNTS, len(word), 0, stats.tobytes())

    return run


def _discounts(n: np.ndarray) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from counts of counts 1 to 4."""
    n = [float(x) for x in n]
    if min(n[0], n[1]) <= 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 3.0]
    return [min(max(d, 0.1 * (k + 1)), k + 1.0) for k, d in enumerate(raw)]


@dataclass
class Model:
    """Where a model's arrays lie, and the numbers that hold for all of it."""

    folder: str
    shards: int
    bigrams: dict[int, tuple[int, int]]  # of each shard: keys, keys with large counts
    words: dict[int, int]
    discounts: list[float]
    word_discounts: list[float]
    tokens: int  # in training, ends too
    vocabulary: int
    pairs: int  # distinct bigrams
    rest: float  # weight of the uniform distribution


def _mounted(folder: str) -> str:
    path = folder.removeprefix("file:")
    if ":" in path.split("/")[0]:
        raise ValueError(f"{folder}: the n-gram arrays need a folder that all executors have mounted")
    return "/" + path.lstrip("/")


def fit(texts: DataFrame) -> Model:
    """Count the ``text`` column of ``texts`` and store the model in the shared folder."""
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = _mounted(shared_folder(spark))
    os.makedirs(folder)
    blocks = map_texts(texts.select("text"), _count(shards), _BLOCKS)
    # one pass over the texts feeds both rounds
    blocks = blocks.repartition(shards, "kind", "shard")
    first = blocks.sortWithinPartitions("kind", "shard").mapInArrow(_first_round(folder, shards), _BLOCKS + ", round int")
    first = keep(first)
    done = first.filter("round = 0").select("shard", "a", "b", "block").collect()  # a few numbers per shard
    discounts = _discounts(sum((np.frombuffer(r.block, np.uint64) for r in done), np.zeros(4, np.uint64)))
    second = first.filter("round > 0").drop("round").repartition(shards, "shard").sortWithinPartitions("shard")
    last = second.mapInArrow(_words(folder, discounts), _BLOCKS).select("shard", "a", "block").collect()  # likewise
    total = sum((np.frombuffer(r.block, np.uint64) for r in last), np.zeros(8, np.uint64))
    low = _discounts(total[:4])
    pairs = int(total[5])
    rest = (low[0] * int(total[0]) + low[1] * int(total[1]) + low[2] * int(total[4])) / max(1, pairs)
    return Model(folder, shards, {r.shard: (r.a, r.b) for r in done}, {r.shard: r.a for r in last}, discounts, low, int(total[6]), int(total[7]), pairs, rest)


def _first_round(folder: str, shards: int):
    """Bigram blocks are merged and written; word blocks go on as they are."""
    bigrams = _bigrams(folder, shards)

    def tagged(row, number):
        return pa.RecordBatch.from_arrays([*row.columns, pa.array([number], pa.int32())], names=[*row.schema.names, "round"])

    def run(batches):
        def only_bigrams():
            for batch in batches:
                kinds = np.asarray(batch.column(1))
                for i in np.flatnonzero(kinds == COUNTS).tolist():
                    waiting.append(batch.slice(i, 1))
                n = int((kinds == FOLLOWERS).sum())
                if n:
                    yield batch.slice(batch.num_rows - n, n)

        waiting: list = []
        for row in bigrams(only_bigrams()):
            while waiting:
                yield tagged(waiting.pop(), 1)
            kind = row.column(1)[0].as_py()
            if kind == COUNTS:  # contexts before each word
                row = row.set_column(3, "b", pa.array([1], pa.int64()))
            yield tagged(row, 0 if kind == FOLLOWERS else 1)
        while waiting:
            yield tagged(waiting.pop(), 1)

    return run


# ------------------------------------------------------------------ scoring


class Lookup:
    """A model's arrays, mapped as they are needed."""

    def __init__(self, model: Model):
        self.m, self.maps = model, {}

    def _map(self, kind: str, s: int, *layout):
        if (kind, s) not in self.maps:
            raw = np.memmap(f"{self.m.folder}/{kind}-{s}", np.uint8, "r")
            at, arrays = 0, []
            for n, t in layout:
                size = n * np.dtype(t).itemsize
                arrays.append(raw[at : at + size].view(t))
                at += size
            self.maps[kind, s] = arrays
        return self.maps[kind, s]

    def words(self, words: np.ndarray):
        """count, weight of the lower order, contexts of sorted distinct words."""
        n, left, contexts = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words))
        for s, i in _by_shard(_word_shard(words >> _PART, self.m.shards), self.m.shards):
            size = self.m.words.get(s, 0)
            if size:
                key, count, weight, before = self._map("words", s, (size, np.uint64), (size, np.uint64), (size, np.float32), (size, np.uint32))
                at = np.minimum(np.searchsorted(key, words[i]), size - 1)
                hit = key[at] == words[i]
                at, i = at[hit], i[hit]
                n[i], left[i], contexts[i] = count[at], weight[at], before[at]
        return n, left, contexts

    def bigrams(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Counts of bigrams."""
        key = _bigram_key(v, w)
        order = np.argsort(key)
        key, shard, out = key[order], _bigram_shard(v, w, self.m.shards)[order], np.zeros(len(v))
        for s, i in _by_shard(shard, self.m.shards):
            size, large = self.m.bigrams.get(s, (0, 0))
            if size:
                keys, big, counts, small = self._map("bigrams", s, (size, np.uint64), (large, np.uint64), (large, np.uint64), (size, np.uint8))
                k = key[i]
                at = np.minimum(np.searchsorted(keys, k), size - 1)
                n = np.where(keys[at] == k, small[at], 0).astype(float)
                full = np.flatnonzero(n == 255)
                n[full] = counts[np.searchsorted(big, k[full])] if len(full) else 0
                out[order[i]] = n
        return out

    def score(self, tokens: np.ndarray, before: np.ndarray):
        """count of each token, and log10 of its probability after its context."""
        m = self.m
        distinct, index = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        n, left, contexts = self.words(distinct)
        t, b = index[: len(tokens)], index[len(tokens) :]
        cut = np.array([0.0, *m.word_discounts])[np.minimum(contexts, 3).astype(int)]
        low = (np.maximum(contexts - cut, 0) / max(1, m.pairs) + (m.rest if m.pairs else 1.0) / (m.vocabulary + 1))[t]
        pair = self.bigrams(before >> _PART, tokens >> _PART)
        pair[n[b] == 0] = 0
        cut = np.array([0.0, *m.discounts])[np.minimum(pair, 3).astype(int)]
        p = np.where(n[b] > 0, np.maximum(pair - cut, 0) / np.maximum(n[b], 1) + left[b] * low, low)
        return n[t], np.log10(np.minimum(p, 1.0))


def score(docs: DataFrame, model: Model, columns: list[F.Column]) -> DataFrame:
    """``columns`` with n_tokens, n_known, base_score and score of each whole text."""
    rows = docs.select(*columns, F.col("text").alias("_text"))
    names = rows.columns[:-1]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        look = Lookup(sent.value)
        m = sent.value
        for batch in batches:
            for lo, tokens, before, ends in _tokens(batch.column(len(names))):
                n, log_p = look.score(tokens, before)
                first = np.append(0, ends[:-1])
                base = np.log10((n + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
                part = batch.slice(lo, len(ends))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ends - first), pa.array(np.add.reduceat(n > 0, first, dtype=np.int64)),
                     pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(log_p, first))],
                    names=[*names, "n_tokens", "n_known", "base_score", "score"])

    new = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    return map_texts(rows, run, T.StructType([*rows.schema[:-1], *(T.StructField(n, t) for n, t in new)]))


def perplexity(tokens: F.Column, score: F.Column) -> F.Column:
    return F.pow(F.lit(10.0), -score / tokens)


def language_model(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; a fifth of the documents is held out."""
    out = held_out(F.col("doc_id"), 5, 1)
    model = fit(docs.filter(~out))
    s = score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out")])
    return s.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
