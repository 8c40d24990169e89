"""Phrase collocations by sorted count streams.

The layout is that of external estimation of language models: nothing is looked up in
a hash table of counts; count streams are kept sorted and read in lockstep.

1. Each position of a piece of text gives one window, its word and up to four that
   follow. Windows are added up inside each batch and sorted by range; in the sorted
   stream every phrase of one to five words is a run of windows with a common beginning,
   so one pass over the stream counts all orders at once. A run that goes on in the
   next partition is added up afterwards.
2. The counts of at least ``least`` are sorted in suffix order (words last to first). One
   pass reads the streams of all orders in lockstep: the open beginnings of a phrase are its
   ends in the text, so each phrase meets the counts of all its right parts, and marks the
   phrase without its first word if that is as frequent (its extension to the left).
3. The same in prefix order gives the left parts and the extensions to the right; the marks
   of step 2 lie beside the phrases that they mark. Each candidate's lowest score of
   all its cuts is exact: the counts are integers of any size there.

Range partitions cut such streams anywhere, also inside the phrases of one frequent word, so
no word's phrases meet in one task: each task begins with the counts of the open beginnings at
its cut (at most five for each partition, looked up once). A phrase contained in a longer one
that is as frequent is contained in one a word longer that is as frequent, so extensions by one word are enough.

Defined results: a null text is empty, a null lang is ``und``; texts and words of any length count
whole; repeated rows count each time; ties of score go to the more frequent phrase, then to the
smaller in bytes; ties of a candidate's cuts to the earliest; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, map_texts, text_bytes

WORDS, LEAST, TOP = 5, 100, 2000
#: Windows that a batch adds up before it hands them on, and their bytes.
HELD, HELD_BYTES = 150_000, 16 << 20
#: Bytes of windows of a partition (about seven times the text), and counted phrases of one.
WINDOW_BYTES, PHRASES = 48 << 20, 200_000
#: Bytes of text that are sampled for each partition to place its cut (which changes no result).
SAMPLE_BYTES = 40_000
#: The bytes that end a piece, and the other white space between words.
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(0x0A if b in _PIECE_ENDS else 0x20 if b == 0x09 else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

# A key is the language (its name if that is a to z, else % and its bytes in hexadecimal) and the words,
# each followed by a space: then the keys that begin with some words are neighbours in the order of bytes.
# Short names leave more of the words in the first bytes, by which most keys are told apart when they are sorted.

# ------------------------------------------------------------------ counting


def _windows(cuts: list[bytes]):
    """(key, n, part): the windows of all positions, added up, and the range partition of each."""

    def run(batches):
        yield from _added_up(batches, cuts)

    return run


def _added_up(batches, cuts: list[bytes]):
    held: dict[str, Counter] = {}
    size = 0

    def flush():
        keys, n = [], []
        for lang, c in held.items():
            head = lang.encode() + b" "
            keys += [head + k for k in c]
            n += c.values()
        held.clear()
        part = [bisect_right(cuts, k) for k in keys] if cuts else [0] * len(keys)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(part, pa.int32())], names=["key", "n", "part"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            count = held.setdefault(lang, Counter())
            for piece in (text.as_py() or "").encode().translate(_TABLE).split(b"\n"):
                words = [w + b" " for w in piece.split()]
                if not words:
                    continue
                rest = words + [b""] * (WORDS - 1)
                for a in range(0, len(words), HELD):  # a piece may be very long
                    part = rest[a : a + HELD + WORDS - 1]
                    count.update(map(b"".join, zip(*(part[k:] for k in range(WORDS)))))
                    size += WORDS * sum(map(len, part))
                    if size > HELD_BYTES or len(count) > HELD:
                        yield flush()
                        count, size = held.setdefault(lang, Counter()), 0
    if held:
        yield flush()


def _shared_bytes(data: np.ndarray, offs: np.ndarray, width: int = 96) -> np.ndarray:
    """How many bytes each row has in common with the row before it (the first: 0)."""
    size, n = np.diff(offs), len(offs) - 1
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    width = int(min(width, size.max()))
    at = offs[:-1, None] + np.arange(width)
    inside = np.arange(width) < size[:, None]
    m = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
    same = (m[1:] == m[:-1]) & inside[1:] & inside[:-1]
    out[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    for i in np.flatnonzero((out == width) & (size > width)).tolist():
        if size[i - 1] > width:
            out[i] = len(os.path.commonprefix([bytes(data[offs[i - 1] : offs[i]]), bytes(data[offs[i] : offs[i + 1]])]))
    return out


def _runs(least: int):
    """Windows in the order of their keys to (key, n) of all beginnings: the frequent ones, the
    languages, and, whatever they count, those that may go on in a partition before or after."""

    def run(batches):
        last = None
        open_: list[list | None] = [None] * (WORDS + 1)  # for each depth: key, count, whether it began the partition

        def closed(depth, out):
            r = open_[depth]
            if r is not None and (r[1] >= least or depth == 0 or r[2]):
                out.append((r[0], r[1]))

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()).cast(pa.string()), pa.array([n for _, n in out], pa.int64())], names=["key", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            data, offs = text_bytes(batch.column(0))
            n = batch.column(1).to_numpy()
            ends = np.flatnonzero(data[: offs[-1]] == 0x20)
            first = np.searchsorted(ends, offs)
            words = np.diff(first)
            shared = _shared_bytes(data, offs)
            if last is not None:
                shared[0] = len(os.path.commonprefix([last, bytes(data[offs[0] : offs[1]])]))
            begin = np.searchsorted(ends, offs[:-1] + shared) - first[:-1]  # whole words in common
            out = []
            for depth in range(WORDS + 1):
                has = words > depth
                total = np.append(0, np.cumsum(np.where(has, n, 0)))
                starts = np.flatnonzero(has & (begin <= depth))
                if open_[depth] is not None:
                    open_[depth][1] += int(total[starts[0] if len(starts) else -1])
                if not len(starts):
                    continue
                closed(depth, out)
                stops = np.append(starts[1:], len(n))
                sums = total[stops] - total[starts]
                edge = last is None and starts[0] == 0
                for i in np.flatnonzero((sums[:-1] >= least) | (depth == 0) | ((starts[:-1] == 0) & edge)).tolist():
                    row = starts[i]
                    out.append((bytes(data[offs[row] : ends[first[row] + depth] + 1]), int(sums[i])))
                row = starts[-1]
                open_[depth] = [bytes(data[offs[row] : ends[first[row] + depth] + 1]), int(sums[-1]), edge and len(starts) == 1]
            last = bytes(data[offs[-2] : offs[-1]])
            if out:
                yield table(out)
        yield table([(r[0], r[1]) for r in open_ if r is not None])

    return run


def counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, f): occurrences of the phrases of up to five words that occur ``least`` times, and of all words of each language."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    lang = F.when(lang.rlike(r"\A[a-z]+\z"), lang).otherwise(F.concat(F.lit("%"), F.hex(F.encode(lang, "UTF-8"))))
    texts = docs.select(lang.alias("lang"), F.col("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-7 * size // WINDOW_BYTES))
    cuts: list[bytes] = []
    if parts > 1:  # places of the cuts, from the windows of a sample of texts; every window is then dealt by them
        some = map_texts(texts.sample(min(1.0, parts * SAMPLE_BYTES / size), seed=11), _windows([]), "key string, n long, part int")
        keys = some.filter(F.pmod(F.xxhash64("key"), F.lit(256)) == 0).select(F.substring("key", 1, 64).alias("key")).collect()  # some 20 for a partition
        keys = sorted(r.key.encode() for r in keys)
        cuts = sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []
    windows = map_texts(texts, _windows(cuts), "key string, n long, part int")
    stream = windows.repartitionById(len(cuts) + 1, F.col("part")).select("key", "n").sortWithinPartitions("key")
    runs = stream.mapInArrow(_runs(least), "key string, n long")
    f = runs.groupBy("key").agg(F.sum("n").alias("f"))
    return keep(f.filter((F.col("f") >= least) | (F.instr("key", " ") == F.length("key"))))


# ------------------------------------------------------------------ lockstep


def _prefixes(key: str) -> list[str]:
    parts = key.split(" ")[:-1]
    return [" ".join(parts[:k]) + " " for k in range(1, len(parts) + 1)]


def in_order(rows: DataFrame, per: int = PHRASES) -> tuple[DataFrame, list[list[tuple[str, int]]]]:
    """``rows`` (key, f, ...) sorted by ``key`` in range partitions, and for each partition the open
    beginnings (key, f) at the cut before it, shortest first."""
    parts = max(1, -(-rows.count() // per))
    share = F.pmod(F.xxhash64("key"), F.lit(max(1, per // 20))) == 0  # some 20 for a partition, for the places of the cuts only
    sample = rows.filter(share).select("key").collect() if parts > 1 else []
    sample = sorted({r.key for r in sample}, key=str.encode)
    cuts = sorted({sample[len(sample) * k // parts] for k in range(1, parts)}, key=str.encode) if sample else []
    wanted = sorted({p for c in cuts for p in _prefixes(c) if p != c})
    found: dict[str, int] = {}
    if wanted:
        spark = rows.sparkSession
        found = {r.key: r.f for r in rows.filter("f is not null").join(spark.createDataFrame([(w,) for w in wanted], "key string"), "key").collect()}
    seams = [[], *([(p, found[p]) for p in _prefixes(c) if p in found and p != c] for c in cuts)]
    if not cuts:
        return rows.withColumn("part", F.lit(0)).coalesce(1).sortWithinPartitions("key", F.col("f").desc_nulls_last()), seams
    borders = [c.encode() for c in cuts]

    def place(batches):
        for batch in batches:
            at = [bisect_right(borders, k.encode()) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "part"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int"
    dealt = rows.mapInArrow(place, schema).repartitionById(len(seams), F.col("part"))
    return dealt.sortWithinPartitions("key", F.col("f").desc_nulls_last()), seams


def _backwards(key: str) -> str:
    lang, *words = key.split(" ")[:-1]
    return " ".join([lang, *words[::-1]]) + " "


_STREAM = "key string, f long, along array<long>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    key, f, along = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(f, pa.int64()), pa.array(along, pa.list_(pa.int64()))], names=["key", "f", "along"])


class _Open:
    """The phrases that the phrase just read begins with: a stack of (key, count)."""

    def __init__(self, seams):
        self.seams, self.part, self.stack = seams, None, []

    def read(self, part: int, key: str) -> list[tuple[str, int]]:
        if part != self.part:
            self.part, self.stack = part, list(self.seams[part])
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()
        return self.stack


def _right_parts(seams):
    """Suffix order: for each phrase its right parts' counts, and marks (f null) on what its extension to the left equals."""

    def run(batches):
        open_ = _Open(seams)
        for batch in batches:
            out = []
            for key, f, part in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2))):
                above = open_.read(part, key)
                out.append((_backwards(key), f, [n for _, n in above[1:]]))
                if len(above) > 2 and above[-1][1] == f:
                    out.append((_backwards(above[-1][0]), None, None))
                above.append((key, f))
            yield _batch(out)

    return run


def _left_parts(seams):
    """Prefix order: for each candidate without a mark the cut of the lowest score; marks (score null) on what its extension to the right equals."""

    def run(batches):
        open_ = _Open(seams)
        for batch in batches:
            out: list[tuple] = []
            for key, f, right, part in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3))):
                above = open_.read(part, key)
                if f is None:
                    out.append((key, None, None, None, None, None))
                    continue
                if len(above) > 1:
                    if len(above) > 2 and above[-1][1] == f:
                        out.append((above[-1][0], None, None, None, None, None))
                    total, left = above[0][1], [n for _, n in above[1:]]
                    score, k = min((1000 * f * total // (left[k] * right[-1 - k]), k) for k in range(len(left)))
                    out.append((key, f, left[k], right[-1 - k], total, score))
                above.append((key, f))
            cols = zip(*out) if out else [()] * 6
            kinds = [pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "a", "l", "r", "n", "score"])

    return run


# ------------------------------------------------------------------ the operator


def candidates(docs: DataFrame, least: int = LEAST, per: int = PHRASES) -> DataFrame:
    """key (language always in hexadecimal), a, l, r, n, score of every phrase of two words or more that no longer one of the same count contains."""
    c = counts(docs, least)
    words = F.split("key", " ")  # language, words, nothing
    turned = F.concat(words[0], F.lit(" "), F.array_join(F.transform(F.reverse(F.slice(words, F.lit(2), F.size(words) - 2)), lambda w: F.concat(w, F.lit(" "))), ""))
    stream, seams = in_order(keep(c.select(turned.alias("key"), "f")), per)
    right = keep(stream.select("key", "f", "part").mapInArrow(_right_parts(seams), _STREAM))
    stream, seams = in_order(right, per)
    both = keep(stream.select("key", "f", "along", "part").mapInArrow(_left_parts(seams), "key string, a long, l long, r long, n long, score long"))
    found = both.filter("a is not null").join(both.filter("a is null").select("key").distinct(), "key", "left_anti")
    lang = F.substring_index("key", " ", 1)
    lang = F.when(lang.startswith("%"), F.substring(lang, 2, 1 << 30)).otherwise(F.hex(F.encode(lang, "UTF-8")))
    return found.withColumn("key", F.concat(lang, F.expr("substring(key, instr(key, ' '))")))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    c = candidates(docs, least)
    head = F.instr("key", " ")
    c = c.select(F.decode(F.unhex(F.substring_index("key", " ", 1)), "UTF-8").alias("lang"),
                 F.substring(F.col("key"), head + 1, F.length("key") - head - 1).alias("phrase"), "a", "l", "r", "n", "score")
    # the limit lets Spark keep only each task's first of a language before they meet
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    c = c.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return c.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
