"""Pieces that several operators share: tables kept in the shared folder, words
as numpy hashes, components, running positions inside large groups.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.components import components as _components
from ..session import ensure_checkpoint_dir, shuffles_go

# ------------------------------------------------------------------ kept tables


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-llm-{uuid.uuid4().hex}"


def keep(df: DataFrame, clean: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and (unlike ``checkpoint()``)
    lets later readers load single columns. With ``clean`` the shuffle files of the
    write go as soon as it has ended, not when the driver next collects garbage.
    """
    path = shared_folder(df.sparkSession)
    with shuffles_go(df.sparkSession) if clean else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*kept: DataFrame) -> None:
    """Give the disk of tables of ``keep`` back that nothing reads any more: empty ones take their place."""
    for df in kept:
        for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)


#: Bytes of rows that a Python worker gets at once (or one row, if it is longer).
BATCH_BYTES = 8 << 20


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` over rows with texts, in batches of ``BATCH_BYTES`` (set for the
    session; its default of 64 MB is held in several copies).

    Spark uses Python workers again for later tasks: at its end each task gives the
    memory it no longer needs back to the machine.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return free memory of Python, Arrow and the allocator to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def hold_memory(most: int = 64 << 20) -> None:
    """Keep up to ``most`` bytes of free memory in this process until ``give_back``: steps that need the same again do not
    ask the machine for it each time."""
    try:
        mallopt = ctypes.CDLL(None).mallopt
        mallopt(-1, most)  # M_TRIM_THRESHOLD
        mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD, the most that it takes
    except (OSError, AttributeError):  # another C library
        pass


# ------------------------------------------------------------------ words in numpy

#: The white space that separates words, 0x20 and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        _powers[which] = np.cumprod(p)
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (invertible, so distinct inputs stay distinct)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row (nulls are empty)."""
    col = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def word_hashes(data: np.ndarray, offs: np.ndarray, window: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each row, and where each row's words begin.

    Words are the runs without 0x20 and 0x09-0x0D, A-Z lower-cased. Bytes are
    hashed in windows that end between words, so that memory stays bounded for
    texts of any length; row ``i`` has ``hashes[ptr[i]:ptr[i + 1]]``.
    """
    hashes, starts = [], []
    at, end = int(offs[0]), int(offs[-1])
    while at < end:
        to = min(at + window, end)
        if to < end:  # back to the last boundary, else on to the next one
            row_edge = int(offs[np.searchsorted(offs, to, "right") - 1])
            gaps = np.flatnonzero(_SPACE[data[max(at, row_edge) : to]])
            cut = max(row_edge, max(at, row_edge) + int(gaps[-1]) + 1 if len(gaps) else 0)
            if cut <= at:
                row_end = int(offs[np.searchsorted(offs, to, "right")]) if to not in offs else to
                cut = row_end
                for a in range(to, row_end, window):
                    gaps = np.flatnonzero(_SPACE[data[a : min(a + window, row_end)]])
                    if len(gaps):
                        cut = a + int(gaps[0])
                        break
            to = cut
        d = _LOWER[data[at:to]]
        n = len(d)
        word = ~_SPACE[d]
        new_row = np.zeros(n + 1, bool)
        inside = offs[np.searchsorted(offs, at) : np.searchsorted(offs, to, "right")] - at
        new_row[inside] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | new_row[1:n]
        last[:-1] &= ~word[1:] | new_row[1:n]
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        term = (d.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n)
        total = np.cumsum(term)
        h = (total[e] - total[s] + term[s]) * _power("down", _BASE_INV, n)[s]
        hashes.append(mix(h + (e - s + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        at = to
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    at_byte = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, np.searchsorted(at_byte, offs)


def row_slices(offs: np.ndarray, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes (a longer row is a range by itself)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        b = min(b, n)
        yield a, b
        a = b


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, width: int) -> pa.Array:
    """Rows of ``width`` numbers each as a list column."""
    flat = values.reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat))


# ------------------------------------------------------------------ components


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b), each round kept in the shared folder: node, component."""
    return _components(edges, keep)


# ------------------------------------------------------------------ positions in large groups


def running(df: DataFrame, group: str, order: list[str], value: str, out: str, rows_per_bucket: int = 4096) -> DataFrame:
    """``out``: sum of ``value`` over the rows before this one in its group.

    Rows are ordered by a hash of the columns ``order``, then by these (rows equal in all of
    them change places freely, and meet in one task: count them beforehand). No group meets in
    one task: each is cut into buckets of the hash's top bits, bucket sums are added up (one
    row per bucket), and only the rows of one bucket are sorted together.
    """
    n = df.count()
    buckets = 1 << max(0, (n // rows_per_bucket).bit_length())
    h = F.xxhash64(F.lit(20), *order)
    df = df.withColumn("_h", h).withColumn("_b", F.pmod(F.shiftright(h, 24), F.lit(buckets)))
    sums = df.groupBy(group, "_b").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(group).alias("_g"), F.col("_b").alias("_k"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(group, "_b").orderBy("_h", *order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    df = df.join(sums, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_k")))
    return df.withColumn(out, F.col("_o") + F.col("_i")).drop("_h", "_b", "_g", "_k", "_o", "_i", "_s")


def ranked(df: DataFrame, order: list[F.Column], out: str) -> DataFrame:
    """``out``: position of each row in the total order, from 0, without one task for all rows."""
    d = keep(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offset = d.groupBy("_p").agg(F.count("*").alias("_n")).withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    d = d.join(offset.select("_p", "_o"), "_p")
    return d.withColumn(out, F.col("_o") + F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1).drop("_p", "_o")
