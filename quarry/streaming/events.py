"""Event-time streams: sliding windows with late rows, duplicates, and a join of two streams.

Every function takes a DataFrame of events that is a stream or a batch; ``run`` takes a stream
through whatever has arrived and can be started again later with the same folders: offsets,
state and the list of finished output files lie in the checkpoint, so a lost executor or a
restarted driver neither loses nor repeats a row.

State is bounded by the watermark: open windows, keys of the last ``delay``, and rows that can
still find a partner. It is spread by its keys; the join adds a time bin to them, so one user
with a third of all rows does not meet in one task. For large states set
``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider.

Defined results: rows without a time belong to no window, have no partner and are not
told apart by ``once`` (they are left out by all three); null keys form a group in windows and
duplicates and find no partner in the join; an empty stream gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """A stream of the files that arrive in ``path``."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def run(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Take ``stream`` through all that has arrived, add the rows that are final to ``out``, return all of ``out``.

    With the same ``out`` and ``checkpoint`` it goes on where it ended."""
    q = stream.writeStream.format("parquet").outputMode("append").option("path", out) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def _timed(events: DataFrame, time: str, delay: str) -> DataFrame:
    d = events.filter(F.col(time).isNotNull())
    return d.withWatermark(time, delay) if d.isStreaming else d


def sliding_windows(events: DataFrame, keys: list[str], measures: list[Column], time: str = "ts",
                    size: str = "6 hours", slide: str = "2 hours", delay: str = "1 hour") -> DataFrame:
    """(window_start, window_end, keys, measures): a row for each window that holds rows of a key.

    On a stream a window is final once the largest time seen is ``delay`` past its end; rows that come for it
    later do not count (``late_rows`` tells how many)."""
    d = _timed(events, time, delay)
    d = d.groupBy(F.window(time, size, slide).alias("_w"), *keys).agg(*measures)
    return d.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    *[c for c in d.columns if c != "_w"])


def late_rows(counted: DataFrame, arrived: DataFrame, keys: list[str], time: str = "ts", size: str = "6 hours",
              slide: str = "2 hours", delay: str = "1 hour", n: str = "n") -> DataFrame:
    """The final windows of ``counted`` (a result of ``sliding_windows`` with the count ``n``) and ``late``: how many of
    the rows ``arrived`` came too late for them. Windows for which every row was late have null measures."""
    on = ["window_start", "window_end", *keys]
    whole = sliding_windows(arrived, keys, [F.count(F.lit(1)).alias("_all")], time, size, slide)
    # one row: the watermark after all that arrived, in the milliseconds that Spark keeps
    end = arrived.agg(F.max(time).alias("_last")).select(
        F.timestamp_millis(F.unix_millis("_last")) - F.expr(f"interval {delay}")).first()[0]
    whole = whole.filter(F.col("window_end") <= F.lit(end))
    c = counted.select(*[F.col(x).alias(f"_{x}") for x in on], *[x for x in counted.columns if x not in on])
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in on]
    j = whole.join(c, same, "left").drop(*[f"_{x}" for x in on])
    return j.withColumn("late", F.col("_all") - F.coalesce(n, F.lit(0))).drop("_all")


def once(events: DataFrame, keys: list[str], time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each key once: rows that come again within ``delay`` of event time are dropped, later ones are late."""
    d = _timed(events, time, delay)
    return d.dropDuplicatesWithinWatermark(keys) if d.isStreaming else d.dropDuplicates(keys)


def followed_by(first: DataFrame, then: DataFrame, key: str, within_seconds: int, time: str = "ts",
                delay: str = "1 hour") -> DataFrame:
    """Rows of ``first`` with each row of ``then`` of the same key at the same time or up to ``within_seconds`` later.

    Columns of the two are named ``first_...`` and ``then_...``. Bins as long as the time allowed make it an equality
    join: a row of ``then`` is looked for in its own bin and in the one before."""
    bins = F.floor(F.unix_millis(F.col(time)) / F.lit(1000 * within_seconds))
    a, b = _timed(first, time, delay), _timed(then, time, delay)
    a = a.select(*[F.col(c).alias(f"first_{c}") for c in first.columns], bins.alias("_a"))
    b = b.select(*[F.col(c).alias(f"then_{c}") for c in then.columns], F.explode(F.array(bins, bins - 1)).alias("_b"))
    t1, t2 = F.col(f"first_{time}"), F.col(f"then_{time}")
    on = (F.col(f"first_{key}") == F.col(f"then_{key}")) & (F.col("_a") == F.col("_b"))
    late = t1 + F.expr(f"interval {within_seconds} seconds")
    return a.join(b, on & (t2 >= t1) & (t2 <= late)).drop("_a", "_b")
