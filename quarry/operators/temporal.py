"""Ordered operators over time: as-of join, interval join, sessions, running values, range frames.

No key meets in one task. Time is cut into buckets of fixed width; windows run inside
one bucket of one key, and what has to pass from bucket to bucket (the last value, a
running sum) is carried by a window over one row for each bucket of the key. A key that
holds a third of all events is so many small groups, sorted apart.

Nulls: a null key is a group of its own and matches nothing in a join; rows without a
time come first in their key and match nothing. Rows of equal time are ordered
by the tie columns, which the caller names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

MICROS = 1_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970; a time without a zone is read in the session's zone (UTC, unless the caller has another)."""
    return F.unix_micros(ts.cast("timestamp"))


def bucket(ts: Column, seconds: int) -> Column:
    return F.floor(micros(ts) / (seconds * MICROS))


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def _with(d: DataFrame, per_bucket: DataFrame, key: list[str], carried: list[str]) -> DataFrame:
    names = [*key, "_bucket"]
    b = per_bucket.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], *carried)
    on = reduce(lambda x, y: x & y, [d[c].eqNullSafe(b[f"_k{i}"]) for i, c in enumerate(names)])
    return d.join(b, on, "left").drop(*[f"_k{i}" for i in range(len(names))])


def last_value(d: DataFrame, key: list[str], order: list[str], ts: str, value: Column, out: str, seconds: int, itself: bool = True) -> DataFrame:
    """``d`` with ``out``: the last ``value`` that is not null in the rows of the key up to this one (``itself`` or before it)."""
    d = d.withColumn("_bucket", bucket(F.col(ts), seconds)).withColumn("_value", value)
    inside = Window.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if itself else -1)
    ends = d.groupBy(*key, "_bucket").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before))
    d = _with(d.withColumn("_inside", F.last("_value", ignorenulls=True).over(inside)), ends, key, ["_carried"])
    return d.withColumn(out, F.coalesce("_inside", "_carried")).drop("_bucket", "_value", "_inside", "_carried")


def running_sums(d: DataFrame, key: list[str], order: list[str], ts: str, values: dict[str, Column], seconds: int) -> DataFrame:
    """``d`` with each of ``values`` (out -> value) summed over the rows of the key up to this one."""
    d = d.withColumn("_bucket", bucket(F.col(ts), seconds)).withColumns({f"_v{i}": v for i, v in enumerate(values.values())})
    sums = d.groupBy(*key, "_bucket").agg(*[F.sum(f"_v{i}").alias(f"_s{i}") for i in range(len(values))])
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({f"_b{i}": F.sum(f"_s{i}").over(before) for i in range(len(values))})
    inside = Window.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_i{i}": F.sum(f"_v{i}").over(inside) for i in range(len(values))})
    d = _with(d, sums, key, [f"_b{i}" for i in range(len(values))])
    d = d.withColumns({out: F.coalesce(F.col(f"_b{i}"), F.lit(0)) + F.coalesce(F.col(f"_i{i}"), F.lit(0)) for i, out in enumerate(values)})
    return d.drop("_bucket", *[f"_{x}{i}" for x in "vib" for i in range(len(values))])


def as_of_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, tie: str, columns: dict[str, str],
               seconds: int = 86_400, strict: bool = False) -> DataFrame:
    """Rows of ``left`` with ``columns`` (right column -> name) of the last row of ``right`` with the same ``on`` and a time
    not after theirs (``strict``: before theirs), null where there is none.

    Both sides are put into one stream, ordered once; of right rows of one time the one with the largest ``tie`` counts.
    """
    picked = F.struct(*[F.col(c).alias(name) for c, name in columns.items()])
    lrow, rrow = left.select(F.struct(*left.columns).alias("_l")).schema["_l"].dataType, right.select(picked.alias("_r")).schema["_r"].dataType
    keys = [f"_on{i}" for i in range(len(on))]
    tie_type = right.schema[tie].dataType
    a = left.select(F.struct(*left.columns).alias("_l"), F.lit(None).cast(rrow).alias("_r"), *[F.col(c).alias(k) for c, k in zip(on, keys)],
                    F.col(left_ts).alias("_ts"), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(tie_type).alias("_tie"))
    b = right.filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in [*on, right_ts]]))
    b = b.select(F.lit(None).cast(lrow).alias("_l"), picked.alias("_r"), *[F.col(c).alias(k) for c, k in zip(on, keys)],
                 F.col(right_ts).alias("_ts"), F.lit(1 if strict else 0).alias("_side"), F.col(tie).alias("_tie"))
    d = last_value(a.union(b), keys, ["_ts", "_side", "_tie"], "_ts", F.col("_r"), "_found", seconds).filter("_l is not null")
    found = F.when(F.col("_ts").isNotNull(), F.col("_found"))
    return d.select("_l.*", *[found.getField(name).alias(name) for name in columns.values()])


def sessions(events: DataFrame, key: str, ts: str, tie: str, gap_seconds: int, seconds: int = 86_400) -> DataFrame:
    """``events`` with ``session``, from 1 in each key: a new one begins after more than ``gap_seconds`` without an event (gaps and islands)."""
    order = [ts, tie]
    d = last_value(events, [key], order, ts, F.col(ts), "_last", seconds, itself=False)
    starts = F.col("_last").isNull() | (micros(F.col(ts)) - micros(F.col("_last")) > gap_seconds * MICROS)
    return running_sums(d, [key], order, ts, {"session": starts.cast("long")}, seconds).drop("_last")


def range_mean(d: DataFrame, key: list[str], ts: str, value: str, out: str, range_seconds: int, seconds: int = 86_400) -> DataFrame:
    """``d`` with the mean of ``value`` over the key's rows of the last ``range_seconds`` up to this one's time (a range frame).

    Rows near the end of a bucket are also given to the next, where they only serve as the frame's beginning.
    """
    if range_seconds > seconds:
        raise ValueError("a frame must not be wider than a bucket")
    at = micros(F.col(ts))
    b = bucket(F.col(ts), seconds)
    near = at >= (b + 1) * (seconds * MICROS) - range_seconds * MICROS
    copies = F.when(near, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = d.withColumn("_at", at).withColumn("_copy", F.explode(copies)).withColumn("_bucket", b + F.col("_copy"))
    frame = Window.partitionBy(*key, "_bucket").orderBy("_at").rangeBetween(-range_seconds * MICROS, 0)
    return rows.withColumn(out, F.avg(value).over(frame)).filter("_copy = 0").drop("_at", "_copy", "_bucket")


def interval_join(intervals: DataFrame, points: DataFrame, start: str, end: str, ts: str, base_seconds: float = 3600, fan: int = 8, levels: int = 16,
                  totals: dict[str, Column] | None = None, most: int = 64) -> DataFrame:
    """Pairs of rows with ``start`` <= ``ts`` < ``end``: an equality join on bins, the exact condition after it.

    An interval lies in the bins of one level, the finest whose bins are as wide as it is (two bins at most; beyond the
    last level as many as it needs); a point lies in one bin of each level that any interval uses. So
    wide intervals cost no more rows than narrow ones, and no two rows meet twice.

    The pairs themselves can be as many as rows times rows. Where only their number and sums are wanted, ``totals``
    (out -> a column of ``points`` to be summed) returns them in parts: rows of ``intervals`` with ``n_points`` and the
    sums of ``totals`` over some of the interval's points, no point in two of them. Each interval has parts in proportion
    to ``most`` and to the logarithm of the time covered, however many points it holds (see ``_parts``).
    """
    if totals is not None:
        return _parts(intervals, points, start, end, ts, fan, totals, most)
    widths = [w for w in (round(base_seconds * MICROS) * fan**k for k in range(levels)) if w < 1 << 62]  # all that a long holds
    width, levels = F.array(*[F.lit(w).cast("long") for w in widths]), len(widths)
    a, b = micros(F.col(start)), micros(F.col(end))
    level = F.aggregate(F.transform(width, lambda w: (b - a > w).cast("int")), F.lit(0), lambda x, y: x + y)
    i = intervals.filter(F.col(start) < F.col(end)).withColumn("_level", F.least(level, F.lit(levels - 1)))
    w = F.element_at(width, F.col("_level") + 1)
    i = i.withColumn("_bin", F.explode(F.sequence(F.floor(a / w), F.floor((b - 1) / w))))
    used = sorted(r[0] for r in i.select("_level").distinct().collect())  # at most ``levels`` numbers
    p = points.filter(F.col(ts).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")))
    p = p.withColumn("_bin", F.floor(micros(F.col(ts)) / F.element_at(width, F.col("_level") + 1)))
    return i.join(p, ["_level", "_bin"]).filter((F.col(start) <= F.col(ts)) & (F.col(ts) < F.col(end))).drop("_level", "_bin")


def _whole(x: Column, w: Column, up: bool = False) -> Column:
    """``x`` / ``w`` rounded down (or up), in whole numbers."""
    down = F.call_function("div", x - F.pmod(x, w), w)
    return down + (F.pmod(x, w) != 0).cast("long") if up else down


def _span(a: str, b: str, w: str, times: int = 1) -> list[Column]:
    """The whole bins in ``a`` to ``b``, from the first to before the last: named _f, _l, with the number of ``times`` the width."""
    w, name = F.col(w) * times, "" if times == 1 else times
    return [_whole(F.col(a), w, True).alias(f"_f{name}"), _whole(F.col(b), w).alias(f"_l{name}")]


def _parts(intervals: DataFrame, points: DataFrame, start: str, end: str, ts: str, fan: int, totals: dict[str, Column], most: int) -> DataFrame:
    """``interval_join`` with ``totals``.

    The points are added up by moment, these by bins that hold at most ``most`` moments each, and these by ever wider bins,
    each of ``fan`` of the level below. An interval consists of a few whole bins of each level, whose sums it takes (equality
    join), and of two edges narrower than the finest bin, which are joined with the moments.
    """
    sums = [F.sum(f"_s{k}").alias(f"_s{k}") for k in range(len(totals))]
    added = points.filter(F.col(ts).isNotNull()).select(micros(F.col(ts)).alias("_at"), *[v.alias(f"_s{k}") for k, v in enumerate(totals.values())])
    moments = cut_lineage(added.groupBy("_at").agg(F.count("*").alias("n_points"), *sums))
    lo, hi, n = moments.agg(F.min("_at"), F.max("_at"), F.count("*")).first()  # three numbers
    if not n:
        lo, hi = 0, -1
    width = 1
    while (hi + 1 - lo) // (width * fan) > 0 and n * width * fan <= most * (hi + 1 - lo):
        width *= fan
    # dense stretches: finer bins, until none holds too many moments (one at a width of 1)
    while width > 1 and moments.groupBy(_whole(F.col("_at"), F.lit(width))).count().agg(F.max("count")).first()[0] > most:
        width //= fan
    top = 0
    while (hi - lo) // (width * fan**top) >= fan:
        top += 1
    finest = cut_lineage(moments.groupBy(_whole(F.col("_at"), F.lit(width)).alias("_bin")).agg(F.sum("n_points").alias("n_points"), *sums))
    wider = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(fan**k).cast("long").alias("w")) for k in range(top + 1)])).alias("_step")
    bins = finest.select("*", wider).groupBy(F.col("_step.k").alias("_level"), _whole(F.col("_bin"), F.col("_step.w")).alias("_bin")).agg(
        F.sum("n_points").alias("n_points"), *sums)
    a, b = micros(F.col(start)), micros(F.col(end))
    i = intervals.filter(F.col(start) < F.col(end)).withColumn("_a", F.greatest(a, F.lit(lo).cast("long"))).withColumn("_b", F.least(b, F.lit(hi + 1).cast("long")))
    i = i.filter("_a < _b")
    own = [F.col(f"`{c}`") for c in intervals.columns]
    found = [F.col("n_points"), *[F.col(f"_s{k}").alias(out) for k, out in enumerate(totals)]]
    # of each level the whole bins of the interval that no whole bin of the level above holds
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(width * fan**k).cast("long").alias("w")) for k in range(top + 1)])).alias("_step")
    whole = i.select(*own, "_a", "_b", steps).select(*own, F.col("_step.k").alias("_level"), *_span("_a", "_b", "_step.w"), *_span("_a", "_b", "_step.w", fan))
    f, l = F.col("_f"), F.col("_l")
    split = (F.col("_level") < top) & (F.col(f"_f{fan}") < F.col(f"_l{fan}"))
    heads = F.struct(f.alias("x"), F.when(split, F.col(f"_f{fan}") * fan).otherwise(l).alias("y"))
    tails = F.struct(F.when(split, F.col(f"_l{fan}") * fan).otherwise(l).alias("x"), l.alias("y"))
    runs = whole.select(*own, "_level", F.explode(F.array(heads, tails)).alias("_run")).filter("_run.x < _run.y")
    inner = runs.select(*own, "_level", F.explode_outer(F.sequence("_run.x", F.col("_run.y") - 1)).alias("_bin"))
    inner = inner.join(bins, ["_level", "_bin"]).select(*own, *found)
    f, l = _whole(F.col("_a"), F.lit(width), True) * width, _whole(F.col("_b"), F.lit(width)) * width
    edge = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    edges = F.array(edge(F.col("_a"), F.least(f, F.col("_b"))), edge(F.greatest(l, F.least(f, F.col("_b"))), F.col("_b")))
    i = i.select(*own, F.explode(edges).alias("_edge")).select(*own, F.timestamp_micros("_edge.x").alias("_from"), F.timestamp_micros("_edge.y").alias("_to"))
    at = moments.withColumn("_at", F.timestamp_micros("_at"))
    return inner.union(interval_join(i, at, "_from", "_to", "_at", base_seconds=width / MICROS).select(*own, *found))
