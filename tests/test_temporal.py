import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import temporal as tp

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def some_events(seed, n=300):
    g = random.Random(seed)
    rows = [(i, g.choice([1, 2, None]) if g.random() < 0.5 else 7, at(g.choice([g.randrange(400), g.random() * 400])), g.choice("ab"), round(g.random(), 3)) for i in range(n)]
    return rows + [(n, 7, None, "a", 1.0), (n + 1, None, None, "b", 1.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz, kind string, value double")


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("seconds", [3600, 86_400, 10**8])
def test_as_of_join_equals_a_plain_search(spark, strict, seconds):
    rows = some_events(3)
    left, right = [r for r in rows if r[3] == "a"], [r for r in rows if r[3] == "b"]

    def best(r):
        ok = [x for x in right if None not in (x[1], x[2], r[1], r[2]) and x[1] == r[1] and (x[2] < r[2] if strict else x[2] <= r[2])]
        return max(ok, key=lambda x: (x[2], x[0]), default=(None,))[0]

    out = tp.as_of_join(frame(spark, left), frame(spark, right), ["user"], "ts", "ts", "id", {"id": "found"}, seconds, strict).collect()
    assert {(r.id, r.found) for r in out} == {(r[0], best(r)) for r in left} and len(out) == len(left)


def test_sessions_sums_and_frames_equal_a_plain_pass(spark):
    rows = [r for r in some_events(4) if r[1] is not None and r[2] is not None]
    want, last, n, total = {}, {}, {}, {}
    for i, user, ts, _, value in sorted(rows, key=lambda r: (r[2], r[0])):
        n[user] = n.get(user, 0) + (user not in last or ts - last[user] > dt.timedelta(hours=1))
        last[user], total[user] = ts, total.get(user, 0.0) + value
        frame_rows = [r[4] for r in rows if r[1] == user and ts - dt.timedelta(hours=5) <= r[2] <= ts]
        want[i] = (n[user], round(total[user], 6), round(sum(frame_rows) / len(frame_rows), 6))
    for seconds in (6 * 3600, 10**7):
        d = tp.sessions(frame(spark, rows), "user", "ts", "id", 3600, seconds)
        d = tp.running_sums(d, ["user"], ["ts", "id"], "ts", {"total": F.col("value")}, seconds)
        d = tp.range_mean(d, ["user"], "ts", "value", "mean", 5 * 3600, seconds)
        assert {r.id: (r.session, round(r.total, 6), round(r.mean, 6)) for r in d.collect()} == want
    with pytest.raises(ValueError):
        tp.range_mean(d, ["user"], "ts", "value", "m", 100, 50)


def test_a_hot_user_is_dealt_by_time(spark):
    n = 20_000  # one user, one event a minute
    e = spark.range(n).select("id", F.lit(1).alias("user"), (F.lit(DAY).cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("ts"))
    d = tp.last_value(e, ["user"], ["ts", "id"], "ts", F.when(F.col("id") == 0, F.col("id")), "first", 3600)
    assert d.filter("first = 0").count() == n  # carried over 333 buckets
    size = e.groupBy(tp.bucket(F.col("ts"), 3600)).count().agg(F.max("count")).first()[0]
    assert size == 60  # what one window sorts together
    assert tp.sessions(e, "user", "ts", "id", 120, 3600).agg(F.max("session")).first()[0] == 1


def test_interval_join_equals_all_pairs_under_the_condition(spark):
    g = random.Random(6)
    spans = [(i, at(a), at(a + g.choice([0, 0.5, 1, 8, 8.001, 64, 500]))) for i, a in enumerate(g.choice([g.randrange(500), g.random() * 500]) for _ in range(120))]
    spans += [(1000, None, at(3)), (1001, at(3), None), (1002, at(9), at(1)), (1003, at(-100_000), at(100_000))]
    points = [(i, at(g.choice([g.randrange(600), g.random() * 600]))) for i in range(150)] + [(999, None)]
    i = spark.createDataFrame(spans, "span long, a timestamp_ntz, b timestamp_ntz")
    p = spark.createDataFrame(points, "point long, t timestamp_ntz")
    want = {(s, x) for s, a, b in spans if a and b for x, t in points if t and a <= t < b}
    for levels in (1, 2, 16):
        got = [(r.span, r.point) for r in tp.interval_join(i.filter("span <> 1003") if levels == 1 else i, p, "a", "b", "t", fan=4, levels=levels).collect()]
        assert len(got) == len(set(got)) and set(got) == {w for w in want if levels > 1 or w[0] != 1003}
    assert tp.interval_join(i.limit(0), p, "a", "b", "t").count() == 0


def test_interval_totals_equal_all_pairs_in_few_rows(spark):
    g = random.Random(8)
    spans = [(i, at(a), at(a + g.choice([0, 0.0001, 1, 8, 24, 64, 500]))) for i, a in enumerate(g.choice([g.randrange(500), g.random() * 500]) for _ in range(100))]
    spans += [(1000, None, at(3)), (1001, at(3), None), (1002, at(9), at(1)), (1003, at(-100_000), at(100_000)), (3, at(1), at(400)), (3, at(1), at(400))]
    points = [(at(g.choice([g.randrange(600), g.random() * 600, 100 + g.random() / 10])), g.choice([None, round(g.random(), 2)])) for _ in range(3000)] + [(None, 1.0)]
    i = spark.createDataFrame(spans, "span long, a timestamp_ntz, b timestamp_ntz")
    p = spark.createDataFrame(points, "t timestamp_ntz, value double")
    want = {}
    for s, a, b in spans:
        if a and b:
            for t, v in points:
                if t and a <= t < b:
                    n, total = want.get(s, (0, None))
                    want[s] = n + 1, total if v is None else (total or 0) + v
    for most, fan in ((1, 3), (64, 8)):
        parts = tp.interval_join(i, p, "a", "b", "t", fan=fan, totals={"total": F.col("value")}, most=most)
        got = {r.span: (r.n, r.total) for r in parts.groupBy("span").agg(F.sum("n_points").alias("n"), F.sum("total").alias("total")).collect()}
        assert {s: (n, None if v is None else round(v, 6)) for s, (n, v) in got.items()} == {s: (n, None if v is None else round(v, 6)) for s, (n, v) in want.items()}
    # 200 intervals that hold all of 20,000 points: far fewer rows than their 4,000,000 pairs
    p = spark.range(20_000).select((F.lit(DAY).cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("t"), F.lit(1.0).alias("value"))
    i = spark.range(200).select("id", (F.lit(DAY).cast("timestamp") - F.make_dt_interval(secs=F.col("id"))).alias("a"), F.lit(at(99)).cast("timestamp").alias("b"))
    parts = tp.interval_join(i, p, "a", "b", "t", totals={"total": F.col("value")})
    assert parts.count() < 200 * 300 and parts.agg(F.sum("n_points")).first()[0] == 4_000_000
    assert tp.interval_join(i, p.limit(0), "a", "b", "t", totals={"total": F.col("value")}).count() == 0
