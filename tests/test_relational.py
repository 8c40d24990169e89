import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import relational as rl

ROWS = [(g.choice("xyz"), g.choice([None, "p", "q"]), g.randrange(5), g.randrange(9)) for g in [random.Random(8)] for _ in range(200)]


def frame(spark):
    return spark.createDataFrame(ROWS, "a string, b string, s long, v long")


def test_cube_has_every_grouping(spark):
    got = {(r.a, r.b, r.grouping_id): (r.n, r.n_distinct, r.v) for r in rl.cube(frame(spark), ["a", "b"], "s", {"v": F.col("v")}).collect()}
    want = {}
    for keep_a, keep_b in itertools.product([True, False], repeat=2):
        gid = (not keep_a) * 2 + (not keep_b)
        for r in ROWS:
            want.setdefault((r[0] if keep_a else None, r[1] if keep_b else None, gid), []).append(r)
    assert got == {k: (len(v), len({r[2] for r in v}), sum(r[3] for r in v)) for k, v in want.items()}


def test_sketches_merge_to_the_sketch_of_all(spark):
    d = spark.range(50_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 3).alias("kind"), (F.col("id") % 9_000).alias("user"), F.col("id").cast("double").alias("v"))
    kept = rl.sketches(d, ["day", "kind"], "user", "v")
    r = rl.estimates(rl.merged(kept, []), 0.5).first()
    assert r.n == 50_000 and abs(r.n_distinct - 9_000) < 270 and abs(r.quantile - 25_000) < 1_000


def test_top_k_and_positions(spark):
    d = frame(spark).withColumn("id", F.monotonically_increasing_id())
    order = [F.desc("v"), F.asc_nulls_last("b"), F.asc("id")]
    rows = [r.asDict() for r in d.collect()]
    rows.sort(key=lambda r: (-r["v"], r["b"] is None, r["b"] or "", r["id"]))
    best = {(r.a, r["rank"]): r.id for r in rl.top_k(d, ["a"], order, 4).collect()}
    for a in "xyz":
        assert [best[a, k] for k in range(1, 5)] == [r["id"] for r in rows if r["a"] == a][:4]
    assert len(best) == 12
    got = sorted((r.position, r.id) for r in rl.positions(d, order).collect())
    assert got == [(i + 1, r["id"]) for i, r in enumerate(rows)]
    assert rl.positions(d.limit(0), order).count() == 0


def test_snapshot_diff_with_nulls(spark):
    schema = "k long, x string, y long"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, None, 3), (None, "n", 1), (5, "e", 5)], schema)
    new = spark.createDataFrame([(1, "a", 1), (2, "B", 2), (3, None, 3), (None, "n", 2), (6, None, None)], schema)
    got = sorted(map(tuple, rl.snapshot_diff(old, new, ["k"], alike=True).collect()), key=str)
    assert got == sorted([(1, "same", ""), (2, "changed", "x,y"), (3, "same", ""), (None, "changed", "y"), (5, "removed", ""), (6, "added", "")], key=str)
    assert rl.snapshot_diff(old, new, ["k"]).count() == 4


def test_multisets_keep_copies(spark):
    a = [r[:2] for r in ROWS[:120]]
    b = [r[:2] for r in ROWS[120:]]
    make = lambda rows: spark.createDataFrame(rows, "a string, b string")
    count = lambda df: {(r.a, r.b): r.n for r in df.collect()}
    assert count(rl.except_all(make(a), make(b))) == dict(Counter(a) - Counter(b))
    assert count(rl.intersect_all(make(a), make(b))) == dict(Counter(a) & Counter(b))
