from fractions import Fraction

import pytest

from quarry.operators import rank as rk


def edges(spark, text):
    rows = [tuple(l.split(" ")) for l in text.split(" / ")]
    return spark.createDataFrame(rows, "src string, dst string")


FIX = "A B / A C / B C / C A / A B / C D"
EXPECTED = {
    1: {"A": Fraction(1, 6), "B": Fraction(1, 6), "C": Fraction(1, 2), "D": Fraction(1, 6)},
    2: {"A": Fraction(1, 4), "B": Fraction(1, 12), "C": Fraction(1, 4), "D": Fraction(1, 4)},
    3: {"A": Fraction(1, 8), "B": Fraction(1, 8), "C": Fraction(5, 24), "D": Fraction(1, 8)},
}


@pytest.mark.parametrize("rounds", [1, 2, 3])
@pytest.mark.parametrize("slice_size", [200_000, 1])
def test_hand_fixture(spark, rounds, slice_size):
    g = rk.LinkGraph(rk.distinct_edges(edges(spark, FIX)), edges_per_slice=slice_size)
    got = {r["id"]: r["rank"] for r in g.run(rounds, checkpoint_every=2).collect()}
    assert got.keys() == EXPECTED[rounds].keys()
    for k, v in EXPECTED[rounds].items():
        assert got[k] == pytest.approx(float(v), abs=1e-12)


def test_page_without_in_links_vanishes(spark):
    g = rk.LinkGraph(rk.distinct_edges(edges(spark, "E A / A B / B A")))
    r1 = {r["id"]: r["rank"] for r in g.run(1).collect()}
    assert r1 == pytest.approx({"A": 2 / 3, "B": 1 / 3})
    r10 = {r["id"]: r["rank"] for r in g.run(10, checkpoint_every=3).collect()}
    assert r10 == pytest.approx({"A": 1 / 3, "B": 2 / 3})


def test_closed_graph_keeps_mass_and_damping(spark, small_dir):
    from quarry.sources import tables as tb
    e = tb.supply_edges(spark, small_dir, closed=True)
    total = sum(r["rank"] for r in rk.pagerank(e, 5).collect())
    assert total == pytest.approx(1.0, abs=1e-9)
    damped = sum(r["rank"] for r in rk.pagerank(e, 5, damping=0.85).collect())
    assert damped == pytest.approx(1.0, abs=1e-9)
    leaky = tb.supply_edges(spark, small_dir, closed=False)
    masses = [sum(r["rank"] for r in rk.pagerank(leaky, k).collect()) for k in (1, 2, 3)]
    assert masses[0] >= masses[1] >= masses[2]


def test_edges_are_computed_once(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    e = spark.createDataFrame(edges(spark, FIX).rdd.mapPartitions(count), "src string, dst string")
    for slice_size in (200_000, 1):
        before = seen.value
        g = rk.LinkGraph(rk.distinct_edges(e.withColumn("dst", F.concat("dst", F.lit("")))), edges_per_slice=slice_size)
        got = {r["id"]: r["rank"] for r in g.run(1).collect()}
        assert got == pytest.approx({k: float(v) for k, v in EXPECTED[1].items()}) and seen.value - before == 6
        g.unpersist()


def test_shuffles_go_when_the_lineage_is_cut(spark):
    """Rounds leave no shuffle files behind that nothing reads again."""
    import time

    from quarry.session import cut_lineage

    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before, clean = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    kept = cut_lineage(spark.range(1000).repartition(7, "id").groupBy("id").count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert kept.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == clean
