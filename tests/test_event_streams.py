import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from quarry.operators import similarity as sim
from quarry.sources import text as tx
from quarry.streaming import events as ev

SCHEMA = "id long, who long, kind string, ts timestamp"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def folders():
    return [tempfile.mkdtemp(prefix="quarry-events-", dir="/tmp") for _ in range(3)]


def deliver(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return ev.source(spark, path, spark.createDataFrame([], SCHEMA).schema)


HOW = {"size": "60 minutes", "slide": "30 minutes", "delay": "10 minutes"}


def test_windows_late_rows_and_restart(spark):
    path, out, state = folders()
    flow = lambda: ev.sliding_windows(stream(spark, path), ["kind"], [F.count(F.lit(1)).alias("n")], **HOW)
    deliver(spark, path, [(1, 1, "a", at(5)), (2, 1, "a", at(40)), (3, 1, None, at(45)), (4, 1, "a", None), (5, 1, "a", at(130))])
    first = ev.run(flow(), out, state)
    minute = lambda r: int((r["window_end"] - at(0)).total_seconds() // 60)
    # the watermark is at 120 minutes: windows that end there or before are final
    assert {(minute(r), r["kind"]): r["n"] for r in first.collect()} == {
        (30, "a"): 1, (60, "a"): 2, (90, "a"): 1, (60, None): 1, (90, None): 1}
    # 50 is late for both of its windows, 100 for the one that ends at 120 only; 70 stands alone and late
    deliver(spark, path, [(6, 1, "a", at(50)), (7, 1, "a", at(100)), (8, 1, "b", at(70)), (9, 1, "a", at(300))])
    d = ev.run(flow(), out, state)
    got = ev.late_rows(d, spark.read.parquet(path), ["kind"], **HOW)
    assert {(minute(r), r["kind"]): (r["n"], r["late"]) for r in got.collect()} == {
        (30, "a"): (1, 0), (60, "a"): (2, 1), (90, "a"): (1, 1), (60, None): (1, 0), (90, None): (1, 0),
        (120, "a"): (None, 1), (90, "b"): (None, 1), (120, "b"): (None, 1),
        (150, "a"): (2, 0), (180, "a"): (1, 0)}
    assert ev.run(flow(), out, state).count() == d.count()  # nothing new, nothing twice


def test_once_over_runs(spark):
    path, out, state = folders()
    flow = lambda: ev.once(stream(spark, path), ["id"], delay="10 minutes")
    deliver(spark, path, [(1, 1, "a", at(0)), (1, 1, "a", at(0)), (2, 1, "a", at(8)), (None, 1, "a", at(8)), (None, 1, "a", at(8)), (3, 1, "a", None)])
    assert sorted(str(r["id"]) for r in ev.run(flow(), out, state).collect()) == ["1", "2", "None"]
    deliver(spark, path, [(2, 1, "a", at(8)), (1, 1, "a", at(0)), (4, 1, "a", at(30))])
    assert sorted(str(r["id"]) for r in ev.run(flow(), out, state).collect()) == ["1", "2", "4", "None"]
    batch = ev.once(spark.createDataFrame([(1, 1, "a", at(0)), (1, 1, "a", at(0)), (3, 1, "a", None)], SCHEMA), ["id"])
    assert [r["id"] for r in batch.collect()] == [1]


def _pairs(d):
    return sorted((r["first_id"], r["then_id"]) for r in d.collect())


def test_join_of_streams_with_a_hot_user_equals_brute_force(spark):
    path, out, state = folders()
    rows = [(i, 0 if i % 3 else i % 7, "view" if i % 2 else "buy", at(i * 7 % 997)) for i in range(300)]
    rows += [(900, None, "view", at(1)), (901, None, "buy", at(1)), (902, 0, "buy", None)]

    def flow(d):
        return ev.followed_by(d.filter("kind = 'view'"), d.filter("kind = 'buy'"), "who", 1800, delay="10 minutes")

    timed = sorted((r for r in rows if r[3]), key=lambda r: r[3])
    want = sorted((a[0], b[0]) for a in timed for b in timed if a[2] == "view" and b[2] == "buy" and a[1] is not None
                  and a[1] == b[1] and dt.timedelta() <= b[3] - a[3] <= dt.timedelta(minutes=30))
    assert len(want) > 50
    deliver(spark, path, timed[:150] + [rows[-1]])
    ev.run(flow(stream(spark, path)), out, state)
    deliver(spark, path, timed[150:])
    assert _pairs(ev.run(flow(stream(spark, path)), out, state)) == want
    assert _pairs(flow(spark.createDataFrame(rows, SCHEMA))) == want


def test_whole_files_come_back(spark):
    texts = {"a": "one\ntwo\r\n", "b": "", "c": "é 漢\n", "d": "word " * 50_000}
    rows = [*texts.items(), ("e", None)]
    path = tempfile.mkdtemp(prefix="quarry-files-", dir="/tmp")
    docs = spark.createDataFrame(rows, "name string, text string")
    for _ in range(2):  # a repeated write changes nothing
        files = tx.write_documents(docs, path, F.col("name"))
        got = {r["name"]: r["text"] for r in tx.read_written(spark, files).collect()}
        assert got == {**texts, "e": ""}


def test_whole_files_lie_in_few_folders(spark):
    """However many documents: a folder for each made writing and listing fail by time."""
    path = tempfile.mkdtemp(prefix="quarry-files-", dir="/tmp")
    rows = [(f"_doc.{i}-x", f"text {i}\n") for i in range(3000)] + [("same", t) for t in ("b", "a", "a", None)]
    docs = spark.createDataFrame(rows, "name string, text string").coalesce(1)
    files = tx.write_documents(docs, path, F.col("name"))
    found = [(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith(".")]
    assert len(found) == 3001 and len({d for d, _ in found}) <= 256
    # rows with one name share its file, as ever
    assert sorted(map(tuple, tx.read_written(spark, files).collect())) == sorted([*rows[:3000], ("same", "b\na\na\n")])
    # dealt otherwise, in place of the files of these names alone
    again = docs.filter("name = 'same' and text = 'b' or name = '_doc.7-x'").repartition(7)
    tx.write_documents(again, path, F.col("name"))
    assert sorted(map(tuple, tx.read_written(spark, files).collect())) == sorted(rows[:3001])
    none = tx.write_documents(docs.limit(0), f"file://{path}/none", F.col("name"))
    assert tx.read_written(spark, none).count() == 0


def test_minhash_groups_equal_the_exact_ones_here(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    sets = sim.shingle_sets(docs)
    exact = {r["doc_id"]: r["group_id"] for r in sim.similar_groups(sets, 0.8).collect()}
    got = {r["doc_id"]: r["group_id"] for r in sim.minhash_similar_groups(sets, 0.8).collect()}
    assert got.keys() == exact.keys()
    assert sum(got[d] == exact[d] for d in exact) / len(exact) >= 0.99
    members = {}
    for d, g in got.items():
        members.setdefault(g, set()).add(exact[d])
    assert all(len(m) == 1 for m in members.values())  # never joins what the exact search keeps apart


def test_minhash_buckets_of_copies_stay_linear(spark):
    """Near copies in one group: candidates in proportion to the texts, not to their pairs."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base + [f"x{i}"])) for i in range(400)] + [(500, " ".join(f"v{i}" for i in range(60)))]
    sets = sim.shingle_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["group_id"] for r in sim.minhash_similar_groups(sets, 0.8).collect()}
    assert got == {**{i: 0 for i in range(400)}, 500: 500}
    reps = sim.representatives(sim.hashed_sets(sets))
    sig = sim.minhash_signatures(reps).join(reps.select("rep_id", "n"), "rep_id")
    lists = sig.select(F.xxhash64("band", "key").alias("h"), "rep_id", "n", F.lit(1).alias("pos"), F.lit(True).alias("short"))
    assert sim.star_candidates(lists).count() <= 400
