import os
import tempfile

from quarry.sources.text import read_documents
from quarry.streaming import baskets as sb


def test_streaming_item_counts(spark):
    d = tempfile.mkdtemp(prefix="quarry-stream-", dir="/tmp")
    with open(os.path.join(d, "b1.txt"), "w") as f:
        f.write("{1,2,3}\n{1,2}\n")
    with open(os.path.join(d, "b2.txt"), "w") as f:
        f.write("{2,3}\n{1,2,2}\n{x}\n")
    stream = sb.basket_stream(spark, d, max_files_per_trigger=1)
    q = sb.item_counts(stream).writeStream.outputMode("complete").format("memory") \
        .queryName("quarry_item_counts").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    counts = {r["item"]: r["n"] for r in spark.sql("SELECT * FROM quarry_item_counts").collect()}
    assert counts == {1: 3, 2: 5, 3: 2}
    freq = sb.frequent_items_batch(spark.sql("SELECT * FROM quarry_item_counts"), 4, 0.5)
    assert {r["item"] for r in freq.collect()} == {1, 2, 3}


def test_read_documents_base_name(spark):
    d = tempfile.mkdtemp(prefix="quarry-docs-", dir="/tmp")
    for name, text in [("doc_1.txt", "a b c d\nsecond line"), ("doc_10.txt", "b c d e")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    docs = {r["doc_id"]: r["text"] for r in read_documents(spark, os.path.join(d, "doc_*.txt")).collect()}
    assert docs == {"doc_1.txt": "a b c d\nsecond line", "doc_10.txt": "b c d e"}


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    """Spark alone counts 4 MB for each file: 32 files a task, however small they are."""
    for i in range(1500):
        (tmp_path / f"doc_{i}.txt").write_text(f"text {i}\n")
    docs = read_documents(spark, str(tmp_path / "doc_*.txt"))
    tasks = docs.selectExpr("spark_partition_id() as task", "doc_id", "text").collect()
    assert len({r.task for r in tasks}) <= 4 * spark.sparkContext.defaultParallelism
    assert {r.doc_id: r.text for r in tasks} == {f"doc_{i}.txt": f"text {i}\n" for i in range(1500)}
