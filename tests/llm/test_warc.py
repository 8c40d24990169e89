import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F
from quarry.llm import warc
from quarry.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string, digest string, size int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows):
    best = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, -1), -1 if page is None else page)
    out, met = [], set()
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = data in best and (best[data] != (-1 if page is None else page) or (data, page) in met)
        met.add((data, page))
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", (None if best[data] == -1 else best[data]) if revisit else None))
    return sorted(out, key=str)


def some_rows():
    g = random.Random(1)
    same, long = "<p>é same</p>" * 100, "".join(chr(g.randrange(32, 0x2FF)) for _ in range(400_000))
    rows = [(i, f"http://a.example/{i}", same if i % 3 == 0 else f"<p>{i}</p>" * g.randrange(400)) for i in range(200)]
    rows += [(1000, None, None), (1001, "http://a/\r\nWARC-Type: revisit", ""), (1002, "http://b/é ?", "x" * 999), (1003, "u", "x" * 999), (1004, "u", "x" * 1000), (1005, "u", "x" * 1000),
             (None, "n", same), (None, "n", None), (1006, "l", long), (1007, "l", "\r\n\r\nWARC/1.1\r\n\r\n" * 200), (1008, "r", long), (1008, "r", long)]
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def path_of(folder):
    return folder.removeprefix("file:").replace("//", "/")


def test_round_trip_equals_the_plain_result(spark):
    rows = some_rows()
    assert got(warc.round_trip(frame(spark, rows))) == brute(rows)
    assert got(warc.round_trip(frame(spark, rows), roll_bytes=20_000)) == brute(rows)
    assert warc.round_trip(frame(spark, rows).limit(0)).count() == 0
    nulls = [(None, None, "y" * 2000), (None, None, "y" * 2000), (None, "u", None)]
    assert got(warc.round_trip(frame(spark, nulls))) == brute(nulls)


def test_payloads_come_back_whole(spark):
    rows = [r for r in some_rows() if r[0] is not None]
    folder = shared_folder(spark)
    warc.write(frame(spark, rows), folder)
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for r in warc.read(spark, folder).collect():
        if r.record_type == "response":
            assert bytes(r.payload) == html[r.page_id]
        else:
            assert r.payload is None and html[r.refers_to] == html[r.page_id]


def test_same_bytes_however_the_rows_are_dealt(spark):
    rows = [r for r in some_rows() if r[0] is not None]
    lines = []
    for parts, shuffled in ((1, 0), (7, 1)):
        random.Random(shuffled).shuffle(rows)
        lines.append(got(warc.write(frame(spark, rows).repartition(parts), shared_folder(spark), roll_bytes=10_000, range_bytes=150_000)))
    assert lines[0] == lines[1] and len(lines[0]) > 3
    assert all(size <= 10_000 + 1_000_000 for _, _, size, _ in lines[0])


def test_files_are_gzip_members_that_any_reader_takes(spark):
    folder = shared_folder(spark)
    lines = warc.write(frame(spark, some_rows()), folder, roll_bytes=50_000).collect()
    base = path_of(folder)
    assert not [f for f in os.listdir(base) if f.startswith(".pages")]
    for line in lines:
        data = open(f"{base}/{line.file}", "rb").read()
        assert len(data) == line.bytes and hashlib.sha1(data).hexdigest() == line.sha1
        rest, n = gzip.decompress(data), 0
        while rest:
            head, _, rest = rest.partition(b"\r\n\r\n")
            h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
            assert head.startswith(b"WARC/1.1\r\n") and rest[int(h["Content-Length"]) :].startswith(b"\r\n\r\n")
            rest, n = rest[int(h["Content-Length"]) + 4 :], n + 1
        assert n == line.records


def test_what_the_manifest_does_not_name_is_not_read_and_damage_is_seen(spark):
    folder = shared_folder(spark)
    rows = some_rows()
    warc.write(frame(spark, rows), folder, roll_bytes=50_000)
    base = path_of(folder)
    with open(f"{base}/pages-999999-00000.warc.gz", "wb") as f:
        f.write(b"left by a job that failed")
    assert warc.read(spark, folder).count() == len(rows)
    with pytest.raises(FileExistsError):
        warc.write(frame(spark, rows), folder)
    name = f"{base}/pages-000000-00000.warc.gz"
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 1
    with open(name, "wb") as f:
        f.write(data)
    with pytest.raises(Exception, match="not what the manifest says"):
        warc.read(spark, folder).count()


def test_pages_of_the_tables(spark, small_dir):
    pages = spark.read.parquet(f"{small_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert got(warc.round_trip(pages)) == brute(rows)
    assert got(warc.round_trip(pages.select(F.lit("a").alias("member"), "html", "url", "page_id", F.lit(1).alias("file")))) == brute(rows)
