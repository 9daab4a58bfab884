import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from creditflow.llm import warc

SCHEMA = "page_id long, url string, html string, row string, keep_id string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x", "x") for i, u, h in rows], SCHEMA)


def brute_force(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, p in payloads:
        keep = max((j for j, q in payloads if q == p and j is not None), default=None)
        revisit = len(p) >= 1000 and keep is not None and i != keep
        out.append((i, "revisit" if revisit else "response", keep if revisit else None, hashlib.sha1(p).hexdigest(), len(p)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in df.collect()), key=repr)


def test_hard_rows(spark):
    big, other = "<p>é</p>" * 300, "y" * 1000
    rows = [
        (1, "http://a/?q=é \r\nX: y", big), (2, None, big), (3, "u", other), (3, "u", other), (4, "u", "y" * 999), (5, "u", "y" * 999),
        (6, "u", None), (7, "u", ""), (None, "u", big), (None, "u", "z" * 2000), (8, "u", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n" * 60), (9, "u", "w" * 3_000_000),
    ]
    assert result(warc.round_trip(pages(spark, rows).repartition(3))) == brute_force(rows)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.collect()]
    doubled = df.unionByName(df.selectExpr("page_id + 100000 AS page_id", "url", "html"))
    assert result(warc.round_trip(df)) == brute_force(rows)
    assert result(warc.round_trip(doubled)) == brute_force(rows + [(i + 100000, u, h) for i, u, h in rows])


def test_small_files(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").repartition(1)
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.collect()]
    monkeypatch.setattr(warc, "FILE_BYTES", 5000)
    assert result(warc.round_trip(df)) == brute_force(rows)


def archive(*payloads):
    return b"".join(warc.member(i, "http://x/", p, None, False) for i, p in enumerate(payloads))


def read(data):
    return [(f, warc.payload_of(b)) for f, b in map(warc.parse, warc.members(io.BytesIO(data)))]


def test_members_are_plain_gzip():
    data = archive(b"one", b"two" * 100_000)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    assert [p for _, p in read(data)] == [b"one", b"two" * 100_000]
    assert read(b"") == []



def repacked(content):
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d[:-9],
        lambda d: d[: len(d) // 2],
        lambda d: b"junk" + d,
        lambda d: d + b"junk",
        lambda d: repacked(gzip.decompress(d).replace(b"payload", b"pay1oad")),
        lambda d: repacked(gzip.decompress(d).replace(b"Content-Length: ", b"Content-Length: 1")),
        lambda d: repacked(gzip.decompress(d).replace(b"Content-Length: ", b"Content-Size: ")),
        lambda d: repacked(gzip.decompress(d) + b"more"),
        lambda d: repacked(gzip.decompress(d).replace(b"WARC/1.1", b"WARC/9.9")),
    ],
)
def test_damage_is_noticed(change):
    with pytest.raises(warc.WarcError):
        read(change(archive(b"a payload of some length")))


def test_every_cut_is_noticed():
    """An archive that ends anywhere but after a whole record is an error, also within the first bytes of a member."""
    first = archive(b"one")
    data = archive(b"one", b"and two")
    for cut in range(1, len(data)):
        if cut == len(first):
            assert len(read(data[:cut])) == 1
            continue
        with pytest.raises(warc.WarcError):
            read(data[:cut])


def test_lost_records_are_noticed(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(archive(b"one", b"two"))
    listed = lambda n: spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", n)], "path string, records long")
    assert warc.read_archives(listed(2)).count() == 2
    for n in (1, 3):
        with pytest.raises(Exception, match="has 2 records"):
            warc.read_archives(listed(n)).collect()


def test_a_hot_payload_is_not_brought_together(spark):
    """Half of the pages are one payload: what is joined with payloads is dealt by page."""
    rows = [(i, "u", "h" * 1500 if i % 2 else f"{i} " * 400) for i in range(600)]
    marked = warc.mark_revisits(pages(spark, rows).repartition(8), "page_id", "html", "url")
    assert {r["page_id"]: r["keep_id"] for r in marked.collect()} == {i: 599 if i % 2 and i != 599 else None for i, _, _ in rows}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marked = warc.mark_revisits(pages(spark, rows).repartition(8), "page_id", "html", "url").where("keep_id IS NOT NULL")
        sizes = [r["n"] for r in marked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 299 and max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]
