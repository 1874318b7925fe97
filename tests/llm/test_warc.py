import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from stratum.llm import queries, warc
from stratum.llm.tables import stored

PAGES = "page_id long, url string, html string"


def plain(rows, least=0):
    latest = {}
    for page, _, html in rows:
        if page is not None:
            latest[html or ""] = max(page, latest.get(html or "", page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        original = latest.get(html or "") if len(data) >= least else None
        again = original is not None and page != original
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


def odd_pages():
    rows = [(i, f"https://Www.Host{i % 7}.Example.org:443/p/{i % 50}?q={i}#x", f"<p>{i % 40}</p>") for i in range(200)]
    rows += [(200 + i, "http://same.example/", "same") for i in range(60)]
    rows += [(300, None, None), (301, "", ""), (302, "no url at all\r\nWARC-Type: x", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
             (303, "https://u:p@bücher.example:8080/é ?x=1", "é世😀\x00" * 10), (None, "http://null.example/", "same"), (None, "http://null.example/", "alone"),
             (304, "http://long.example/", "long " * 200_000)]
    return rows + [rows[0], rows[259], rows[259]]


def read_back(spark, pages, **options):
    archive = warc.write_archive(pages, **options)
    keys = pages.select(warc.url_key(F.col("url")).alias("url_key"), "page_id")
    return archive, warc.read_records(archive, warc.lookup(spark, archive, keys))


def tuples(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize("least,part", [(0, 1000), (3, 17), (100, 1000)])
def test_round_trip(spark, monkeypatch, least, part):
    rows = odd_pages()
    pages = spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit(1)).withColumn("payload", F.lit(2))
    _, records = read_back(spark, pages, min_bytes=least, file_bytes=2000, part_entries=part)
    assert tuples(records) == plain(rows, least)
    texts = {}
    for page, _, html in rows:
        texts.setdefault(page, set()).add((html or "").encode())
    assert all(r.payload in texts[r.page_id] for r in records.collect() if r.record_type == "response")


def test_files_are_plain_gzip_members(spark):
    rows = odd_pages()
    archive, _ = read_back(spark, spark.createDataFrame(rows, PAGES))
    whole = b""
    for name in os.listdir(archive.folder):
        with gzip.open(f"{archive.folder}/{name}") as file:
            whole += file.read()
    records = whole.split(b"WARC/1.1\r\n")
    assert whole.startswith(b"WARC/1.1\r\n") and len([r for r in records if b"WARC-Record-ID" in r]) == len(rows)
    assert b"\r\nWARC-Type: x" not in whole.split(b"\r\n\r\n")[0]


def test_fetch_one_url(spark):
    rows = odd_pages()
    archive, _ = read_back(spark, spark.createDataFrame(rows, PAGES), part_entries=10)
    assert sorted(r.page_id for r in warc.fetch(spark, archive, "http://same.example/")) == [*range(200, 259), 259, 259, 259]
    assert [r.page_id for r in warc.fetch(spark, archive, "https://www.host3.example.org/p/10?q=10")] == [10]
    assert warc.fetch(spark, archive, "http://nowhere.example/") == []


def test_lookups_read_few_blocks(spark, monkeypatch):
    rows = [(i, f"http://h.example/{i:05d}", "x") for i in range(3000)]
    archive, _ = read_back(spark, spark.createDataFrame(rows, PAGES))
    reads = []
    original = warc._Ranges.read
    monkeypatch.setattr(warc._Ranges, "read", lambda self, *a: reads.append(a) or original(self, *a))
    assert [r.page_id for r in warc.fetch(spark, archive, "http://h.example/01234")] == [1234]
    assert len(reads) <= 4  # directory, one block or two, the record


def test_keys(spark):
    urls = ["https://Blog.Example.com:80/A?b#c", "http://a.b", "ftp://u@x.y/z", "relative/path", "", None]
    found = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert found == ["com,example,blog)/A?b", "b,a)", "y,x)/z", ")relative/path", "", ""]


def test_damaged_records_are_errors():
    data = warc.record_bytes(1, "http://a/", b"payload", warc.digest_of(b"payload"), None, False)
    assert warc.parse_record(data).payload == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"payload", b"pAyload"))


def test_empty_table_and_given_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    archive, records = read_back(spark, empty)
    assert archive.parts == [] and records.collect() == [] and warc.fetch(spark, archive, "http://a/") == []
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert tuples(queries.op6_warc_index(spark, "/root/testdata/sf0.01")) == plain(rows)


def test_copies_of_one_payload_are_split(spark):
    """A third of all pages are one error page: its copies are written by several tasks."""
    page = "".join(hashlib.sha512(str(i).encode()).hexdigest() for i in range(30))
    html = F.when(F.col("id") % 3 == 0, F.lit(page)).otherwise(F.sha2(F.col("id").cast("string"), 512))
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), html.alias("html"))
    pages = stored(pages.repartition(16))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = warc.with_originals(pages)
        got = rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(got) == 3000
    assert all(r.refers_to == (2997 if r.page_id % 3 == 0 and r.page_id != 2997 else None) for r in got)


def test_few_payloads_move_no_page(spark):
    pages = stored(spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x")], "page_id long, url string, html string"))
    plan = warc.with_originals(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
