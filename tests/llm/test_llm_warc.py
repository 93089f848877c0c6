import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from airloom.llm import warc

PAGES = "page_id long, url string, html string, record_id string, block string, title string"
HTML = "<!DOCTYPE html><html><head><title> A &amp; B </title><style>p{}</style></head><body><script>var t='</p>';</script><!-- <p>no</p> --><h1>Head</h1><p>One <b>two</b>&nbsp;&lt;three&gt;<br>four</p>\n\n<div>é 日本</div></body></html>"
ROWS = [(1, "http://a/", HTML), (2, None, "plain"), (3, "http://c/", None), (4, "", ""), (5, "http://e/", "<p>" + "long " * 40000), (6, "http://a/\r\nX: y", HTML), (6, "http://a/\r\nX: y", HTML), (None, "http://n/", "WARC/1.1\r\n\r\nWARC-Type: no\r\n\r\n\r\n")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "r", "b", "t") for r in rows], PAGES).repartition(2)


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_links_digests_and_text(spark):
    sources = {r.record_id: r for r in warc.responses(pages(spark)).collect()}
    made = warc.derive(warc.responses(pages(spark))).collect()
    assert len(made) == 2 * len(ROWS)
    conversions = {r.refers_to: r for r in made if r.warc_type == "conversion"}
    for r in made:
        s = sources[r.refers_to]
        assert (r.page_id, r.target_uri, r.warc_date, r.source_digest) == (s.page_id, s.target_uri, s.warc_date, s.payload_digest)
        assert r.block_digest == sha(r.block) and s.block_digest == sha(s.block)
        if r.warc_type == "metadata":
            meta, text = json.loads(r.block), conversions[r.refers_to]
            assert meta["source"]["WARC-Record-ID"] == s.record_id and meta["source"]["WARC-Payload-Digest"] == s.payload_digest
            assert meta["conversion"] == {"WARC-Record-ID": text.record_id, "WARC-Block-Digest": sha(text.block)}
            assert meta["http"][1] == "Content-Type: text/html; charset=utf-8" == "Content-Type: " + r.http_content_type
    page1 = next(r for r in made if r.page_id == 1 and r.warc_type == "conversion")
    assert page1.block == "Head\nOne two <three>\nfour\né 日本" and page1.title == "A &amp; B"
    assert {r.page_id: r.source_digest for r in made}[3] == sha("")


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, tmp_path, compression):
    source = warc.responses(pages(spark)).filter("page_id IS NOT NULL AND page_id <> 6")
    records = source.unionByName(warc.derive(source).select(source.columns))
    path = str(tmp_path / "warc")
    warc.write_warc(records, path, compression, records_per_file=5)
    names = [c for _, c in warc.FIELDS] + ["block"]
    key = lambda r: tuple(str(x) for x in r)
    back = sorted(map(key, warc.read_warc(spark, path).select(names).collect()))
    assert back == sorted(map(key, records.select(names).collect()))
    again = warc.derive(warc.read_warc(spark, path).withColumn("page_id", F.lit(0).cast("long")))
    assert again.count() == 2 * source.count()


def test_header_fields_stay_on_their_line(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_warc(warc.responses(pages(spark, [ROWS[5], ROWS[7]])), path)
    back = {r.target_uri: r.block for r in warc.read_warc(spark, path).collect()}
    assert set(back) == {"http://a/ X: y", "http://n/"} and back["http://n/"].endswith(ROWS[7][2])


def test_other_records_and_empty_table(spark):
    r = warc.responses(pages(spark, ROWS[:1]))
    assert warc.derive(r.withColumn("warc_type", F.lit("request"))).count() == 0
    bare = warc.derive(r.withColumn("block", F.lit("no header"))).filter("warc_type = 'conversion'").first()
    assert bare.block == ""
    assert warc.derive(warc.responses(spark.createDataFrame([], PAGES))).count() == 0


def test_pages_of_one_id_and_url_have_their_own_records(spark):
    made = warc.derive(warc.responses(pages(spark, [(1, "http://a/", "<p>x"), (1, "http://a/", "<p>y"), (1, "http://a/", "<p>y")]))).collect()
    assert len(made) == 6 and len({r.record_id for r in made}) == 4
    assert {(r.refers_to_target_uri, r.refers_to_date) for r in made} == {("http://a/", warc.DATE)}


def record(block, length=None, kind="application/http; msgtype=response", sep="\r\n"):
    head = f"WARC/1.0{sep}WARC-Type: response{sep}WARC-Record-ID: <x>{sep}Content-Type: {kind}{sep}Content-Length: {len(block) if length is None else length}{sep}{sep}"
    return head.encode() + block + b"\r\n\r\n"


LATIN = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\ncaf\xe9"
ZIPPED = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + gzip.compress("né".encode())
BYTES = bytes(range(256)) * 3


def test_bytes_charsets_and_encodings_survive(spark, tmp_path):
    source, copy = tmp_path / "source", str(tmp_path / "copy")
    source.mkdir()
    records = [record(LATIN), record(ZIPPED), record(BYTES, kind="image/png"), record(b"")]
    (source / "one.warc").write_bytes(b"".join(records))
    (source / "by-record.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    back = warc.read_warc(spark, str(source))
    assert sorted(bytes(r.raw_block) for r in back.collect()) == sorted([LATIN, ZIPPED, BYTES, b""] * 2)
    texts = {r.block.rpartition("\r\n\r\n")[2] for r in back.filter("content_type LIKE 'application/http%'").collect()}
    assert texts == {"café", "né", ""}
    for compression in ("none", "gzip"):
        warc.write_warc(back, f"{copy}-{compression}", compression, records_per_file=3)
        again = warc.read_warc(spark, f"{copy}-{compression}")
        assert sorted(bytes(r.raw_block) for r in again.collect()) == sorted([LATIN, ZIPPED, BYTES, b""] * 2)


def test_damaged_records_are_counted_and_passed_over(spark, tmp_path):
    good, files = record(LATIN), tmp_path / "damaged"
    files.mkdir()
    (files / "length.warc").write_bytes(good + record(b"abc", "x1") + record(b"abc", "-4") + good + record(b"abc", 10**9) + good)
    (files / "header.warc").write_bytes(b"junk\r\n\r\n" + good + b"WARC/1.0\r\n\xff\xfe: \xff\r\nContent-Length: 2\r\n\r\nok\r\n\r\n" + good + b"WARC/1.0\r\nno end")
    whole = gzip.compress(good)
    (files / "packed.warc.gz").write_bytes(whole + gzip.compress(good * 50)[:-40])
    (files / "broken.warc.gz").write_bytes(whole + b"\x1f\x8bnot")
    (files / "empty.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(files), with_damaged=True).collect()
    damaged = sorted(r.damaged for r in rows if r.damaged)
    assert damaged.count("record cut off") >= 1 and damaged.count("no record") >= 4 and damaged.count("compressed data") == 2
    kept = warc.read_warc(spark, str(files))
    assert "damaged" not in kept.columns and kept.filter("warc_type = 'response'").count() >= 7
    assert all(bytes(r.raw_block) in (LATIN, b"ok") for r in kept.collect())
