"""WARC derivatives: metadata and plain-text conversion records of responses.

A record is a row: its named header fields as columns and its block as text.
``responses`` builds response records from crawled pages, ``derive`` builds
two records from each of them, ``to_text`` renders a record as WARC/1.1
text, ``write_warc`` and ``read_warc`` store and load them with Spark's text
and binary-file sources. A record that was read has its block twice: as the
bytes that its digests are of, which is what is written again, and as text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
FIELDS = (
    ("WARC-Type", "warc_type"),
    ("WARC-Record-ID", "record_id"),
    ("WARC-Date", "warc_date"),
    ("WARC-Target-URI", "target_uri"),
    ("WARC-Refers-To", "refers_to"),
    ("WARC-Refers-To-Target-URI", "refers_to_target_uri"),
    ("WARC-Refers-To-Date", "refers_to_date"),
    ("WARC-Block-Digest", "block_digest"),
    ("WARC-Payload-Digest", "payload_digest"),
    ("Content-Type", "content_type"),
)
# Spark's text source ends each row with this: a record's closing blank lines.
RECORD_END = CRLF * 2
DATE = "1970-01-01T00:00:00Z"

# The character references that plain text most often needs.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A URN that depends on nothing but the record's kind and origin."""
    h = F.md5(F.concat_ws("\n", F.lit(kind), *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def plain_text(html: Column) -> Column:
    """The text of a page: no scripts, styles, comments or tags; block ends break lines.

    Character references for < > " ' & and the hard space are resolved, runs
    of blanks become one, blank lines go.
    """
    t = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>", " ")
    t = F.regexp_replace(t, r"(?i)<br[^>]*>|</?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|nav|section|header|footer)(?:[ /][^>]*)?>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    for name, char in REFERENCES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(t, r"[ \t\r\f]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"\A[ \n]+|[ \n]+\z", "")


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title>", 1))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """A response record per page: an HTTP header block, then the page.

    A null url gives a record without target URI, a null page an empty
    payload. The record id depends on page id, url and payload: pages that
    differ in any of them have different records, repeated pages repeat
    their record. Other columns are left out.
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("_body").cast("string"), F.lit(CRLF * 2))
    return (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("target_uri"), body.alias("_body"))
        .withColumns({"block": F.concat(head, "_body"), "payload_digest": digest(F.col("_body"))})
        .select(
            "page_id",
            F.lit("response").alias("warc_type"),
            record_id("response", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("target_uri", F.lit("")), F.col("payload_digest")).alias("record_id"),
            F.lit(date).alias("warc_date"),
            "target_uri",
            *(F.lit(None).cast("string").alias(c) for c in ("refers_to", "refers_to_target_uri", "refers_to_date")),
            digest(F.col("block")).alias("block_digest"),
            "payload_digest",
            F.lit("application/http; msgtype=response").alias("content_type"),
            "block",
        )
    )


def derive(records: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response record.

    Both name the response in ``refers_to`` (with its URI and date) and keep
    its date and target URI. The conversion's block is the page's plain text; the metadata's is
    JSON with the source's WARC and HTTP headers, digests, title and the
    linked conversion record. ``text_digest`` of both is the digest of the
    plain text, ``source_digest`` the payload digest of the response. Other
    record types give nothing; a response without an HTTP body gives empty
    text.
    """
    block = F.coalesce(F.col("block"), F.lit(""))
    end = F.instr(block, CRLF * 2)
    source = records.filter(F.col("warc_type") == "response").select(
        "page_id",
        "target_uri",
        "warc_date",
        F.col("record_id").alias("refers_to"),
        F.col("payload_digest").alias("source_digest"),
        F.col("block_digest").alias("source_block_digest"),
        F.when(end > 0, F.substring(block, F.lit(1), end - 1)).otherwise("").alias("_http"),
        F.when(end > 0, F.substring(block, end + 4, F.length(block))).otherwise("").alias("_html"),
    )
    made = source.select(
        "*",
        plain_text(F.col("_html")).alias("_text"),
        title(F.col("_html")).alias("_title"),
        record_id("conversion", F.col("refers_to")).alias("_conversion"),
        record_id("metadata", F.col("refers_to")).alias("_metadata"),
        F.regexp_extract(F.col("_http"), r"(?i)\r\ncontent-type:[ ]*([^\r\n]*)", 1).alias("http_content_type"),
    ).withColumn("text_digest", digest(F.col("_text")))
    envelope = F.to_json(
        F.struct(
            F.struct(
                F.col("refers_to").alias("WARC-Record-ID"),
                F.col("target_uri").alias("WARC-Target-URI"),
                F.col("warc_date").alias("WARC-Date"),
                F.col("source_block_digest").alias("WARC-Block-Digest"),
                F.col("source_digest").alias("WARC-Payload-Digest"),
            ).alias("source"),
            F.split("_http", CRLF).alias("http"),
            F.col("_title").alias("title"),
            F.struct(F.col("_conversion").alias("WARC-Record-ID"), F.col("text_digest").alias("WARC-Block-Digest")).alias("conversion"),
        )
    )
    record = F.explode(
        F.array(
            F.struct(F.lit("conversion").alias("warc_type"), F.col("_conversion").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("_text").alias("block")),
            F.struct(F.lit("metadata").alias("warc_type"), F.col("_metadata").alias("record_id"), F.lit("application/json").alias("content_type"), envelope.alias("block")),
        )
    )
    return made.select("*", record.alias("_r")).select(
        "page_id",
        "_r.warc_type",
        "_r.record_id",
        "warc_date",
        "target_uri",
        "refers_to",
        F.col("target_uri").alias("refers_to_target_uri"),
        F.col("warc_date").alias("refers_to_date"),
        digest(F.col("_r.block")).alias("block_digest"),
        F.lit(None).cast("string").alias("payload_digest"),
        "_r.content_type",
        "_r.block",
        "source_digest",
        "text_digest",
        "http_content_type",
        F.col("_title").alias("title"),
    )


def to_text(records: DataFrame) -> DataFrame:
    """One column ``value``: each record as WARC/1.1 text without its closing blank lines.

    Records with ``raw_block`` are written with these bytes, whatever their
    charset; a null there gives the text of ``block``, a null block an empty one.
    """
    clean = [F.concat(F.lit(f"{name}: "), F.regexp_replace(F.col(col), r"[\r\n]+", " "), F.lit(CRLF)) for name, col in FIELDS if col in records.columns]
    lines = [F.coalesce(c, F.lit("")) for c in clean]
    # The bytes as they are: a string column need not be valid UTF-8 to be written.
    raw = [F.col("raw_block").cast("string")] if "raw_block" in records.columns else []
    block = F.coalesce(*raw, F.col("block"), F.lit(""))
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), *lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF * 2), block).alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip", records_per_file: int = 100_000) -> None:
    """WARC files of a bounded number of records each, written by Spark's text sink.

    The text sink compresses a file as one gzip stream, not record by record.
    """
    to_text(records).write.option("lineSep", RECORD_END).option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)


def _unpacked(data: bytes) -> tuple[bytes, bool]:
    """The content of a plain or gzip file (one member or one for each record), and whether it was whole."""
    if data[:2] != b"\x1f\x8b":
        return data, True
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        try:
            out.append(member.decompress(data))
        except zlib.error:
            return b"".join(out), False
        if not member.eof:
            return b"".join(out), False
        data = member.unused_data
    return b"".join(out), not data.strip(b"\0\r\n")


def _text(block: bytes, content_type: str | None) -> str:
    """A block as text: an HTTP body without its content encoding, in its charset."""
    head, gap, body = block.partition(b"\r\n\r\n") if (content_type or "").lower().startswith("application/http") else (b"", b"", block)
    if found := re.search(rb"(?i)\r\ncontent-encoding:[ \t]*(x-gzip|gzip|deflate)[ \t]*(?:\r\n|$)", head):
        try:
            body = zlib.decompress(body, wbits=47) if found[1].lower() != b"deflate" else _inflated(body)
        except zlib.error:
            pass  # as it is
    charset = re.search(r"(?i)charset=[\"']?([\w.:-]+)", head.decode("latin-1") if gap else content_type or "")
    try:
        text = body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        text = body.decode("utf-8", "replace")
    return head.decode("utf-8", "replace") + gap.decode() + text


def _inflated(body: bytes) -> bytes:
    try:
        return zlib.decompress(body)
    except zlib.error:
        return zlib.decompress(body, wbits=-15)  # what some servers send


def _parse(data: bytes, whole: bool = True) -> Iterator[dict]:
    """Records in order; what is no record gives one row with ``damaged`` and is passed over."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            break
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").split(CRLF)
        fields = dict(x.split(":", 1) for x in lines[1:] if ":" in x)
        size = fields.get("Content-Length", "").strip()
        known = data.startswith(b"WARC/1.", at) and end >= 0 and size.isascii() and size.isdigit()
        if known and end + 4 + int(size) <= len(data):
            block = data[end + 4 : end + 4 + int(size)]
            row = {col: fields[name].strip() if name in fields else None for name, col in FIELDS}
            yield row | {"block": _text(block, row["content_type"]), "raw_block": block, "damaged": None}
            at = end + 4 + int(size)
            continue
        yield {"damaged": "record cut off" if known else "no record"}
        following = data.find(b"\r\n\r\nWARC/1.", at)
        if following < 0:
            break
        at = following + 4
    if not whole:
        yield {"damaged": "compressed data"}


def read_warc(spark: SparkSession, path: str, with_damaged: bool = False) -> DataFrame:
    """The records of WARC files, plain or gzip (whole or by record). A file is read by one task.

    Columns: the header fields, ``block`` as text (HTTP bodies unpacked and
    decoded by their charset, bytes that do not fit replaced) and
    ``raw_block``, its bytes. A record with a bad length or header, one that
    is cut off, and broken compressed data are passed over; the records
    around them are read. ``with_damaged`` returns a row for each of these,
    with the reason in ``damaged`` and nulls else.
    """
    names = [c for _, c in FIELDS] + ["block"]
    schema = pa.schema([*((n, pa.string()) for n in names), ("raw_block", pa.binary()), ("damaged", pa.string())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                chunk = []
                for r in _parse(*_unpacked(content.as_py())):
                    chunk.append(r)
                    if len(chunk) == 1000:
                        yield pa.RecordBatch.from_pylist(chunk, schema=schema)
                        chunk = []
                yield pa.RecordBatch.from_pylist(chunk, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    rows = files.mapInArrow(parse, ", ".join(f"{n} string" for n in names) + ", raw_block binary, damaged string")
    return rows if with_damaged else rows.filter("damaged IS NULL").drop("damaged")
