"""Operator 4: WARC archives with revisit records.

Headers are shuffled by payload digest; the smallest page of every digest is the response
and the other pages of that digest become revisit records that refer to it, with fresh
headers and no payload.  Archives are gzip files below the shared folder, written by Spark's
text writer with the record end as line separator, so task commits make them whole.

Edge cases: NULL html is an empty payload; pages under ``min_bytes`` are all responses; rows
that repeat the smallest page with its payload are responses too; pages without an id come
last and are responses where no page of their digest has an id; control characters and
blanks in a url are percent-encoded in headers; an empty table writes archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..names import col as named
from ..session import scratch_path

END = "\r\n\r\n"
#: Fixed value: the revisit profile of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


@F.pandas_udf(StringType())
def _base32(hexes: pd.Series) -> pd.Series:
    return hexes.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())


def classify(pages: DataFrame, *, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """page_id, url, payload, payload_bytes, digest (hex), record_type, refers_to."""
    payload = F.coalesce(named(html_col).cast("string"), F.lit(""))
    records = pages.select(named(id_col).alias("page_id"), named(url_col).alias("url"), payload.alias("payload"),
                           F.octet_length(payload).cast("long").alias("payload_bytes"),
                           F.sha1(payload.cast("binary")).alias("digest"))
    first = records.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("original"))
    revisit = F.coalesce((F.col("page_id") > F.col("original")) | (
        F.col("page_id").isNull() & F.col("original").isNotNull()), F.lit(False))
    return records.join(first, "digest", "left").withColumn(
        "record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("original")))


def _uri(c: Column) -> Column:
    safe = F.coalesce(c, F.lit(""))
    for char in (" ", "\r", "\n", "\t"):
        safe = F.replace(safe, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return safe


def record_text(date: str) -> Column:
    """One WARC record without its closing blank lines; the header lengths are in octets."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, http).otherwise(F.concat(http, "payload"))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"),
             F.concat(F.lit(f"WARC-Record-ID: <{URN}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                      F.lit(">")),
             F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), _base32("digest")),
             F.when(is_revisit, F.concat(F.lit(f"WARC-Refers-To: <{URN}"), F.col("refers_to").cast("string"),
                                         F.lit(f">\r\nWARC-Profile: {PROFILE}"))),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z",
                   records_per_file: int = 5000) -> None:
    """Write the archives of ``pages`` below ``path``."""
    classify(pages, id_col=id_col, url_col=url_col, html_col=html_col, min_bytes=min_bytes).select(
        record_text(date).alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields and block."""
    while line := stream.readline():
        if not line.strip():
            continue
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("archive ends inside a record")
        yield fields, block


def _page(uri: str | None) -> str | None:
    return (uri or "").strip("<>").removeprefix(URN) or None


def read_archives(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records below ``path``.

    Responses are measured and hashed anew; a digest that differs from the header's is an error.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                for fields, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content))):
                    head, _, body = block.partition(b"\r\n\r\n")
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    if fields["warc-type"] == "response":
                        size, own = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
                        if own != digest:
                            raise ValueError(f"payload digest {own} where the header says {digest}")
                    rows.append((_page(fields["warc-record-id"]), size, digest, fields["warc-type"],
                                 _page(fields.get("warc-refers-to"))))
                yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest",
                                                  "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, "page_id string, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to string")


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives below the shared folder, read them back and return their records."""
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, "llm-warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path).withColumns({
        "page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})
