"""Web archives of page captures: written, read back and put together again.

A capture is three records: a ``request``, a ``response`` (or a ``revisit``
that names the response with the same payload) and a ``metadata`` record.
Request and metadata carry ``WARC-Concurrent-To`` with the id of the response
or revisit; reading joins the records through it to one nested row a capture.

Payloads are the pages' ``html`` in UTF-8, byte for byte (NULL: empty). Of
equal payloads of at least ``MIN_REVISIT`` bytes the smallest page_id is the
response. Rows repeated with one page_id, url and payload are captures of the
same id and come back as often as they were written; rows that repeat a
page_id with another url are captures of their own. A page with a NULL id never stands
for others. An empty table gives an archive without records.

White space and control characters of a url, which a header line cannot hold, are
percent-encoded (their UTF-8 bytes). Reading checks every record: an archive that
is cut short, a record that is not closed and a payload that is not the one its
digest was taken of raise an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.session import shared_dir

MIN_REVISIT = 100
#: Records of one archive file, which a task reads whole; payloads from LARGE bytes on have a file each.
RECORDS_PER_FILE, LARGE = 2_000, 64 << 10
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"


def _id(kind: str, *parts: Column) -> Column:
    """A record id that follows from what the record is about."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _header_value(text: Column) -> Column:
    """``text`` with white space and control characters percent-encoded."""
    unsafe = r"[\x00-\x20\x7F-\xA0]"
    one = F.transform(
        F.split(text, ""),
        lambda c: F.when(c.rlike(unsafe), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c),
    )
    return F.when(text.rlike(unsafe), F.array_join(one, "")).otherwise(text)


def _record(kind: str | Column, fields: list[tuple[str, Column]], body: Column) -> Column:
    """A record without the two line ends that close it. NULL fields are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [("WARC-Type", kind), ("WARC-Date", F.lit(DATE)), *fields, ("Content-Length", F.octet_length(body).cast("string"))]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in head]
    return F.concat(F.lit("WARC/1.1" + CRLF), F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), body)


def plan_captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, and the id of the page it revisits, if any.

    Groups of equal payloads are combined map-side to their smallest page_id;
    adaptive execution may split the join of a hot payload.
    """
    url = _header_value(F.col("url")).alias("url")
    rows = pages.select("page_id", url, F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    firsts = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = firsts.where((F.col("n") > 1) & F.col("first").isNotNull()).drop("n")
    of = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    # Of a page_id with several urls, the smallest url is the one that is named.
    named = rows.join(firsts, "digest").where(F.col("page_id") == F.col("first"))
    named = named.groupBy("digest", "first").agg(F.min(F.coalesce("url", F.lit("-"))).alias("first_url"))
    return rows.join(named, "digest", "left").withColumn("refers_to", of)


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of ``pages`` as gzip files under ``path``, by Spark's text writer
    and commit protocol. Each line of its output is a record, closed by two line ends.

    A file is read back whole, so its size is bounded: by the number of records
    for small payloads, and to one capture for large ones.
    """
    captures = plan_captures(pages)
    large = F.octet_length("payload") >= LARGE
    _write(captures.where(~large), path, RECORDS_PER_FILE, "overwrite")
    if not pages.where(F.octet_length("html") >= LARGE).isEmpty():
        _write(captures.where(large), path, 3, "append")


def _write(p: DataFrame, path: str, records: int, mode: str) -> None:
    main = _id("capture", F.col("page_id"), F.col("url"), F.col("digest"))
    first = F.when(F.col("refers_to").isNotNull(), _id("capture", F.col("refers_to"), F.col("first_url"), F.col("digest")))
    again = first.isNotNull()
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF)
    ask = F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("")), F.lit(" HTTP/1.1" + CRLF + CRLF))
    about = F.concat_ws(
        CRLF,
        F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("payload-bytes: "), F.octet_length("payload").cast("string")),
        F.lit(""),
    )
    profile = F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    capture = _record(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        [("WARC-Record-ID", main), target, ("WARC-Refers-To", first), ("WARC-Profile", profile), digest, ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.when(again, http).otherwise(F.concat(http, F.col("payload"))),
    )

    def beside(kind: str, media: str, body: Column) -> Column:
        own = _id(kind, F.col("page_id"), F.col("url"), F.col("digest"))
        return _record(kind, [("WARC-Record-ID", own), target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit(media))], body)

    lines = p.select(
        F.explode(
            F.array(beside("request", "application/http; msgtype=request", ask), capture, beside("metadata", "application/warc-fields", about))
        ).alias("value")
    )
    (
        lines.write.mode(mode)
        .option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records)
        .text(path)
    )


def parse_archive(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and content block of every record of a gzip
    archive. A member or record that is not whole raises ValueError."""
    parts, at = [], 0
    rest = memoryview(raw)
    while len(rest):  # one gzip member, or one a record
        d = zlib.decompressobj(31)
        parts.append(d.decompress(rest))
        if not d.eof:
            raise ValueError("the archive is cut short")
        rest = rest[len(rest) - len(d.unused_data) :]
    data = b"".join(parts)
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"no end of the header at byte {at}")
        lines = data[at:end].decode("utf-8", "surrogateescape").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        if not head.get("content-length", "").isdigit():
            raise ValueError(f"no length of the record at byte {at}")
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not whole")
        yield head, data[start:stop]
        at = stop + 4


RECORD = (
    "type string, id string, concurrent_to string, refers_to string, uri string, date string, digest string, "
    "page_id long, payload_bytes long, payload_digest string, payload binary"
)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record. Payload digests and lengths are taken from the bytes
    that were read; ``payloads=False`` leaves the bytes themselves out."""

    def run(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in files:
            for raw in part["content"]:
                rows = []
                for head, block in parse_archive(raw):
                    kind = head["warc-type"]
                    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    about = dict(x.split(": ", 1) for x in block.decode().split(CRLF) if x) if kind == "metadata" else {}
                    found = hashlib.sha256(body).hexdigest() if body is not None else None
                    told = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    if found and told and found != told:
                        raise ValueError(f"the payload of {head['warc-record-id']} is not the one that was written")
                    number = len(body) if body is not None else int(about["payload-bytes"]) if about else None
                    rows.append((
                        kind, head["warc-record-id"], head.get("warc-concurrent-to"), head.get("warc-refers-to"),
                        head.get("warc-target-uri"), head["warc-date"], told,
                        int(about["page-id"]) if "page-id" in about else None, number,
                        found, body if payloads else None,
                    ))
                names = [c.split()[0] for c in RECORD.split(", ")]
                yield pd.DataFrame(rows, columns=names, dtype=object).astype({"page_id": "Int64", "payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: uri, request, response, metadata (structs) and
    ``original``, the metadata of the response that a revisit names."""
    key = F.coalesce("concurrent_to", "id")
    whole = F.struct(*records.columns)

    def only(*kinds: str) -> Column:
        return F.first(F.when(F.col("type").isin(*kinds), whole), ignorenulls=True)

    captures = records.groupBy(key.alias("capture")).agg(
        only("request").alias("request"),
        only("response", "revisit").alias("response"),
        only("metadata").alias("metadata"),
        F.sum(F.when(F.col("type") == "metadata", 1).otherwise(0)).cast("int").alias("times"),
    )
    originals = captures.where(F.col("response.type") == "response")
    originals = originals.select(F.col("capture").alias("original_id"), F.col("metadata").alias("original"))
    # Responses name nothing; a key of their own spreads them over the tasks.
    named = F.coalesce("response.refers_to", F.concat(F.lit("-"), F.col("capture")))
    out = captures.join(originals, named == F.col("original_id"), "left")
    out = out.select("*", F.explode(F.array_repeat(F.lit(1), F.greatest("times", F.lit(1)))))
    return out.select(F.col("response.uri").alias("uri"), "request", "response", "metadata", "original")


def archive_pages(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = shared_dir(pages.sparkSession, "archives", uuid.uuid4().hex)
    write_archives(pages, path)
    return assemble(read_records(pages.sparkSession, path, payloads))
