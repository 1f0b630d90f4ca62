"""WARC: records of page captures, and their assembly into one nested row per capture.

A capture is written as three records: the request, the response (or a revisit of an earlier page with the same
payload) and metadata.  Request and metadata name the response or revisit in ``WARC-Concurrent-To``.  The files are
gzipped WARC/1.1, written by Spark's text source: a row is a record, the line separator its closing blank lines.

Reading cuts the files before each version line, parses the headers, and assembles the transactions by joins
through the concurrent-to identifiers.  A payload may hold such a line itself: a record is complete only when its
Content-Length is reached, and pieces are put together until it is.  Gzipped files are read by one task each,
in order, so all pieces of a record meet; ``FILE_RECORDS`` bounds the files.  Digests are checked on reading and a
broken record is an error.

Defined results: null html is the empty payload; a null url is an empty target; of rows with equal payloads of
at least ``REVISIT_BYTES`` bytes those with the smallest page_id are responses, the others (also with null page_id)
revisit the first of them, and if all page_ids are null all are responses; every row is a capture, also repeated ones
and those with null page_id, as the record ids hold the row's place in the table (written once, so that it is the same for all readers); an empty table makes an empty
archive; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import prepare, stored, table
from shelfmatch.llm.heat import join_counted
from shelfmatch.session import scratch_path

REVISIT_BYTES = 0
FILE_RECORDS = 60_000
VERSION = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
#: The alphabet of base 32 (a fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digest: Column) -> Column:
    """Base 32 of a hexadecimal SHA-1: 5 digits (20 bits) give 4 characters."""
    out = []
    for i in range(8):
        bits = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.lit(BASE32).substr(F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _record(kind: str, record_id: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    """A record without its closing blank lines; a field whose value is null is left out."""
    lines = [F.lit(f"{VERSION}WARC-Type: {kind}\r\nWARC-Record-ID: <"), record_id, F.lit(">\r\n")]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in fields]
    return F.concat(*lines, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(RECORD_END), block)


def capture_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The three records of each page, as text, in a column ``record``."""
    base = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    base = stored(base.withColumns({"sha1": F.sha1(F.col("payload").cast("binary")), "place": F.monotonically_increasing_id()}), "captures")
    # the first row of each payload that occurs again; the payloads stay behind
    first = base.select("page_id", "place", "sha1", F.octet_length("payload").alias("size")).where(F.col("size") >= revisit_bytes)
    first = first.groupBy("sha1").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "place"))).alias("f"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select("sha1", "n", F.col("f.page_id").alias("first_id"), F.col("f.place").alias("first_place")), "first-captures")
    rows = join_counted(base, first, ["sha1"], how="left")

    def urn(page_id: Column, place: Column) -> Column:
        return F.concat_ws(":", F.lit("urn:page"), F.coalesce(page_id.cast("string"), F.lit("null")), "sha1", place.cast("string"))

    own = urn(F.col("page_id"), F.col("place"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    digest = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    size = F.octet_length("payload").cast("string")
    common = (("WARC-Date", F.lit("1970-01-01T00:00:00Z")), ("WARC-Target-URI", url))
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    response = F.when(revisit, _record(
        "revisit", own, F.lit(HTTP), *common, ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.concat(F.lit("<"), urn(F.col("first_id"), F.col("first_place")), F.lit(">"))),
        ("WARC-Profile", F.lit(REVISIT_PROFILE)), ("Content-Type", F.lit("application/http; msgtype=response")),
    )).otherwise(_record(
        "response", own, F.concat(F.lit(HTTP), F.col("payload")), *common, ("WARC-Payload-Digest", digest),
        ("Content-Type", F.lit("application/http; msgtype=response"))))
    concurrent = ("WARC-Concurrent-To", F.concat(F.lit("<"), own, F.lit(">")))
    request = _record("request", F.concat(own, F.lit(":request")), F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1\r\n\r\n")),
                      *common, concurrent, ("Content-Type", F.lit("application/http; msgtype=request")))
    metadata = _record("metadata", F.concat(own, F.lit(":metadata")), F.concat(F.lit("payload-length: "), size, F.lit("\r\n")),
                       *common, concurrent, ("Content-Type", F.lit("application/warc-fields")))
    return rows.select(F.explode(F.array(request, response, metadata)).alias("record"))


def write_warc(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    prepare(pages.sparkSession)
    (capture_records(pages, revisit_bytes).write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


RECORD = ("record_id string, type string, concurrent_to string, target string, payload_digest string, refers_to string, "
          "payload_bytes long, fields map<string,string>, payload string")


def _parse(header: str, block: bytes, with_payload: bool) -> tuple:
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in header.split("\r\n"))}
    kind = fields["warc-type"]
    ident = [fields.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-concurrent-to", "warc-refers-to")]
    payload = block.split(RECORD_END.encode(), 1)[1] if "application/http" in fields.get("content-type", "") else block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response" and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError(f"the payload of {ident[0]} does not fit its digest")
    extra = dict(line.split(": ", 1) for line in block.decode().split("\r\n") if ": " in line) if kind == "metadata" else None
    return (ident[0], kind, ident[1], fields.get("warc-target-uri"), digest, ident[2], len(payload), extra,
            payload.decode() if with_payload and kind == "response" else None)


def _records(batches, with_payload: bool, kinds: pa.Schema):
    """Records from pieces that each end where the next version line starts."""
    gap = (RECORD_END + VERSION).encode()
    file, have, need = None, b"", 0  # the record so far and its full length

    def opened(piece: bytes) -> tuple[bytes, int]:
        end = piece.find(RECORD_END.encode()) + len(RECORD_END)
        if end < len(RECORD_END):
            raise ValueError(f"the header of a record in {file} is cut off")
        size = next(line for line in piece[:end].lower().split(b"\r\n") if line.startswith(b"content-length:"))
        return piece, end + int(size.split(b":")[1])

    for batch in batches:
        out = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            piece = text.encode()
            if name != file:
                if need:
                    raise ValueError(f"a record at the end of {file} is cut off")
                file, piece = name, piece.removeprefix(VERSION.encode())
            have, need = (have + gap + piece, need) if need else opened(piece)
            while need and len(have) >= need:
                header, block = have[:need].split(RECORD_END.encode(), 1)
                out.append(_parse(header.decode(), block, with_payload))
                rest = have[need:]  # a payload's last line may have overlapped the next version line
                have, need = opened(rest.removeprefix(gap)) if rest.startswith(gap) else (b"", 0)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * len(kinds), kinds)], schema=kinds)
    if need:
        raise ValueError(f"a record at the end of {file} is cut off")


def read_warc(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record (``RECORD``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    prepare(spark)
    pieces = spark.read.option("lineSep", RECORD_END + VERSION).text(path).select("_metadata.file_path", "value")
    kinds = to_arrow_schema(StructType.fromDDL(RECORD))
    return pieces.mapInArrow(functools.partial(_records, with_payload=with_payload, kinds=kinds), RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, target, request, response and metadata (structs).

    A record that occurs twice counts once; a capture without request or metadata has null there.
    """
    records = records.dropDuplicates(["record_id"])
    whole = F.struct("record_id", "type", "payload_digest", "payload_bytes", "refers_to", "payload")
    main = records.where(F.col("type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), "target", whole.alias("response"))

    def beside(kind: str) -> DataFrame:
        return (records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min_by(F.struct("record_id", "target", "fields"), "record_id").alias(kind)))

    return main.join(beside("request"), "capture_id", "left").join(beside("metadata"), "capture_id", "left")


def page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+):", 1).try_cast("long")


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    captures = transactions(stored(read_warc(spark, path, with_payload=False), "warc-records"))
    return captures.select(
        page_of(F.col("capture_id")).alias("page_id"), F.col("metadata.fields")["payload-length"].cast("long").alias("payload_bytes"),
        "response.payload_digest", F.col("response.type").alias("record_type"), page_of(F.col("response.refers_to")).alias("refers_to"))


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x FROM p),
f AS (SELECT x, min(page_id) AS first_id FROM d GROUP BY x),
b AS (SELECT x, string_agg(substr('{BASE32}', CAST((CAST('0x' || substr(x, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS BIGINT) + 1, 1), '' ORDER BY k) AS s
      FROM (SELECT x, unnest(range(32)) AS k FROM f) GROUP BY x)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, s AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d JOIN f USING (x) JOIN b USING (x)
"""
