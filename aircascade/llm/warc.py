"""WARC archives: writing pages, and assembling captures from their records.

Writing: each page gives a request, a response or revisit, and a metadata
record, each a gzip member of its own, so a record can be read from its offset.
Spark's text writer puts them into files of bounded size, so no task opens a file
itself.  Of pages with equal payloads of at least 100 bytes the one with the
smallest page_id is the response and the others revisit it, without a payload;
this is decided on narrow rows of digests, before any page moves.

Reading: files come through Spark's binary reader and are parsed as a stream, a
record at a time.  Records that name each other in WARC-Concurrent-To (on either
side) form one transaction, which becomes one nested row.

Defined results: a null html is an empty payload, a null url an empty target; a
null page_id stays null and is never chosen as the response where another page
has the same payload; rows that share a page_id are captures of their own; an
empty table gives no rows.  A very long page makes a record and a file of its own.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, fresh_path, salted_join, shuffles_dropped, stored, tune

#: Shorter payloads are never revisits.
LEAST_BYTES = 100
#: Bytes after which a file is closed.
FILE_BYTES = 32 << 20
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, fields map<string,string>, payload binary, payload_bytes long, payload_digest string"


def _record(kind: Column, record_id: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """One WARC record; a header with a null value is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in headers]
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: "), record_id, F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}"),
        *[F.coalesce(x, F.lit("")) for x in lines],
        F.lit(f"Content-Type: {content_type}{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block,
    )


def _urn(row: Column, what: str) -> Column:
    h = F.md5(F.concat(F.lit(f"{what}|"), row.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _files(size: int):
    """Records to runs of gzip members, each a file without its last byte."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, n = [], 0

        def closed() -> pa.RecordBatch:
            raw = b"".join(members)
            # A member ends with its record's length, the highest byte last: 0 for under 16 MB.  Else an empty member, which ends so, is added.
            raw = raw if raw[-1] == 0 else raw + _member(b"")
            return pa.RecordBatch.from_arrays([pa.array([raw[:-1]], pa.binary())], ["value"])

        for b in batches:
            for record in b.column(0):
                members.append(_member(record.as_py().encode() + b"\r\n\r\n"))
                n += len(members[-1])
                if n >= size:
                    yield closed()
                    members, n = [], 0
        if members:
            yield closed()

    return run


def write_pages(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write WARC files of ``pages`` (page_id, url, html) at ``path``, each of about ``file_bytes`` compressed bytes at most."""
    tune(pages.sparkSession)
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"), F.monotonically_increasing_id().alias("row"))
    # Written once, so that a row's number is the same in all that follows.
    p = stored(p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("bytes", F.octet_length("html")), "pages")
    narrow = p.where(F.col("bytes") >= LEAST_BYTES).select("row", "page_id", F.unhex("digest").alias("key"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first")
    groups = narrow.groupBy("key").agg(first, F.count("*").alias("n")).where("n > 1").select("key", F.col("first.row").alias("first_row"))
    revisits = stored(salted_join(narrow.select("row", "key"), groups, "key").where("row <> first_row").select("row", "first_row"), "revisits")
    # By row: no key is shared, however many pages have one payload.
    p = p.join(revisits, "row", "left")
    again = F.col("first_row").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    p = p.select("page_id", "html", "digest", "bytes", "row", again.alias("again"), "first_row", url.alias("url"))

    me = _urn(F.col("row"), "capture")
    target, beside = ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", me)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    host = F.regexp_extract("url", r"^\w+://([^/?#]*)", 1)
    get = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF + CRLF))
    fields = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")), F.lit("fetchTimeMs: 0\r\n"))
    records = F.array(
        _record(F.lit("request"), _urn(F.col("row"), "request"), [target, beside], "application/http; msgtype=request", get),
        F.when(
            F.col("again"),
            _record(F.lit("revisit"), me, [target, digest, ("WARC-Refers-To", _urn(F.col("first_row"), "capture")), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))], "application/http; msgtype=response", http),
        ).otherwise(_record(F.lit("response"), me, [target, digest], "application/http; msgtype=response", F.concat(http, F.col("html")))),
        _record(F.lit("metadata"), _urn(F.col("row"), "metadata"), [target, beside], "application/warc-fields", fields),
    )
    files = p.select(F.explode(records).alias("value")).mapInArrow(_files(file_bytes), "value binary").select(F.col("value").cast("string").alias("value"))
    # The separator gives each file its last byte; the text is bytes that Spark writes as they are.
    with shuffles_dropped(pages.sparkSession):
        files.write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", 1).text(path)
    dropped(p)
    dropped(revisits)


class _Stream:
    """Bytes of a file, plain or gzip of one or many members, as they are asked for."""

    def __init__(self, content: memoryview):
        self.rest, self.buffer, self.packed = content, bytearray(), bytes(content[:2]) == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if not len(self.rest):
            return False
        part, self.rest = self.rest[: 1 << 18], self.rest[1 << 18 :]
        while self.packed and len(part):
            self.buffer += self.inflate.decompress(part)
            part = self.inflate.unused_data
            if part:
                self.inflate = zlib.decompressobj(31)
        self.buffer += part
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the next ``mark``, which is taken too; None at the end."""
        at = 0
        while (i := self.buffer.find(mark, at)) < 0:
            at = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(content: memoryview) -> Iterator[dict]:
    """The records of one archive file."""
    s = _Stream(content)
    while (head := s.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split(CRLF)
        if not lines[0].startswith("WARC/"):
            continue
        headers: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        one = lambda name: headers.get(name, [None])[0]  # noqa: B023, E731
        block = s.take(int(one("content-length") or 0))
        kind, payload, fields = one("warc-type"), None, {}
        if kind in ("response", "revisit"):
            payload = block.partition(b"\r\n\r\n")[2] if (one("content-type") or "").startswith("application/http") else block
        elif kind == "metadata":
            for line in block.decode("utf-8", "replace").split(CRLF):
                name, colon, value = line.partition(":")
                if colon:
                    fields[name.strip()] = value.strip()
        full = kind == "response"
        named = (one("warc-payload-digest") or "").partition("sha256:")[2] or None
        yield {
            "record_id": one("warc-record-id"), "type": kind, "concurrent_to": headers.get("warc-concurrent-to", []), "refers_to": one("warc-refers-to"), "target_uri": one("warc-target-uri"), "date": one("warc-date"),
            "fields": list(fields.items()), "payload": payload if full else None, "payload_bytes": len(payload) if full else None, "payload_digest": hashlib.sha256(payload).hexdigest() if full else named,
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of all files below ``path``."""
    text, kinds = pa.string(), {}
    for name in ("record_id", "type", "refers_to", "target_uri", "date", "payload_digest"):
        kinds[name] = text
    kinds |= {"concurrent_to": pa.list_(text), "fields": pa.map_(text, text), "payload": pa.binary(), "payload_bytes": pa.int64()}
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names)

        for b in batches:
            for content in b.column(0):
                rows, size = [], 0
                for r in parse(memoryview(content.as_buffer())):
                    rows.append(r)
                    size += len(r["payload"] or b"")
                    if len(rows) >= 1000 or size > 4 << 20:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row a capture: its response or revisit with the requests and metadata that are concurrent to it."""
    main = records.where(F.col("type").isin("response", "revisit", "resource"))
    beside = records.where(F.col("type").isin("request", "metadata"))
    item = F.struct("record_id", "type", "target_uri", "date", "fields").alias("item")
    named = beside.select(F.explode("concurrent_to").alias("capture_id"), item)
    names = main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other"))
    naming = names.join(beside.select(F.col("record_id").alias("other"), item), "other").select("capture_id", "item")
    # The records of one fetch: a handful by nature.
    sides = named.unionByName(naming).groupBy("capture_id").agg(F.collect_list("item").alias("items"))
    out = main.withColumnRenamed("record_id", "capture_id").drop("fields", "concurrent_to").join(sides, "capture_id", "left")
    pick = lambda kind: F.array_sort(F.array_distinct(F.transform(F.filter("items", lambda x: x["type"] == kind), lambda x: F.struct(x["record_id"].alias("record_id"), x["target_uri"].alias("target_uri"), x["date"].alias("date")))))
    fields = F.aggregate(F.filter("items", lambda x: x["type"] == "metadata"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda a, x: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(x["fields"], k)), x["fields"]))
    return out.select("capture_id", F.col("type").alias("record_type"), "target_uri", "date", "refers_to", "payload", "payload_bytes", "payload_digest", pick("request").alias("requests"), F.coalesce(fields, F.expr("map()").cast("map<string,string>")).alias("metadata"))


def resolved(captures: DataFrame, columns: list[str], salts: int = 16) -> DataFrame:
    """Captures (capture_id, record_type, refers_to, ...) with ``columns`` of the response that each revisit refers to, as <column>_of.

    Many revisits may refer to one response: they are dealt by a salt too, and the
    responses that are referred to are repeated for each salt.
    """
    asked = captures.where("record_type = 'revisit'").select(F.col("refers_to").alias("_id")).distinct()
    full = captures.where("record_type = 'response'").select(F.col("capture_id").alias("_id"), *[F.col(c).alias(f"{c}_of") for c in columns])
    full = full.join(asked, "_id").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = captures.withColumn("_mine", F.pmod(F.xxhash64("capture_id"), F.lit(salts)))
    # Only revisits look for a partner; other rows have ids of their own there, so they are spread as well.
    rows = rows.withColumn("_to", F.when(F.col("record_type") == "revisit", F.col("refers_to")).otherwise(F.concat(F.lit("-"), "capture_id")))
    return rows.join(full, (F.col("_to") == F.col("_id")) & (F.col("_mine") == F.col("_salt")), "left").drop("_id", "_salt", "_mine", "_to")


def page_captures(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives, read them back, and give page_id, payload_bytes, payload_digest, record_type, refers_to, n_requests."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_pages(pages, path)
    c = captures(read_records(spark, path))
    page = F.element_at("metadata", "pageId").cast("long").alias("page_id")
    c = stored(c.select("capture_id", "record_type", "refers_to", "payload_bytes", "payload_digest", page, F.size("requests").alias("n_requests")), "captures")
    tune(spark)  # the small batches were for whole files
    out = resolved(c, ["page_id", "payload_bytes"])
    return out.select("page_id", F.coalesce("payload_bytes", "payload_bytes_of").alias("payload_bytes"), "payload_digest", "record_type", F.col("page_id_of").alias("refers_to"), "n_requests")


#: The pages' captures in DuckDB's SQL.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS b, sha256(h) AS s FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS f FROM d)
SELECT page_id, b AS payload_bytes, s AS payload_digest, CASE WHEN b >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN b >= 100 AND f <> page_id THEN f END AS refers_to, 1 AS n_requests FROM m"""
