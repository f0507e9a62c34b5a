import gzip
import zlib
from hashlib import sha256

from aircascade.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, type string"


def pages():
    long_ = "<p>é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 9
    rows = [(1, "http://a.example/x?y", long_), (2, None, long_), (3, "bad\r\nurl: x", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", long_), (0, "u", "z" * 100), (9, "u", "z" * 100), (9, "u", "z" * 100), (8, "u", "z" * 99), (10, "u", "z" * 99)]
    return [(*r, "p", "t") for r in rows]


def test_round_trip(spark):
    rows = pages()
    got = warc.page_captures(spark.createDataFrame(rows, SCHEMA)).drop("n_requests").collect()
    want = []
    for i, _, html, *_ in rows:
        raw = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(raw) >= 100 and i != min(same)
        want.append((i, len(raw), sha256(raw).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_nested_rows(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_pages(spark.createDataFrame(pages(), SCHEMA), path)
    rows = warc.captures(warc.read_records(spark, path)).collect()
    assert len(rows) == len(pages()) and all(len(r.requests) == 1 and "fetchTimeMs" in r.metadata for r in rows)
    assert {r.payload.decode() for r in rows if r.record_type == "response"} == {p[2] or "" for p in pages()}


def test_each_record_is_a_member_and_files_are_bounded(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", rng.randbytes(3000).hex(), "", "") for i in range(40)] + [(99, "u", "y" * (17 << 20), "", "")]
    path = str(tmp_path / "warc")
    warc.write_pages(spark.createDataFrame(rows, SCHEMA).repartition(2), path, file_bytes=20_000)
    files = sorted(f for f in (tmp_path / "warc").iterdir() if f.name.startswith("part-"))
    n, largest = 0, 0
    for f in files:
        raw = f.read_bytes()
        largest = max(largest, len(raw))
        while raw:
            z = zlib.decompressobj(31)
            record = z.decompress(raw)
            raw = z.unused_data
            if record:
                assert record.startswith(b"WARC/1.1") and record.endswith(b"\r\n\r\n")
                n += 1
    assert n == 3 * len(rows) and len(files) > 5 and largest < 30_000
    assert {r.page_id for r in warc.page_captures(spark.createDataFrame(rows, SCHEMA)).collect()} == {r[0] for r in rows}


def test_either_side_names_the_other_and_members_of_gzip(spark, tmp_path):
    def record(kind, i, block, extra=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{i}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n".encode()

    parts = [record("warcinfo", "w", "x: y"), record("response", "a", "HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http\r\nWARC-Concurrent-To: <q>\r\nWARC-Concurrent-To: <m>\r\n"), record("request", "q", "GET /"), record("metadata", "m", "k: v")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "y.warc").write_bytes(record("response", "b", "raw"))
    rows = {r.capture_id: r for r in warc.captures(warc.read_records(spark, str(tmp_path))).collect()}
    assert rows["<a>"].payload == b"body" and len(rows["<a>"].requests) == 1 and rows["<a>"].metadata == {"k": "v"}
    assert rows["<b>"].payload == b"raw" and rows["<b>"].requests is None or rows["<b>"].requests == []


def test_empty(spark):
    assert warc.page_captures(spark.createDataFrame([], SCHEMA)).count() == 0
