import base64
import gzip
import hashlib
import random

import duckdb
import pytest

from chainlake.llm import common, warc

CLASH = "page_id long, url string, html string, sha string, first int, record string"


def arc_file(version, records):
    out = warc.version_block("x.arc", version)
    for url, body in records:
        fields = [url, "127.0.0.1", "19970501123456", "text/html"] + (["200", "CK", "-", "77", "x"] if version == 2 else []) + [str(len(body))]
        out += b"\n" + " ".join(fields).encode() + b"\n" + body
    return out + b"\n"


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions(version):
    bodies = [("http://a/", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello\n\nworld"), ("dns:x", b""), ("http://b/", b"plain\r\n")]
    found = list(warc.parse_arc(arc_file(version, bodies)))
    assert [(r.url, r.body) for r in found] == bodies and {r.ip for r in found} == {"127.0.0.1"}
    assert ("Result-code" in found[0].fields) == (version == 2)
    fields, block = next(warc.parse_warc(warc.warc_record(found[0], 5, None) + b"\r\n\r\n"))
    assert (fields["warc-type"], fields["warc-date"], block) == ("response", "1997-05-01T12:34:56Z", bodies[0][1])
    assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"hello\n\nworld").digest()).decode()
    plain = next(warc.parse_warc(warc.warc_record(found[2], 6, None) + b"\r\n\r\n"))[0]
    assert plain["warc-type"] == "resource" and plain["content-type"] == "text/html"
    first = {"page_id": 5, "url": found[0].url, "date": found[0].date}
    again, rest = next(warc.parse_warc(warc.warc_record(found[0], 9, first) + b"\r\n\r\n"))
    assert again["warc-refers-to"] == fields["warc-record-id"] != again["warc-record-id"] and rest.endswith(b"\r\n\r\n")


@pytest.mark.parametrize(
    "data",
    [b"http://a/ 1 2 3 4\nbody", warc.version_block("x", 1) + b"\nhttp://a/ ip date type 99\nshort", warc.version_block("x", 1) + b"\nbroken header\n", warc.version_block("x", 1).replace(b"1 0", b"3 0")],
)
def test_broken_archives(data):
    with pytest.raises(ValueError, match="byte"):
        list(warc.parse_arc(data))


def test_broken_warc():
    for data in (b"junk", b"WARC/1.1\r\nContent-Length: x\r\n\r\n", b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"):
        with pytest.raises(ValueError, match="byte"):
            list(warc.parse_warc(data))
    assert warc.unpacked(gzip.compress(b"a") + gzip.compress(b"b")) == b"ab" == warc.unpacked(b"ab")
    assert warc.iso("2024") == "1970-01-01T00:00:00Z" and warc.iso("20240102") == "2024-01-02T00:00:00Z"


SMALL = ((100, 4), (2000, 2), (None, 1))


def round_trip(spark, pages, least=0, sizes=SMALL):
    arc, out = common.scratch_path(spark, "arc"), common.scratch_path(spark, "warc")
    warc.arc_rows(pages, arc, sizes)
    warc.to_warc(spark, arc, out, least, sizes)
    return warc.read_warc(spark, out)


def test_edges(spark):
    tricky = "WARC/1.1\r\n\r\n\r\n\r\nHTTP/1.1 x\r\n\r\n\n é " * 40
    rows = [(1, "http://a/ b", "x"), (2, "http://b", "x"), (3, None, None), (4, "", ""), (5, "u", tricky), (0, "u", "x" * 300_000), (6, "v", tricky), (6, "v", tricky), (None, "n", "x"), (7, "w", "\n")]
    pages = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], CLASH)
    found = [tuple(r)[:6] for r in round_trip(spark, pages).collect()]
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = []
    for page_id, url, html in rows:
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        again = page_id is None or page_id > min(same)
        want.append((page_id, len((html or "").encode()), sha(html or ""), "revisit" if again else "response", min(same) if again else None, url.replace(" ", "%20") if url else None))
    assert sorted(found, key=repr) == sorted(want, key=repr)
    none = round_trip(spark, pages, least=10**6).collect()
    assert {r.record_type for r in none} == {"response"} and len(none) == len(rows)
    assert round_trip(spark, pages.limit(0)).count() == 0


def test_oracle(spark):
    duckdb.sql("CREATE OR REPLACE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    want = duckdb.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({warc.ORACLE_SQL})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in warc.query(spark, "/root/testdata/sf0.001").collect())


def test_files_are_bounded_by_bytes(spark):
    """Both versions of ARC, every page in a file of its class of length, long ones by themselves; all pages come back."""
    rng = random.Random(1)
    rows = [(i, f"http://a/{i}", "".join(rng.choice("abcdef") for _ in range(n))) for i, n in enumerate([10] * 40 + [1500] * 9 + [40_000, 3_000_000])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    arc, out = common.scratch_path(spark, "arc"), common.scratch_path(spark, "warc")
    warc.arc_rows(pages, arc, SMALL)
    versions, sizes = set(), []
    for r in warc._files(spark, arc).collect():
        if not (data := warc.unpacked(bytes(r.content))):
            continue  # of a task without rows
        versions.add(data.split(b"\n")[1][:1])
        sizes.append(sorted(len(warc.split_http(x.body)[1]) for x in warc.parse_arc(data)))
    assert versions == {b"1", b"2"} and sum(map(len, sizes)) == 51
    assert all(len(x) <= 4 and (x[-1] <= 100 or len(x) <= 2 and x[0] > 100 and (x[-1] <= 2000 or len(x) == 1)) for x in sizes if x)
    warc.to_warc(spark, arc, out, sizes=SMALL)
    files = [[len(block) for _, block in warc.parse_warc(warc.unpacked(bytes(r.content)))] for r in warc._files(spark, out).collect()]
    assert all(len(x) <= 4 and (len(x) == 1 or max(x) < 2200) for x in files if x)
    assert {(r.page_id, r.payload_bytes) for r in warc.read_warc(spark, out).collect()} == {(i, len(h)) for i, _, h in rows}


def test_archives_of_others(spark, tmp_path):
    """A folder of ARC files of both versions, of records of any length, that this library has not written."""
    bodies = [(f"http://a/{n}", warc.http_response(b"x" * n, page_id=n)) for n in (5, 50, 1500, 90_000)]
    (tmp_path / "part-1.arc").write_bytes(arc_file(1, bodies))
    (tmp_path / "part-2.arc.gz").write_bytes(gzip.compress(arc_file(2, [("http://b/", b"plain " * 30)])))
    out = common.scratch_path(spark, "warc")
    warc.to_warc(spark, f"file://{tmp_path}", out, sizes=SMALL)
    found = warc.read_warc(spark, out).collect()
    assert {(r.page_id, r.payload_bytes, r.record_type) for r in found} == {(5, 5, "response"), (50, 50, "response"), (1500, 1500, "response"), (90_000, 90_000, "response"), (None, 180, "resource")}
