import gzip
import hashlib
import io

from cohortlens.llm import warc
from helpers import clash

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    """rows: (page_id, url, html) -> sorted result rows."""
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        lead = first.get(data)
        revisit = lead is not None and lead != i and len([1 for r in rows if (r[2] or "").encode() == data]) > 1
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    lead if revisit else None))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, **more):
    pages = clash(spark.createDataFrame(rows, SCHEMA).repartition(3), "payload", "digest", "first_id")
    manifest = warc.write_archives(pages, str(tmp_path), **more)
    out = warc.read_archives(manifest, str(tmp_path)).collect()
    assert all(r.problem is None for r in out)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str)


def test_round_trip(spark, tmp_path):
    long = "<html>é 汉 " + "x" * 200
    rows = [(5, "http://a/ b\r\nX: y", long), (3, None, long), (9, "u", long), (9, "u", long), (1, "u", "short"),
            (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "z" * 3_000_000),
            (8, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (-1, "u", "y" * 99), (-2, "u", "y" * 99)]
    assert run(spark, rows, tmp_path / "a") == brute(rows)
    assert run(spark, rows, tmp_path / "b", archive_bytes=200) == brute(rows)
    assert run(spark, [], tmp_path / "c") == []


def test_members_are_plain_gzip(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame([(1, "u", "a" * 500)], SCHEMA), str(tmp_path)).collect()
    data = gzip.decompress((tmp_path / manifest[0].path).read_bytes())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response") and data.endswith(b"a" * 500 + b"\r\n\r\n")


def test_reader_in_any_portions_and_with_damage():
    digest = hashlib.sha256(b"p" * 400).hexdigest()
    members = [warc.member(warc.record(i, "u", b"p" * 400, digest, None)) for i in range(4)]
    for size in (1, 7, 64, 10_000):
        rows = list(warc.read_members(io.BytesIO(b"".join(members)), size))
        assert [r["page_id"] for r in rows] == [0, 1, 2, 3] and not any(r["problem"] for r in rows)
    bad = warc.member(warc.record(9, "u", b"p" * 400, digest, None).replace(b"ppp", b"qpp", 1))
    short = warc.member(warc.record(8, "u", b"p" * 400, digest, None)[:-9])
    rows = list(warc.read_members(io.BytesIO(members[0] + bad + short + members[1] + members[2][:-5])))
    assert [r.get("page_id") for r in rows] == [0, 9, 8, 1, 2]
    assert [r["problem"] for r in rows] == [None, "block digest differs", "the record is cut off", None,
                                            "the archive is cut off"]
    assert list(warc.read_members(io.BytesIO(b"junk junk")))[0]["problem"].startswith("not a gzip member")
