import base64
import hashlib

import pytest

from pulsemill.llm import arc_convert as A
from pulsemill.session import scratch_path

PAGES = "page_id long, url string, html string"
RECORDS = [("http://a.org/x", "1.2.3.4", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\nmore"),
           ("http://b.org/", "1.2.3.4", "20010203040507", "text/plain", b""),
           ("http://c.org/", "1.2.3.4", "2001", "text/html", b"no head\nhttp://x 1 2 3 4\n")]


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_round_trip(version):
    data = A.write_arc(RECORDS, version, "x.arc")
    found = [(r.url, r.ip, r.date, r.content_type, r.block) for r in A.read_arc(data)]
    assert found == RECORDS
    assert all(r.version == version for r in A.read_arc(data))


@pytest.mark.parametrize("damage", [
    lambda d: d[:-30], lambda d: d.replace(b"filedesc:", b"warcinfo:"), lambda d: d.replace(b"1 0 pulsemill", b"9 0 pulsemill"),
    lambda d: d.replace(b"http://b.org/ 1.2.3.4 20010203040507 text/plain 0", b"http://b.org/ lost")])
def test_damaged_arcs_are_refused(damage):
    with pytest.raises(A.ArcError):
        list(A.read_arc(damage(A.write_arc(RECORDS, "1", "x.arc"))))


def test_the_version_block_can_be_read():
    about, *rest = A.read_arc(A.write_arc(RECORDS, "2", "x.arc"), with_about=True)
    assert about.url == "filedesc://x.arc" and about.block.startswith(b"2 0 pulsemill\nURL") and len(rest) == 3


def test_records_that_differ_late_or_not_at_all_have_their_own_id():
    long = b"HTTP/1.0 200 OK\r\n\r\n" + b"x" * 1000
    same = [("http://a.org/", "1.2.3.4", "20010203040506", "text/html", b) for b in (long, long, long + b"y")]
    data = A.write_arc(same, "1", "x.arc")
    ids = [A.record_id(r, "/a/one.gz") for r in A.read_arc(data)]
    assert len(set(ids)) == 3 and ids == [A.record_id(r, "/b/one.gz") for r in A.read_arc(data)]
    assert ids[0] != A.record_id(next(A.read_arc(data)), "/a/two.gz")


def test_dates_and_digests():
    assert A.iso_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert A.iso_date("2001") == "2001-01-01T00:00:00Z"
    assert A.digest(b"x") == base64.b32encode(hashlib.sha1(b"x").digest()).decode()


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        payload = (h or "").encode()
        own = first.get(h or "")
        again = own is not None and i != own
        out.append((i, len(payload), A.digest(payload), "revisit" if again else "response", own if again else None))
    return sorted(out, key=str)


def test_pages_to_warc_and_back(spark):
    rows = [(1, "http://a.org/ b", "<p>one</p>\r\n\r\nWARC/1.0\r\n\r\n"), (2, None, "<p>é two</p>"), (3, "http://c.org", None),
            (4, "http://d.org", ""), (5, "http://e.org", "<p>é two</p>"), (None, "http://f.org", "<p>é two</p>"),
            (None, "http://g.org", "only here"), (7, "http://h.org", "x" * 300_000), (8, "http://i.org", "<p>é two</p>"),
            (2, None, "<p>é two</p>"), (9, "http://j.org", "\n\n")]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    found = A.round_trip(df)
    narrow = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, narrow.collect()), key=str) == brute(rows)
    records = {r.record_id: r for r in found.collect()}
    assert len(records) == len(rows)
    for r in records.values():
        if r.record_type == "revisit":
            first = records[r.refers_to_record]
            assert (first.record_type, first.page_id, first.payload_digest) == ("response", r.refers_to, r.payload_digest)
        else:
            assert r.refers_to_record is None

    arcs = A.write_arcs(df, scratch_path(spark, "arc"), archive_bytes=20)  # an archive per page
    warcs = A.read_warcs(spark, A.convert(spark, arcs, scratch_path(spark, "warc"), least_bytes=100, archive_bytes=20))
    assert all(r.record_type == "response" for r in warcs.collect()) and warcs.count() == len(rows)
    assert {r.warc_date for r in warcs.collect()} == {"2024-01-01T12:00:00Z"}


def test_warc_files_describe_themselves(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "same"), (2, "http://b.org/", "same"), (3, "http://c.org/", None)], PAGES)
    path = A.convert(spark, A.write_arcs(df.coalesce(1), scratch_path(spark, "arc")), scratch_path(spark, "warc"))
    (data,) = [A.unzipped(r.content) for r in A._files(spark, path).collect()]
    about, *rest = [f for f, _ in A.read_warc(data)]
    assert about["WARC-Type"] == "warcinfo" and {f["WARC-Warcinfo-ID"] for f in rest} == {about["WARC-Record-ID"]}
    again = next(f for f in rest if f["WARC-Type"] == "revisit")
    first = next(f for f in rest if f["Page-Id"] == "1")
    assert (again["WARC-Refers-To"], again["WARC-Refers-To-Target-URI"], again["WARC-Refers-To-Date"]) == (
        first["WARC-Record-ID"], "http://a.org/", first["WARC-Date"])
    block = next(b for f, b in A.read_warc(data) if f["WARC-Type"] == "warcinfo").decode()
    assert "arc-version-line: 1 0 pulsemill\r\n" in block and "isPartOf: part-0.arc" in block


def test_clashing_columns_and_very_long_pages(spark):
    rows = [(1, "http://a.org/" + "u" * 50_000, "é" * 3_000_000, "r", "x"), (2, "http://b.org", "é" * 3_000_000, "s", "y")]
    df = spark.createDataFrame(rows, PAGES + ", record_id string, payload string")
    found = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in A.round_trip(df).collect())
    assert found == [(1, 6_000_000, "response", None), (2, 6_000_000, "revisit", 1)]


def test_empty_table(spark):
    assert A.round_trip(spark.createDataFrame([], PAGES)).count() == 0
