import hashlib
import io
import zipfile

import pyarrow.fs as pafs
import pytest

from moneytrail.llm import queries, warc_zip
from moneytrail.llm.common import fresh_path

from .conftest import SF


def expected(rows):
    first = {}
    for i, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, html in rows:
        data = (html or "").encode()
        other = first.get(data)
        refers = other if other is not None and other != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert sorted(map(tuple, queries.op7_warc(spark, SF).collect()), key=str) == expected([(r.page_id, r.html) for r in pages])


def test_odd_rows(spark, monkeypatch):
    same, small = "é" * 50, "x" * 99
    rows = [(5, same), (2, same), (9, same), (9, same), (3, small), (4, small), (6, None), (7, ""), (None, same), (None, "y" * 200), (8, "\r\n\r\nWARC/1.1\r\n" * 20), (10, "z" * 500_000)]
    pages = spark.createDataFrame([(i, None if i == 6 else "http://a b/ü\n", h, "x") for i, h in rows], "page_id bigint, url string, html string, payload string").repartition(2)
    manifest = warc_zip.write_archives(pages, fresh_path(spark, "warc"), archive_bytes=300)  # several archives a task
    assert manifest.count() > 2
    records = warc_zip.read_archives(manifest, range_bytes=200).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str) == expected(rows)
    assert {r.page_id: bytes(r.payload) for r in records if r.record_type == "response" and r.page_id}[2] == same.encode()
    assert {r.uri for r in records} == {None, "http://a%20b/%C3%BC%0A"}
    assert warc_zip.round_trip(spark, pages.limit(0)).collect() == []


@pytest.mark.parametrize("limit", [None, 0])  # with 0 the directory is written in its ZIP64 form
def test_archives_are_zip_files(spark, monkeypatch, limit):
    folder = fresh_path(spark, "warc")
    if limit is not None:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", limit)
    archive = warc_zip._Archive(folder)
    archive.add(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    archive.add(2, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), 1)
    path = archive.close()["path"]
    files, at = pafs.FileSystem.from_uri(path)
    raw = files.open_input_file(at).read()
    read = lambda offset, n: raw[offset : offset + n]
    members = warc_zip.zip_members(read, len(raw))
    theirs = zipfile.ZipFile(io.BytesIO(raw))
    assert set(members) == set(theirs.namelist()) == {warc_zip.DATA, warc_zip.INDEX}
    for name in members:
        a, n = warc_zip.stored_range(read, members[name])
        assert raw[a : a + n] == theirs.read(name)
    assert (b"PK\x06\x06" in raw) == (limit == 0)


def test_foreign_files():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "b" * 100)
        z.comment = b"a comment with PK inside"
    raw = raw.getvalue()
    members = warc_zip.zip_members(lambda o, n: raw[o : o + n], len(raw))
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.stored_range(lambda o, n: raw[o : o + n], members["a"])
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.zip_members(lambda o, n: b"x" * n, 100)


def test_reading_tasks_grow_with_the_bytes(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"{i} " + "".join(chr(97 + (i * j * j + j) % 26) for j in range(4000))) for i in range(60)], "page_id bigint, url string, html string")
    manifest = warc_zip.write_archives(pages, fresh_path(spark, "warc"))
    size = manifest.agg({"bytes": "sum"}).first()[0]
    records = warc_zip.read_archives(manifest, range_bytes=2000, read_bytes=size // 8)
    assert warc_zip.reading_tasks(manifest, size // 8)[1] == records.rdd.getNumPartitions() >= 8
    assert records.count() == 60
    assert warc_zip.reading_tasks(manifest, size // 16)[1] >= 16
