import base64
import gzip
import hashlib

import pytest

from revspark.llm import warc
from revspark.llm.warc import archived_pages, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, digest string, size long, first long, path string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1, 2, "p") for i, u, h in rows], SCHEMA)


def expected(rows, min_bytes=0):
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == body and j is not None]
        first = min(same) if same and len(body) >= min_bytes else None
        revisit = first is not None and first != i
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


PAGES = [(5, "http://a/\r\nX: y", "<p>one</p>"), (3, "http://b", "<p>one</p>"),
         (9, None, "<p>one</p>"), (4, "u", None), (6, "u", ""), (None, "u", "<p>one</p>"),
         (None, "u", "only"), (8, "u", "WARC/1.1\r\n\x1f\x8b\x08 é漢" * 3000),
         (10, "u", "x"), (10, "u", "x"), (2, "u", "<p>" + "long " * 200_000)]
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.mark.parametrize("range_bytes", [37, 1 << 22])
def test_round_trip(spark, range_bytes):
    got = archived_pages(frame(spark, PAGES), range_bytes=range_bytes).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES)


def test_smaller_payloads_are_all_responses(spark):
    got = archived_pages(frame(spark, PAGES), min_bytes=2).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == expected(PAGES, 2)


def test_files_are_ordinary_gzip_members(spark):
    manifest = write_archives(frame(spark, PAGES))
    text = b""
    for row in manifest.collect():
        store, path = warc.open_store(row["path"])
        text += gzip.decompress(store.open_input_file(path).read())
    assert text.count(b"WARC-Type: response\r\n") + text.count(b"WARC-Type: revisit\r\n") == 11
    assert b"\r\nX: y" not in text  # a line break in a url can't add a field


def test_magic_inside_a_member_is_no_record():
    """A member that stores its data as it is may hold the magic, or even half a member."""
    import zlib

    inner = warc.member(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab")
    whole = warc.record(1, "u", "response", "D", len(inner), inner, None)
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = packer.compress(whole) + packer.flush() + warc.member(
        warc.record(2, "u", "response", "D", 1, b"x", None))
    read = lambda at, n: data[at:at + n]
    for cut in range(0, len(data) + 1, 7):
        found = [f["warc-record-id"] for a, b in ((0, cut), (cut, len(data)))
                 for f, _ in warc.records_in(read, a, b)]
        assert found == ["<urn:page:1>", "<urn:page:2>"]


def test_empty_table(spark):
    manifest = write_archives(frame(spark, []))
    assert manifest.count() == 0 and read_archives(spark, manifest).count() == 0
