import base64
import hashlib

import pytest

from llm import warc

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, "http://a/3", "<p>sämé 東</p>"), (4, "http://a/4", ""), (5, "http://a/5", None),
    (6, None, "x" * 300_000), (7, "http://a/7\r\nInjected: yes", "tail\r\n\r\nWARC/1.1\r\n"), (8, "http://a/8", "twice"), (8, "http://a/8", "twice"), (None, "http://a/9", "<p>same</p>"),
]


def table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id bigint, url string, html string, address int, header string")


@pytest.fixture(scope="module")
def archive(spark):
    return warc.write(table(spark))


def test_records_read_back(archive):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(archive).collect()), key=repr)
    expected = []
    for number, (page, _, html) in enumerate(PAGES):
        data = (html or "").encode()
        holder = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        first = page == holder and page is not None and not any(p == page and (h or "") == (html or "") for p, _, h in PAGES[number + 1 :])
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "response" if first else "revisit", None if first else holder))
    assert got == sorted(expected, key=repr)


def test_each_payload_is_stored_once(archive):
    stored = [bytes(r.payload) for r in archive.payloads.collect()]
    assert len(stored) == len(set(stored)) == len({(h or "") for _, _, h in PAGES})


def test_original_records_come_back(archive):
    for r in warc.reconstruct(archive).collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and b"\nInjected" not in head
        assert body in {(h or "").encode() for p, _, h in PAGES if p == r.page_id}


def test_exported_file_has_lengths_that_fit(spark, archive, tmp_path):
    warc.export(archive, f"file://{tmp_path}/out")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    seen = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        length = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert rest[length : length + 4] == b"\r\n\r\n"
        data, seen = rest[length + 4 :], seen + 1
    assert seen == len(PAGES)


def test_small_payloads_are_never_revisits(spark):
    got = {(r.page_id, r.record_type) for r in warc.read(warc.write(table(spark), min_bytes=100)).collect()}
    assert {kind for _, kind in got} == {"response"}


def test_wrong_bytes_are_found(spark, archive, tmp_path):
    from pyspark.sql import functions as F

    broken = warc.write(table(spark))
    bad = broken.payloads.withColumn("payload", F.when(F.length("payload") == 5, F.lit(b"other")).otherwise(F.col("payload")))
    bad.write.parquet(f"{tmp_path}/p/payloads")
    broken.headers.write.parquet(f"{tmp_path}/p/headers")
    with pytest.raises(Exception, match="does not match its address"):
        warc.read(warc.Archive(spark, f"{tmp_path}/p")).collect()


def test_urls_cannot_write_header_fields(spark):
    """Line ends go, and other line separators stay inside the url's own field."""
    urls = ["http://a/\u2028WARC-Refers-To: <urn:page:77#0>", "http://a/\u0085WARC-Payload-Digest: sha1:AAAA", "http://a/\u2029WARC-Type: revisit", "http://a/\r\nWARC-Type: revisit", "http://a/\rWARC-Type: revisit"]
    made = warc.write(table(spark, [(k, url, f"text {k}") for k, url in enumerate(urls)]))
    assert {(r.record_type, r.refers_to) for r in warc.read(made).collect()} == {("response", None)}
    assert sorted(bytes(r.record).partition(b"\r\n\r\n")[2] for r in warc.reconstruct(made).collect()) == [f"text {k}".encode() for k in range(5)]


def test_records_have_the_fields_that_the_format_demands(archive):
    heads = [r.header.split("\r\n") for r in archive.headers.collect()]
    names = [[line.partition(":")[0] for line in head[1:-1]] for head in heads]
    must = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"}
    assert all(must <= set(n) and len(n) == len(set(n)) for n in names)
    assert all(("WARC-Profile" in n and "WARC-Refers-To" in n) == any("revisit" in line for line in head[:2]) for n, head in zip(names, heads))
    ids = [line for head in heads for line in head if line.startswith("WARC-Record-ID")]
    assert len(ids) == len(set(ids))
    targets = {line.partition(": ")[2] for head in heads for line in head if line.startswith("WARC-Refers-To")}
    assert targets <= {line.partition(": ")[2] for line in ids}


def test_empty_table(spark):
    assert warc.read(warc.write(table(spark, []))).count() == 0
