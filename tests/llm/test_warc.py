import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import pytest

from assetboard.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, size string, copy string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def expected(rows, least_bytes=0):
    """Of equal payloads the largest (id, url) responds, and everything else revisits it."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    out, responded = Counter(), set()
    for r in sorted(rows, key=order, reverse=True):
        text = r[2] or ""
        size = len(text.encode())
        top = max((x for x in rows if (x[2] or "") == text), key=order)
        first = size < least_bytes or text not in responded
        responded.add(text)
        out[(r[0], size, digest(text), "response" if first else "revisit", None if first else top[0])] += 1
    return out


def got(rows):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)


def odd_rows():
    rng = random.Random(3)
    inner = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n").decode("latin-1")
    texts = ["", None, "x", "é" * 50, inner * 3, "\x1f\x8b\x08" * 2000, "WARC/1.1\r\n\r\n" * 9,
             "".join(chr(rng.randrange(32, 0x2000)) for _ in range(60_000))]
    rows = [(i, f"http://a b/é{i}" if i % 3 else None, rng.choice(texts)) for i in range(60)]
    return rows + [(None, "u", "x"), (None, None, None), rows[4], rows[4], (4, "other", rows[4][2]), (-7, "u:9", "only")]


@pytest.mark.parametrize("split", [700, 40_000, 1 << 22])
def test_every_record_comes_back_once(spark, split):
    rows = odd_rows()
    assert got(warc.page_records(pages(spark, rows), split_bytes=split).collect()) == expected(rows)


def test_small_payloads_are_never_revisits(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    assert got(warc.page_records(pages(spark, rows), least_bytes=3).collect()) == expected(rows, 3)


def test_archives_are_gzip_of_whole_records_with_payloads(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"text {i}" * 100) for i in range(30)]
    archives = warc.write_warc(pages(spark, rows), str(tmp_path / "out"), archive_bytes=2000)
    assert sum(a.records for a in archives.collect()) == 30
    for a in archives.collect():
        raw = open(a.path, "rb").read()
        assert len(raw) == a.bytes and raw.count(warc.MAGIC) == a.records
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == a.records
    read = warc.read_warc(archives, 500).collect()
    assert {r.target_uri: r.payload.decode() for r in read} == {u: t for _, u, t in rows}


def test_a_changed_payload_is_noticed_and_broken_members_are_passed(tmp_path):
    good = warc.gzip_member(warc.record("response", "urn:x:1", None, warc.base32_sha1(b"abc"), 3, None, b"abc"))
    wrong = warc.gzip_member(warc.record("response", "urn:x:2", None, warc.base32_sha1(b"abd"), 3, None, b"abc"))
    (tmp_path / "a").write_bytes(warc.MAGIC + b"junk" + good[:-3] + warc.MAGIC + good)
    found = list(warc.records_of(str(tmp_path / "a"), 0, 1 << 20))
    assert [f[3] for f in found] == ["urn:x:1"]
    (tmp_path / "b").write_bytes(wrong)
    with pytest.raises(ValueError):
        list(warc.records_of(str(tmp_path / "b"), 0, 1 << 20))


def test_members_hold_their_first_bytes_once():
    rng = random.Random(5)
    for raw in (warc.MAGIC * 500, bytes(rng.randrange(256) for _ in range(20_000)) + warc.MAGIC, b""):
        member = warc.gzip_member(raw)
        assert member.find(warc.MAGIC, 1) < 0 and gzip.GzipFile(fileobj=io.BytesIO(member)).read() == raw


def test_empty_table(spark):
    assert warc.page_records(pages(spark, [(1, "u", "x")]).limit(0)).collect() == []


def test_archives_of_others_are_listed(spark, tmp_path):
    member = warc.gzip_member(warc.record("response", "urn:x:1", "http://h/", warc.base32_sha1(b"abc"), 3, None, b"abc"))
    (tmp_path / "a.warc.gz").write_bytes(member * 3)
    read = warc.read_warc(warc.archives_in(spark, str(tmp_path)), 100).collect()
    assert [(r.position, r.length, bytes(r.payload)) for r in sorted(read, key=lambda r: r.position)] == [
        (i * len(member), len(member), b"abc") for i in range(3)]
