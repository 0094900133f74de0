"""Archives: round trips, and what the reader recovers from damaged files."""

import gzip
import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorledger.llm import warc
from motorledger.llm.common import prepared

LONG = "<p>é" + "x" * 200
PAGES = [
    (5, "http://a/1", LONG), (3, "http://a/2 b\r\nWARC-Type: x", LONG), (9, None, LONG), (3, "http://a/3", LONG), (None, "http://a/4", LONG),
    (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", "y" * 100), (None, "u", "y" * 100), (7, "u", "z" * 99), (8, "u", "z" * 99),
    (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9), (-11, "u", "\0\x1f\n" * 50), (12, "u", "\0\x1f\n" * 50),
]


def plain_archive(rows):
    least = {}
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= 100:
            least[html] = min(least.get(html, key), key)
    for key, _, html in rows:
        data, first = (html or "").encode(), least.get(html)
        again = first is not None and (key is None or key > first)
        yield key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None


def read(spark, path):
    rows = warc.read_archives(spark, path).withColumn("page_id", warc.page_of(F.col("record_id"))).withColumn("first", warc.page_of(F.col("refers_to")))
    return rows.collect()


def contents(folder):
    return {f: open(os.path.join(folder, f), "rb").read() for f in sorted(os.listdir(folder)) if f.startswith("part-")}


def test_archives_by_brute_force(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 1, "x") for r in PAGES], "page_id long, url string, html string, size int, digest string")
    path = warc.write_archives(pages.repartition(3), path=f"{tmp_path}/a", per_file=4)
    got = read(spark, path)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"][7:], r["type"], r["first"]) for r in got) == Counter(plain_archive(PAGES))
    for r in got:
        if r["type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"][7:]
    files = contents(path)
    assert len(files) > 3
    for data in files.values():  # any gzip tool reads the file, and a member is a record
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == sum(1 for _ in warc.salvaged(data))


def test_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert read(spark, warc.write_archives(pages, path=f"{tmp_path}/a")) == []
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "empty.warc").write_bytes(b"")
    assert read(spark, f"{tmp_path}/b") == []


def test_records_beyond_16_mib():
    data = warc._member(b"a" * (1 << 24))
    assert data[-1] == 0 and gzip.decompress(data) == b"a" * (1 << 24)
    small = warc._member(warc.record("response", b"<urn:page:1>", None, "d", 1, hashlib.sha256(b"x").hexdigest(), b"x", None))
    assert small[-1] == 0
    found = list(warc.salvaged(small + warc._NOTHING + small))
    assert [f.reason for f in found] == [None, None] and found[1].start == len(small) + len(warc._NOTHING)


def made(n, packed):
    turn, out = np.random.default_rng(n), []
    for i in range(n):
        payload = turn.bytes(int(turn.integers(0, 3000)))
        if i % 5 == 4:  # a page that shows a whole record
            payload += warc.record("response", b"<urn:page:999>", None, "d", 1, hashlib.sha256(b"x").hexdigest(), b"x", None)
        one = warc.record("response", b"<urn:page:%d>" % i, b"u", "d", len(payload), hashlib.sha256(payload).hexdigest(), payload, None)
        out.append(warc._member(one) if packed else one)
    return out


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("kind", ["flip", "cut", "junk", "drop", "swap"])
def test_damage_costs_only_the_damaged_records(packed, kind):
    turn = np.random.default_rng(7)
    for trial in range(40):
        parts = made(12, packed)
        hurt = sorted({int(x) for x in turn.integers(0, 12, 2)})
        whole = [i for i in range(12) if i not in hurt]
        for i in hurt:
            spot = int(turn.integers(0, len(parts[i])))
            part = bytearray(parts[i])
            if kind == "flip":
                part[spot] ^= 1 << int(turn.integers(0, 8))
            elif kind == "cut":
                del part[spot:]
            elif kind == "junk":
                part[spot:spot] = turn.bytes(50)
            elif kind == "drop":
                del part[spot : spot + 20]
            else:
                part[:] = turn.bytes(len(part))
            parts[i] = bytes(part)
        data = b"".join(parts)
        found = list(warc.salvaged(data))
        assert found[0].start == 0 and found[-1].end == len(data)
        assert all(a.end == b.start for a, b in zip(found, found[1:]))  # no byte is lost or told twice
        names = [f.fields["warc-record-id"] for f in found if f.reason is None]
        assert {f"<urn:page:{i}>" for i in whole} <= set(names)
        gaps = [f for f in found if f.reason]
        assert all(a.end < b.start for a, b in zip(gaps, gaps[1:]))
        if kind == "swap":
            assert gaps


def test_a_record_shown_in_a_damaged_page_is_not_taken_for_one():
    """The damaged record's length leads to the next record, so its payload is not searched."""
    parts = made(6, packed=False)
    at = parts[4].index(b"\r\n\r\nHTTP") + 100
    parts[4] = parts[4][:at] + bytes([parts[4][at] ^ 1]) + parts[4][at + 1 :]
    found = list(warc.salvaged(b"".join(parts)))
    assert [f.reason for f in found] == [None] * 4 + ["block digest differs"] + [None]
    assert "<urn:page:999>" not in [f.fields["warc-record-id"] for f in found if f.fields]


def test_gaps_are_rows(spark, tmp_path):
    prepared(spark)
    (tmp_path / "a.warc.gz").write_bytes(b"junk" + b"".join(made(3, True)) + b"tail")
    (tmp_path / "b.warc").write_bytes(b"".join(made(2, False))[:-9])
    got = read(spark, str(tmp_path))
    rows = sorted((r["path"][-9:], r["start"], r["kind"], r["reason"]) for r in got)
    assert [r[2] for r in rows] == ["gap", "record", "record", "record", "gap", "record", "gap"]
    assert rows[0][3] == "no member or version line" and rows[-1][3] == "cut off"


def test_other_records_and_digests():
    sha1 = "TOIJMFQDXJW4UD5XU5VAYVGBX3CJWOE7"  # not that of the block
    text = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: d\r\nWARC-Record-ID: <urn:a>\r\nX: a\r\n b\r\n%sContent-Length: 5\r\n\r\nhello\r\n\r\n"
    fine = text % b""
    assert [f.fields["x"] for f in warc.salvaged(fine)] == ["a b"]
    assert [f.reason for f in warc.salvaged(text % f"WARC-Block-Digest: sha1:{sha1}\r\n".encode() + fine)] == ["block digest differs", None]
    right = b"WARC-Block-Digest: sha1:VL2MMHO4YXUKFWV63YHTWSBM3GXKSQ2N\r\n"
    assert [f.reason for f in warc.salvaged(text % right)] == [None]
