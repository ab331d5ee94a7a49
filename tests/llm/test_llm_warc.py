from __future__ import annotations

import hashlib
import io
from collections import Counter

import pyarrow as pa
from tests.llm.support import pages

from plumbline.llm import warc
from plumbline.llm.common import shared_folder

BIG = "<p>" + "é" * 600
ROWS = [
    (1, "http://a/", BIG), (2, None, BIG), (9, "http://b/ c", BIG), (9, "http://b/", BIG), (None, "http://n/", BIG), (3, "http://a/", None),
    (4, "", ""), (5, "http://s/", "short"), (6, "http://s/", "short"), (7, "http://x/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 100),
]


def want(rows):
    out, last = [], {}
    for i, _, t in rows:
        body = (t or "").encode()
        if len(body) >= 1000 and i is not None:
            last[body] = max(i, last.get(body, i))
    for i, _, t in rows:
        body = (t or "").encode()
        other = last.get(body)
        revisit = other is not None and other != i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return Counter(out)


def test_round_trip(spark):
    got = warc.round_trip(pages(spark, ROWS)).drop("file", "offset")
    assert Counter(tuple(r) for r in got.collect()) == want(ROWS)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_payloads_come_back(spark):
    folder = shared_folder(spark, "test")
    found = warc.read(warc.write(pages(spark, ROWS), folder), payloads=True)
    assert found.filter("gap is not null").count() == 0
    bodies = Counter(bytes(r.payload) for r in found.filter("record_type = 'response' and page_id in ('7', '3', '5')").collect())
    assert bodies == Counter([(ROWS[9][2]).encode(), b"", b"short"])


def archive(n=6, packed=True):
    parts = []
    for k in range(n):
        body = f"<p>page {k} ".encode() * 80
        data = warc.page_record(k, f"http://h/{k}", body, hashlib.sha1(body).hexdigest(), None)
        parts.append(warc.member(data) if packed else data)
    return parts


def salvaged(data):
    found = list(warc.salvage(pa.BufferReader(data)))
    ids = [f.headers.get("x-page-id", "") for f in found if not f.reason]
    good = [int(i) if i.isascii() and i.isdigit() else None for i in ids]
    gaps = [(f.offset, f.length) for f in found if f.reason]
    at = 0
    for f in found:  # records and gaps cover the file without overlap
        assert f.offset == at
        at += f.length
    assert at == len(data)
    return good, gaps


def test_every_single_damaged_byte_costs_one_record_at_most():
    for packed in (True, False):
        parts = archive(4, packed)
        clean = b"".join(parts)
        starts = [sum(map(len, parts[:k])) for k in range(5)]
        for at in range(0, len(clean), 7 if packed else 41):
            data = bytearray(clean)
            data[at] ^= 0x5A
            good, gaps = salvaged(bytes(data))
            hurt = next(k for k in range(4) if starts[k] <= at < starts[k + 1])
            lost = [k for k in range(4) if k not in good]
            assert lost in ([], [hurt]), (packed, at)
            if lost and (packed or gaps):  # the headers of a plain record have no sum of their own
                assert gaps == [(starts[hurt], starts[hurt + 1] - starts[hurt])]


def test_truncation_noise_and_mixed_forms():
    a, b = archive(3), archive(3, packed=False)
    noise = b"\x1f\x8b\x08 not a member WARC/1.0\r\nno header\r\n\r\n" * 50
    data = a[0] + noise + b[1] + a[2][: len(a[2]) // 2]
    good, gaps = salvaged(data)
    assert good == [0, 1]
    assert gaps == [(len(a[0]), len(noise)), (len(a[0] + noise + b[1]), len(a[2]) // 2)]
    assert salvaged(b"") == ([], [])
    assert salvaged(b"x" * (3 << 20))[1] == [(0, 3 << 20)]


def test_search_finds_starts_across_window_edges():
    body = b"<p>late</p>" * 120
    late = warc.member(warc.page_record(1, "http://h/", body, hashlib.sha1(body).hexdigest(), None))
    for shift in range(-12, 4):
        data = b"x" * (warc.WINDOW // 4 + shift) + late
        assert salvaged(data)[0] == [1]


def test_damaged_archives_in_a_job(spark, tmp_path):
    parts = archive(5)
    hurt = bytearray(b"".join(parts))
    hurt[len(parts[0]) + 30] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(bytes(hurt))
    (tmp_path / "b.warc").write_bytes(b"".join(archive(2, packed=False)))
    (tmp_path / "empty.warc").write_bytes(b"")
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in ("a.warc.gz", "b.warc", "empty.warc")], "file string")
    found = warc.read(files).collect()
    assert Counter(r.file[-6:] for r in found if r.gap is None) == Counter({"arc.gz": 4, "b.warc": 2})
    assert [(r.offset, r.length) for r in found if r.gap] == [(len(parts[0]), len(parts[1]))]
    assert io.BytesIO(bytes(hurt)).read(2) == b"\x1f\x8b"


def test_headers_of_any_size(spark):
    rows = [(1, "http://long/?" + "q" * 200_000, BIG), (2, "data:text/html," + " é" * 50_000, "short"), (3, "http://c/", None)]
    assert Counter(tuple(r) for r in warc.round_trip(pages(spark, rows)).drop("file", "offset").collect()) == want(rows)
    plain = b"".join(warc.page_record(i, u, b"x", hashlib.sha1(b"x").hexdigest(), None) for i, u, _ in rows)
    good, gaps = salvaged(plain)
    assert len(good) == 3 and not gaps


def test_good_records_of_a_member_outlive_a_bad_one():
    parts = [warc.page_record(i, "http://m/", b"body %d" % i, hashlib.sha1(b"body %d" % i).hexdigest(), None) for i in range(4)]
    parts[1] = parts[1].replace(b"body 1", b"BODY 1")
    found = list(warc.salvage(pa.BufferReader(warc.member(b"".join(parts)))))
    assert [f.headers["x-page-id"] for f in found if not f.reason] == ["0", "2", "3"]
    assert [f.reason for f in found if f.reason] == ["wrong block digest"]


def test_sound_records_of_a_damaged_member():
    """One gzip member of 20 records, as of a whole file: a flipped byte or a lost end costs what it hits."""
    bodies = [hashlib.sha256(b"%d" % i).hexdigest().encode() * 40 for i in range(20)]
    plain = [warc.page_record(i, "http://m/", b, hashlib.sha1(b).hexdigest(), None) for i, b in enumerate(bodies)]
    packed = warc.member(b"".join(plain))
    late = warc.member(warc.page_record(99, "http://late/", b"x", hashlib.sha1(b"x").hexdigest(), None))

    def ids(data):
        found = list(warc.salvage(pa.BufferReader(data)))
        return [int(f.headers["x-page-id"]) for f in found if not f.reason], [(f.offset, f.length) for f in found if f.reason], found

    hurt = bytearray(packed)
    hurt[len(hurt) // 2] ^= 0xFF
    got, gaps, found = ids(bytes(hurt) + late)
    assert got[-1] == 99 and set(range(8)) <= set(got) and got == sorted(got)
    assert gaps == [(0, len(packed))] and all(f.length == 0 for f in found[: len(got) - 1])
    assert all(warc.payload_of(f.block) == bodies[int(f.headers["x-page-id"])] for f in found[: len(got) - 1])
    got, gaps, _ = ids(packed[:-10])
    assert got[:19] == list(range(19)) and gaps == [(0, len(packed) - 10)]
    wrong_sum = packed[:-8] + b"\0\0\0\0" + packed[-4:]
    got, gaps, _ = ids(wrong_sum + late)
    assert got == [*range(20), 99] and gaps == [(0, len(packed))]
    unsigned = [p.replace(b"WARC-Block-Digest", b"X-Block-Digest") for p in plain]
    assert ids(warc.member(b"".join(unsigned))[:-10])[0] == []  # nothing vouches for them


def test_revisits_are_resolved(spark, tmp_path):
    digest = hashlib.sha1(BIG.encode()).hexdigest()
    response = warc.member(warc.page_record(9, "http://a/", BIG.encode(), digest, None))
    revisits = [warc.member(warc.page_record(i, "http://b/", BIG.encode(), digest, r)) for i, r in ((1, 9), (2, 9), (3, 8))]
    (tmp_path / "a.warc.gz").write_bytes(b"".join([response, *revisits]))
    got = warc.resolved(warc.read(spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "file string")))
    assert {int(r.page_id): r.response_found for r in got.collect()} == {9: None, 1: True, 2: True, 3: False}
