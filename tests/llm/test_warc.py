"""Archives against the pages they were written from, and against a plain reading of the files."""

import gzip
import hashlib
import io
import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rivertally.llm import warc

@pytest.fixture(autouse=True)
def few_tasks(monkeypatch):
    """Many small ranges in few tasks."""
    monkeypatch.setattr(warc, "MOST_TASKS", 4)


SCHEMA = "page_id long, url string, html string, body string, sha1 string, pid long, n_bytes long, original long, payload string"


def html(seed, size):
    rng = random.Random(seed)
    return "".join(rng.choices("abcdefghij <>/é日", k=size))


def page_rows():
    copy, short = html(1, 1500), html(2, 300)
    rows = [
        (1, "http://a.example/1", copy),
        (9, "http://a.example/2 x\r\ny", copy),
        (4, None, copy),
        (5, "u", short),
        (6, "u", short),
        (7, "u", None),
        (8, "", ""),
        (None, "u", copy),
        (None, "n", html(3, 2000)),
        (None, "n", html(3, 2000)),
        (12, "u", "x" * 1000),
        (13, "u", "x" * 1000),
        (14, "u", "x" * 999),
        (15, "u", "x" * 999),
        (16, "u", "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\n\r\n"),
        (17, "é", html(4, 60_000)),
        (18, "r", html(5, 1200)),
        (18, "r", html(5, 1200)),
        (11, "r", html(5, 1200)),
        (20, "k", "é" * 500),
        (21, "k", "é" * 500),
    ]
    return [(i, u, h, "x", "y", 0, 0, 0, "z") for i, u, h in rows]


def expected(rows):
    tops = {}
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        tops.setdefault(data, []).append(-(2**63) if i is None else i)
    out = []
    for i, _, h, *_ in rows:
        data = (h or "").encode()
        top = max(tops[data])
        revisit = len(data) >= 1000 and (-(2**63) if i is None else i) < top
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_report(spark):
    pages = spark.createDataFrame(page_rows(), SCHEMA).repartition(3)
    got = [tuple(r) for r in warc.warc_report(pages).collect()]
    assert sorted(got, key=str) == expected(page_rows())


def test_empty(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.warc_report(pages).count() == 0


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    pages = spark.createDataFrame(page_rows(), SCHEMA).repartition(2)
    folder = str(tmp_path_factory.mktemp("archives") / "a")
    return folder, warc.write_archives(pages, folder, file_bytes=2_000)


def test_files_are_plain_archives(archives):
    """The gzip module reads the files as a whole, and members follow each other without a gap."""
    folder, manifest = archives
    listed = {r.path: r for r in manifest.collect()}
    assert {Path(p).name for p in listed} == {p.name for p in Path(folder).iterdir()} and len(listed) > 2
    total = 0
    for path, row in listed.items():
        data = Path(path).read_bytes()
        assert len(data) == row.n_bytes
        assert gzip.decompress(data).count(b"WARC-Record-ID") == row.n_records + 1
        while data:
            reader = zlib.decompressobj(31)
            assert reader.decompress(data).startswith(b"WARC/1.1\r\n")
            data = reader.unused_data
        total += row.n_records
    assert total == len(page_rows())


@pytest.mark.parametrize("size", [100, 1 << 30])
def test_ranges_of_any_size(spark, archives, size):
    folder, manifest = archives
    files = warc.archive_files(spark, f"{folder}/*.warc.gz")
    assert sorted(r.n_bytes for r in files.collect()) == sorted(r.n_bytes for r in manifest.collect())
    records = warc.read_archives(files, size).where("type <> 'warcinfo'")
    assert records.where("damage IS NOT NULL").count() == 0
    got = [(bytes(r.payload), r.type) for r in warc.with_payloads(records).collect()]
    want = [(h or "").encode() for _, _, h, *_ in page_rows()]
    assert sorted(p for p, _ in got) == sorted(want)
    assert sum(t == "revisit" for _, t in got) == sum(x[3] == "revisit" for x in expected(page_rows()))


def stored(content):
    """A gzip member that holds its content as it is, not compressed."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def record(payload, name):
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\nContent-Type: application/x\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


@pytest.mark.parametrize("size", [50, 5000])
def test_archive_inside_an_archive(spark, tmp_path, size):
    """Members of an archive that is another record's payload are not taken for records, wherever ranges begin."""
    inner = b"".join(stored(record(f"inner {i}".encode() * 9, f"i{i}")) for i in range(12))
    outer = [stored(record(b"first", "o1")), stored(record(inner, "o2")), b"junk", gzip.compress(b""), gzip.compress(record(b"two", "o3") + record(b"in one", "o4")), stored(record(inner, "o5"))]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(outer))
    found = warc.read_archives(warc.archive_files(spark, str(tmp_path / "*.gz")), size)
    assert sorted((r.record_id, len(r.payload)) for r in found.collect()) == [("o1", 5), ("o2", len(inner)), ("o3", 3), ("o4", 6), ("o5", len(inner))]


def test_damage_is_told(spark, tmp_path):
    good = [gzip.compress(record(html(i, 400).encode(), f"g{i}")) for i in range(4)]
    broken = bytearray(good[1])
    broken[-6] ^= 0xFF  # its checksum
    (tmp_path / "x.warc.gz").write_bytes(good[0] + bytes(broken) + good[2] + good[3][:-20])
    wrong_digest = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: d\r\nWARC-Payload-Digest: sha1:" + b"A" * 32 + b"\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "y.warc.gz").write_bytes(gzip.compress(wrong_digest) + gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\n"))
    found = warc.read_archives(warc.archive_files(spark, str(tmp_path / "*.gz")), 100)
    got = {r.record_id: r.damage for r in found.select(F.coalesce("record_id", F.lit("none")).alias("record_id"), "damage").collect()}
    assert got["g0"] is None and got["g2"] is None
    assert all(got[x] for x in ("g1", "g3", "d", "none"))


def test_no_member_in_sight():
    data = bytes(random.Random(1).choices(range(256), k=50_000)) + warc.MAGIC * 300
    from pyarrow import BufferReader

    assert list(warc.members(BufferReader(data), 0, len(data))) == []
    assert list(warc.members(BufferReader(io.BytesIO(b"").getvalue()), 0, 0)) == []
