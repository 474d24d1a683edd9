"""WARC archives: pages written as compressed records, and archives read back by byte ranges.

Writing: one gzip member per record. Of the pages with equal payloads of ``least`` bytes or more, the one with the largest
identifier is written as ``response``; the others are ``revisit`` records that refer to it and hold no payload. Each task writes files of
its own, under names of their own, and returns a manifest; files that a lost or repeated task left are in no manifest and never read.

Reading: a file is cut into byte ranges, each read by a task on its own. The task looks for the gzip magic, takes a place for a member
only if it decodes to the head of a record, and owns the members that start inside its range, however far past it they go. Inside a
payload that is itself an archive, places can pass this test though they are no members of the file; so the first pass notes where each
range's members start and stop, and a range whose first member starts before an earlier range's last one stops is
scanned again from that stop. The records are then read from starts that are known to be right.

A missing page text is an empty payload. Rows that repeat an identifier are records of their own; all rows that hold a group's largest
identifier are responses. A missing identifier counts as the smallest, and comes back as missing. An empty table gives no files and no
rows. Other columns of the table don't matter. A record must fit into a row (2 GB).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivertally.llm.common import NO_ID, known_id
from rivertally.session import durable, new_folder

LEAST = 1000  # bytes of a payload that may be replaced by a revisit record
RANGE = 32 << 20  # bytes of an archive that one task scans
FILE = 1 << 30  # bytes after which a task begins another file
READ = 1 << 20
BATCH = 8 << 20
MOST_TASKS = 20_000

# Fixed values of the formats: gzip members that use deflate, and the record that stands for an equal payload.
MAGIC = b"\x1f\x8b\x08"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_FIELD = "X-Page-ID"
REFERS_FIELD = "X-Refers-To-Page-ID"

RECORDS = (
    "path string, offset long, type string, record_id string, uri string, refers_to string, fields map<string,string>, "
    "n_bytes long, sha1 string, payload binary, damage string"
)


# ----- writing --------------------------------------------------------------------------------------------
def with_originals(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pid`` (see ``known_id``), ``url``, ``body``, ``sha1``, ``n_bytes`` and ``original``: the page that holds an equal payload, if it's another one.

    Groups of equal payloads are counted before they are shuffled, and joined back by digest, which Spark can split.
    """
    body = F.coalesce(pages["html"].cast("binary"), F.lit(b""))
    rows = pages.select(known_id(pages["page_id"]).alias("pid"), F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumns({"sha1": F.sha1("body"), "n_bytes": F.length("body").cast("long")})
    # SHA-1 alone can be made to collide; the second hash tells such payloads apart.
    rows = rows.withColumn("other", F.xxhash64("body"))
    key = ["sha1", "other", "n_bytes"]
    groups = rows.where(F.col("n_bytes") >= least).groupBy(*key).agg(F.max("pid").alias("top"), F.min("pid").alias("low"))
    found = rows.join(groups.where("low < top").drop("low"), key, "left")
    return found.select("pid", "url", "body", "sha1", "n_bytes", F.when(F.col("pid") < F.col("top"), F.col("top")).alias("original"))


def _record_id(pid: int, sha1: str) -> str:
    return f"<{uuid.UUID(hashlib.md5(f'{pid}/{sha1}'.encode()).hexdigest()).urn}>"


def _plain(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "replace")) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _page_member(pid: int, url: str, body: bytes, sha1: str, n_bytes: int, original: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", _record_id(pid, sha1)),
        ("WARC-Target-URI", _plain(url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if pid != NO_ID:
        fields.append((PAGE_FIELD, str(pid)))
    if original is None:
        return _member(fields, http + body)
    fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _record_id(original, sha1)), (REFERS_FIELD, str(original))]
    return _member(fields, http)


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, file_bytes: int = FILE, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` as archives below ``folder``, which all executors share; returns the manifest: ``path``, ``n_bytes``, ``n_records``.

    ``folder`` is a path or URI that Arrow's file systems open (local, HDFS, S3, GCS).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        done, out, path, size, count = [], None, "", 0, 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((f"{folder}/{path}", size, count))
                out = None

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                    head = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(head)
                    size, count = len(head), 0
                member = _page_member(*row, date)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    close()
        close()
        names, sizes, counts = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["path", "n_bytes", "n_records"])

    return durable(with_originals(pages, least).mapInArrow(write, "path string, n_bytes long, n_records long"))


def archive_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``path`` and ``n_bytes`` of all files that match, for archives made elsewhere. Only the listing is read."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("n_bytes"))


# ----- members of a byte range ----------------------------------------------------------------------------------
def _decoded(file: pa.NativeFile, at: int) -> tuple[bytes | None, int, str | None]:
    """What the member at ``at`` holds, where it stops, and what is wrong with it.

    None for the bytes means that no record starts there.
    """
    reader, parts, place, step = zlib.decompressobj(31), [], at, 4096
    try:
        while not reader.eof:
            data = file.read_at(step, place)
            if not data:
                break
            place += len(data)
            if step != 4096:
                parts.append(reader.decompress(data))
            else:
                # In small steps, so that a fault doesn't take the record's head along.
                for i in range(0, len(data), 64):
                    parts.append(reader.decompress(data[i : i + 64]) if not reader.eof else b"")
                    if reader.eof:
                        place += i + len(data[i : i + 64]) - len(data)
                        break
                start = b"".join(parts)
                if start[:5] != b"WARC/"[: len(start)] or (not start and not reader.eof):
                    return None, at, None
                step = READ
        whole = b"".join(parts)
        if reader.eof:
            return whole, place - len(reader.unused_data), None
        return (whole, place, "cut short") if whole[:5] == b"WARC/" else (None, at, None)
    except zlib.error as error:
        whole = b"".join(parts)
        return (whole, at, str(error)) if whole[:5] == b"WARC/" else (None, at, None)


def members(file: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[int, int, bytes, str | None]]:
    """Offset, stop, content and damage of the members that start in [begin, end), each looked for where the one before stops.

    After a damaged member the search goes on behind its magic.
    """
    at = begin
    while at < end:
        window = file.read_at(min(READ, end - at) + len(MAGIC) - 1, at)
        place = window.find(MAGIC)
        if place < 0 or at + place >= end:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += place
        content, stop, damage = _decoded(file, at)
        if content is None:
            at += 1
            continue
        if content:
            yield at, stop, content, damage
        at = stop if damage is None else at + 1


def _parsed(content: bytes, damage: str | None) -> Iterator[tuple]:
    """The records of a member, as the columns of ``RECORDS`` after the offset."""
    at = 0
    while at < len(content):
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0:
            yield (None, None, None, None, {}, None, None, None, damage or "no end of the record's head")
            return
        lines = content[at:stop].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        known = {k.lower(): v for k, v in fields.items()}
        length = known.get("content-length", "")
        size = int(length) if length.isascii() and length.isdigit() else None
        wrong = damage
        if size is None or not lines[0].startswith("WARC/"):
            size, wrong = len(content) - stop - 4, wrong or "no usable head"
        block = content[stop + 4 : stop + 4 + size]
        if len(block) < size:
            wrong = wrong or "block cut short"
        kind, payload, n_bytes, sha1 = known.get("warc-type"), block, len(block), None
        if known.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
            n_bytes = len(payload)
        declared = known.get("warc-payload-digest", "")
        if declared.lower().startswith("sha1:"):
            value = declared[5:]
            try:
                sha1 = bytes.fromhex(value).hex() if len(value) == 40 else base64.b32decode(value.upper()).hex()
            except ValueError:
                wrong = wrong or "digest can't be read"
        if kind == "revisit":
            told = [line[15:].strip() for line in block.decode("latin-1").split("\r\n") if line[:15].lower() == "content-length:"]
            n_bytes = int(told[0]) if told and told[0].isascii() and told[0].isdigit() else None
            payload = None
        else:
            computed = hashlib.sha1(payload).hexdigest()
            if sha1 not in (None, computed):
                wrong = wrong or "payload and digest differ"
            sha1 = computed
        yield (kind, known.get("warc-record-id"), known.get("warc-target-uri"), known.get("warc-refers-to"), fields, n_bytes, sha1, payload, wrong)
        at = stop + 4 + size
        while content[at : at + 2] == b"\r\n":
            at += 2


# ----- reading ----------------------------------------------------------------------------------------------------------
def _opened(path: str) -> pa.NativeFile:
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _tasks(ranges: DataFrame, count: int) -> DataFrame:
    """Ranges, one for a task as far as that is sensible."""
    return ranges.repartition(max(1, min(count, MOST_TASKS)), "path", "begin")


def _indexed(ranges: DataFrame, count: int) -> DataFrame:
    """Where the members of every range start and stop, one row per range that has any."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first = last = None
                with _opened(row["path"]) as file:
                    for offset, stop, _, _ in members(file, row["start"], row["end"]):
                        first, last = offset if first is None else first, max(last or 0, stop)
                if first is not None:
                    yield pa.RecordBatch.from_pylist([{"path": row["path"], "begin": row["begin"], "first": first, "last": last}])

    return durable(_tasks(ranges.where("start < end"), count).mapInArrow(scan, "path string, begin long, first long, last long"))


def known_starts(files: DataFrame, range_bytes: int = RANGE) -> tuple[DataFrame, int]:
    """``path``, ``begin``, ``end`` and ``start`` of every range, and their number.

    ``start`` is where the range's own first member is to be looked for: its begin, or where a member of an earlier range
    stops.
    """
    step = F.lit(range_bytes).cast("long")
    cut = files.where("n_bytes > 0").select(
        "path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, step)).alias("begin")
    )
    ranges = durable(cut.select("path", "begin", F.least(F.col("begin") + step, "n_bytes").alias("end"), F.col("begin").alias("start")))
    count = ranges.count()
    found = _indexed(ranges, count)
    # A file has one row per range here.
    earlier = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        reached = ranges.join(found, ["path", "begin"], "left").withColumn("reached", F.max("last").over(earlier))
        wrong = durable(reached.where("first < reached").select("path", "begin", "end", F.col("reached").alias("start")))
        again = wrong.count()
        if not again:
            return ranges, count
        mended = wrong.select("path", "begin", F.col("start").alias("_start"))
        ranges = durable(ranges.join(mended, ["path", "begin"], "left").withColumn("start", F.coalesce("_start", "start")).drop("_start"))
        found = durable(found.join(wrong, ["path", "begin"], "left_anti").unionByName(_indexed(wrong, again)))


def read_archives(files: DataFrame, range_bytes: int = RANGE, payloads: bool = True) -> DataFrame:
    """Every record of the archives, with the columns of ``RECORDS``.

    ``files`` holds ``path`` and ``n_bytes`` (a manifest, or ``archive_files``). ``n_bytes`` and ``sha1`` of the result are the
    payload's; for revisits, those of the payload they stand for. ``damage`` tells what is wrong with a record (a
    digest that doesn't fit, a member that ends early), so that none is lost in silence. ``payloads`` false leaves the payload column empty.
    """
    ranges, count = known_starts(files, range_bytes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "offset", "type", "record_id", "uri", "refers_to", "fields", "n_bytes", "sha1", "payload", "damage"]
        text, number = pa.string(), pa.int64()
        kinds = [text, number, text, text, text, text, pa.map_(text, text), number, text, pa.binary(), text]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            columns[6] = [list(x.items()) for x in columns[6]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                with _opened(row["path"]) as file:
                    for offset, _, content, damage in members(file, row["start"], row["end"]):
                        for record in _parsed(content, damage):
                            kept = record if payloads else (*record[:7], None, record[8])
                            rows.append((row["path"], offset, *kept))
                            held += 500 + len(kept[7] or b"")
                            if held > BATCH:
                                yield made(rows)
                                rows, held = [], 0
                if rows:
                    yield made(rows)

    return _tasks(ranges.where("start < end"), count).mapInArrow(read, RECORDS)


def with_payloads(records: DataFrame) -> DataFrame:
    """Revisits with the payload of the response that they refer to; the rest as it is."""
    held = records.where("type = 'response'").groupBy(F.col("record_id").alias("_id")).agg(F.first("payload").alias("_payload"))
    again = records.where("type = 'revisit'").join(held, F.col("refers_to") == F.col("_id"), "left")
    filled = again.withColumn("payload", F.coalesce("payload", "_payload")).drop("_id", "_payload")
    return records.where("type IS NULL OR type <> 'revisit'").unionByName(filled)


def warc_report(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back, and tell each page's payload and record."""
    files = write_archives(pages, new_folder(pages.sparkSession, "archives"))
    records = read_archives(files, payloads=False).where("type IN ('response', 'revisit')")

    def page(field: str):
        return F.col("fields")[field].cast("long")

    return records.select(
        page(PAGE_FIELD).alias("page_id"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        F.col("type").alias("record_type"),
        page(REFERS_FIELD).alias("refers_to"),
    )
