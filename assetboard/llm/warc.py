"""WARC archives: records with deduplicated payloads written by tasks, and a reader that splits archives.

Writing. Every row becomes one record in a gzip member of its own. Of rows with equal payloads of at least
``least_bytes`` bytes the one with the largest id is a response, the others are revisits of it, which hold no
payload; smaller payloads are all responses. Repeats of the responding row are revisits of it too, and of rows
with the same id the one with the largest url responds. Each task writes archives of its own under fresh names
in the shared folder, through the file systems that Arrow opens (file, hdfs, s3, gs, abfs), and returns a row
for each: only archives in this manifest count, so what a lost or repeated task leaves behind is never read.

Reading. Archives are cut into byte ranges, and a task for each range looks for the first bytes of a gzip
member, takes a candidate for a record when it inflates to a WARC header and its checksum holds, and owns the
records that start inside its range; the last of them is read beyond it. A candidate that fails is passed by
one byte. Members are written so that these first bytes occur nowhere else in them, so no range can start a
record that lies inside another one. A task holds one range and one record.

Null text is an empty payload. Null ids come before all others and return as null. Urls are percent-encoded
where they hold white space, controls or other characters than ASCII; a null url is left out. An empty table
gives no archive and no rows. Columns besides the id, url and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetboard.llm.common import text_bytes
from assetboard.session import land, scratch_path

MAGIC = b"\x1f\x8b\x08"
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 4 << 20
BLOCK = 1 << 18
COPIES_AT_ONCE = 10_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD_FIELDS = ("path string, position long, length long, record_type string, record_id string, refers_to string, "
                 "target_uri string, payload_digest string, payload_bytes long, payload binary")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def gzip_member(raw: bytes) -> bytes:
    """One gzip member whose first three bytes occur nowhere else in it."""
    # Where compression would copy the first bytes from the content as they are, a flush between them parts them.
    pieces = [raw] if MAGIC[:2] not in raw else re.split(rb"(?<=\x1f)(?=\x8b)", raw)
    for level in (6, 9, 5, 8, 4, 7, 3, 2, 1):
        for parts in ([raw], pieces):
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            out = b"".join(packer.compress(p) + packer.flush(zlib.Z_FULL_FLUSH) for p in parts[:-1])
            out += packer.compress(parts[-1]) + packer.flush()
            if out.find(MAGIC, 1) < 0:
                return out
    raise ValueError("no compression without a second member start")


def record(kind: str, record_id: str, url: str | None, digest: str, size: int, refers_to: str | None,
           payload: bytes) -> bytes:
    """The bytes of one record, not compressed."""
    block = HTTP.format(size).encode() + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE),
              ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def plan_records(pages: DataFrame, least_bytes: int, id_column: str, url_column: str, text_column: str) -> DataFrame:
    """(id, url, digest, size, text, of, copy, kind): one row per record; ``of`` is the id of a revisit's response.

    Payloads move once, and copies in one task are one before they do; what else moves are digests and urls.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), text.alias("text"),
                        F.sha1(F.encode(text, "UTF-8")).alias("digest"), text_bytes(text).cast("long").alias("size"))
    none, zero = F.lit(None).cast(pages.schema[id_column].dataType), F.lit(0).cast("long")
    shared = rows.where(F.col("size") >= least_bytes)
    first = shared.groupBy("digest", "size").agg(F.max(F.struct("id", "url", "text")).alias("first"))
    chosen = shared.groupBy("digest").agg(F.max(F.struct("id", "url")).alias("chosen"))
    copies = shared.groupBy("digest", "size", "id", "url").agg(F.count("*").alias("copies")).join(chosen, "digest")
    copies = copies.withColumn(
        "copies", F.col("copies") - F.struct("id", "url").eqNullSafe(F.col("chosen")).cast("long")).where("copies > 0")
    # A page that is repeated very often is dealt out in chunks before each repeat becomes a row.
    chunks = copies.withColumn("low", F.explode(F.sequence(F.lit(1).cast("long"), "copies", F.lit(COPIES_AT_ONCE).cast("long"))))
    later = chunks.repartition("digest", "id", "low").withColumn("copy", F.explode(
        F.sequence("low", F.least("copies", F.col("low") + (COPIES_AT_ONCE - 1)))))
    alone = rows.where(F.col("size") < least_bytes)
    return first.select("first.id", "first.url", "digest", "size", "first.text", none.alias("of"), zero.alias("copy"),
                        F.lit("response").alias("kind")).union(
        later.select("id", "url", "digest", "size", F.lit(None).cast("string"), "chosen.id", "copy",
                     F.lit("revisit"))).union(
        alone.select("id", "url", "digest", "size", "text", none, F.monotonically_increasing_id(), F.lit("response")))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
               text_column: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row to archives in ``folder``; (path, bytes, records) of each archive."""

    def name(identity, digest: str, copy) -> str:
        return f"urn:x-page:{'' if identity is None else quote(str(identity), safe='')}:{digest}:{copy}"

    def run(batches):
        archive = Archive(folder)
        done = []
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                identity, url, digest, size, text, of, copy, kind = (v.as_py() for v in row)
                bare = base64.b32encode(bytes.fromhex(digest)).decode()
                refers = name(of, digest, 0) if kind == "revisit" else None
                archive.add(gzip_member(record(kind, name(identity, digest, copy), url, bare, size, refers,
                                               (text or "").encode())))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = Archive(folder)
        if archive.stream is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))],
                names=["path", "bytes", "records"])

    rows = plan_records(pages, least_bytes, id_column, url_column, text_column)
    return land(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class Archive:
    """One archive that a task writes; it exists once it holds a record."""

    def __init__(self, folder: str):
        self.folder, self.stream, self.size, self.records = folder, None, 0, 0

    def add(self, member: bytes) -> None:
        if self.stream is None:
            self.path = f"{self.folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
            files, path = arrow_fs.FileSystem.from_uri(self.path)
            files.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream = files.open_output_stream(path, compression=None)
        self.stream.write(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        return self.path, self.size, self.records


class Window:
    """A file's bytes from a moving place on, read in blocks."""

    def __init__(self, stream, start: int, size: int):
        self.stream, self.base, self.size, self.held = stream, start, size, bytearray()
        stream.seek(start)

    def more(self) -> bool:
        block = self.stream.read(BLOCK)
        self.held += block
        return bool(block)

    def forget(self, place: int) -> None:
        del self.held[: place - self.base]
        self.base = place


def inflate(window: Window, start: int) -> tuple[bytes, int] | None:
    """Content and end of the member at ``start``, or None where no whole WARC record starts."""
    unpacker, at, out = zlib.decompressobj(31), start, []
    known = 0
    try:
        while not unpacker.eof:
            if at - window.base >= len(window.held) and not window.more():
                return None
            chunk = bytes(window.held[at - window.base: at - window.base + BLOCK])
            at += len(chunk)
            out.append(unpacker.decompress(chunk))
            known += len(out[-1])
            if known >= 5 > known - len(out[-1]) and not b"".join(out).startswith(b"WARC/"):
                return None  # a candidate is given up by its first bytes
    except zlib.error:
        return None
    whole = b"".join(out)
    return (whole, at - len(unpacker.unused_data)) if whole.startswith(b"WARC/") else None


def parse(whole: bytes) -> tuple | None:
    """(type, record id, refers to, target, digest, payload bytes, payload) of a record; None where it is none.

    Digest and size are those of the payload where the record has one, else as its headers tell.
    """
    head, found, rest = whole.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    if not found or not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    length = int(fields["content-length"])
    if len(rest) < length:
        return None
    block, bare = rest[:length], lambda name: fields.get(name, "").strip("<>") or None
    http = block.startswith(b"HTTP/")
    answer, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    told = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    if fields["warc-type"] == "revisit":
        size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", answer)
        return "revisit", bare("warc-record-id"), bare("warc-refers-to"), bare("warc-target-uri"), told, \
            int(size[1]) if size else None, None
    digest = base32_sha1(payload)
    if told not in (None, digest):
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not have the digest {told}")
    return fields["warc-type"], bare("warc-record-id"), bare("warc-refers-to"), bare("warc-target-uri"), digest, \
        len(payload), payload


def records_of(path: str, start: int, stop: int):
    """The records that start in the bytes [start, stop) of an archive: (place, length, *parse)."""
    files, inner = arrow_fs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as stream:
        window, place = Window(stream, start, stop - start), start
        while place < stop:
            window.forget(place)
            at = window.held.find(MAGIC)
            while at < 0:
                place = max(place, window.base + len(window.held) - len(MAGIC) + 1)
                if place >= stop:
                    return
                window.forget(place)
                if not window.more():
                    return
                at = window.held.find(MAGIC)
            place = window.base + at
            if place >= stop:
                return
            found = inflate(window, place)
            some = parse(found[0]) if found else None
            if some is None:
                place += 1
                continue
            yield place, found[1] - place, *some
            place = found[1]


def splits(archives: DataFrame, split_bytes: int) -> DataFrame:
    """(path, start, stop) of the byte ranges of archives (path, bytes), spread over tasks."""
    step = F.lit(split_bytes).cast("long")
    cuts = archives.where("bytes > 0").select("path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("start"))
    cuts = cuts.select("path", "start", F.least(F.col("start") + step, "bytes").alias("stop"))
    total = archives.agg(F.sum(F.ceil(F.col("bytes") / step))).first()[0] or 1
    return cuts.repartition(max(1, min(int(total), 1 << 16)), "path", "start")


def read_warc(archives: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """One row per record of archives (path, bytes), as ``RECORD_FIELDS`` names them."""
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORD_FIELDS.split(", ")]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for path, start, stop in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for place, length, *some in records_of(path, start, stop):
                    if not with_payload:
                        some[-1] = None
                    held.append((path, place, length, *some))
                    size += 200 + len(some[-1] or b"")
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return splits(archives, split_bytes).mapInArrow(run, RECORD_FIELDS)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the files of a folder that Spark can list, for archives that others wrote."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def page_records(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
                 text_column: str = "html", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives and read them back: what each record says of its page."""
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_warc(pages, folder, least_bytes, id_column, url_column, text_column)
    read = read_warc(archives, split_bytes, with_payload=False)
    kind = pages.schema[id_column].dataType

    def identity(urn: str):
        part = F.element_at(F.split(urn, ":"), 3)
        return F.when(part != "", F.url_decode(part)).cast(kind)

    return read.select(identity("record_id").alias(id_column), "payload_bytes", "payload_digest", "record_type",
                       identity("refers_to").alias("refers_to"), "target_uri", "path", "position", "length")
