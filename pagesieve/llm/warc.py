"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Archives are real files below a shared folder, written and read inside tasks through Arrow's
file systems. Records with equal payloads are stored once: one response and revisits that refer
to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesieve.llm.common import new_file, open_store, shuffle_partitions, small_batches
from pagesieve.session import new_folder, shared_folder, stored

#: Magic of the skippable frame that holds a dictionary, of a frame, and of a trained dictionary.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
#: Bytes of records after which a task begins its next archive, of a dictionary, and of the records it learns from.
ARCHIVE_BYTES, DICTIONARY_BYTES, LEARN_BYTES = 256 << 20, 16 << 10, 512 << 10
#: Payloads of fewer bytes are always stored. Pieces a group of equal payloads is split into.
REVISIT_BYTES, SALTS = 1000, 32
READ_BYTES = 1 << 20
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("archive", T.StringType()),
    ]
)


class BadArchive(ValueError):
    """An archive that breaks the format, or a record whose header, length or digest is wrong."""


def with_targets(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``; the last is null for what is stored whole.

    Of rows with equal payloads of ``least`` bytes or more the one with the largest page_id is
    stored, the others refer to it; rows that share that page_id too are stored each.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("g_digest"), "target", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("salt") == F.col("g_salt")), "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(NAMESPACE, f'page-{page_id}')}"


def base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: version line, named fields, block. A revisit's block is the HTTP head alone."""
    whole = refers_to is None
    block = HTTP_HEAD + payload if whole else HTTP_HEAD
    fields = [
        ("WARC-Type", "response" if whole else "revisit"),
        ("WARC-Record-ID", f"<{record_id(page_id)}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        # Control characters would end the line; the page's id is a field of its own.
        ("WARC-Target-URI", "".join(c for c in url or "" if c >= " ").strip() or "urn:none"),
        ("WARC-Payload-Digest", base32(digest)),
        ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if not whole:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{record_id(refers_to)}>"),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def decode_record(data: bytes, archive: str = "") -> tuple:
    """A row of ``RECORD``; raises ``BadArchive`` where version, fields, lengths or digests are wrong."""
    end = data.find(b"\r\n\r\n")
    lines = data[: max(end, 0)].decode("utf-8", "replace").split("\r\n")
    if end < 0 or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive(f"{archive}: no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.lower() in fields:
            raise BadArchive(f"{archive}: bad or repeated field {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "x-payload-length"):
        if name not in fields:
            raise BadArchive(f"{archive}: no {name}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit") or (kind == "revisit") != ("warc-refers-to" in fields):
        raise BadArchive(f"{archive}: type {kind}")
    if not fields["content-length"].isdigit() or not fields["x-payload-length"].isdigit():
        raise BadArchive(f"{archive}: a length is no number")
    size, block = int(fields["content-length"]), data[end + 4 : -4]
    if len(block) != size or data[-4:] != b"\r\n\r\n":
        raise BadArchive(f"{archive}: length {size}, found {len(block)}")
    if fields.get("warc-block-digest") not in (None, base32(hashlib.sha1(block).hexdigest())):
        raise BadArchive(f"{archive}: block digest")
    split = block.find(b"\r\n\r\n")
    if split < 0:
        raise BadArchive(f"{archive}: no HTTP head")
    payload, length = block[split + 4 :], int(fields["x-payload-length"])
    if kind == "response" and (len(payload) != length or base32(hashlib.sha1(payload).hexdigest()) != fields["warc-payload-digest"]):
        raise BadArchive(f"{archive}: payload length or digest")
    if kind == "revisit" and payload:
        raise BadArchive(f"{archive}: a revisit has a payload")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    target = fields.get("warc-target-uri")
    return (number("x-page-id"), target, fields["warc-record-id"], kind, number("x-refers-to-page-id"), digest, length, payload if kind == "response" else None, archive)


def learned_dictionary(samples: list[bytes]):
    """A dictionary trained on ``samples``; none where they are too few to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``page_id, url, payload, digest, refers_to``; gives ``archive, records, bytes`` per file.

    Each task learns a dictionary from its first records, at most ``LEARN_BYTES`` of them, and
    begins a new archive after ``ARCHIVE_BYTES`` of records. The list is stored, so it names just
    the files of the attempts that counted.
    """
    small_batches(rows.sparkSession)
    listed = T.StructType([T.StructField("archive", T.StringType()), T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType())])
    names = ("page_id", "url", "payload", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        records = (encode_record(*row) for batch in batches for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True))
        first, size = [], 0
        for record in records:
            first.append(record)
            size += len(record)
            if size >= LEARN_BYTES:
                break
        if not first:
            return
        learned = learned_dictionary(first)
        raw = learned.as_bytes() if learned else b""
        packer = zstandard.ZstdCompressor(level=3, write_checksum=True, **({"dict_data": learned} if learned else {}))
        store, sink, path, count, size, written = None, None, "", 0, 0, []

        def every() -> Iterator[bytes]:
            yield from first
            first.clear()
            yield from records

        for record in every():
            if sink is None:
                store, path = new_file(folder, ".warc.zst")
                sink = store.open_output_stream(path)
                if raw:
                    head = zstandard.ZstdCompressor(level=9).compress(raw)
                    sink.write(struct.pack("<II", SKIPPABLE, len(head)) + head)
                count = size = 0
            sink.write(packer.compress(record))
            count, size = count + 1, size + len(record)
            if size >= ARCHIVE_BYTES:
                sink.close()
                written.append((path, count, size))
                sink = None
        if sink is not None:
            sink.close()
            written.append((path, count, size))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*written, strict=True)], listed.names)

    return stored(rows.select(*names).mapInArrow(write, listed), "archives")


def read_frames(source) -> Iterator[bytes]:
    """Each frame's content, from a stream; the dictionary comes from the leading skippable frame.

    Of the stream one buffer and one frame are held at a time. Skippable frames further on are
    passed over; anything else that is no frame, a frame cut short included, raises ``BadArchive``.
    """
    import zstandard

    held, ended = b"", False

    def more(size: int) -> bool:
        nonlocal held, ended
        while len(held) < size and not ended:
            got = source.read(READ_BYTES)
            held, ended = held + got, not got
        return len(held) >= size

    decoder = zstandard.ZstdDecompressor()
    leading = True
    while more(1):
        if not more(8):
            raise BadArchive("cut short")
        magic, size = struct.unpack_from("<II", held)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not more(8 + size):
                raise BadArchive("a skippable frame is cut short")
            inside, held = held[8 : 8 + size], held[8 + size :]
            if leading and magic == SKIPPABLE:
                if inside[:4] == struct.pack("<I", FRAME):
                    inside = zstandard.ZstdDecompressor().decompressobj().decompress(inside)
                if inside[:4] != struct.pack("<I", DICTIONARY):
                    raise BadArchive("the leading frame holds no dictionary")
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(inside, dict_type=zstandard.DICT_TYPE_FULLDICT))
            leading = False
            continue
        if magic != FRAME:
            raise BadArchive(f"no frame begins here: {magic:08x}")
        leading = False
        frame, parts = decoder.decompressobj(), []
        try:
            while not frame.eof:
                if not held and not more(1):
                    raise BadArchive("a frame is cut short")
                parts.append(frame.decompress(held))
                held = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as error:
            raise BadArchive(str(error)) from error
        yield b"".join(parts)


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the files that the column ``archive`` names, as ``RECORD``.

    ``payload`` is null for revisits, and for all without ``with_payload``; lengths and digests
    are always those of the full payload. Files are dealt out one by one; an empty list gives an
    empty result, a damaged archive fails the job.
    """
    spark = archives.sparkSession
    small_batches(spark)
    root = shared_folder(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], RECORD.names)
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows, size = [], 0
                with open_store(root).open_input_stream(path) as source:
                    for data in read_frames(source):
                        row = decode_record(data, path)
                        rows.append(row if with_payload else (*row[:7], None, path))
                        size += len(data)
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)

    # A given number of partitions: the list is short, the files are not, and one task must not get all.
    return archives.select("archive").repartition(shuffle_partitions(spark), "archive").mapInArrow(read, RECORD)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) to archives in the shared folder; gives their list.

    A null html is an empty payload, a null url ``urn:none``. Other columns are not read. Every
    row is a record, whatever its ``page_id``: of equal payloads of at least ``REVISIT_BYTES`` the
    rows with the largest id are responses (all of them where it repeats), the others, rows
    without id included, revisit it. An empty table writes no archive.
    """
    return write_archives(with_targets(pages), new_folder(pages.sparkSession, "warc"))
