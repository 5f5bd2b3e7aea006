"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a skippable frame at the beginning.

`write` makes archives of at most about `file_bytes` of records in a folder that all executors share and returns the list of its files.
File names carry the task attempt, and `read` opens the listed files alone, so what an attempt that was lost or ran twice left behind in
the folder is never read; store the list (Spark commits one attempt per task) before reading. Payloads of at least `least` bytes that occur more than once are stored once, in the
record with the largest page_id; the others are revisits of it. Only a digest and an id per payload are grouped for that.

The reader checks the dictionary frame, the record version, the header fields it needs, the block length and its digest, the length in
the HTTP header and the payload digest, and raises ValueError where one is wrong.

Defined results: null html is an empty payload, a null url leaves its header out, a null page_id is never the largest (without another
id all copies are responses); repeated rows with the largest id are all responses; other columns are ignored; an empty table gives an
empty folder and no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabulens.llm.common import batches_of

DICTIONARY_MAGIC, FRAME_MAGIC, SKIPPABLE = 0x184D2A5D, 0xFD2FB528, range(0x184D2A50, 0x184D2A60)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "<urn:page:{}>"
DICTIONARY_BYTES = 1 << 15
#: Bytes of records a file's dictionary is trained on.
SAMPLE_BYTES = 1 << 20
LONGEST_HEADER = 1 << 16


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit has only the HTTP header as its block."""
    digest = hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    fields += [("WARC-Record-ID", ID.format("" if page_id is None else page_id))]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if revisit:
        fields += [("WARC-Refers-To", ID.format(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The file of these records."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r)
        size += len(r)
    try:
        data = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:  # too few or too small records to train on
        data = b"".join(sample)[:DICTIONARY_BYTES]
    compressor = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(data))
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data + b"".join(compressor.compress(r) for r in records)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO if data else zstandard.DICT_TYPE_RAWCONTENT)


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each frame, decoded with the dictionary of the first; other skippable frames are passed over."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    size = struct.unpack_from("<I", data, 4)[0]
    raw, at = data[8 : 8 + size], 8 + size
    if len(raw) < size:
        raise ValueError("short dictionary frame")
    if raw[:4] == struct.pack("<I", FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
    view = memoryview(data)
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("short frame")
        if struct.unpack_from("<I", data, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        one = decoder.decompressobj()
        try:
            # a window that grows until the frame ends in it: a frame is seldom longer than the first
            window, out, begin = 1 << 16, [], at
            while not one.eof and at < len(data):
                out.append(one.decompress(view[at : at + window]))
                at = min(at + window, len(data))
        except zstandard.ZstdError as error:
            raise ValueError(f"bad frame at byte {begin}: {error}") from error
        if not one.eof:
            raise ValueError("short frame")
        at -= len(one.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """(header fields in lower case, payload, payload length) of one record, checked."""
    cut = data.find(b"\r\n\r\n", 0, LONGEST_HEADER)
    lines = data[: max(cut, 0)].split(b"\r\n")
    if cut < 0 or lines[0] != VERSION:
        raise ValueError("no record header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or name != name.strip() or name.lower() in fields:
            raise ValueError(f"bad header line {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit() or len(data) != cut + 4 + int(fields["content-length"]) + 4 or data[-4:] != b"\r\n\r\n":
        raise ValueError("wrong record length")
    block = data[cut + 4 : -4]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
        raise ValueError("wrong block digest")
    end = block.find(b"\r\n\r\n")
    length = [x.partition(b":")[2].strip() for x in block[: max(end, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if end < 0 or len(length) != 1 or not length[0].isdigit():
        raise ValueError("no HTTP header")
    payload = block[end + 4 :]
    if fields["warc-type"] == "revisit":
        if payload or "warc-refers-to" not in fields or "warc-payload-digest" not in fields:
            raise ValueError("bad revisit")
    elif fields["warc-type"] != "response":
        raise ValueError(f"unexpected record type {fields['warc-type']}")
    elif len(payload) != int(length[0]) or fields.get("warc-payload-digest") != f"sha1:{hashlib.sha1(payload).hexdigest()}":
        raise ValueError("wrong payload length or digest")
    return fields, payload, int(length[0])


def write(pages: DataFrame, folder: str, least: int = 1000, file_bytes: int = 8 << 20) -> DataFrame:
    """Write all pages and return (file, records, bytes) of what was written."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.when(F.octet_length("payload") >= least, F.sha1("payload")))
    firsts = rows.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first_id")
    refers = F.when(F.col("first_id") != F.coalesce("page_id", F.col("first_id") - 1), F.col("first_id"))
    # small payloads have no digest; each gets a key of its own, so that they don't meet in one task
    keyed = rows.withColumn("digest", F.coalesce("digest", F.concat(F.lit("page "), F.coalesce("page_id", F.octet_length("payload")))))
    joined = keyed.join(firsts, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        context, files, held, size = TaskContext.get(), 0, [], 0
        attempt = f"{context.partitionId():06d}-{context.taskAttemptId()}"

        def flush():
            nonlocal files, held, size
            name = f"part-{attempt}-{files:05d}.warc.zst"
            data = archive(held)
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64()), pa.array([len(data)], pa.int64())], ["file", "records", "bytes"])
            files, held, size = files + 1, [], 0
            return row

        for batch in batches_of(batches):
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.append(record(*row))
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    return joined.mapInArrow(run, "file string, records long, bytes long")


def _number(field: str | None) -> int | None:
    text = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def read(written: DataFrame, folder: str, with_payload: bool = False, task_bytes: int = 32 << 20) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record, and the payload itself on demand.

    `written` lists the files as (file, records, bytes), as `write` does; a file with another number of records raises ValueError. The list
    is dealt over tasks of about `task_bytes` each.
    """
    total = written.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    files = written.select("file", "records").repartition(1 + total // task_bytes, "file")

    def run(batches):
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * with_payload
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * with_payload
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, seen = [], 0, 0
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    content = stream.read()
                for data in frames(content):
                    seen += 1
                    fields, payload, length = parse(data)
                    row = (_number(fields["warc-record-id"]), length, fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"], _number(fields.get("warc-refers-to")), fields.get("warc-target-uri"))
                    rows.append(row + (payload,) * with_payload)
                    size += len(payload) * with_payload
                    if size >= 8 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{name}: {seen} records instead of {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload)
