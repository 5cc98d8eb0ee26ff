"""WARC archives compressed with a dictionary, and their reader.

Each task writes its records to one archive of the shared folder. The first records of an archive are its dictionary's
training set (at most ``TRAIN_BYTES``); the trained Zstandard dictionary stands in a skippable frame at the head of the
file, and every record is a frame of its own, so that records can be read alone. Payloads that occur more than once are
written once: the record with the smallest id is the response, the others are revisits that refer to it.

Tasks write under a new name each time and report it; only names reported by finished tasks are read, so that a lost
executor leaves at most a file that nobody reads.

Defined results: a null payload is an empty one; a null id is written as such and never referred to while another id has
the payload; rows that repeat the smallest id of a payload are all responses; a null url is left out of the record; an
empty table gives no archive and an empty result; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import small_batches, stored
from changeloom.session import shared_dir

# The skippable frame that holds a dictionary, and the head of a trained dictionary.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
TRAIN_BYTES = 4 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def record(page, url: str | None, payload: bytes, refers_to=None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC record: a response with its payload, or a revisit that keeps the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page)}", f"WARC-Date: {date}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        fields += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    fields += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields of a record, its HTTP head and its payload."""
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    head, _, payload = block.partition(b"\r\n\r\n")
    return fields, head, payload


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records, or none where they are too few to learn from."""
    try:
        number = 32768 + zlib.crc32(b"".join(s[:64] for s in samples)) % (1 << 30)
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8)), samples, k=256, d=8, f=18, dict_id=number)
    except (zstandard.ZstdError, ValueError):
        return None


def write_archive(records: Iterator[bytes], sink, level: int = 3) -> tuple[int, int]:
    """Write records to a file: dictionary frame, then a frame per record. Returns records and bytes."""
    first, size = [], 0
    for data in records:
        first.append(data)
        size += len(data)
        if size >= TRAIN_BYTES:
            break
    learned = trained([s[: 128 << 10] for s in first])
    n = written = 0
    if learned is not None:
        raw = learned.as_bytes()
        written += sink.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
    press = zstandard.ZstdCompressor(level=level, dict_data=learned, write_content_size=True, write_checksum=True)
    for part in (first, records):
        for data in part:
            written += sink.write(press.compress(data))
            n += 1
    return n, written


def read_archive(source, step: int = 64 << 10) -> Iterator[bytes]:
    """The records of an archive; it is read in steps, and one record at a time is in memory."""
    head = source.read(8)
    learned = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        learned = zstandard.ZstdCompressionDict(source.read(struct.unpack("<I", head[4:])[0]))
        head = b""
    expand = zstandard.ZstdDecompressor(dict_data=learned)
    rest, frame, parts = head, None, []
    while True:
        rest = rest or source.read(step)
        if not rest:
            break
        frame = frame or expand.decompressobj()
        parts.append(frame.decompress(rest))
        rest = b""
        if frame.eof:
            yield b"".join(parts)
            rest, frame, parts = frame.unused_data, None, []
    if frame is not None:
        raise ValueError("archive ends within a record")


def _store(uri: str):
    """The file system of a folder and the folder's path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` below ``folder``; one row per archive: path, records, bytes."""
    small_batches(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    # Payloads that occur once need no partner: the table of first records holds the repeated ones alone.
    first = (
        keyed.where(F.col("size") >= least_bytes).groupBy("sha", "size")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    decided = keyed.join(first, ["sha", "size"], "left").select("page_id", "url", "payload", refers.alias("refers_to"))

    def run(batches):
        def records():
            for batch in batches:
                for page, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    yield record(page, url, payload, refers_to)

        made = records()
        one = next(made, None)
        if one is None:
            return

        def rest():
            yield one
            yield from made

        fs, base = _store(folder)
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        with fs.open_output_stream(f"{base}/{name}", compression=None) as sink:
            n, size = write_archive(rest(), sink)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], ["name", "records", "bytes"])

    return stored(decided.mapInArrow(run, "name string, records long, bytes long"), "warc-names")


def read(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """Records of the archives: page_id (text), url, payload_bytes, payload_digest, record_type, refers_to (text)."""
    names = archives.select("name")
    names = names.repartition(max(1, names.count()))  # an archive a task

    def run(batches):
        fs, base = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for data in read_archive(source):
                        rows.append(_row(*parse(data)))
                        if len(rows) == 2000:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    return names.mapInArrow(run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def _row(fields: dict[str, str], head: bytes, payload: bytes) -> tuple:
    page = lambda uri: uri[len("<urn:x-page:") : -1] or None
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(next(line for line in head.split(b"\r\n") if line.startswith(b"Content-Length: "))[16:])
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != stated):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is not what was written")
    return page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, stated, fields["WARC-Type"], page(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 6
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` to a new folder of the shared checkpoint folder and read them back."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    kind = pages.schema[id_col].dataType
    found = read(spark, folder, write(pages, folder, id_col, url_col, payload_col, least_bytes))
    return found.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
