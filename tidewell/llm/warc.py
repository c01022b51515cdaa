"""WARC archives compressed record by record with a shared Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.storage import new_path, ship, some_rows, stored

# Fixed values of the format: skippable frame that holds the dictionary, frame of a record,
# frame of a dictionary, version line, profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on so many pages at most, and has so many bytes.
SAMPLE, DICTIONARY_BYTES = 1_000, 64 << 10
DATE = "2024-01-01T00:00:00Z"

_RECORD = (
    "page_id long, record_id string, record_type string, url string, payload_bytes long, "
    "payload_digest string, refers_to_id string"
)


class ArchiveError(ValueError):
    """An archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(samples: list[bytes]) -> bytes:
    """A dictionary from samples of payloads; without enough of them, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n"


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == DICTIONARY_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


class Writer:
    """Archive bytes: the dictionary in a leading skippable frame, then a frame a record."""

    def __init__(self, dictionary: bytes):
        held = zstandard.ZstdCompressor().compress(dictionary)
        self._frames = zstandard.ZstdCompressor(
            level=3, dict_data=_dictionary(dictionary), write_checksum=True, write_content_size=True
        )
        self._out = io.BytesIO()
        self._out.write(struct.pack("<II", DICTIONARY_FRAME, len(held)) + held)

    def add(self, headers: list[tuple[str, str]], block: bytes) -> None:
        head = [VERSION, *(f"{name}: {value}".encode() for name, value in headers)]
        head.append(b"Content-Length: %d" % len(block))
        self._out.write(self._frames.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"))

    def __len__(self) -> int:
        return self._out.tell()

    def bytes(self) -> bytes:
        return self._out.getvalue()


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes


def _record(raw: bytes) -> Record:
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/1."):
        raise ArchiveError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError(f"bad header line: {line[:80]!r}")
        headers[name.decode().strip().lower()] = value.decode().strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ArchiveError(f"header {name} is missing")
    if not headers["content-length"].isdigit():
        raise ArchiveError("Content-Length is no number")
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"block of {len(rest) - 4} bytes; Content-Length is {size}")
    return Record(headers, rest[:size])


def records(archive: bytes) -> Iterator[Record]:
    """Records of an archive, with headers and lengths checked; one frame is decoded at a time."""
    if len(archive) < 8:
        raise ArchiveError("archive is cut off")
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_FRAME:
        raise ArchiveError("no leading dictionary frame")
    held = archive[8 : 8 + size]
    if len(held) != size:
        raise ArchiveError("dictionary frame is cut off")
    if held[:4] == ZSTD_FRAME:
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    frames = zstandard.ZstdDecompressor(dict_data=_dictionary(held))
    rest = memoryview(archive)[8 + size :]
    while len(rest):
        if bytes(rest[:4]) != ZSTD_FRAME:
            raise ArchiveError("not a Zstandard frame")
        frame = frames.decompressobj()
        try:
            # The input goes in pieces, so that what follows the frame is not copied again and again.
            raw, at = [], 0
            while not frame.eof and at < len(rest):
                raw.append(frame.decompress(rest[at : at + 65_536]))
                at += 65_536
        except zstandard.ZstdError as e:
            raise ArchiveError(f"bad frame: {e}") from e
        if not frame.eof:
            raise ArchiveError("frame is cut off")
        used = min(at, len(rest)) - len(frame.unused_data)
        yield _record(b"".join(raw))
        rest = rest[used:]


def _http(payload_bytes: int) -> bytes:
    return (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
        % payload_bytes
    )


def payload_of(record: Record) -> bytes:
    """The body of the HTTP message in a response record."""
    head, mark, body = record.block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        raise ArchiveError("response without an HTTP header")
    return body


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder)


def _written(folder: str, dictionary: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(folder)
        writer, n = Writer(dictionary), 0

        def close() -> pd.DataFrame:
            data = writer.bytes()
            # A second attempt of a task writes files of its own; only listed ones are read.
            name = f"{zlib.crc32(data):08x}-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            return pd.DataFrame({"name": [name], "n_records": [n], "n_bytes": [len(data)]})

        for batch in batches:
            for page, url, html, winner, known in zip(
                batch["page_id"], batch["url"], batch["html"], batch["winner"], batch["sha1"], strict=True
            ):
                page = None if pd.isna(page) else int(page)
                payload = html.encode()
                mark = base64.b32encode(bytes.fromhex(known)).decode()
                headers = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", record_id(page, mark)),
                    ("WARC-Date", DATE),
                    ("WARC-Payload-Digest", f"sha1:{mark}"),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if url is not None:
                    headers.append(("WARC-Target-URI", urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
                if page is not None:
                    headers.append(("Tidewell-Page-Id", str(page)))
                if pd.isna(winner):
                    block = _http(len(payload)) + payload
                else:
                    headers[0] = ("WARC-Type", "revisit")
                    headers.append(("WARC-Profile", REVISIT))
                    headers.append(("WARC-Refers-To", record_id(int(winner), mark)))
                    block = _http(len(payload))
                writer.add(headers, block)
                n += 1
                if len(writer) >= ARCHIVE_BYTES:
                    yield close()
                    writer, n = Writer(dictionary), 0
        if n:
            yield close()

    return run


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for archive in batch["content"]:
            rows = []
            for record in records(bytes(archive)):
                h = record.headers
                kind = h["warc-type"]
                said = h.get("warc-payload-digest", "").removeprefix("sha1:")
                size = found = None
                if kind == "response":
                    payload = payload_of(record)
                    size, found = len(payload), digest(payload)
                    if said and said != found:
                        raise ArchiveError(f"payload digest of {h['warc-record-id']} does not match")
                elif kind == "revisit":
                    if "warc-refers-to" not in h:
                        raise ArchiveError("revisit without WARC-Refers-To")
                    found = said
                page = h.get("tidewell-page-id")
                rows.append(
                    (
                        None if page is None else int(page), h["warc-record-id"], kind,
                        h.get("warc-target-uri"), size, found, h.get("warc-refers-to"),
                    )
                )
            out = pd.DataFrame(
                rows,
                columns=["page_id", "record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to_id"],
            )
            yield out.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in ``folder``.

    Gives (name, n_records, n_bytes) of the archives, which is the list of those that count. Of
    rows with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id is
    the response and the others revisit it without the payload. Rows that repeat the largest id
    are responses too; rows without an id revisit one with an id, if there is any.

    A null html is an empty payload, a null url leaves out the target. The dictionary is trained
    on SAMPLE pages at most. ``folder`` is any place that all executors reach.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    sample = some_rows(rows, SAMPLE, "page_id", "sha1").select(F.substring("html", 1, 16_384).alias("html"))
    dictionary = train([r["html"].encode() for r in sample.collect()])
    store, root = _open(folder)
    store.create_dir(root)
    most = stored(
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("sha1").agg(F.max("page_id").alias("winner"), F.count("*").alias("n"))
        .where("n > 1 and winner is not null").drop("n"),
        "responses",
    )
    dealt = rows.join(most, "sha1", "left").withColumn(
        "winner", F.when(~F.col("page_id").eqNullSafe(F.col("winner")), F.col("winner"))
    )
    return stored(
        dealt.mapInPandas(_written(folder, dictionary), "name string, n_records long, n_bytes long"), "archives"
    )


def read_archives(spark: SparkSession, folder: str, archives: DataFrame | None = None) -> DataFrame:
    """(page_id, record_id, record_type, url, payload_bytes, payload_digest, refers_to_id) of all records.

    The dictionary comes from the leading skippable frame; every record is a frame of its own. A
    broken frame, header, length or digest fails the job. With ``archives`` only files that it
    lists are read. Size and digest are of the payload read; a revisit has no size.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    if archives is not None:
        files = files.join(archives.select("name"), "name", "left_semi")
    return files.select("content").mapInPandas(_read, _RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) read back from archives.

    Sizes of revisits come from the response that they refer to.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    archives = write_archives(pages, folder, least_bytes)
    if archives.isEmpty():
        read = spark.createDataFrame([], _RECORD)
    else:
        read = stored(read_archives(spark, folder, archives), "records")
    targets = stored(
        read.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
            F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("target_bytes"),
            F.max("payload_digest").alias("target_digest"),
        ),
        "targets",
    )
    joined = read.where("record_type = 'revisit'").join(targets, "refers_to_id", "left")
    broken = F.raise_error(F.lit("revisit of a record that is not there or has another payload"))
    matches = F.coalesce(F.col("payload_digest") == F.col("target_digest"), F.lit(False))
    revisits = joined.select(
        "page_id", F.when(matches, F.col("target_bytes")).otherwise(broken.cast("long")).alias("payload_bytes"),
        "payload_digest", "record_type", "refers_to", "url",
    )
    responses = read.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to"), "url",
    )
    return responses.union(revisits)
