"""Zstandard-compressed WARC archives: a writer, and a reader that checks what it reads.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary of all other frames,
itself compressed or not; then comes one frame per record.  The reader loads the dictionary, walks the frames by
their block headers, decodes one frame per record, and validates the version line, the mandatory headers, the
block's length and the payload's digest; a damaged archive raises ``ValueError``.

``write_archives`` stores a page's payload once: of rows with equal payloads of at least ``min_bytes`` the one
with the smallest id is a response record and the others are revisit records that name it.  Tasks stream
records into archives of about ``archive_bytes`` (compressed) in the shared folder, under names of their own attempt; the
manifest they return names the archives that count, so what a lost or repeated task left behind is never read.
Writing goes through Arrow's file systems, since Spark has no sink for raw bytes; reading through Spark's ``binaryFile`` source.

Null html is an empty payload, null urls are left out of the record, null ids are kept (and never the smallest).
Rows that repeat both the smallest id and its payload are responses all.  An empty table gives no archive and
an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import scratch_path, stored

# Fixed values of the archive format and of Zstandard frames.
DICT_FRAME = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
DICT_MAGIC = 0xEC30A437
VERSION = b"WARC/1.1"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = b"\r\n"


def train_dictionary(samples: list[bytes], size: int = 65_536) -> bytes:
    """A dictionary of at most ``size`` bytes; plain content where there is too little to train on."""
    samples = [s for s in samples if len(s) >= 16]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:] or VERSION


def dictionary_frame(raw: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=9).compress(raw)
    return struct.pack("<II", DICT_FRAME, len(body)) + body


def read_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The leading frame's dictionary and the offset behind the frame."""
    if len(data) < 8:
        raise ValueError("archive without a dictionary frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICT_FRAME or 8 + size > len(data):
        raise ValueError("archive without a whole dictionary frame in front")
    body = bytes(data[8 : 8 + size])
    if body[:4] == struct.pack("<I", FRAME_MAGIC):
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    return body, 8 + size


def frame_end(data: memoryview, at: int) -> int:
    """The offset behind the frame at ``at``, from its header and block headers."""
    if len(data) - at < 9 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    content = (1 if single else 0, 2, 4, 8)[flags >> 6]
    end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + content
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError(f"frame at byte {at} is cut off")
        head = data[end] | data[end + 1] << 8 | data[end + 2] << 16
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * (flags >> 2 & 1)
    if end > len(data):
        raise ValueError(f"frame at byte {at} is cut off")
    return end


def build_record(headers: dict[str, str], block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {v}".encode() for k, v in headers.items()), f"Content-Length: {len(block)}".encode()]
    return _CRLF.join(head) + _CRLF * 2 + block + _CRLF * 2


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises where the format is violated."""
    head, split, rest = data.partition(_CRLF * 2)
    lines = head.split(_CRLF)
    if not split or lines[0] != VERSION:
        raise ValueError("not a record: version line or end of headers missing")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:60]!r}")
        headers[name.decode()] = value.strip().decode()
    missing = [h for h in MANDATORY if h not in headers]
    if missing:
        raise ValueError(f"headers missing: {missing}")
    if not headers["Content-Length"].isdigit() or len(rest) != int(headers["Content-Length"]) + 4 or rest[-4:] != _CRLF * 2:
        raise ValueError(f"block length differs from Content-Length in {headers['WARC-Record-ID']}")
    block = rest[:-4]
    if headers["WARC-Type"] == "response" and headers.get("Payload-Length", str(len(block))) != str(len(block)):
        raise ValueError(f"payload length differs in {headers['WARC-Record-ID']}")
    if headers["WARC-Type"] == "response" and headers.get("WARC-Payload-Digest", "").startswith("sha256:"):
        if hashlib.sha256(block).hexdigest() != headers["WARC-Payload-Digest"][7:]:
            raise ValueError(f"payload digest differs in {headers['WARC-Record-ID']}")
    return headers, block


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive in order."""
    data = memoryview(content)
    raw, at = read_dictionary(data)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    while at < len(data):
        end = frame_end(data, at)
        try:
            record = decoder.decompress(data[at:end])
        except zstandard.ZstdError as error:
            raise ValueError(f"frame at byte {at}: {error}") from error
        yield parse_record(record)
        at = end


def _headers(row: dict, date: str) -> dict[str, str]:
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{row['_id']}|{row['_digest']}")
    out = {"WARC-Type": row["_type"], "WARC-Record-ID": f"<urn:uuid:{name}>", "WARC-Date": date}
    if row["_url"] is not None:
        out["WARC-Target-URI"] = quote(row["_url"], safe="/:?#[]@!$&'()*+,;=%~")
    if row["_id"] is not None:
        out["Page-ID"] = quote(row["_id"])
    out |= {"WARC-Payload-Digest": f"sha256:{row['_digest']}", "Payload-Length": str(row["_bytes"]), "Content-Type": "text/html; charset=utf-8"}
    if row["_type"] == "revisit":
        out |= {"WARC-Profile": REVISIT_PROFILE, "Refers-To-Page": quote(row["_first"])}
    return out


def _file_system(folder: str):
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _records(pages: DataFrame, id_col: str, html_col: str, url_col: str | None, min_bytes: int) -> DataFrame:
    """What each page's record holds; revisits carry no payload."""
    url = pages[url_col].cast("string") if url_col else F.lit(None).cast("string")
    rows = pages.select(pages[id_col].alias("_key"), url.alias("_url"), F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("_html"))
    rows = rows.withColumn("_digest", F.sha2("_html", 256)).withColumn("_bytes", F.octet_length("_html").cast("bigint"))
    copies = (
        rows.where(F.col("_bytes") >= min_bytes)
        .groupBy(F.col("_digest").alias("_same"))
        .agg(F.min("_key").alias("_least"), F.count("*").alias("_n"))
        .where((F.col("_n") > 1) & F.col("_least").isNotNull())
        .drop("_n")
    )
    again = F.col("_least").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_least"))
    return rows.join(copies, rows._digest == copies._same, "left").select(
        F.col("_key").cast("string").alias("_id"),
        "_url",
        "_digest",
        "_bytes",
        F.when(again, "revisit").otherwise("response").alias("_type"),
        F.when(again, F.col("_least").cast("string")).alias("_first"),
        F.when(~again, F.col("_html")).alias("_html"),
    )


def write_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    url_col: str | None = "url",
    min_bytes: int = 100,
    archive_bytes: int = 8 << 20,
    dictionary_rows: int = 500,
    date: str = "2024-01-01T00:00:00Z",
) -> tuple[str, DataFrame]:
    """The folder of the archives, and their manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")

    def learn(batches):
        samples = [x.encode() for b in batches for x in b.column("_html").to_pylist()]
        yield pa.RecordBatch.from_pydict({"raw": [train_dictionary(samples)]})

    html = F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("_html")
    raw = pages.select(html).limit(dictionary_rows).coalesce(1).mapInArrow(learn, "raw binary").collect()
    shared = spark.sparkContext.broadcast(bytes(raw[0].raw) if raw else VERSION)

    def write(batches):
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        body = zstandard.ZstdCompressionDict(shared.value)
        encoder = zstandard.ZstdCompressor(level=3, dict_data=body, write_checksum=True)
        attempt, done, file, name, n, size = uuid.uuid4().hex, [], None, "", 0, 0
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for k in range(batch.num_rows):
                row = {c: v[k].as_py() for c, v in columns.items()}
                if file is None:
                    name, n = f"{attempt}-{len(done):05d}.warc.zst", 0
                    file = system.open_output_stream(f"{root}/{name}", compression=None)
                    size = file.write(lead := dictionary_frame(shared.value)) or len(lead)
                frame = encoder.compress(build_record(_headers(row, date), (row["_html"] or "").encode()))
                file.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= archive_bytes:
                    file.close()
                    done.append((name, n, size))
                    file = None
        if file is not None:
            file.close()
            done.append((name, n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)] if done else [pa.array([], t) for t in kinds],
            names=["archive", "records", "bytes"],
        )

    kinds = [pa.string(), pa.int64(), pa.int64()]
    records = _records(pages, id_col, html_col, url_col, min_bytes)
    manifest, _ = stored(records.mapInArrow(write, "archive string, records bigint, bytes bigint"), "manifest")
    return folder, manifest


def read_archives(spark, folder: str, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives in ``manifest``; page ids come back as strings."""

    def read(batches):
        for batch in batches:
            column = batch.column("content")
            for k in range(len(column)):
                out = {name: [] for name in names}
                for headers, block in read_archive(column[k].as_py()):
                    values = (
                        _plain(headers.get("Page-ID")),
                        headers.get("WARC-Target-URI"),
                        int(headers["Payload-Length"]),
                        headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                        headers["WARC-Type"],
                        _plain(headers.get("Refers-To-Page")),
                        block if payloads and headers["WARC-Type"] == "response" else None,
                    )
                    for name, value in zip(names, values, strict=True):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    sql = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    if not manifest.head(1):
        return spark.createDataFrame([], sql)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")
    return named.join(manifest.select("archive"), "archive", "left_semi").select("content").mapInArrow(read, sql)


def _plain(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url", **options) -> DataFrame:
    """Writes all pages and returns what the archives hold: (id, payload_bytes, payload_digest, record_type, refers_to)."""
    kind = pages.schema[id_col].dataType
    folder, manifest = write_archives(pages, id_col, html_col, url_col, **options)
    back = read_archives(pages.sparkSession, folder, manifest)
    return back.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
