"""WARC records in ZIP-packaged archives, read by byte ranges.

An archive is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` holds one gzip
member for each record, ``indexes/index.cdx`` one line ``offset length record-id`` for each. The reader parses
the central directory (ZIP64 too), finds where members lie, and reads single records from the file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: An archive is closed at so many bytes of records; a reading task takes so many at once.
ARCHIVE_BYTES, BLOCK_BYTES = 32 << 20, 4 << 20
#: Payloads of so many bytes at least are written once.
REVISIT_FROM = 0

# Signatures of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def warc_record(kind: str, page: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record, with pages percent-encoded; a revisit's block ends after the HTTP header, whose Content-Length is that of the full payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += payload if kind == "response" else b""
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{quote(page, safe='')}>", f"WARC-Target-URI: {target}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{quote(refers_to, safe='')}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, with names in lower case, and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def members(size: int, read: Callable[[int, int], bytes]) -> dict[str, tuple[int, int]]:
    """``name: (offset, length)`` of the stored members of a ZIP file of ``size`` bytes; ``read(offset, length)``."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == LOCATOR64:
        end64 = struct.unpack("<Q", tail[at - 12 : at - 4])[0]
        record = read(end64, 56)
        if record[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    directory, out, i = read(start, length), {}, 0
    for _ in range(count):
        if directory[i : i + 4] != ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[i + 10 : i + 12])
        packed, full, n, extra, comment = struct.unpack("<IIHHH", directory[i + 20 : i + 34])
        local, = struct.unpack("<I", directory[i + 42 : i + 46])
        name = directory[i + 46 : i + 46 + n].decode()
        j, stop = i + 46 + n, i + 46 + n + extra
        while j + 4 <= stop:
            tag, many = struct.unpack("<HH", directory[j : j + 4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{many // 8}Q", directory[j + 4 : j + 4 + many // 8 * 8]))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            j += 4 + many
        if method == 0:
            head = read(local, 30)
            if head[:4] != LOCAL:
                raise ValueError("no local header")
            out[name] = (local + 30 + sum(struct.unpack("<HH", head[26:30])), packed)
        i = stop + comment
    return out


def _archive(records: bytes, index: list[str]) -> bytes:
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as z:
        for name, data in ((DATA, records), (INDEX, "\n".join(index).encode())):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=True) as f:
                f.write(data)
    return held.getvalue()


def dedupe_plan(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``page, url, payload, refers_to``: of equal payloads that with the largest page is kept in full.

    Payloads are equal if SHA-1 and length are. ``refers_to`` is null where the record is a response. The table of
    repeated payloads has one row for each, so a payload that a third of the pages share splits over tasks.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page).alias("page"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("payload"))
    keyed = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    tops = (keyed.where(F.octet_length("payload") >= revisit_from).groupBy("digest")
            .agg(F.max("page").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "top"))
    refers = F.when((F.octet_length("payload") >= revisit_from) & ~F.col("page").eqNullSafe(F.col("top")), F.col("top"))
    return keyed.join(checkpointed(tops), "digest", "left").select("page", "url", "payload", refers.alias("refers_to"))


def write_archives(plan: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``dedupe_plan`` under ``folder``; returns the manifest ``path, bytes, records``.

    Each attempt of a task writes files of its own names and only those of the attempt that counts come into the
    manifest, which is checkpointed: a lost executor leaves files that nobody reads.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, index = bytearray(), []

        def close() -> pd.DataFrame:
            path, data = f"{root}/{uuid.uuid4().hex}.wacz", _archive(bytes(held), index)
            with store.open_output_stream(path) as f:
                f.write(data)
            out = pd.DataFrame({"path": [path], "bytes": [len(data)], "records": [len(index)]})
            held.clear()
            index.clear()
            return out

        for batch in batches:
            for page, url, payload, refers in batch.itertuples(index=False):
                refers = None if pd.isna(refers) else refers
                page = "" if pd.isna(page) else page
                record = warc_record("response" if refers is None else "revisit", page, url, payload.encode(), refers)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = packer.compress(record) + packer.flush()
                index.append(f"{len(held)} {len(packed)} {quote(page, safe='')}")
                held.extend(packed)
                if len(held) >= ARCHIVE_BYTES:
                    yield close()
        if index:
            yield close()

    text = plan.withColumns({"page": F.col("page").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return checkpointed(text.mapInPandas(put, "path string, bytes long, records long"))


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """``page, payload_bytes, payload_digest, record_type, refers_to, payload`` of every record; pages as text.

    The first step reads only directories and indexes and gives blocks of neighbouring records, which the second
    step shares out anew and reads by their ranges. A response whose digest does not fit its payload raises.
    """

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"]:
                with store.open_input_file(path) as f:
                    where = members(f.size(), lambda at, n: f.read_at(n, at))
                    base, (start, length) = where[DATA][0], where[INDEX]
                    lines = [tuple(map(int, x.split(" ", 2)[:2])) for x in f.read_at(length, start).decode().split("\n")]
                blocks, cut = [], 0
                for i, (at, n) in enumerate(lines):
                    if i + 1 == len(lines) or at + n - lines[cut][0] >= BLOCK_BYTES:
                        blocks.append((path, base + lines[cut][0], [x[1] for x in lines[cut : i + 1]]))
                        cut = i + 1
                yield pd.DataFrame(blocks, columns=["path", "start", "lengths"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start, lengths in batch.itertuples(index=False):
                with store.open_input_file(path) as f:
                    data = f.read_at(int(sum(lengths)), int(start))
                rows, at = [], 0
                for n in lengths:
                    fields, block = parse_record(zlib.decompress(data[at : at + n], 31))
                    at += n
                    head, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
                    full = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    if kind == "response" and (len(payload) != full or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"broken record in {path}")
                    page, refers = (unquote(fields.get(k, "").removeprefix("<urn:page:").removesuffix(">")) or None for k in ("warc-record-id", "warc-refers-to"))
                    rows.append((page, full, digest, kind, refers, payload.decode() if kind == "response" else None))
                yield pd.DataFrame(rows, columns=["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    n = max(manifest.sparkSession.sparkContext.defaultParallelism, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = manifest.repartition(n).mapInPandas(locate, "path string, start long, lengths array<long>")
    return blocks.repartition(n).mapInPandas(
        read, "page string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload string")


def round_trip(pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Archives of ``pages`` written under ``folder`` and read back; one row per page, with pages of their own type.

    Null payloads are empty ones. Rows that tie for the largest page of a payload are all responses; where all
    pages of a payload are null, so are those. Repeated rows give repeated records. An empty table writes nothing.
    """
    kind = pages.schema[page].dataType
    back = read_archives(write_archives(dedupe_plan(pages, page, url, html, revisit_from), folder), folder)
    return back.select(F.col("page").cast(kind).alias(page), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "payload")


def remove(folder: str) -> None:
    """Deletes the archives under ``folder``."""
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        store.delete_dir(root)
