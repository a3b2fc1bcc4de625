"""WARC archives: writing, normalising monolithic gzip, and reading by a sidecar offset index.

``write_archives`` writes each partition as one monolithic gzip stream, which cannot be read
from the middle. ``normalise`` inflates such a stream once, front to back and in chunks, and
rewrites every record as a gzip member of its own, with a sidecar file of offsets beside it.
``read_records`` then reads single records by offset.

Files go to a folder that driver and executors share, through pyarrow's file systems. Names are
drawn anew by each attempt of a task and only the names that a finished job returned are read,
so a lost executor or a second attempt leaves at worst an unused file.

Defined results: a null payload is empty; a null id is written as an empty one and comes back
null, and counts as the smallest; repeated rows are all written, and those with the largest id
of their payload are all responses. An empty table gives no archive. Other columns are unused.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillflow.session import scratch_path

CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "path string, offset long, length long, record_type string, record_id string"
RECORD_SCHEMA = ("page_id long, url string, payload binary, payload_bytes long, "
                 "payload_digest string, record_type string, refers_to long")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def tag_revisits(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): equal payloads refer to their largest id.

    Only payloads of at least ``revisit_from`` bytes are compared. A payload that is held
    elsewhere is dropped at once, so a page with many copies is not carried along.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    keepers = rows.where(F.octet_length("payload") >= revisit_from).groupBy("digest").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1")
    held = F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper"))
    refers = F.when(F.col("keeper").isNotNull() & held, F.col("keeper"))
    joined = rows.join(keepers, "digest", "left").withColumn("refers_to", refers)
    return joined.select(
        "page_id", "url", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "digest", "refers_to")


def _urn(page_id) -> str:
    return f"<urn:page:{'' if pd.isna(page_id) else int(page_id)}>"


def _id_of(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _one_line(value: str) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record_head(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def page_record(page_id, url, payload, payload_bytes, digest, refers_to, date) -> list[bytes]:
    """A response with its payload, or a revisit with the HTTP head alone."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()
    body = payload if pd.isna(refers_to) else b""
    fields = [("WARC-Type", "response" if pd.isna(refers_to) else "revisit"),
              ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    fields.append(("WARC-Payload-Digest",
                   "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if not pd.isna(refers_to):
        fields += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return [record_head(fields, len(http) + len(body)), http, body, b"\r\n\r\n"]


def write_archives(tagged: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   roll_bytes: int = 1 << 30, level: int = 1) -> DataFrame:
    """Archives of at most about ``roll_bytes`` each; returns (path, records), not yet run."""
    info = b"software: tillflow\r\n"
    head = record_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:warcinfo>"),
                        ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                       len(info))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = path = None
        records = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    fs, base = filesystem(folder)
                    name = f"crawl-{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", fs.open_output_stream(
                        f"{base}/{name}", compression=None)
                    gz, records = zlib.compressobj(level, wbits=31), 0
                    out.write(gz.compress(head + info + b"\r\n\r\n"))
                for part in page_record(row.page_id, row.url, row.payload, row.payload_bytes,
                                        row.digest, row.refers_to, date):
                    out.write(gz.compress(part))
                records += 1
                if out.tell() >= roll_bytes:
                    out.write(gz.flush())
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [path], "records": [records]})
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pd.DataFrame({"path": [path], "records": [records]})

    # A nullable integer would reach pandas as a float and lose digits beyond 2^53.
    ids = tagged.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return ids.mapInPandas(write, "path string, records long")


class Inflated:
    """Buffered reading of a gzip stream, one inflate pass, of one member or of many."""

    def __init__(self, source):
        self.source, self.gz, self.buffer = source, zlib.decompressobj(wbits=31), b""

    def _more(self) -> bool:
        data = self.gz.unconsumed_tail or self.gz.unused_data or self.source.read(CHUNK)
        if self.gz.eof:
            if not data:
                return False
            self.gz = zlib.decompressobj(wbits=31)
        elif not data:
            raise EOFError("truncated archive")
        self.buffer += self.gz.decompress(data, CHUNK)
        return True

    def head(self) -> bytes | None:
        """Up to and with the next blank line; None at the end."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise EOFError("truncated record")
                return None
        head, self.buffer = self.buffer[:end + 4], self.buffer[end + 4:]
        return head

    def body(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.buffer and not self._more():
                raise EOFError("truncated record")
            part, self.buffer = self.buffer[:length], self.buffer[length:]
            length -= len(part)
            yield part


def head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise_stream(source, out, level: int = 1) -> Iterator[tuple[int, int, str, str]]:
    """Rewrite a WARC gzip stream with a member for each record; yields the index entries."""
    stream = Inflated(source)
    while (head := stream.head()) is not None:
        fields = head_fields(head)
        start, gz = out.tell(), zlib.compressobj(level, wbits=31)
        out.write(gz.compress(head))
        for part in stream.body(int(fields["content-length"]) + 4):
            out.write(gz.compress(part))
        out.write(gz.flush())
        yield start, out.tell() - start, fields["warc-type"], fields.get("warc-record-id", "")


def normalise(archives: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Normalise the archives named in ``path``; returns their index, not yet run.

    Beside every new archive lies its index as text: offset, length, type and record id.
    """

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = filesystem(folder)
        for batch in batches:
            for path in batch["path"]:
                fs, inner = filesystem(path)
                name = f"records-{uuid.uuid4().hex}.warc.gz"
                with (fs.open_input_stream(inner, compression=None) as source,
                      target.open_output_stream(f"{base}/{name}", compression=None) as out,
                      target.open_output_stream(f"{base}/{name}.idx") as sidecar):
                    found: list[tuple] = []
                    for entry in normalise_stream(source, out, level):
                        sidecar.write(("%d\t%d\t%s\t%s\n" % entry).encode())
                        found.append((f"{folder}/{name}", *entry))
                        if len(found) >= 10_000:
                            yield pd.DataFrame(found, columns=names)
                            found = []
                if found:
                    yield pd.DataFrame(found, columns=names)

    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
    return archives.select("path").mapInPandas(rewrite, INDEX_SCHEMA)


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = head_fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    size = len(payload)
    if kind == "revisit":
        size = int(http.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
    else:
        found = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != found:
            raise ValueError(f"payload of {fields['warc-record-id']} is {found}, not {digest}")
    return {"page_id": _id_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "payload": payload if kind == "response" else None, "payload_bytes": size,
            "payload_digest": digest.removeprefix("sha1:"), "record_type": kind,
            "refers_to": _id_of(fields.get("warc-refers-to"))}


def read_records(index: DataFrame) -> DataFrame:
    """Every response and revisit that ``index`` names, read by offset, digests verified."""
    columns = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = file = None
        for batch in batches:
            found, held = [], 0
            for row in batch.itertuples(index=False):
                if row.path != path:
                    if file is not None:
                        file.close()
                    fs, inner = filesystem(row.path)
                    path, file = row.path, fs.open_input_file(inner)
                file.seek(row.offset)
                found.append(parse_record(zlib.decompress(file.read(row.length), wbits=31)))
                held += found[-1]["payload_bytes"]
                if held > 16 * CHUNK:
                    yield _frame(found, columns)
                    found, held = [], 0
            if found:
                yield _frame(found, columns)

    wanted = index.where(F.col("record_type").isin("response", "revisit"))
    return wanted.sortWithinPartitions("path", "offset").mapInPandas(read, RECORD_SCHEMA)


def _frame(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_pages(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Write pages to archives, normalise these, and read every record back."""
    folder = scratch_path(spark, "warc")
    fs, base = filesystem(folder)
    for name in ("crawl", "records"):
        fs.create_dir(f"{base}/{name}", recursive=True)
    archives = write_archives(tag_revisits(pages, revisit_from), f"{folder}/crawl")
    archives.write.parquet(f"{folder}/archives")
    names = spark.read.parquet(f"{folder}/archives")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = normalise(names.repartition(width), f"{folder}/records")
    index.write.parquet(f"{folder}/index")
    return read_records(spark.read.parquet(f"{folder}/index"))
