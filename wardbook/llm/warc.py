"""WARC archives as a PySpark Python data source, and the writing of one record per page.

Reading. `spark.read.format("warc").load(path)`: the files are planned into partitions on the driver, small ones together up to
`partitionBytes`. Each record is a gzip member of its own (or plain). A record's header block is inflated first; the
predicates that Spark pushed down (equality and IN on record_type, target_uri, payload_digest, refers_to, record_id; null
tests) are tried on it, and only wanted payloads are decoded: members that this writer made state their length in the gzip extra
field ("sl"), so an unwanted payload is skipped unread; in other files it is inflated past. `payload` false reads headers only.

Writing. `df.write.format("warc").mode("append").save(path)`: each task writes one file under a name of its own, and the commit
moves the files of the tasks that count into place; files of lost attempts are left in the staging folder and removed.
Files go through pyarrow's file systems: local or shared folders, S3 (`s3a://` is read as `s3://`, with pyarrow's own settings), GCS, Azure, and
HDFS where its library is there. Other stores that only Hadoop knows are not reached.

Revisits. Of records with equal payloads of at least `least_bytes`, the one with the largest page_id is a response, and the others
revisit it: they carry no payload, but its digest and length.

Defined results. Very long payloads: whole. Null html is an empty payload. Null url is written as `about:blank`. A page without an id is revisited by none; it
revisits the page with the largest id if there is one, else it is a response. Rows that share the largest id are responses.
Other columns play no part. An empty table writes no record and reads back as no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    WriterCommitMessage,
)

from wardbook.llm.bloom import Bloom
from wardbook.operators.keep import keep_table

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, payload_bytes bigint, "
    "refers_to string, page_id bigint, payload binary"
)
_ARROW = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "warc_date", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("page_id", pa.int64()), ("payload", pa.binary())]
)
PARTITION_BYTES = 64 << 20
_HEADER_NAMES = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "page_id": "x-page-id",
}
_READ = 1 << 16
_BATCH_BYTES = 4 << 20
#: Archives made from a table have no time of capture; a fixed one keeps a rerun equal byte for byte.
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- one record ----


def record(headers: dict[str, str], payload: bytes, gzip: bool = True) -> bytes:
    """A WARC record; as a gzip member its extra field has the compressed and the plain length."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in {**headers, "Content-Length": str(len(payload))}.items())
    plain = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + payload + b"\r\n\r\n"
    if not gzip:
        return plain
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(plain) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = struct.pack("<2sHII", b"sl", 8, total & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + extra + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def _parse(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


class _Plain:
    """Records of an archive that is not compressed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at = file, size, 0

    def headers(self) -> dict[str, str] | None:
        if self.at >= self.size:
            return None
        held = b""
        self.file.seek(self.at)
        while b"\r\n\r\n" not in held:
            more = self.file.read(4096)
            if not more:
                raise EOFError("the archive ends within a header")
            held += more
        block = held[: held.index(b"\r\n\r\n") + 4]
        found = _parse(block)
        self.start, self.length = self.at + len(block), int(found["content-length"])
        self.at = self.start + self.length + 4
        return found

    def payload(self) -> bytes:
        self.file.seek(self.start)
        return self.file.read(self.length)


class _Gzip:
    """Records of an archive with one gzip member for each."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at = file, size, 0

    def headers(self) -> dict[str, str] | None:
        if self.at >= self.size:
            return None
        self.file.seek(self.at)
        raw = self.file.read(4096)
        self.stated = struct.unpack("<I", raw[16:20])[0] if raw[3] & 4 and raw[12:14] == b"sl" else 0
        self.unpacker = zlib.decompressobj(zlib.MAX_WBITS | 16)
        self.read = len(raw)
        self.plain = self.unpacker.decompress(raw, 4096)
        while b"\r\n\r\n" not in self.plain:
            if not self._more(4096):
                raise EOFError("the archive ends within a header")
        block = self.plain[: self.plain.index(b"\r\n\r\n") + 4]
        found = _parse(block)
        self.plain, self.length = self.plain[len(block) :], int(found["content-length"])
        if self.stated:
            self.at += self.stated
        else:  # a member of unknown length: inflate it now, piece by piece, keeping the payload
            while not self.unpacker.eof and self._more(_READ):
                pass
            self.at += self.read - len(self.unpacker.unused_data)
        return found

    def _more(self, size: int) -> bool:
        if self.unpacker.eof:
            return False
        fed = self.unpacker.unconsumed_tail
        if not fed:
            fed = self.file.read(_READ)
            self.read += len(fed)
            if not fed:
                return False
        self.plain += self.unpacker.decompress(fed, size)
        return True

    def payload(self) -> bytes:
        parts = [self.plain]
        have = len(self.plain)
        self.plain = b""
        while have < self.length and self._more(_READ):
            parts.append(self.plain)
            have += len(self.plain)
            self.plain = b""
        return b"".join(parts)[: self.length]


# ---- reading ----


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]

    def __init__(self, paths: list[tuple[str, int]]):
        self.paths = paths


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def _fields(headers: dict[str, str]) -> dict[str, object]:
    out: dict[str, object] = {name: _bare(headers.get(key)) for name, key in _HEADER_NAMES.items()}
    out["payload_digest"] = (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    out["page_id"] = int(headers["x-page-id"]) if "x-page-id" in headers else None
    out["payload_bytes"] = int(headers.get("x-payload-length", headers["content-length"]))
    return out


def _uri(path: str) -> str:
    """Hadoop's names of S3 as pyarrow knows it."""
    return re.sub("^s3[an]://", "s3://", path)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri = _uri(options["path"])
        self.target = int(options.get("partitionbytes", PARTITION_BYTES))
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes predicates on what the headers say; yields those that Spark has to try itself."""
        for f in filters:
            column = getattr(f, "attribute", (None, None))
            if len(column) == 1 and column[0] in {**_HEADER_NAMES, "payload_bytes": None}:
                if isinstance(f, EqualTo | EqualNullSafe):
                    self.wanted.append((column[0], "safe" if isinstance(f, EqualNullSafe) else "=", f.value))
                    continue
                if isinstance(f, In):
                    self.wanted.append((column[0], "in", tuple(f.value)))
                    continue
                if isinstance(f, IsNotNull | IsNull):
                    self.wanted.append((column[0], "null" if isinstance(f, IsNull) else "not null", None))
                    continue
            yield f

    def _passes(self, fields: dict[str, object]) -> bool:
        for name, kind, value in self.wanted:
            have = fields[name]
            if kind == "null":
                ok = have is None
            elif kind == "not null":
                ok = have is not None
            elif kind == "safe":
                ok = have == value
            else:
                ok = have is not None and (have in value if kind == "in" else have == value)
            if not ok:
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        system, path = pafs.FileSystem.from_uri(self.uri)
        listed = system.get_file_info(pafs.FileSelector(path, recursive=True)) if system.get_file_info(path).type == pafs.FileType.Directory else [system.get_file_info(path)]
        files = sorted((f.path, f.size) for f in listed if f.type == pafs.FileType.File and f.path.endswith((".warc", ".warc.gz")))
        files = [f for f in files if "/_" not in f[0][len(path) :]]
        plan: list[list[tuple[str, int]]] = []
        held = self.target
        for name, size in files:
            if held + size > self.target:
                plan.append([])
                held = 0
            plan[-1].append((name, size))
            held += size
        return [Files(p) for p in plan] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = pafs.FileSystem.from_uri(self.uri)
        rows: list[dict] = []
        held = 0
        for path, size in partition.paths:
            with system.open_input_file(path) as file:
                archive = (_Gzip if path.endswith(".gz") else _Plain)(file, size)
                while (headers := archive.headers()) is not None:
                    fields = _fields(headers)
                    if not self._passes(fields):
                        continue
                    payload = archive.payload() if self.with_payload and fields["record_type"] != "revisit" else None
                    rows.append({**fields, "payload": payload})
                    held += 512 + len(payload or b"")
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


# ---- writing ----


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int


class WarcWriter(DataSourceArrowWriter):
    """Expects the columns page_id, url, payload, payload_digest, refers_to, is_revisit."""

    def __init__(self, options: dict[str, str]):
        self.uri = _uri(options["path"])
        self.gzip = options.get("gzip", "true").lower() == "true"
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = pafs.FileSystem.from_uri(self.uri)
        name, out, n = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip, None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(f"{path}/{self.staging}", recursive=True)
                    out = system.open_output_stream(f"{path}/{self.staging}/{name}", compression=None)
                out.write(_page_record(row, self.gzip))
                n += 1
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = pafs.FileSystem.from_uri(self.uri)
        system.create_dir(path, recursive=True)
        for message in messages:
            if message is not None and message.name:
                system.move(f"{path}/{self.staging}/{message.name}", f"{path}/{message.name}")
        self._clear(system, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*pafs.FileSystem.from_uri(self.uri))

    def _clear(self, system: pafs.FileSystem, path: str) -> None:
        if system.get_file_info(f"{path}/{self.staging}").type == pafs.FileType.Directory:
            system.delete_dir(f"{path}/{self.staging}")


def _urn(page_id: int | None, payload_digest: str, url: str | None) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url}|{payload_digest}')}"


def _page_record(row: dict, gzip: bool) -> bytes:
    payload = row["payload"] or b""
    checked = digest(payload)
    if checked != row["payload_digest"]:
        raise ValueError(f"payload of page {row['page_id']} does not match its digest")
    url = " ".join((row["url"] or "about:blank").split()) or "about:blank"
    headers = {
        "WARC-Type": "revisit" if row["is_revisit"] else "response",
        "WARC-Record-ID": f"<{_urn(row['page_id'], checked, url)}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{checked}",
        "Content-Type": "text/html; charset=utf-8",
        "X-Payload-Length": str(len(payload)),
    }
    if row["page_id"] is not None:
        headers["X-Page-Id"] = str(row["page_id"])
    if row["is_revisit"]:
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = f"<urn:page:{row['refers_to']}>"
        payload = b""
    return record(headers, payload, gzip)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to: use mode('append') and a new folder")
        return WarcWriter({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload):
    """Column: the upper-case base32 SHA-1 of a binary column. Five hex digits are four letters."""
    hexed = F.sha1(payload)
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hexed, i * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    letters = F.transform(
        groups,
        lambda g: F.concat(*[F.substring(F.lit(_BASE32), F.shiftright(g, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]),
    )
    return F.array_join(letters, "")


def write_pages(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, gzip: bool = True) -> None:
    """One record per page. Digests are counted without payloads; only pages whose digest occurs twice are joined with those digests, the
    others are written straight from their scan."""
    register(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("payload_digest", base32_sha1(F.col("payload")))
    shared = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 and refers_to is not null")
        .select("payload_digest", "refers_to", F.xxhash64("payload_digest").alias("digest_key"))
    )
    shared = keep_table(shared)
    rows = rows.withColumn("digest_key", F.xxhash64("payload_digest"))
    repeated = Bloom(shared.select("digest_key")).may_have("digest_key")
    alone = rows.filter(~repeated).withColumn("refers_to", F.lit(None).cast("long"))
    met = rows.filter(repeated).join(shared.drop("digest_key"), "payload_digest", "left").select(*alone.columns)
    marked = alone.union(met).withColumn("is_revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull(), F.lit(False)))
    marked.select("page_id", "url", "payload", "payload_digest", "refers_to", "is_revisit").write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All records below `path`.

    Spark keeps a Python source's plan with the frame, and asks for a new one only where a query has a predicate: after a filtered
    query, an unfiltered one on the same frame would read what the first one wanted. So every query gets one that always holds.
    """
    register(spark)
    return spark.read.format("warc").options(**options).load(path).filter("payload_bytes IS NOT NULL")
