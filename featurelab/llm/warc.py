"""WARC archives as a Spark data source (operator 11).

``WarcSource`` is a Python data source named ``warc``.  Its writer turns rows
into WARC 1.1 records, one gzip member each, in files of bounded size.  Its
reader plans partitions over files, takes filters on record headers from
Spark's plan, parses a record's headers first and leaves the payload of a
record that no one wants undecoded: the member's compressed length stands in
its gzip header, so such a record is one seek.

``mark_revisits`` decides with DataFrame operations which records carry their
payload and which only point to an equal one.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)

from featurelab.llm.common import fresh, shared_table, text_rows, workers_import

SCHEMA = ("record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
          "content_type string, payload_digest string, payload_length long, payload binary")
ARROW = pa.schema([(n, t) for n, t in (
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
    ("refers_to", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
    ("payload_length", pa.int64()), ("payload", pa.binary()))])
#: fixed values of the format: column, header line
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
BRACKETED = ("record_id", "refers_to")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 256 << 20       # a file is closed once it has grown to this
PARTITION_BYTES = 128 << 20  # files are read together up to this
BATCH_BYTES = 8 << 20
CHUNK = 1 << 16              # bytes read at a time
HEAD = 2048                  # bytes inflated at first: a record's headers, as a rule
UNSAFE = re.compile("[\x00-\x1f\x7f]")


# ---- records -----------------------------------------------------------------

def _line(value: str) -> str:
    """A value that fits one header line: control characters as %XX."""
    return UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", value).strip(" ")


def record_bytes(row: dict) -> bytes:
    """One WARC record.  A response holds an HTTP head and the payload, a
    revisit the head alone, any other type the payload alone."""
    kind, payload = row["record_type"], row["payload"] or b""
    head = {"WARC-Type": kind, "WARC-Date": row["warc_date"]}
    for col in ("record_id", "target_uri", "refers_to", "payload_digest"):
        if row[col] is not None:
            v = _line(row[col])
            head[HEADERS[col]] = f"<{v}>" if col in BRACKETED else f"sha1:{v}" if col == "payload_digest" else v
    content = _line(row["content_type"] or "application/octet-stream")
    if kind in ("response", "revisit"):
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: {content}\r\n"
                f"Content-Length: {row['payload_length']}\r\n\r\n").encode()
        head["Content-Type"] = "application/http;msgtype=response"
        if kind == "revisit":
            head["WARC-Profile"] = PROFILE
            block = http
        else:
            block = http + payload
    else:
        head["Content-Type"] = content
        block = payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member whose extra field ``SL`` holds its whole
    compressed and uncompressed lengths."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    extra = b"SL" + (8).to_bytes(2, "little")
    size = 10 + 2 + 12 + len(body) + 8
    if size >= 1 << 32:
        raise ValueError("a record over 4 GB does not fit a gzip member's length field")
    extra += size.to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + len(extra).to_bytes(2, "little") + extra + body
            + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little"))


def parse_head(head: bytes) -> dict[str, str]:
    """Header lines by lower-cased name; the version line is dropped."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


class _Plain:
    """The records of an uncompressed file, front to back."""

    def __init__(self, f, size: int) -> None:
        self.f, self.size = f, size

    def records(self) -> Iterator[_Record]:
        at = 0
        while at < self.size:
            self.f.seek(at)
            buf = b""
            while b"\r\n\r\n" not in buf:
                more = self.f.read(CHUNK)
                if not more:
                    if buf.strip(b"\r\n"):
                        raise ValueError("a WARC record ends in its headers")
                    return
                buf = (buf + more).lstrip(b"\r\n") if not buf else buf + more
                start = self.f.tell() - len(buf)
            head, _, rest = buf.partition(b"\r\n\r\n")
            head = parse_head(head)
            n = int(head["content-length"])
            body = start + len(buf) - len(rest)
            yield _Record(head, n, rest[:n], lambda r=rest: r + self._read(body + len(r), n - len(r)) if len(r) < n else r[:n])
            at = body + n

    def _read(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)


class _Gzip:
    """The records of a file of gzip members, one record each."""

    def __init__(self, f, size: int) -> None:
        self.f, self.size = f, size

    def records(self) -> Iterator[_Record]:
        at = 0
        while at < self.size:
            self.f.seek(at)
            z, raw = zlib.decompressobj(31), self.f.read(CHUNK)
            length = self._length(raw)
            plain = z.decompress(raw, HEAD)
            while b"\r\n\r\n" not in plain:
                more = self._more(z)
                if not more:
                    raise ValueError("a WARC record ends in its headers")
                plain += more
            head, _, rest = plain.partition(b"\r\n\r\n")
            head = parse_head(head)
            n = int(head["content-length"])
            yield _Record(head, n, rest[:n], lambda r=rest, z=z: self._block(z, r, n))
            if length is None:  # another writer's member: inflate it to find its end
                while not z.eof and self._more(z):
                    pass
                length = self.f.tell() - at - len(z.unused_data)
            at += length

    @staticmethod
    def _length(raw: bytes) -> int | None:
        """The member's compressed length, if its extra field says it."""
        if len(raw) < 12 or raw[:2] != b"\x1f\x8b" or not raw[3] & 4:
            return None
        end, i = 12 + int.from_bytes(raw[10:12], "little"), 12
        while i + 4 <= end:
            n = int.from_bytes(raw[i + 2:i + 4], "little")
            if raw[i:i + 2] == b"SL" and n >= 8:
                return int.from_bytes(raw[i + 4:i + 8], "little")
            i += 4 + n
        return None

    def _more(self, z) -> bytes:
        while not z.eof:
            data = z.unconsumed_tail or self.f.read(CHUNK)
            if not data:
                raise ValueError("a gzip member is cut short")
            out = z.decompress(data, CHUNK * 16)
            if out:
                return out
        return b""

    def _block(self, z, have: bytes, n: int) -> bytes:
        parts, size = [have], len(have)
        while size < n:
            more = self._more(z)
            if not more:
                raise ValueError("a WARC block is shorter than its Content-Length")
            parts.append(more)
            size += len(more)
        return b"".join(parts)[:n]


@dataclass
class _Record:
    head: dict[str, str]
    length: int           # of the block
    first: bytes          # the block's first bytes, as far as they came with the headers
    block: object         # () -> the whole block

    def column(self, col: str) -> str | None:
        v = self.head.get(HEADERS[col].lower())
        if v is not None and col in BRACKETED:
            v = v.removeprefix("<").removesuffix(">")
        if v is not None and col == "payload_digest":
            v = v.removeprefix("sha1:")
        return v

    def row(self, with_payload: bool) -> list:
        kind = self.column("record_type")
        content, n, start = self.head.get("content-type"), self.length, 0
        block = None
        if content and content.startswith("application/http"):
            block = self.first
            if b"\r\n\r\n" not in block and len(block) < self.length:
                block = self.block()
            start = block.find(b"\r\n\r\n") + 4
            if start < 4:
                raise ValueError("an HTTP head without its end")
            http = parse_head(block[:start - 4])
            content = http.get("content-type")
            n = self.length - start if kind != "revisit" else int(http.get("content-length", 0))
        payload = None
        if with_payload and kind != "revisit":
            if block is None or len(block) < self.length:
                block = self.block()
            payload = block[start:]
        return [self.column(c) for c in ("record_id", "record_type", "target_uri", "warc_date", "refers_to")] + [
            content, self.column("payload_digest"), n, payload]


# ---- the data source ---------------------------------------------------------

def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    files: list


@dataclass
class Files(InputPartition):
    paths: list


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own names; a commit lists the files of
    the tasks that count in a manifest, so a task that ran twice, or was lost
    half way, leaves nothing that a reader would see."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.level = int(options.get("level", 6))
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            cols = {n: batch.column(n) for n in ARROW.names}
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in cols.items()}
                row["warc_date"] = row["warc_date"] or self.date
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = where.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    info = {"record_id": f"urn:uuid:{uuid.uuid4()}", "record_type": "warcinfo", "target_uri": None,
                            "warc_date": self.date, "refers_to": None, "payload_digest": None, "payload_length": 0,
                            "content_type": "application/warc-fields", "payload": b"format: WARC File Format 1.1\r\n"}
                    size += out.write(gzip_member(record_bytes(info), self.level))
                size += out.write(gzip_member(record_bytes(row), self.level))
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        where, root = _open(self.path)
        where.create_dir(root, recursive=True)
        old = _manifests(where, root) if self.overwrite else []
        names = [f for m in messages if m for f in m.files]
        with where.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())
        for m in old:
            where.delete_file(m)

    def abort(self, messages: list) -> None:
        where, root = _open(self.path)
        for m in messages:
            for f in m.files if m else []:
                where.delete_file(f"{root}/{f}")


def _manifests(where: fs.FileSystem, root: str) -> list[str]:
    return [x.path for x in where.get_file_info(fs.FileSelector(root, allow_not_found=True))
            if os.path.basename(x.path).startswith("_manifest-")]


def archive_files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of an archive's files: those its manifests list, or, of a
    folder that another tool wrote, all ``.warc`` and ``.warc.gz`` files."""
    where, root = _open(path.rstrip("/"))
    found = {os.path.basename(x.path): x for x in where.get_file_info(fs.FileSelector(root))
             if re.search(r"\.warc(\.gz)?$", x.path)}
    lists = _manifests(where, root)
    if lists:
        names = [n for m in lists for n in json.loads(where.open_input_stream(m).read())]
        missing = [n for n in names if n not in found]
        if missing:
            raise FileNotFoundError(f"{path}: the manifest lists {missing[0]}, which is not there")
        return sorted((found[n].path, found[n].size) for n in names)
    return sorted((x.path, x.size) for x in found.values())


class WarcReader(DataSourceReader):
    """Predicates on header columns are a conjunction of sets and prefixes,
    checked before a block is looked at."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.cores = int(options.get("cores", 1))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            col = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if col in HEADERS and isinstance(f, EqualTo):
                self.tests.append((col, "in", {f.value}))
            elif col in HEADERS and isinstance(f, In):
                self.tests.append((col, "in", set(f.value)))
            elif col in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((col, "prefix", f.value))
            elif col in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((col, "some", None))
            else:
                yield f

    def partitions(self) -> list[Files]:
        """Files of about ``partitionBytes`` together, or less where that left
        some of the ``cores`` idle; a larger file alone."""
        files = archive_files(self.path)
        most = min(self.partition_bytes, max(1 << 20, sum(n for _, n in files) // self.cores))
        parts, held = [], most
        for path, size in files:
            if held + size > most:
                parts.append(Files([]))
                held = 0
            parts[-1].paths.append((path, size))
            held += size
        return parts or [Files([])]

    def wanted(self, r: _Record) -> bool:
        for col, kind, value in self.tests:
            v = r.column(col)
            if v is None or (kind == "in" and v not in value) or (kind == "prefix" and not v.startswith(value)):
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        where, _ = _open(self.path)
        for path, size in partition.paths:
            with where.open_input_file(path) as f:
                for r in (_Gzip if path.endswith(".gz") else _Plain)(f, size).records():
                    if not self.wanted(r):
                        continue
                    rows.append(r.row(self.with_payload))
                    held += 512 + len(rows[-1][-1] or b"")
                    if held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), ARROW)], schema=ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` / ``df.write.format("warc")``.

    Read options: ``payload`` (``false`` leaves all payloads undecoded),
    ``partitionBytes``, ``cores``.  Write options: ``fileBytes``, ``level``, ``date``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session and let it take filters."""
    workers_import(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_archive(records: DataFrame, path: str, mode: str = "append", **options: object) -> None:
    """Write records (columns of ``SCHEMA`` but ``payload_length``; missing ones
    are null, others are ignored) as WARC files under the shared folder
    ``path``.

    A null payload is written as an empty one, a null date as the time of the
    job, a null type as ``resource``; a record without an id gets no id line.
    Rows that occur twice give two records.  An empty table gives an archive
    without records.
    """
    register(records.sparkSession)
    types = dict(x.rsplit(" ", 1) for x in SCHEMA.split(", "))
    have = {c for c in records.columns}
    cols = {n: (F.col(f"`{n}`") if n in have else F.lit(None)).cast(t) for n, t in types.items() if n != "payload_length"}
    length = F.col("payload_length") if "payload_length" in have else F.octet_length(cols["payload"])
    cols["record_type"] = F.coalesce(cols["record_type"], F.lit("resource"))
    cols["payload_length"] = F.coalesce(length.cast("long"), F.lit(0))
    records.select(*[cols[n].alias(n) for n in types]).write.format("warc").mode(mode).options(
        **{k: str(v) for k, v in options.items()}).save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True, **options: object) -> DataFrame:
    """The records of an archive, in the columns of ``SCHEMA``, without the
    files' own ``warcinfo`` records.  Filters on header columns (equality,
    ``isin``, prefix, not null) reach the reader; ``payload=False`` decodes no
    payload at all.  A revisit's payload is null and its ``payload_length``
    that of the page it stands for."""
    register(spark)
    src = (spark.read.format("warc").option("payload", str(payload).lower())
           .option("cores", str(spark.sparkContext.defaultParallelism)))
    for k, v in options.items():
        src = src.option(k, str(v))
    return src.load(path).where(F.col("record_type").isin("response", "revisit", "resource", "request", "metadata",
                                                          "conversion", "continuation"))


# ---- which records are revisits ----------------------------------------------

def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits at a time to four digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def mark_revisits(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0,
                  broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``pages`` with payload (binary), payload_length, payload_digest,
    record_type and refers_to (an id, null for responses) added.

    Among equal payloads of at least ``min_bytes`` the largest id's is the
    response and the others revisit it; payloads are equal if SHA-256 and
    length are.  A null payload counts as empty.  A null id comes below all
    others; rows that share the largest id, or have none while no row of the
    group has one, are all responses.  The input's own columns of the added
    names are replaced.

    Payloads are not shuffled for it while the list of repeated ones is proven
    small; beyond that the most repeated (over a 2,000th of the rows each, so
    under 2,000) are joined by broadcast and the rest by shuffle.
    """
    rows = text_rows(pages).withColumn("payload", F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")))
    rows = (rows.withColumn("payload_length", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", base32_sha1(F.col("payload"))))
    key = F.when(F.col("payload_length") >= min_bytes, F.concat(F.sha2("payload", 256), F.lit("-"), F.col("payload_length")))
    k, top, hot_k, hot_top, n_of = fresh(rows, "key", "top", "hot_key", "hot_top", "n")
    groups = shared_table(
        rows.select(F.col(f"`{id_col}`").alias("id"), key.alias(k)).where(F.col(k).isNotNull())
        .groupBy(k).agg(F.max("id").alias(top), F.count("*").alias(n_of)).where(F.col(n_of) > 1), "warc-repeats")
    n_groups = groups.count()
    rows = rows.withColumn(k, key)
    if n_groups * 128 <= broadcast_bytes:
        rows = rows.join(F.broadcast(groups.drop(n_of)), k, "left")
    else:
        n_rows = rows.count()
        is_hot = F.col(n_of) > n_rows / 2000
        hot = groups.where(is_hot).select(F.col(k).alias(hot_k), F.col(top).alias(hot_top))
        rows = rows.join(F.broadcast(hot), F.col(k) == F.col(hot_k), "left")
        # rows that the first join served go to any task: their key meets no group
        spread_key = F.when(F.col(hot_k).isNull(), F.col(k)).otherwise(
            F.concat(F.lit("served-"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
        rows = (rows.withColumn(k, spread_key).join(groups.where(~is_hot).drop(n_of), k, "left")
                .withColumn(top, F.coalesce(top, hot_top)).drop(hot_k, hot_top))
    older = F.col(top).isNotNull() & ~F.col(f"`{id_col}`").eqNullSafe(F.col(top))
    return (rows.withColumn("record_type", F.when(older, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(older, F.col(top))).drop(k, top))

