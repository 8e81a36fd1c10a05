"""WARC archives of pages, compressed record by record with a shared Zstandard dictionary.

*Write.* One narrow pass groups equal payloads (SHA-256 of the UTF-8 html): the row with the largest id
is the group's ``response``, the others become ``revisit`` records that name it and carry no body. A
bounded sample of distinct payloads trains a Zstandard dictionary. Every task then writes its rows to
its own ``.warc.zst`` file: a leading skippable frame (magic 0x184D2A5D) that holds the dictionary, a
``warcinfo`` record, and each record as a frame of its own, so that any record can be read alone. A file
name is new for every attempt of a task, and the manifest (a table that Spark commits) names only the
files of attempts that ended, so a lost executor leaves no half archive among the results.

*Read.* The manifest cuts each file into ranges that begin and end with a record. A task reads the
dictionary frame, walks the frames of its range by their block headers, and checks the digests.

Only (digest, id) rows are shuffled. Payloads meet their group's response through a broadcast of the
repeated groups if their checked size is small. Otherwise groups with over 1/1000 of all rows (at most
1,000 of them) are broadcast and the others joined by shuffle, so no hot payload gathers in one task.

Defined results: null html is an empty payload; of rows repeated with the same id and payload exactly one
is the response; null ids are the smallest and are kept; other columns are ignored, so clashing names
are harmless; a null url writes no target; an empty table writes no archive and reads as no rows. Row
numbers tell repeated rows apart, so the input must be a repeatable scan (a written table).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import BROADCAST_BYTES, shared_dir, written

#: Rows, and bytes of each, that the dictionary (of so many bytes) is trained on.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 1000, 64 << 10, 64 << 10
#: Compressed bytes after which a task begins a new archive, and of one range of it.
ARCHIVE_BYTES, RANGE_BYTES = 1 << 30, 16 << 20
LEVEL = 3
#: Groups with more than this share of all rows are broadcast (at most 1 / HOT_SHARE of them).
HOT_SHARE = 0.001
DATE = "2024-01-01T00:00:00Z"
DICT_MAGIC = 0x184D2A5D
_IN = "rid long, id string, url string, payload binary, best string, again boolean"
_MANIFEST = "path string, start long, size long, records long"
_OUT = "id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(text: str) -> str:
    """A header value on one line: control characters and spaces are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else quote(c) for c in text)


def _urn(page_id: str | None, digest: str, own: str = "") -> str:
    return f"<urn:page:{'' if page_id is None else '+' + quote(page_id, safe='')}:{digest}{own}>"


def _urn_id(urn: str) -> str | None:
    name = urn.split(":")[2]
    return unquote(name[1:]) if name else None


def _record(kind: str, urn: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", urn), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", "sha1:" + _digest(block)), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id: str | None, url: str | None, payload: bytes, refers_to: tuple | None, own: str) -> bytes:
    """The record of a page: a response with its payload, or a revisit of the response (id,)."""
    digest = _digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", _field(url))] if url is not None else []
    fields += [("WARC-Payload-Digest", "sha1:" + digest), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is None:
        return _record("response", _urn(page_id, digest, own), fields, head + payload)
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
               ("WARC-Refers-To", _urn(refers_to[0], digest))]
    return _record("revisit", _urn(page_id, digest, own), fields, head)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises if its length or block digest is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not first.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    if fields.get("WARC-Block-Digest", "sha1:" + _digest(block)) != "sha1:" + _digest(block):
        raise ValueError(f"block digest of {fields.get('WARC-Record-ID')} differs")
    return fields, block


# ---- write -----------------------------------------------------------------------

def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    return pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))


def _marked(src: DataFrame, groups: DataFrame, total: int, min_bytes: int) -> DataFrame:
    """Rows with their group's response: ``best`` (its id) and ``again`` (whether they revisit it)."""
    src = src.withColumn("k", F.sha2("payload", 256))
    repeated = groups.filter((F.col("n") > 1) & (F.col("size") >= min_bytes)).select("k", "n", "best")
    cond = F.col("k") == F.col("gk")
    right = repeated.withColumnRenamed("k", "gk")
    count = repeated.count()
    if count * 200 <= BROADCAST_BYTES:
        joined = src.join(F.broadcast(right), cond, "left")
    else:
        hot = F.col("n") > HOT_SHARE * total                     # at most 1 / HOT_SHARE groups
        top = F.broadcast(right.filter(hot))
        joined = (src.join(top, cond, "inner")
                  .unionByName(src.join(top, cond, "left_anti").join(right.filter(~hot), cond, "left")))
    again = F.col("gk").isNotNull() & (F.col("rid") != F.col("best.rid"))
    return joined.select("rid", F.col("id").cast("string").alias("id"), "url", "payload",
                         F.col("best.id").cast("string").alias("best"), again.alias("again"))


def _dictionary(src: DataFrame, groups: DataFrame) -> bytes:
    """A dictionary of a bounded sample of distinct payloads; empty if there is too little text for one."""
    picked = (groups.filter(F.col("size").between(1, SAMPLE_BYTES)).orderBy("k").limit(SAMPLE_ROWS)
              .select(F.col("best.rid").alias("pick")))
    got = src.join(F.broadcast(picked), F.col("rid") == F.col("pick")).select("payload").collect()
    records = [page_record("0", "", bytes(r["payload"]), None, "") for r in got]
    try:
        return zstandard.train_dictionary(DICT_BYTES, records).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class _Archive:
    """One ``.warc.zst`` file of a task."""

    def __init__(self, root: str, dictionary: bytes):
        part = TaskContext.get().partitionId()
        self.path = f"{root}/pages-{part:06d}-{uuid.uuid4().hex}.warc.zst"
        fs, local = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(local, compression=None)     # frames are written as they are
        zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zd:
            zd.precompute_compress(level=LEVEL)
            self.out.write(struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd, write_checksum=True).compress
        self.at = 8 + len(dictionary) if zd else 0
        info = b"software: meridian\r\nformat: WARC File Format 1.1\r\n"
        self.add(_record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", [("Content-Type", "application/warc-fields")], info))
        self.ranges: list[tuple[int, int, int]] = []
        self.start, self.records = self.at, 0

    def add(self, record: bytes) -> None:
        frame = self.pack(record)
        self.out.write(frame)
        self.at += len(frame)

    def put(self, record: bytes) -> None:
        self.add(record)
        self.records += 1
        if self.at - self.start >= RANGE_BYTES:
            self.cut()

    def cut(self) -> None:
        if self.records:
            self.ranges.append((self.start, self.at - self.start, self.records))
        self.start, self.records = self.at, 0

    def close(self) -> pa.RecordBatch:
        self.cut()
        self.out.close()
        cols = list(zip(*self.ranges)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path] * len(self.ranges), pa.string()), *(pa.array(c, pa.int64()) for c in cols)],
            ["path", "start", "size", "records"])


def _write(root: str, dictionary, min_bytes: int, archive_bytes: int):
    def run(batches):
        archive = None
        for b in batches:
            cols = [b.column(c) for c in ("rid", "id", "url", "payload", "best", "again")]
            for i in range(b.num_rows):                    # one row's payload at a time
                rid, pid, url, payload, best, again = (c[i].as_py() for c in cols)
                archive = archive or _Archive(root, dictionary.value)
                # a group's response has the plain name, which its revisits refer to
                own = f":{rid}" if again or len(payload) < min_bytes else ""
                archive.put(page_record(pid, url, payload, (best,) if again else None, own))
                if archive.at >= archive_bytes:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()
    return run


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row as a WARC record under ``root`` (a folder all executors share).

    Returns the manifest: one row per range of an archive (path, start, size, records). Payloads
    shorter than ``min_bytes`` are written as responses each.
    """
    src = _rows(pages, id_col, url_col, html_col)
    # null ids sort first; of equal ids the later row stands for the group
    best = F.max(F.struct(F.col("id").isNotNull().alias("some"), "id", "rid")).alias("best")
    groups = written(src.select(F.sha2("payload", 256).alias("k"), F.length("payload").cast("long").alias("size"), "id", "rid")
                     .groupBy("k").agg(F.count("*").alias("n"), F.max("size").alias("size"), best), "warc-groups")
    total = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    dictionary = pages.sparkSession.sparkContext.broadcast(_dictionary(src, groups) if total else b"")
    marked = _marked(src, groups, total, min_bytes)
    return written(marked.mapInArrow(_write(root, dictionary, min_bytes, archive_bytes), _MANIFEST), "warc-manifest")


# ---- read ------------------------------------------------------------------------

def frame_end(buf: bytes, at: int) -> int | None:
    """End of the Zstandard or skippable frame that starts at ``at``; None if ``buf`` ends before it."""
    if len(buf) - at < 18 and len(buf) - at < 8:
        return None
    magic, size = struct.unpack_from("<II", buf, at)
    if magic & 0xFFFFFFF0 == 0x184D2A50:
        return at + 8 + size if at + 8 + size <= len(buf) else None
    try:
        p = at + zstandard.frame_header_size(buf[at:at + 18])
    except zstandard.ZstdError:
        return None
    check = 4 if buf[at + 4] & 4 else 0
    while True:
        if p + 3 > len(buf):
            return None
        head = int.from_bytes(buf[p:p + 3], "little")
        p += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)   # a run-length block holds one byte
        if head & 1:
            return p + check if p + check <= len(buf) else None


def read_range(path: str, start: int, size: int | None, chunk: int = 4 << 20):
    """Records (header fields, block) of a byte range of an archive; ``size`` None: to its end."""
    fs, local = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(local) as f:
        head = f.read(8)
        zd = None
        if len(head) == 8 and struct.unpack("<II", head)[0] == DICT_MAGIC:
            raw = f.read(struct.unpack("<II", head)[1])
            if raw[:4] == b"\x28\xb5\x2f\xfd":              # the dictionary itself may be compressed
                raw = zstandard.ZstdDecompressor().decompress(raw)
            zd = zstandard.ZstdCompressionDict(raw)
        unpack = zstandard.ZstdDecompressor(dict_data=zd)
        f.seek(start)
        left = f.size() - start if size is None else size
        buf, at = b"", 0
        while left or at < len(buf):
            end = frame_end(buf, at)
            if end is None:
                if not left:
                    raise ValueError(f"archive {path} ends inside a frame")
                more = f.read(min(left, max(chunk, len(buf) - at)))   # doubles for a frame longer than a chunk
                if not more:
                    raise ValueError(f"archive {path} ends before its range")
                left -= len(more)
                buf, at = buf[at:] + more, 0
                continue
            if struct.unpack_from("<I", buf, at)[0] & 0xFFFFFFF0 != 0x184D2A50:
                yield parse_record(unpack.decompressobj().decompress(buf[at:end]))
            at = end


def _read(keep_payload: bool):
    def batch(rows):
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = ["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def row(fields, block):
        kind, head = fields["WARC-Type"], block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            n = len(head[2])
            if _digest(head[2]) != digest:
                raise ValueError(f"payload digest of {fields['WARC-Record-ID']} differs")
        else:
            n = next(int(x.split(b":")[1]) for x in head[0].split(b"\r\n") if x.lower().startswith(b"content-length:"))
        to = fields.get("WARC-Refers-To")
        return (_urn_id(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, n, digest,
                _urn_id(to) if to else None, head[2] if keep_payload and kind == "response" else None)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                rows, held = [], 0
                for fields, block in read_range(r["path"], r["start"], r["size"]):
                    if fields["WARC-Type"] not in ("response", "revisit"):
                        continue
                    rows.append(row(fields, block))
                    held += len(block) if keep_payload else 200
                    if held >= 1 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_archives(manifest: DataFrame, *, keep_payload: bool = False, id_type: str = "long") -> DataFrame:
    """Records of the ranges in ``manifest`` (path, start, size): id, url, record_type, payload_bytes,
    payload_digest, refers_to and, of responses if ``keep_payload``, payload. Digests are checked."""
    ranges = manifest.select("path", "start", "size")
    n = max(1, min(ranges.count(), 100_000))
    got = ranges.repartition(n).mapInArrow(_read(keep_payload), _OUT)
    return got.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return f"{shared_dir(spark)}/llm-warc-{uuid.uuid4().hex[:12]}"
