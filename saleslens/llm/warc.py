"""WARC archives: writing with revisit records, and a salvage reader.

A record is one gzip member. The reader checks each: the member's own checksum, the version line, the
content length, the block digest and, for responses, the payload digest. After a failed check it searches
for the next place where a valid member (or, in plain archives, a version line) starts, goes on from there,
and logs the bytes between as a quarantined gap. Members may hold several records, as in archives compressed as a
whole: they are unpacked as a stream and searched for the next version line in the same way. What was
unpacked before a member's error stays if it is valid; a member's only record needs the member's checksum, too.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, prepare, written
from saleslens.session import fresh_dir

#: Payloads below this many bytes are always stored.
LEAST = 1000
#: Bytes of one block at most; a longer one is taken for damage. A value of Spark's is below 2 GiB, so all that is written fits.
LONGEST = (1 << 31) + (1 << 20)
#: Bytes read at a time, and packed bytes unpacked at a time.
CHUNK, PIECE = 1 << 20, 1 << 14
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("5d0c1c5e-6a39-5c0f-9d6e-3f8f1c1f7a11")


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = "2000-01-01T00:00:00Z") -> bytes:
    """One record, not compressed: a response, or a revisit if refers_to is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "urn:none")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", target), ("WARC-Payload-Digest", _digest(payload)), ("WARC-Block-Digest", _digest(block)),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to)), ("X-Refers-To-Page-ID", str(refers_to))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    head: dict[str, str]
    block: bytes
    at: int

    @property
    def payload_bytes(self) -> int:
        """Of the full payload; a revisit has it in the stored HTTP header."""
        m = re.search(rb"(?im)^content-length:\s*(\d+)", self.block.split(b"\r\n\r\n", 1)[0])
        return int(m[1]) if m else max(0, len(self.block) - self.block.find(b"\r\n\r\n") - 4)

    @property
    def payload(self) -> bytes:
        return self.block.split(b"\r\n\r\n", 1)[1] if b"\r\n\r\n" in self.block else self.block

    @property
    def payload_hex(self) -> str:
        return base64.b32decode(self.head["warc-payload-digest"].removeprefix("sha1:")).hex()


@dataclass
class Gap:
    at: int
    to: int
    reason: str


class _Window:
    """A sliding view of a stream: what lies before ``done`` is dropped."""

    def __init__(self, stream):
        self.stream, self.buf, self.start, self.ended = stream, bytearray(), 0, False

    def more(self) -> bool:
        part = b"" if self.ended else self.stream.read(CHUNK)
        self.ended = not part
        self.buf += part
        return bool(part)

    def reach(self, size: int) -> bool:
        """Reads on to so many bytes, or the end; whether there are more than before."""
        before = len(self.buf)
        while len(self.buf) < size and self.more():
            pass
        return len(self.buf) > before

    def upto(self, at: int) -> None:
        del self.buf[:at - self.start]
        self.start = at


def _parse(data: bytes | bytearray, at: int) -> tuple[Record | None, int, str]:
    """A record at the start of data, how many bytes it takes, and why not; a length below 0: so many bytes are needed."""
    if not VERSION.match(data):
        return None, (-10 if len(data) < 10 and b"WARC/1.1\r\n".startswith(bytes(data[:7])) else 0), "no version line"
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None, -2 * len(data), "header without an end"
    head = {}
    for line in bytes(data[:end]).split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if colon:
            head[k.decode("utf-8", "replace").strip().lower()] = v.decode("utf-8", "replace").strip()
    if not re.fullmatch(r"\d{1,10}", head.get("content-length", "")):
        return None, 0, "no content length"
    n = int(head["content-length"])
    if n > LONGEST:
        return None, 0, "too long"
    if len(data) < end + 4 + n + 4:
        return None, -(end + 8 + n), "cut short"
    block = bytes(data[end + 4:end + 4 + n])
    if data[end + 4 + n:end + 8 + n] != b"\r\n\r\n":
        return None, 0, "no end mark after the block"
    if head.get("warc-block-digest", "").startswith("sha1:") and head["warc-block-digest"] != _digest(block):
        return None, 0, "block digest"
    r = Record(head, block, at)
    if head.get("warc-type") == "response" and head.get("warc-payload-digest", "").startswith("sha1:") and head["warc-payload-digest"] != _digest(r.payload):
        return None, 0, "payload digest"
    return r, end + 8 + n, ""


def _next(w: _Window) -> tuple[Record | None, int, str]:
    """The record at the window's start, read on as far as it needs."""
    r, n, why = _parse(w.buf, w.start)
    while r is None and n < 0 and w.reach(-n):
        r, n, why = _parse(w.buf, w.start)
    return r, n, why


class _Member:
    """The gzip member at the start of a window as a stream of its unpacked bytes, up to its end or first error (``why``)."""

    def __init__(self, w: _Window):
        self.w, self.d, self.at, self.before, self.start, self.safe = w, zlib.decompressobj(31), w.start, w.start, w.start, w.start
        self.why = self.lost = ""

    @property
    def end(self) -> int:
        return self.at - len(self.d.unused_data)

    def read(self, _size: int) -> bytes:
        while not self.d.eof and not self.why:
            i = self.at - self.w.start
            if i == len(self.w.buf) and not self.w.more():
                self.why = "member cut short"
                break
            part = bytes(self.w.buf[i:i + PIECE])
            again = zlib.decompressobj(31) if self.at == self.start else self.d.copy()
            self.before, self.at = self.at, self.at + len(part)
            try:
                got = self.d.decompress(part)
            except zlib.error as e:
                self.why, got = f"member: {e}", b"".join(_till_error(again, part))
            if got:
                return got
        return b""

    def records(self) -> Iterator[Record]:
        """Valid records; ``lost`` says what failed first between them, ``safe`` up to where the raw bytes are surely the member's."""
        v, some = _Window(self), False
        while v.buf or v.more():
            r, n, why = _next(v)
            if r is not None:
                v.upto(v.start + n)
                r.at, safe = self.start, self.before
                alone = not some and not (v.buf or v.more())
                if alone and self.why:
                    return
                some, self.safe = True, safe
                self.w.upto(max(safe, self.w.start))
                yield r
                continue
            self.lost = self.lost or why
            while (m := v.buf.find(b"WARC/1.", 1)) < 0:
                v.upto(v.start + max(0, len(v.buf) - 8))
                if not v.more():
                    return
            v.upto(v.start + m)


def _till_error(d, part: bytes) -> Iterator[bytes]:
    """What can be unpacked of part before its error."""
    try:
        for i in range(len(part)):
            yield d.decompress(part[i:i + 1])
    except zlib.error:
        return


def read_warc(stream) -> Iterator[Record | Gap]:
    """Valid records in order, and the gaps between them. Plain and compressed records may be mixed. A gap in a member of
    several records has the member's place (after an error, its place from the last valid record on) and follows them."""
    w = _Window(stream)
    bad: tuple[int, str] | None = None
    while True:
        if len(w.buf) < 16 and not w.ended:
            w.more()
            continue
        if not w.buf:
            break
        skip = 1
        if w.buf.startswith(MEMBER):
            m, some = _Member(w), False
            for r in m.records():
                if bad:
                    yield Gap(bad[0], m.start, bad[1])
                    bad = None
                some = True
                yield r
            if not m.why:
                if some and m.lost:
                    yield Gap(m.start, m.end, m.lost)
                elif not some:
                    bad = bad or (m.start, m.lost or "no record")
                w.upto(m.end)
                continue
            bad = bad or (m.safe, m.why)
            skip = 0 if w.start > m.start else 1
        else:
            r, n, why = _next(w)
            if r is not None:
                if bad:
                    yield Gap(bad[0], w.start, bad[1])
                    bad = None
                yield r
                w.upto(w.start + n)
                continue
            bad = bad or (w.start, why)
        while True:                      # the next place where a record may start
            at = min((i for i in (w.buf.find(MEMBER, skip), w.buf.find(b"WARC/1.", skip)) if i >= 0), default=-1)
            if at >= 0:
                w.upto(w.start + at)
                break
            w.upto(w.start + max(0, len(w.buf) - 8))
            if not w.more():
                w.upto(w.start + len(w.buf))
                break
    if bad:
        yield Gap(bad[0], w.start, bad[1])


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) for pages whose payload of LEAST bytes or more a page with a larger id has too."""
    light = pages.where("bytes >= %d and page_id is not null" % LEAST).select("page_id", "digest")
    last = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return light.join(last, "digest").where("page_id < refers_to").distinct()


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes one record for each row of pages (page_id, url, html); returns the written manifest (shard, path, n).

    A null html is an empty payload. Rows without page_id are responses and nothing refers to them. Rows that share
    a page_id are separate records, revisits or not as that id is. Shards are in order of page_id. A task that runs
    again writes a file of another name; the manifest has only the finished task's.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or fresh_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    again = written(revisits(rows.select("page_id", "digest", "bytes")), "revisits")
    full = rows.select("page_id", "url", "payload", "digest").join(again, ["page_id", "digest"], "left")
    # A revisit's block has no payload, but its digest and length are of the full one.

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        out, n = None, 0
        for pdf in batches:
            if len(pdf) and out is None:
                store.create_dir(base, recursive=True)
                path = f"{base}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz"
                out = store.open_output_stream(path, compression=None)
            for page, url, payload, to in zip(*(clean(pdf[c]) for c in ("page_id", "url", "payload", "refers_to"))):
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                rec = record(None if page is None else int(page), url, bytes(payload), None if to is None else int(to))
                out.write(z.compress(rec) + z.flush())
                n += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"shard": [TaskContext.get().partitionId()], "path": [path], "n": [n]})
    return written(full.repartitionByRange("page_id", "url").sortWithinPartitions("page_id", "url")
                   .mapInPandas(run, "shard int, path string, n long"), "manifest")


def read_archives(manifest: DataFrame, folder: str = "", whole: bool = False) -> DataFrame:
    """(kind, page_id, url, payload_bytes, payload_digest, record_type, refers_to, path, at, to, reason) of each record (kind
    'record') and each quarantined gap (kind 'gap'). whole: fails if an archive has other than the manifest's n records."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, n in zip(pdf["path"], pdf["n"] if whole else [None] * len(pdf)):
                store = fs.FileSystem.from_uri(folder)[0] if ":" in folder else fs.LocalFileSystem()
                rows, records = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    for x in read_warc(f):
                        if isinstance(x, Gap):
                            rows.append(("gap", None, None, None, None, None, None, path, x.at, x.to, x.reason))
                        else:
                            records += 1
                            page, to = x.head.get("x-page-id"), x.head.get("x-refers-to-page-id")
                            rows.append(("record", page and int(page), x.head.get("warc-target-uri"), x.payload_bytes, x.payload_hex,
                                         x.head.get("warc-type"), to and int(to), path, x.at, None, None))
                        if len(rows) == 5000:
                            yield _frame(rows)
                            rows = []
                if whole and records != n:
                    raise ValueError(f"{path}: {records} records read, {n} written")
                yield _frame(rows)
    return manifest.repartition(max(1, manifest.count())).mapInPandas(
        run, "kind string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "path string, at long, to long, reason string")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    f = pd.DataFrame(rows, columns=["kind", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "at", "to", "reason"])
    return f.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "at", "to")})
