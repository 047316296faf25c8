"""Token files of patched frame-of-reference blocks.

A shard holds the ids of consecutive documents in blocks of 128. A block stores its minimum; each id less
the minimum is packed at the width that holds ``PERCENTILE`` of the block's values, and the others are
kept whole in the block's exception list (their packed bits are zero). An index of block starts and a
table of documents follow, so that a document is read from the blocks it touches alone.

Layout, little-endian: magic; blocks, each: minimum u32, width u8, exceptions u8, packed 16*width bytes,
exception places u8 each, exception values u32 each; index u64 for each block; document table i64 doc_id,
u8 whether the id is null, u64 tokens before it; footer u64 blocks, documents, tokens, index start, crc32 of
index and table; magic. The last block is filled up with its minimum.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.common import clean, prepare, trim, written
from saleslens.llm.tokens import encoder
from saleslens.session import fresh_dir

MAGIC, BLOCK, PERCENTILE = b"PFORBLK1", 128, 0.9
FOOTER = struct.Struct("<QQQQQ")
#: Blocks encoded or decoded at once.
AT_ONCE = 4096


def _widths(top: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(top.astype(np.float64) + 1)).astype(np.int64)


def _bits(v: np.ndarray, width: int) -> np.ndarray:
    """Rows of values packed at width bits, most significant first: rows of BLOCK/8*width bytes."""
    full = 16 if width <= 16 else 32
    b = np.unpackbits(v.astype(f">u{full // 8}").view(np.uint8).reshape(len(v), BLOCK, full // 8), axis=2)[:, :, full - width:]
    return np.packbits(b.reshape(len(v), BLOCK * width), axis=1)


def _unbits(raw: np.ndarray, width: int) -> np.ndarray:
    full = 16 if width <= 16 else 32
    b = np.zeros((len(raw), BLOCK, full), np.uint8)
    if width:
        b[:, :, full - width:] = np.unpackbits(raw, axis=1).reshape(len(raw), BLOCK, width)
    return np.packbits(b, axis=2).view(f">u{full // 8}").reshape(len(raw), BLOCK).astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of the blocks of ids (a multiple of BLOCK long), and the lengths of the blocks in bytes."""
    v = ids.reshape(-1, BLOCK)
    low = v.min(axis=1)
    v = v - low[:, None]
    place = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _widths(np.partition(v, place, axis=1)[:, place])
    over = v >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    count = over.sum(axis=1)
    sizes = 6 + width * (BLOCK // 8) + 5 * count
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    head = np.empty((len(v), 6), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5] = width, count
    out[begin[:, None] + np.arange(6)] = head
    packed = np.where(over, 0, v)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        out[(begin[at] + 6)[:, None] + np.arange(BLOCK // 8 * w)] = _bits(packed[at], int(w))
    row, place = np.nonzero(over)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = (begin + 6 + width * (BLOCK // 8))[row]
        out[at + nth] = place
        out[(at + count[row] + 4 * nth)[:, None] + np.arange(4)] = v[over].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), sizes


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that start at the given places of raw."""
    buf = np.frombuffer(raw, np.uint8)
    head = buf[starts[:, None] + np.arange(6)]
    low = head[:, :4].copy().view("<u4").ravel()
    width, count = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    out = np.empty((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = _unbits(buf[(starts[at] + 6)[:, None] + np.arange(BLOCK // 8 * w)], int(w))
    total = int(count.sum())
    if total:
        row = np.repeat(np.arange(len(starts)), count)
        nth = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        begin = starts + 6 + width * (BLOCK // 8)
        place = buf[begin[row] + nth]
        value = buf[(begin[row] + count[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        out[row, place] = value
    return (out + low[:, None]).ravel()


class ShardWriter:
    """Streams documents into one shard; holds at most AT_ONCE blocks of ids and the index."""

    def __init__(self, stream):
        self.stream, self.at, self.tokens = stream, len(MAGIC), 0
        self.waiting, self.n_waiting = [], 0
        self.index: list[np.ndarray] = []
        self.docs: list[tuple[int, int, int]] = []
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.tokens))
        v = np.frombuffer(ids, "<u4")
        self.tokens += len(v)
        self.waiting.append(v)
        self.n_waiting += len(v)
        if self.n_waiting >= AT_ONCE * BLOCK:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        v = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        whole = len(v) // BLOCK * BLOCK
        rest = v[whole:]
        if last and len(rest):
            v = np.concatenate([v, np.full(BLOCK - len(rest), rest.min(), np.uint32)])
            whole, rest = len(v), v[:0]
        for lo in range(0, whole, AT_ONCE * BLOCK):
            raw, sizes = encode_blocks(v[lo:min(lo + AT_ONCE * BLOCK, whole)])
            self.index.append(self.at + np.cumsum(sizes) - sizes)
            self.stream.write(raw)
            self.at += len(raw)
        self.waiting, self.n_waiting = [rest], len(rest)

    def close(self) -> None:
        self._flush(last=True)
        index = np.concatenate(self.index) if self.index else np.empty(0, np.int64)
        ids, null, before = (np.array(x) for x in zip(*self.docs))
        tail = index.astype("<u8").tobytes() + ids.astype("<i8").tobytes() + null.astype(np.uint8).tobytes() + before.astype("<u8").tobytes()
        self.stream.write(tail + FOOTER.pack(len(index), len(self.docs), self.tokens, self.at, zlib.crc32(tail)) + MAGIC)


def read_shard(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document of a shard, in order. stream: a seekable pyarrow file."""
    end = stream.size()
    stream.seek(end - FOOTER.size - len(MAGIC))
    foot = stream.read(FOOTER.size + len(MAGIC))
    if foot[-len(MAGIC):] != MAGIC:
        raise ValueError("not a token shard, or cut short")
    n_blocks, n_docs, tokens, at, crc = FOOTER.unpack(foot[:FOOTER.size])
    stream.seek(at)
    tail = stream.read(end - at - FOOTER.size - len(MAGIC))
    if zlib.crc32(tail) != crc:
        raise ValueError("a token shard's index is damaged")
    index = np.append(np.frombuffer(tail, "<u8", n_blocks).astype(np.int64), at)
    ids = np.frombuffer(tail, "<i8", n_docs, 8 * n_blocks)
    null = np.frombuffer(tail, np.uint8, n_docs, 8 * (n_blocks + n_docs))
    ends = np.append(np.frombuffer(tail, "<u8", n_docs, 8 * (n_blocks + n_docs) + n_docs).astype(np.int64), tokens)
    have, have_from, block = np.empty(0, np.uint32), 0, 0
    for i in range(n_docs):
        lo, hi = ends[i], ends[i + 1]
        parts = [have[lo - have_from:]]
        while sum(map(len, parts)) < hi - lo:
            upto = min(block + AT_ONCE, n_blocks)
            stream.seek(int(index[block]))
            raw = stream.read(int(index[upto] - index[block]))
            parts.append(decode_blocks(raw, index[block:upto] - index[block]))
            block = upto
        have = np.concatenate(parts) if len(parts) > 1 else parts[0]
        have_from = lo
        yield (None if null[i] else int(ids[i])), have[:hi - lo]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the ids of docs (doc_id, text) in ascending doc_id order into shards; returns their manifest
    (shard, path, n_docs, n_tokens), a written table. Shards are in order of doc_id and so are the documents in them.

    Null and empty texts have the end id alone. Rows without doc_id come first; rows that share a doc_id
    are separate documents, in order of a hash of their text. A task that is run again writes another file
    under another name, and only the finished task's is in the manifest. No rows in, no shards out.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or fresh_dir(spark, "tokens")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        shard, out, n_docs = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if len(pdf) and out is None:
                store.create_dir(base, recursive=True)
                path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.pfor"
                stream = store.open_output_stream(path)
                out = ShardWriter(stream)
            end = np.uint32(end_id).tobytes()
            for doc, ids in zip(clean(pdf["doc_id"]), encoder(tokenizer).encode(clean(pdf["text"]))):
                out.add(doc, ids + end)
                n_docs += 1
        if out is not None:
            out.close()
            stream.close()
            trim()                 # the worker lives on with what it remembers; the batches' memory goes back
            yield pd.DataFrame({"shard": [shard], "path": [path], "n_docs": [n_docs], "n_tokens": [out.tokens]})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInPandas(run, "shard int, path string, n_docs long, n_tokens long"), "manifest")


def read_tokens(manifest: DataFrame, folder: str | None = None, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document, from the shards of a manifest; ids are null unless
    they are to be kept."""
    uri = folder or ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, start in zip(pdf["path"], pdf["before"]):
                store = fs.FileSystem.from_uri(uri)[0] if ":" in uri else fs.LocalFileSystem()
                with store.open_input_file(path) as f:
                    out, held = [], 0
                    for doc, ids in read_shard(f):
                        raw = ids.astype("<u4").tobytes()
                        out.append((doc, start, len(ids), zlib.crc32(raw), raw if keep_ids else None))
                        start += len(ids)
                        held += len(ids) * keep_ids
                        if len(out) == 2000 or held > AT_ONCE * BLOCK:
                            yield _frame(out)
                            out, held = [], 0
                    yield _frame(out)
    # One row a shard: the sums before them are over the manifest, not over documents.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before)
    return shards.repartition(max(1, manifest.count())).mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"]).astype({"doc_id": "Int64"})
