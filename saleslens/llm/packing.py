"""Packing by shortest-pack-first over the length histogram.

Documents are tokenized once and cut at every ``length`` ids; only the histogram of the pieces' lengths
(at most ``length`` counts) goes to the driver. There lengths are placed from the longest down: each goes
into the pack with the most room left (the shortest), and what changes is the number of packs of a
pattern, never a single pack. A length that fits in no pack opens new ones. Patterns go back to pieces
by rank: a piece's rank among those of its length says which pack of which pattern it is in.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.common import clean, prepare, tidy, trim, written
from saleslens.llm.tokens import encoder

LENGTH = 2048
#: Pieces of one length that are numbered in one group.
GROUP = 20_000
PIECES = "row_id long, doc_id long, start long, length int, ids_crc32 long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int, keep_ids: bool = True) -> DataFrame:
    """One row for each piece of each row of docs: its ids as little-endian unsigned 32-bit integers, and their crc32."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end, n = np.uint32(end_id).tobytes(), TaskContext.get().partitionId() << 40
        for pdf in batches:
            out = []
            for doc, ids in zip(clean(pdf["doc_id"]), encoder(tokenizer).encode(clean(pdf["text"]))):
                ids += end
                for at in range(0, len(ids), 4 * length):
                    part = ids[at:at + 4 * length]
                    out.append((n, doc, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part if keep_ids else None))
                    n += 1
            frame = pd.DataFrame(out, columns=["row_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            yield frame.astype({"doc_id": "Int64"})
        trim()                     # the worker lives on with what it remembers; the batches' memory goes back
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInPandas(run, PIECES)


def shortest_pack_first(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern of lengths, number of packs): all of counts placed, longest first, into the shortest packs."""
    room: dict[int, list[list]] = defaultdict(list)     # room left: [packs, pattern]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            most = max(room, default=0)
            if most < size:
                room[length - size].append([left, (size,)])
                break
            pack = room[most][-1]
            use = min(left, pack[0])
            room[most - size].append([use, pack[1] + (size,)])
            pack[0] -= use
            left -= use
            if not pack[0]:
                room[most].pop()
                if not room[most]:
                    del room[most]
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for packs in room.values():
        for n, pattern in packs:
            merged[pattern] += n
    return sorted(merged.items())


def ranges(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset) in ascending order of rank: of the pieces of this
    length, those from that rank on lie at that offset of consecutive sequences. Its size is that of the patterns."""
    next_rank: dict[int, int] = defaultdict(int)
    rows: dict[int, list] = defaultdict(list)
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for size in pattern:
            rows[size].append((next_rank[size], sequence, offset))
            next_rank[size] += n
            offset += size
        sequence += n
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def place(cut: DataFrame, length: int) -> DataFrame:
    """The columns of cut (a written table of pieces, without ids) with sequence_id and offset."""
    light = cut.drop("ids")
    counts = {r["length"]: r["n"] for r in light.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = ranges(shortest_pack_first(counts, length))
    # A length's pieces are numbered in groups of about GROUP; a group starts where those before it end.
    # The table of group counts has a row for each length, at most ``length`` of them.
    groups = cut.sparkSession.createDataFrame([(size, -(-n // GROUP)) for size, n in counts.items()], "length int, groups long")
    cells = light.join(F.broadcast(groups), "length").withColumn("cell", F.pmod(F.xxhash64("row_id"), "groups"))
    sizes = cells.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(
        Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))).drop("n")
    ranked = (cells.withColumn("in_cell", F.row_number().over(Window.partitionBy("length", "cell").orderBy("row_id")) - 1)
              .join(before, ["length", "cell"]).withColumn("rank", F.col("in_cell") + F.coalesce("before", F.lit(0)))
              .select(*light.columns, "rank"))

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, rank = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = where[int(size)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = row[:, 1] + rank[at] - row[:, 0], row[:, 2]
            yield pdf.drop(columns="rank").assign(sequence_id=sequence, offset=offset)
    # Tidy: pieces are cut and written by now, and what the workers remember of the encoder would stay while others' stages run.
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in light.schema.fields)
    return ranked.mapInPandas(tidy(locate), f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(placed, cut) for docs (doc_id, text; other columns are ignored).

    cut is a written table of all pieces with their ids; placed has the same rows without ids and with the
    sequence and offset of each. Null and empty texts are one piece, the end id. Rows that share a doc_id
    or have none are separate documents (row_id tells their pieces apart). No rows in, no rows out.
    """
    prepare(docs.sparkSession)
    cut = written(pieces(docs, tokenizer, end_id, length), "pieces")
    return place(cut, length), cut


def sequences(placed: DataFrame, cut: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids): the packed sequences, padded to ``length``, but for those whose ids are a power of two."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pad = np.uint32(pad_id).tobytes()
        for pdf in batches:
            out = []
            for parts in pdf["parts"]:
                ids = b"".join(p["ids"] for p in parts)
                n = len(ids) // 4
                out.append(ids if n & (n - 1) == 0 else ids + pad * (length - n))
            yield pd.DataFrame({"sequence_id": pdf["sequence_id"], "ids": out})
    return (placed.select("row_id", "sequence_id", "offset").join(cut.select("row_id", "ids"), "row_id")
            .groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .mapInPandas(run, "sequence_id long, ids binary"))
