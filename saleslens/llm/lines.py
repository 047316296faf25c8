"""Line dedup: lines that many documents share go; DataFrame functions alone.

Every line is a hash of its key, its document and its position. The hashes are range-partitioned and
sorted by (hash, document, position): a range border may lie inside one hash, so a line that holds a
third of all rows is spread over many tasks, and every task streams its rows once to mark the first
occurrence in each document. First occurrences are summed before they meet, so a hash is one row a task.

What comes back is no text but a bitmap a document: 64 lines a word, words whose lines all stay left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.common import free_names, prepare, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = " \t\n\x0b\x0c\r"
#: A key with at least this part of all lines is hot. There are at most HOT such keys, so they are broadcast.
HOT = 4096


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def line_hashes(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(d, t, pos, h1, h2) for each line whose key has ``min_chars`` code points or more.

    d is doc_id and t a hash of the text: rows equal in both are one document. The key is the line with
    A-Z in lower case and white space stripped at both ends; (h1, h2) are 128 bits of it.
    """
    low = F.translate(_text(), UPPER, UPPER.lower())
    keys = F.transform(F.split(low, "\n"), lambda x: F.btrim(x, F.lit(SPACE)))
    lines = docs.select(F.col("doc_id").alias("d"), F.xxhash64(_text()).alias("t"), F.posexplode(keys).alias("pos", "key"))
    return lines.where(F.length("key") >= min_chars).select(
        "d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, n_rows, n_docs) of the hashes that ``min_docs`` documents or more have."""
    order = ["h1", "h2", "d", "t"]
    spread = lines.repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    before = F.lag(F.lit(1)).over(Window.partitionBy(*order).orderBy("pos"))
    firsts = spread.select("h1", "h2", F.when(before.isNull(), 1).otherwise(0).alias("first"))
    return (firsts.groupBy("h1", "h2").agg(F.count("*").alias("n_rows"), F.sum("first").alias("n_docs"))
            .where(F.col("n_docs") >= min_docs))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(d, t, n_dropped, keep) for each document that loses a line.

    ``keep`` lists (word, bits) in ascending order: bit i of word w is 1 if line 64 w + i stays. A word
    that isn't listed is all ones.
    """
    lines = written(line_hashes(docs, min_chars), "line-hashes")
    shared = written(shared_lines(lines, min_docs), "shared-lines")
    least = F.lit(lines.count())
    hot = F.broadcast(shared.where(F.col("n_rows") * HOT >= least).select("h1", "h2"))
    rest = shared.where(F.col("n_rows") * HOT < least).select("h1", "h2")
    gone = lines.join(hot, ["h1", "h2"], "left_semi").unionByName(
        lines.join(hot, ["h1", "h2"], "left_anti").join(rest, ["h1", "h2"], "left_semi"))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = gone.groupBy("d", "t", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("d", "t").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"))


def _dense(keep: Column) -> Column:
    """The listed words and, as -1, those before them."""
    def with_gap(e: Column, i: Column) -> Column:
        previous = F.when(i == 0, F.lit(-1)).otherwise(F.get(keep, i - 1)["word"])
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), e["word"] - previous - 1), F.array(e["bits"]))
    return F.flatten(F.transform(keep, with_gap))


def _joined(docs: DataFrame, min_docs: int, min_chars: int) -> tuple[DataFrame, Column, str]:
    """docs with the bitmap of each row, the column of kept text, and the column of dropped lines."""
    d, t, dropped, dense, own = free_names(docs, "d", "t", "n_dropped", "dense", "text_hash")
    found = keep_bitmaps(docs, min_docs, min_chars)
    maps = found.select(F.col("d").alias(d), F.col("t").alias(t), F.col("n_dropped").alias(dropped),
                        _dense(F.col("keep")).alias(dense))
    keyed = docs.withColumn(own, F.xxhash64(_text()))
    joined = keyed.join(maps, keyed["doc_id"].eqNullSafe(F.col(d)) & (F.col(own) == F.col(t)), "left")

    def stays(_: Column, i: Column) -> Column:
        word = F.coalesce(F.get(F.col(dense), F.floor(i / 64).cast("int")), F.lit(-1).cast("long"))
        return F.getbit(word, (i % 64).cast("int")) == 1
    kept = F.when(F.col(dropped).isNull(), F.col("text").cast("string")).otherwise(
        F.array_join(F.filter(F.split(_text(), "\n"), stays), "\n"))
    return joined, kept, dropped


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """docs, all columns, with the lines that ``min_docs`` documents or more share dropped from the text.

    Documents are told apart by (doc_id, text): repeated rows are one document and get the same text. A null
    doc_id is an id like others. A null text stays null and has one empty line, as an empty one; lines whose
    key has fewer than ``min_chars`` code points stay. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    joined, kept, _ = _joined(docs, min_docs, min_chars)
    return joined.withColumn("text", kept).select(*docs.columns)


def line_digests(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for each row of docs, as ``dedup_lines`` keeps them."""
    prepare(docs.sparkSession)
    joined, kept, dropped = _joined(docs.select("doc_id", "text"), min_docs, min_chars)
    return joined.select(
        "doc_id", F.size(F.split(_text(), "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.col(dropped), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"))
