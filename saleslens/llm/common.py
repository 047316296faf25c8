"""Helpers that the operators share: reading, words, work tables, key hashes, worker memory."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.session import fresh_dir, work_root

#: Bytes of an Arrow batch: texts can be long, so rows alone don't bound it. One text is never cut.
ARROW_BYTES = "8m"


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (texts can be long) and a checkpoint folder, if none is set."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    work_root(spark)
    ship(spark)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python once an application: they may not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="saleslens-code-"), "saleslens_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_held: dict[str, dict] = {}


def release() -> None:
    """Lets go this Python worker's caches and gives freed memory back to the system. Workers live on between
    stages, and what they or their allocators keep counts against the executor while other stages run."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    trim()


def trim() -> None:
    """Gives freed memory of this process back to the system."""
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give is not None:
        give(0)


def worker_cache(name: str) -> dict:
    """This worker's cache of one operator; taking it up lets go those of others."""
    if name not in _held:
        release()
        _held[name] = {}
    return _held[name]


def tidy(fn: Callable) -> Callable:
    """fn over batches, with the worker's memory given back before and after."""
    def run(batches):
        release()
        yield from fn(batches)
        release()
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: they are computed once, read by column,
    and survive the loss of the executors that made them."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes to differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes, unchanged; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The words with A-Z (only) in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id, mod: int) -> int:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode()) % mod


def fold_column(col, mod: int):
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def rows_of(batches: Iterable[pd.DataFrame], *cols: str) -> Iterator[tuple]:
    for pdf in batches:
        yield from zip(*(clean(pdf[c]) for c in cols))


def clean(s: pd.Series) -> list:
    """Values with None for null (pandas turns null integers into NaN)."""
    return [None if v is None or v is pd.NA or v != v else v for v in s.tolist()]
