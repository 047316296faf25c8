"""Sources and sinks.

Tables are Parquet directories. Writes never target the path being read:
a change writes a new version directory and the caller switches to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.dates import as_date


def read_csv_positional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Quoted UTF-8 CSV, header row skipped, fields bound by position, all text.

    The enforced schema binds by position whatever the header says; quotes are
    RFC 4180 (a doubled quote escapes a quote). Empty fields read as NULL.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
            .option("encoding", "UTF-8").option("enforceSchema", True).csv(path))


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where=None) -> DataFrame:
    """Table scan with column pruning and a pushed-down filter."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def copy_with_casts(df: DataFrame, casts: dict[str, str], load_date=None,
                    stamp_col: str = "LoadDate") -> DataFrame:
    """S3: the copy's projection: each column cast to its target type, plus a load-date stamp."""
    cols = [F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    if load_date is not None:
        cols.append(as_date(load_date).alias(stamp_col))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append(df: DataFrame, path: str) -> str:
    """Add new files to a table directory; existing files are not rewritten."""
    return write_table(df, path, "append")


def overwrite(df: DataFrame, path: str) -> str:
    """Replace a table's content (the input must not be read from ``path``)."""
    return write_table(df, path, "overwrite")


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header row, RFC 4180 quoting."""
    df.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Co-located layout for repeated joins: rows hash-bucketed and sorted on ``key``.

    Written as an external table at ``path`` (under the shared folder). Two tables
    bucketed on the same key with the same bucket count join without shuffling
    either side, e.g. order lines and order headers on SalesOrderID.
    """
    (df.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A named, lazily evaluated view usable from SQL."""
    df.createOrReplaceTempView(name)
    return df


def normalize_columns(df: DataFrame, required: list[str], aliases: dict[str, str] | None = None) -> DataFrame:
    """Resolve column names case-insensitively, apply aliases, fail when one is missing.

    ``aliases`` maps an alternative (any casing) to the canonical name, e.g.
    ``{"DiscountPct": "UnitPriceDiscount"}``. Only the schema is inspected.
    """
    lower = {c.lower(): c for c in df.columns}
    for alt, canon in (aliases or {}).items():
        if canon.lower() not in lower and alt.lower() in lower:
            lower[canon.lower()] = lower[alt.lower()]
    missing = [c for c in required if c.lower() not in lower]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    rename = {lower[c.lower()]: c for c in required if lower[c.lower()] != c}
    return df.withColumnsRenamed(rename) if rename else df
