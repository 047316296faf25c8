"""S1 for files with damaged rows: good rows typed as before, the others kept with their line.

Every line is read once, as text, and judged by its quotes and its number of fields (RFC 4180). So a row that
would shift, lose or glue fields never gets into the good rows, and nothing is lost: each line but the header
and empty ones is in exactly one of the two results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands between no two fields of a text file; a line that holds it is still read whole (see lines()).
_NO_SEPARATOR = "\x01"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(File, Line): the lines of CSV files without each file's first, whole and unparsed; empty lines are left out."""
    raw = (spark.read.schema("value string, damaged string").option("header", True).option("sep", _NO_SEPARATOR)
           .option("quote", "").option("escape", _NO_SEPARATOR).option("enforceSchema", True).option("encoding", "UTF-8")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "damaged").csv(path))
    return raw.select(F.col("_metadata.file_path").alias("File"), F.coalesce("damaged", "value").alias("Line")) \
        .where("Line is not null")


def _outside(line: Column) -> Column:
    """The pieces of a line outside of quotes: those between an even number of quote signs and the next."""
    return F.filter(F.split(line, '"', -1), lambda piece, i: i % 2 == 0)


def bad_quotes(line: Column) -> Column:
    """Whether a quote is left open, or stands inside a field that doesn't begin and end with one."""
    pieces = F.split(line, '"', -1)
    n = F.size(pieces)
    # Between two quoted stretches stands nothing (a doubled quote) or commas at both ends.
    wrong = F.filter(pieces, lambda x, i: (i % 2 == 0) & (x != "")
                     & (((i > 0) & ~x.startswith(",")) | ((i < n - 1) & ~x.endswith(","))))
    return (n % 2 == 0) | (F.size(wrong) > 0)


def field_count(line: Column) -> Column:
    """Fields of a line whose quotes are good."""
    return F.aggregate(_outside(line), F.lit(1), lambda n, x: n + F.length(x) - F.length(F.replace(x, F.lit(","))))


def judged(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(File, Line, Reason): Reason is null for good lines, else 'quotes', 'short' or 'long'."""
    line, n = F.col("Line"), len(columns)
    reason = (F.when(bad_quotes(line), "quotes").when(field_count(line) < n, "short").when(field_count(line) > n, "long"))
    return lines(spark, path).withColumn("Reason", reason)


def read_csv_quarantined(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of the CSV files at ``path``, header rows skipped.

    good: the columns by position, all text, as read_csv_positional gives them. quarantine: (File, Line, Reason),
    repeated lines as often as they stand in the files. A file with its header alone has no row in either.
    """
    rows = judged(spark, path, columns)
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("Line", schema, {"quote": '"', "escape": '"'})
    good = rows.where("Reason is null").select(parsed.alias("row")).select("row.*")
    return good, rows.where("Reason is not null")
