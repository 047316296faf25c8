"""Daily batch load.

Tables live in a ``TableStore``. A load commits its headers, lines and staging flags together (the history
is never rewritten or copied); the test reset drops the load's segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.dates import as_date
from saleslens.functions.money import MONEY, line_total
from saleslens.sources import files

HEADER_COLS = ["SalesOrderID", "OrderDate", "DueDate", "ShipDate", "OnlineOrderFlag", "CustomerID",
               "SalesPersonID", "TerritoryID", "SubTotal", "modified_date"]
DETAIL_COLS = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice",
               "UnitPriceDiscount", "LineTotal", "SpecialOfferID"]


class DuplicateLoadError(RuntimeError):
    """Raised when a staged order id is already in the history (the reference's THROW 50001)."""


@dataclass
class TableStore:
    """Named tables under one root: a read-only base frame and Parquet segments.

    Base frames are read where they lie; a load writes its own rows only. Which segments are live stands
    in a manifest of a few rows, written as one file: ``commit`` writes the segments of all tables first
    and the next manifest last, so they become visible together or not at all, and a rerun after a crash
    writes the same paths again. A store opened on the same root sees the same tables. One writer at a time.
    """

    spark: SparkSession
    root: str
    bases: dict[str, DataFrame] = field(default_factory=dict)

    MANIFEST = "name string, path string, batch string"

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self._seen = 0
        self._rows: dict[str, int] = {}     # segments never change, so each is counted once

    def version(self) -> int:
        """The number of the newest manifest; 0 before the first commit."""
        return self._state()[0]

    def _state(self) -> tuple[int, list]:
        """The newest manifest's number and rows, and base frames that no manifest names yet.

        Manifests older than the newest that this store has seen are not read.
        """
        try:
            m = (self.spark.read.schema(self.MANIFEST + ", v int").parquet(f"{self.root}/_manifest")
                 .where(F.col("v") >= self._seen))
            rows = m.where(F.col("v") == m.select(F.max("v")).scalar()).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        live = [(r.name, r.path, r.batch) for r in rows]
        self._seen = rows[0].v if rows else 0
        return self._seen, live + [(n, None, None) for n in self.bases if n not in {name for name, _, _ in live}]

    def has_batch(self, batch: str) -> bool:
        return any(b == batch for _, _, b in self._state()[1])

    def _frame(self, name: str, rows: list) -> DataFrame:
        mine = [p for n, p, _ in rows if n == name]
        paths = [p for p in mine if p is not None]
        parts = ([self.bases[name]] if None in mine else []) + ([self.spark.read.parquet(*paths)] if paths else [])
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, name: str) -> DataFrame:
        return self._frame(name, self._state()[1])

    def rows(self, name: str, batch: str | None = None) -> int:
        """The table's rows, or those of one batch. A base frame is counted once a store, a segment once, from
        its files' footers."""
        total = 0
        for n, path, b in self._state()[1]:
            if n == name and batch in (None, b):
                key = path or f"base {name}"
                if key not in self._rows:
                    self._rows[key] = (self.bases[name] if path is None else self.spark.read.parquet(path)).count()
                total += self._rows[key]
        return total

    def segment(self, name: str, batch: str) -> DataFrame:
        """The rows that one batch appended to a table."""
        return self._frame(name, [r for r in self._state()[1] if r[2] == batch])

    def commit(self, batch: str, append: dict[str, DataFrame] | None = None,
               replace: dict[str, DataFrame] | None = None, drop: str | None = None) -> None:
        """Append and replace tables and drop another batch's segments, all in one step.

        A replacing frame may read the table it replaces: its rows go to a new segment.
        """
        version, live = self._state()
        rows = [r for r in live if drop is None or r[2] != drop]
        for name, df in (append or {}).items():
            rows.append((name, self._write(name, df, live, version + 1, batch), batch))
        for name, df in (replace or {}).items():
            new = self._write(name, df, live, version + 1, batch)
            rows = [r for r in rows if r[0] != name] + [(name, new, None)]
        m = self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1)
        files.overwrite(m, f"{self.root}/_manifest/v={version + 1}")

    def _write(self, name: str, df: DataFrame, live: list, version: int, batch: str) -> str:
        schema = self._frame(name, live).schema
        return files.overwrite(df.select(*[F.col(f.name).cast(f.dataType) for f in schema]),
                               f"{self.root}/{name}/{version}-{batch}")


def subtotals(details_temp: DataFrame) -> DataFrame:
    """G1: discounted value summed per order."""
    return details_temp.groupBy("SalesOrderID").agg(F.sum(line_total()).cast(MONEY).alias("SubTotal"))


def build_headers(orders_temp: DataFrame, details_temp: DataFrame) -> DataFrame:
    """Pending staged orders rebuilt as headers with their subtotal.

    Only orders with ``processed = false`` and at least one staged line qualify
    (the reference loaded every staged order and flagged all of them).
    """
    pending = orders_temp.where(~F.col("processed"))
    return (subtotals(details_temp).join(pending, "SalesOrderID")
            .select("SalesOrderID", "OrderDate", "DueDate", "ShipDate", "OnlineOrderFlag", "CustomerID",
                    "SalesPersonID", "TerritoryID", "SubTotal"))


def loaded_details(details_temp: DataFrame, headers: DataFrame) -> DataFrame:
    """Staged lines of the rebuilt orders, with the line value recomputed (F1)."""
    return (details_temp.join(headers.select("SalesOrderID"), "SalesOrderID", "left_semi")
            .select("SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID", "UnitPrice",
                    "UnitPriceDiscount", line_total().alias("LineTotal"), "SpecialOfferID"))


def pending_today(orders_temp: DataFrame, as_of) -> DataFrame:
    """Unprocessed staged orders modified on ``as_of``."""
    return orders_temp.where(~F.col("processed") & (F.col("modified_date").cast("date") == as_date(as_of)))


def load_audit(store: TableStore, batch: str) -> DataFrame:
    """(TableName, Stage, Rows) before and after a batch's load, from the rows that the load wrote.

    The history is counted once a store, not around each load; ``before`` is what stands now less the batch.
    """
    rows = []
    for name in ("header", "detail"):
        after = store.rows(name)
        rows += [(name, "before", after - store.rows(name, batch)), (name, "after", after)]
    return store.spark.createDataFrame(rows, "TableName string, Stage string, Rows long")


def mark(orders_temp: DataFrame, ids: DataFrame, processed: bool) -> DataFrame:
    """Set ``processed`` for the staged orders in ``ids``; others keep their flag."""
    hit = ids.select("SalesOrderID").distinct().withColumn("__hit", F.lit(True))
    return (orders_temp.join(hit, "SalesOrderID", "left")
            .withColumn("processed", F.when(F.col("__hit"), F.lit(processed)).otherwise(F.col("processed")))
            .select(*orders_temp.columns))


def header_rows(headers: DataFrame) -> DataFrame:
    """Rebuilt headers with the history's columns."""
    return headers.select(*[c for c in HEADER_COLS if c != "modified_date"],
                          F.lit(None).cast("date").alias("modified_date"))


def known_ids(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Order ids of the batch that the history holds already.

    The batch's id range goes to the history's scan, which skips files and row groups outside it; the
    batch is the small side of the semi join, so the history is not shuffled when the batch is measured small.
    """
    ids = batch.select("SalesOrderID")
    lo, hi = ids.agg(F.min("SalesOrderID"), F.max("SalesOrderID")).first()
    near = history.select("SalesOrderID").where(F.col("SalesOrderID").between(F.lit(lo), F.lit(hi)))
    return near.join(ids, "SalesOrderID", "left_semi").distinct()


def daily_load(store: TableStore, batch: str) -> None:
    """Guard, then headers, lines and staging flags in one commit; ``load_audit`` has its audit rows.

    The rebuilt headers are written once (used by the guard, the lines and the flag update) so the staging
    data is read once and the lineage is cut.
    """
    spark = store.spark
    hist_h, staged = store.read("header"), store.read("orders_temp")
    lines = store.read("daily_details_temp")
    if store.has_batch(batch):
        raise DuplicateLoadError(f"batch {batch} is loaded already; reset before reloading")
    helper = files.overwrite(build_headers(staged, lines), f"{store.root}/orderheader_temp/{batch}")
    headers = spark.read.parquet(helper)

    # Q4 guard: any rebuilt order already in history stops the load.
    if not known_ids(hist_h, headers).isEmpty():
        raise DuplicateLoadError("staged orders are already in the history; reset before reloading")

    store.commit(batch, append={"header": header_rows(headers), "detail": loaded_details(lines, headers)},
                 replace={"orders_temp": mark(staged, headers, True)})


def daily_gate(store: TableStore, as_of, batch: str) -> DataFrame:
    """Load only when today's pending staged orders exist; returns the decision row."""
    spark = store.spark
    n = pending_today(store.read("orders_temp"), as_of).count()
    if n > 0:
        daily_load(store, batch)
        action = "loaded"
    else:
        action = "no data for today"
    return spark.createDataFrame([(n, action)], "PendingRows long, Action string") \
        .select(as_date(as_of).alias("AsOf"), "PendingRows", "Action")


def daily_reset(store: TableStore, batch: str) -> bool:
    """Remove a batch's orders and lines and un-flag its orders in staging, in one commit.

    Works from any session that opens the store. The duplicate guard ensured that the history held none of
    the batch's order keys, so its segments hold exactly the rows to delete and no history is rewritten.
    False if the store holds no such batch.
    """
    if not store.has_batch(batch):
        return False
    keys = store.segment("header", batch).select("SalesOrderID")
    store.commit(f"{batch}-reset", replace={"orders_temp": mark(store.read("orders_temp"), keys, False)}, drop=batch)
    return True


def table_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one table and not the other, counting duplicates (exceptAll both ways)."""
    return a.exceptAll(b).unionByName(b.exceptAll(a))
