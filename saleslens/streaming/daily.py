"""Structured Streaming versions of the daily load (X1) and daily revenue.

X1: staged orders and staged lines are two file streams of one query. Each micro-batch moves its rows to
the store's waiting tables, in one commit under a name made from the query's id (kept in the checkpoint)
and the epoch; at the end of a run the orders that have lines are loaded and leave the waiting tables in
the same commit. An order that is staged before its lines, or the other way round, waits for the other.

X2: purchases per day with a watermark and keyed state. Rows inside the watermark correct their day;
rows whose day is closed go to a side table instead of being dropped.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from saleslens.plans import daily
from saleslens.sources import files

WAITING = ("waiting_orders", "waiting_lines")
#: Side tables of X1: lines of orders that were loaded without them, and rows that waited too long.
SIDE = ("late_lines", "expired_orders", "expired_lines")


def stage_batch(orders_temp: DataFrame, details_temp: DataFrame, staging_root: str) -> None:
    """Land a staging batch as Parquet files."""
    root = staging_root.rstrip("/")
    orders_temp.write.mode("append").parquet(f"{root}/orders")
    details_temp.write.mode("append").parquet(f"{root}/details")


def _run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int, str], None]) -> str:
    """Process what is new (availableNow); ``each`` gets the rows, the epoch and the query's id.

    The id is made with the checkpoint and stays with it, whatever the folder is called.
    """
    known, got = threading.Event(), {}

    def batch(df: DataFrame, epoch: int) -> None:
        known.wait()
        each(df, epoch, got["id"])
    q = (stream.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    got["id"] = q.id
    known.set()
    q.awaitTermination()
    return q.id


# ---------------------------------------------------------------------------
# The daily load
# ---------------------------------------------------------------------------

def _staged(spark: SparkSession, root: str, max_files: int) -> DataFrame:
    """Both staging folders as one stream: (o, l), one of them null."""
    def one(folder: str):
        schema = spark.read.parquet(f"{root}/{folder}").schema
        return schema, spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{root}/{folder}")
    o_schema, orders = one("orders")
    l_schema, lines = one("details")
    pending = orders.where(~F.col("processed"))
    return (pending.select(F.struct(*o_schema.names).alias("o"), F.lit(None).cast(l_schema).alias("l"))
            .unionByName(lines.select(F.lit(None).cast(o_schema).alias("o"), F.struct(*l_schema.names).alias("l"))))


def _receive(store: daily.TableStore, name: str, batch: DataFrame) -> None:
    """Add a micro-batch to the waiting tables. What waits already is left out, so a replay adds nothing."""
    orders, lines = store.read("waiting_orders"), store.read("waiting_lines")
    new_orders = batch.where(F.col("o").isNotNull()).select("o.*").dropDuplicates(["SalesOrderID"])
    new_lines = batch.where(F.col("l").isNotNull()).select("l.*")
    store.commit(name, append={"waiting_orders": new_orders.join(orders, "SalesOrderID", "left_anti"),
                               "waiting_lines": new_lines.exceptAll(lines)})


def load_waiting(store: daily.TableStore, name: str, max_wait: int) -> None:
    """W12 for the waiting tables: orders that have lines are loaded, in one commit with what is left waiting.

    Orders that the history holds already leave the waiting table without being loaded again; their lines
    that the history doesn't hold go to ``late_lines``. Rows staged ``max_wait`` days before the newest
    waiting one go to the side tables, so the waiting tables stay bounded by the days they cover.
    """
    spark, work = store.spark, f"{store.root}/x1/{name}"
    orders, lines = store.read("waiting_orders"), store.read("waiting_lines")
    ids = orders.select("SalesOrderID").unionByName(lines.select("SalesOrderID")).distinct()
    known = spark.read.parquet(files.overwrite(daily.known_ids(store.read("header"), ids), f"{work}/known"))
    fresh = orders.join(known, "SalesOrderID", "left_anti")
    headers = spark.read.parquet(files.overwrite(daily.build_headers(fresh, lines), f"{work}/headers"))
    done = headers.select("SalesOrderID").unionByName(known)
    left_orders = orders.join(done, "SalesOrderID", "left_anti")
    left_lines = lines.join(done, "SalesOrderID", "left_anti")
    newest = (left_orders.select("modified_date").unionByName(left_lines.select("modified_date"))
              .agg(F.max("modified_date").cast("date").alias("d")).scalar())
    old = F.coalesce(F.date_diff(newest, F.col("modified_date").cast("date")) > max_wait, F.lit(False))
    of_known = lines.join(known, "SalesOrderID", "left_semi")
    held = store.read("detail").join(known, "SalesOrderID", "left_semi").select("SalesOrderDetailID")
    store.commit(name, append={
        "header": daily.header_rows(headers), "detail": daily.loaded_details(lines, headers),
        "late_lines": of_known.join(held, "SalesOrderDetailID", "left_anti").select(*lines.columns),
        "expired_orders": left_orders.where(old), "expired_lines": left_lines.where(old)},
        replace={"waiting_orders": left_orders.where(~old), "waiting_lines": left_lines.where(~old)})


def stream_daily_load(spark: SparkSession, store: daily.TableStore, staging_root: str, checkpoint: str,
                      max_files: int = 1000, max_wait: int = 365) -> None:
    """Consume new staging files once (availableNow), then load the orders that have lines.

    A run that dies after some micro-batches is resumed by the next: their rows wait in the store, and the
    checkpoint goes on behind them. ``max_files`` bounds the files of one micro-batch and folder. An order is
    loaded with the lines that are there at the end of a run, as the reference loads what is staged.
    """
    root = staging_root.rstrip("/")
    stream = _staged(spark, root, max_files)
    for n, folder in zip(WAITING + SIDE, ("orders", "details", "details", "orders", "details")):
        store.bases.setdefault(n, spark.createDataFrame([], spark.read.parquet(f"{root}/{folder}").schema))

    def receive(batch: DataFrame, epoch: int, query: str) -> None:
        if not store.has_batch(f"{query}-{epoch}"):     # else it was committed before the crash
            _receive(store, f"{query}-{epoch}", batch)
    query = _run_once(stream, checkpoint, receive)
    if not (store.read("waiting_orders").isEmpty() and store.read("waiting_lines").isEmpty()):
        load_waiting(store, f"{query}-load-{store.version()}", max_wait)


# ---------------------------------------------------------------------------
# Daily revenue
# ---------------------------------------------------------------------------

#: A day's rows are dealt to so many states, so that no day is one task's.
PARTS = 8
DAY_MS = 86_400_000
REVENUE_ROWS = ("WindowStart timestamp, part int, Revenue double, Purchases long, "
                "event_id long, ts timestamp, value double, kind string")


def revenue_by_day(events: DataFrame, delay: str) -> DataFrame:
    """X2 on a stream of (event_id, ts, event_type, value): rows of ``REVENUE_ROWS``.

    ``kind`` window: a day's new sum and count in one part; the latest row of a part counts. ``kind`` late:
    a purchase whose day ended at or before the watermark (the newest event time seen by the last batch, less
    ``delay``). State is a sum and a count for each day and part, so it grows with the days and not with the
    rows. (An event-time timeout would remove closed days, but then Spark drops late rows unseen.)
    """
    # Days are cut in the session zone.
    purchases = (events.where((F.col("event_type") == "purchase") & F.col("ts").isNotNull())
                 .select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value"))
                 .withWatermark("ts", delay))
    keyed = purchases.select("*", F.window("ts", "1 day")["start"].alias("WindowStart"),
                             F.pmod(F.xxhash64("event_id", "value"), F.lit(PARTS)).cast("int").alias("part"))

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, part = key
        closed = int(pd.Timestamp(start).timestamp() * 1000) + DAY_MS <= state.getCurrentWatermarkMs()
        revenue, n = state.get if state.exists else (0.0, 0)
        for pdf in batches:
            if closed:
                yield pd.DataFrame({"WindowStart": start, "part": part, "Revenue": None, "Purchases": None,
                                    "event_id": pdf["event_id"], "ts": pdf["ts"], "value": pdf["value"], "kind": "late"})
            else:
                revenue, n = revenue + float(pdf["value"].fillna(0.0).sum()), n + len(pdf)
        if closed:
            return
        state.update((revenue, n))
        yield pd.DataFrame({"WindowStart": [start], "part": [part], "Revenue": [revenue], "Purchases": [n],
                            "event_id": [None], "ts": [pd.NaT], "value": [None], "kind": ["window"]})
    return keyed.groupBy("WindowStart", "part").applyInPandasWithState(
        step, REVENUE_ROWS, "revenue double, n long", "update", GroupStateTimeout.NoTimeout)


def run_daily_revenue(spark: SparkSession, source_dir: str, sink: str, checkpoint: str,
                      delay: str = "3 days") -> tuple[DataFrame, DataFrame]:
    """Run X2 over the new files; (every day's totals, the late purchases) of all runs on the checkpoint.

    Each micro-batch writes its rows to a folder of its epoch, which a replay overwrites, below one of the
    query's id. A run that dies goes on from the checkpoint's state. A fresh checkpoint starts anew, with its
    own folder. Null values count as 0, events without a time are left out.
    """
    schema = spark.read.parquet(source_dir).schema
    events = spark.readStream.schema(schema).parquet(source_dir)

    def write(batch: DataFrame, epoch: int, query: str) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{sink.rstrip('/')}/{query}/epoch={epoch}")
    query = _run_once(revenue_by_day(events, delay), checkpoint, write)
    root = f"{sink.rstrip('/')}/{query}"
    nothing = spark.createDataFrame([], REVENUE_ROWS).drop("kind")
    nothing.write.mode("overwrite").parquet(f"{root}/epoch=-1/kind=none")       # so that there is something to read
    rows = spark.read.schema(f"{REVENUE_ROWS}, epoch int").parquet(root)
    latest = (rows.where("kind = 'window'").groupBy("WindowStart", "part")
              .agg(F.max_by(F.struct("Revenue", "Purchases"), "epoch").alias("x")))
    days = latest.groupBy("WindowStart").agg(F.sum("x.Revenue").alias("Revenue"), F.sum("x.Purchases").alias("Purchases"))
    return days, rows.where("kind = 'late'").select("event_id", "ts", "value", "WindowStart")


def all_revenue(days: DataFrame, late: DataFrame) -> DataFrame:
    """(WindowStart, WindowEnd, Revenue, Purchases): the days' totals with the late purchases added."""
    side = late.select("WindowStart", F.coalesce("value", F.lit(0.0)).alias("Revenue"), F.lit(1).cast("long").alias("Purchases"))
    start = F.col("WindowStart").cast("timestamp_ntz")
    return (days.unionByName(side).groupBy("WindowStart")
            .agg(F.round(F.sum("Revenue"), 6).alias("Revenue"), F.sum("Purchases").alias("Purchases"))
            .select(start.alias("WindowStart"), (start + F.expr("INTERVAL 1 DAY")).alias("WindowEnd"), "Revenue", "Purchases"))
