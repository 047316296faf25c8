"""Registered streaming operators X1, X2."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslens.catalog import register
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.catalog.pipelines import staged_store
from saleslens.session import fresh_dir
from saleslens.sources.fixtures import SalesTables
from saleslens.streaming import daily as sd


@register("stream_daily_load", with_ctes("SELECT * FROM detail_after_load", "detail_after_load"))
def q_stream_daily_load(spark, sf_dir):
    """Staging files streamed into the history, every third order's lines one run after the order; a replay
    with a fresh checkpoint adds nothing."""
    t = SalesTables.of(spark, sf_dir)
    store = staged_store(spark, t)
    staging, checkpoint = fresh_dir(spark, "staging"), fresh_dir(spark, "x1")
    later = F.col("SalesOrderID") % 3 == 0
    sd.stage_batch(t.orders_temp, t.daily_details_temp.where(~later), staging)
    sd.stream_daily_load(spark, store, staging, checkpoint)
    sd.stage_batch(t.orders_temp.limit(0), t.daily_details_temp.where(later), staging)
    sd.stream_daily_load(spark, store, staging, checkpoint)
    sd.stream_daily_load(spark, store, staging, fresh_dir(spark, "x1-replay"))
    return store.read("detail")


@register("stream_daily_revenue",
          "SELECT time_bucket(INTERVAL 1 DAY, ts) AS WindowStart, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY "
          "AS WindowEnd, round(sum(value), 6) AS Revenue, count(*) AS Purchases FROM events WHERE event_type = "
          "'purchase' GROUP BY 1, 2")
def q_stream_daily_revenue(spark, sf_dir):
    """Daily purchase revenue of the events, which arrive in three runs, a part of them late: the days that the
    stream keeps up to its watermark, with the side table's rows added."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    source, sink, checkpoint = (fresh_dir(spark, f"x2-{n}") for n in ("source", "sink", "ckpt"))
    run = F.when(F.col("event_id") % 40 == 0, 2).when(F.dayofmonth("ts") > 15, 1).otherwise(0)
    for n in range(3):
        events.where(run == n).write.mode("append").parquet(source)
        days, late = sd.run_daily_revenue(spark, source, sink, checkpoint)
    return sd.all_revenue(days, late)
