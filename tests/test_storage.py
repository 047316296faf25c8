"""Damaged CSV rows, tables replaced by part, distinct counts from bitmaps."""
import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from saleslens.operators import bitmaps
from saleslens.plans import insights
from saleslens.sources import files, partitioned, quarantine

HEADER = "a,b,c\n"
GOOD = ['1,2,3', '"a""b","c,d",e', ',,', '"x",y,"z"', '"""q""",,""', 'é,\\,"\\"', '"1,2","3,4","5,6"', 'a\tb\x01,c,d']
BAD = {'1,2': "short", 'x': "short", '1,2,3,4': "long", '"a,b",c,d,e': "long", '"ab"c,d,e': "quotes", 'a,"b"x,c': "quotes",
       'a,b,"c': "quotes", '"a,b,c': "quotes", 'a,b"q,c': "quotes", '""x,b,c': "quotes", 'a""b,c,d': "quotes", '",a,b': "quotes"}


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "".join(x + "\n" for x in lines))


def local(path):
    return path.removeprefix("file:")


def test_damaged_rows_are_quarantined_with_their_line(spark, work):
    path, clean = work("csv"), work("csv")
    put(local(path), "one.csv", GOOD + [""] + list(BAD))
    put(local(path), "two.csv", list(BAD)[:1] + GOOD)
    put(local(path), "none.csv", [])
    put(local(clean), "one.csv", GOOD + GOOD)
    good, bad = quarantine.read_csv_quarantined(spark, path, ["a", "b", "c"])
    want = files.read_csv_positional(spark, clean, ["a", "b", "c"])
    assert good.columns == want.columns
    assert sorted(map(str, good.collect())) == sorted(map(str, want.collect()))
    rows = bad.collect()
    assert sorted((r.Line, r.Reason) for r in rows) == sorted([*BAD.items(), list(BAD.items())[0]])
    assert {os.path.basename(r.File) for r in rows if r.Line == "1,2"} == {"one.csv", "two.csv"}


def test_a_quoted_field_with_very_many_quotes_is_judged(spark, work):
    path = work("csv")
    put(local(path), "one.csv", ['"' + '""' * 50_000 + '",b,c', '"' + '""' * 50_000 + ',b,c'])
    good, bad = quarantine.read_csv_quarantined(spark, path, ["a", "b", "c"])
    assert [len(r.a) for r in good.collect()] == [50_000]
    assert [r.Reason for r in bad.collect()] == ["quotes"]


def stamps(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(local(path) + "/OrderYear=*/*.parquet")}


def test_one_year_is_replaced_and_the_others_stay(spark, work):
    rows = [(i, dt.date(1998 + i % 4, 1 + i % 12, 3)) for i in range(200)] + [(900, None)]
    df = partitioned.by_year(spark.createDataFrame(rows, "id int, OrderDate date"))
    path = partitioned.write_partitioned(df, work("years"), "OrderYear")
    before = stamps(path)
    table = partitioned.read_partitioned(spark, path, df.schema)
    assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
    new = table.where("OrderYear = 2000 and id > 20").unionByName(
        partitioned.by_year(spark.createDataFrame([(1000, dt.date(2000, 5, 5))], "id int, OrderDate date")))
    want = sorted(map(str, df.where("OrderYear is null or OrderYear <> 2000").unionByName(new).collect()))
    partitioned.replace_parts(new, path, "OrderYear")               # reads the year that it replaces
    after = stamps(path)
    assert sorted(map(str, partitioned.read_partitioned(spark, path, df.schema).collect())) == want
    same = {f: t for f, t in before.items() if "OrderYear=2000" not in f}
    assert same and all(after.get(f) == t for f, t in same.items())
    assert not any(f in after for f in before if "OrderYear=2000" in f)
    partitioned.replace_parts(new.limit(0), path, "OrderYear")      # nothing to replace
    assert stamps(path) == after


def test_folders_are_pruned_by_filters_and_by_joins(spark, work):
    rows = [(i, dt.date(1998 + i % 4, 1, 3)) for i in range(40)]
    df = partitioned.by_year(spark.createDataFrame(rows, "id int, OrderDate date"))
    table = partitioned.read_partitioned(spark, partitioned.write_partitioned(df, work("years"), "OrderYear"), df.schema)
    plan = table.where("OrderYear = 1999")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(OrderYear" in plan
    years = spark.createDataFrame([(1999, "x"), (2000, "y")], "OrderYear int, kind string").where("kind = 'x'")
    joined = table.join(F.broadcast(years), "OrderYear")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString().lower()
    assert joined.count() == 10


def headers(spark, rows):
    return spark.createDataFrame(rows, "SalesOrderID long, CustomerID long, OrderDate date")


def some_orders():
    out = [(i, (i * i * 7919) % 90_000 - 5, dt.date(1999 + i % 3, 1 + (i * 5) % 12, 1 + i % 28)) for i in range(3000)]
    return out + [(5000, 40_000, dt.date(2002, 2, 1)), (5001, 40_000, dt.date(2002, 2, 9)), (5002, None, dt.date(2002, 2, 9)),
                  (5003, 2**40, dt.date(2002, 2, 9)), (5004, -2**40, dt.date(2002, 2, 9))]


def test_cohorts_from_bitmaps_are_those_of_the_orders(spark):
    df = headers(spark, some_orders())
    got = bitmaps.cohorts(bitmaps.month_customers(df))
    want = insights.cohort_retention(df.where("CustomerID is not null"))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert bitmaps.cohorts(bitmaps.month_customers(df.limit(0))).count() == 0


def test_a_new_month_adds_its_bitmaps_alone(spark, work):
    rows = some_orders()
    old, new = [r for r in rows if r[2] < dt.date(2002, 1, 1)], [r for r in rows if r[2] >= dt.date(2002, 1, 1)]
    first = bitmaps.month_customers(headers(spark, old)).withColumn("OrderYear", F.year("Month"))
    path = partitioned.write_partitioned(first, work("bitmaps"), "OrderYear")
    before = stamps(path)
    partitioned.replace_parts(bitmaps.month_customers(headers(spark, new)).withColumn("OrderYear", F.year("Month")), path, "OrderYear")
    after = stamps(path)
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)
    stored = partitioned.read_partitioned(spark, path, first.schema)
    got = bitmaps.cohorts(stored.drop("OrderYear"))
    want = insights.cohort_retention(headers(spark, rows).where("CustomerID is not null"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_distinct_counts_merge(spark):
    df = headers(spark, some_orders()).withColumn("y", F.year("OrderDate"))
    a, b = (bitmaps.bitmaps(df.where(f"SalesOrderID % 2 = {i}"), ["y"], "CustomerID") for i in (0, 1))
    got = {r.y: r.Distinct for r in bitmaps.distinct_counts(a.unionByName(b), ["y"]).collect()}
    want = {r.y: r.n for r in df.groupBy("y").agg(F.count_distinct("CustomerID").alias("n")).collect()}
    assert got == want


def test_the_history_is_joined_once_and_a_year_is_replaced_from_its_stored_rows(spark, monkeypatch):
    from saleslens.catalog import storage
    from saleslens.catalog.pipelines import loaded_fact
    from saleslens.plans import fact as fact_plan
    from saleslens.sources.fixtures import SalesTables
    t = SalesTables.of(spark, SF_SMALL)
    want = sorted(map(str, loaded_fact(spark, t).collect()))
    made, rows = fact_plan.fact_sales_margin, []

    def counted(detail, *args, **kw):
        rows.append(detail.count())
        return made(detail, *args, **kw)
    monkeypatch.setattr(fact_plan, "fact_sales_margin", counted)
    found = storage.q_sink_overwrite_partitions(spark, SF_SMALL)
    assert sorted(map(str, found.collect())) == want
    assert len(rows) == 2 and 0 < rows[1] <= t.daily_details_temp.count() < rows[0]


def test_rows_that_are_dealt_already_are_written_without_a_shuffle(spark, work):
    df = spark.range(1000, numPartitions=3).selectExpr("id", "id % 2 as side")
    path = partitioned.write_partitioned(df, work("dealt"), "side", rebalance=False)
    assert {len(glob.glob(f"{local(path)}/side={k}/*.parquet")) for k in (0, 1)} == {3}
    assert partitioned.read_partitioned(spark, path, df.schema).count() == 1000


def test_staged_tables_are_read_not_computed_again(spark):
    from saleslens.catalog.pipelines import staged_store
    from saleslens.sources.fixtures import SalesTables
    store = staged_store(spark, SalesTables.of(spark, SF_SMALL))
    for name in ("orders_temp", "daily_details_temp"):
        plan = store.read(name)._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "Join" not in plan and "Exchange" not in plan
