"""Registered pipelines W1-W19."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslens.catalog import register
from saleslens.catalog.oracle_ctes import with_ctes
from saleslens.plans import fact as fact_plan
from saleslens.plans import model
from saleslens.sources.fixtures import SalesTables

FACT_SELECT = ("SalesOrderID, SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount, LineTotal, "
               "SpecialOfferID, OrderDate, DueDate, ShipDate, OnlineOrderFlag, CustomerID, StandardCost, "
               "SalesPersonID, TerritoryID, modified_date, ProductMargin, ProductMarginPct")


def sales_fact(t: SalesTables):
    return fact_plan.fact_sales_margin(t.detail_all, t.header_hist, t.cost_history)   # the join keeps history lines


@register("fact_sales_margin", with_ctes(f"SELECT {FACT_SELECT} FROM fact", "fact"))
def q_fact_sales_margin(spark, sf_dir):
    """The margin fact: one row per history line with a cost valid on its order date."""
    return sales_fact(SalesTables.of(spark, sf_dir))


# ---------------------------------------------------------------------------
# Commercial-action monitoring: report export -> CSV -> import -> snapshot -> monitoring
# ---------------------------------------------------------------------------
import datetime as dt  # noqa: E402

from saleslens.catalog import oracle_ctes as oc  # noqa: E402
from saleslens.plans import monitoring as mon  # noqa: E402
from saleslens.session import fresh_dir  # noqa: E402
from saleslens.sources import files  # noqa: E402
from saleslens.sources.fixtures import ACTION_IMPORT_COLUMNS, AS_OF, HISTORY_END  # noqa: E402

SNAPSHOT_DATE = HISTORY_END   # the action was opened on the last history day
LOAD_BATCH = f"load-{AS_OF}"      # the staged batch, loaded after the snapshot


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _rev_pairs_sql(as_of: dt.date, fact: str = "fact") -> str:
    a = _d(as_of)
    return ("SELECT t.Name AS Country, p.Subcategory, "
            f"CAST(SUM(CASE WHEN f.OrderDate >= make_date(year({a}), 1, 1) AND f.OrderDate < {a} + 1 "
            "THEN f.LineTotal ELSE 0 END) AS DECIMAL(38,4)) AS CurrentRevenue, "
            f"CAST(SUM(CASE WHEN f.OrderDate >= make_date(year({a}) - 1, 1, 1) AND f.OrderDate < "
            f"make_date(year({a}), 1, 1) THEN f.LineTotal ELSE 0 END) AS DECIMAL(38,4)) AS PreviousYearRevenue "
            f"FROM {fact} f JOIN dim_product p ON f.ProductID = p.ProductID "
            "JOIN territory t ON f.TerritoryID = t.TerritoryID GROUP BY t.Name, p.Subcategory")


def _goal_sql(prev: str, as_of: dt.date) -> str:
    a = _d(as_of)
    return (f"CAST({prev} AS DOUBLE) / NULLIF(datediff('day', make_date(year({a}) - 1, 1, 1), "
            f"make_date(year({a}), 1, 1)), 0) * (datediff('day', make_date(year({a}), 1, 1), {a}) + 1) * 1.3012")


def _money_text(x: str) -> str:
    v = f"CAST({x} AS DECIMAL(18,2))"
    return f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END || '€ ' || format('{{:,.2f}}', abs({v})))"


def _pct_text(x: str) -> str:
    v = f"CAST({x} * 100 AS DECIMAL(18,2))"
    return f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END || format('{{:,.2f}}', abs({v})) || '%')"


from saleslens.operators.joins import small_side  # noqa: E402
from saleslens.plans import daily  # noqa: E402

oc.add("built_headers",
       "SELECT p.SalesOrderID, p.OrderDate, p.DueDate, p.ShipDate, p.OnlineOrderFlag, p.CustomerID, "
       "p.SalesPersonID, p.TerritoryID, s.SubTotal FROM (SELECT SalesOrderID, CAST(SUM(CAST(CAST(UnitPrice * "
       "OrderQty AS DECIMAL(19,4)) * CAST(1 - UnitPriceDiscount AS DECIMAL(10,4)) AS DECIMAL(19,4))) AS "
       "DECIMAL(19,4)) AS SubTotal FROM daily_details_temp GROUP BY SalesOrderID) s JOIN orders_temp p ON "
       "s.SalesOrderID = p.SalesOrderID WHERE NOT p.processed")
oc.add("loaded_details",
       "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, d.ProductID, d.UnitPrice, d.UnitPriceDiscount, "
       "CAST(CAST(d.UnitPrice * d.OrderQty AS DECIMAL(19,4)) * CAST(1 - d.UnitPriceDiscount AS DECIMAL(10,4)) AS "
       "DECIMAL(19,4)) AS LineTotal, d.SpecialOfferID FROM daily_details_temp d WHERE d.SalesOrderID IN "
       "(SELECT SalesOrderID FROM built_headers)")
DETAIL_SQL_COLS = ", ".join(daily.DETAIL_COLS)
HEADER_SQL_COLS = ", ".join(daily.HEADER_COLS)
oc.add("detail_after_load",
       f"SELECT {DETAIL_SQL_COLS} FROM detail_hist UNION ALL SELECT {DETAIL_SQL_COLS} FROM loaded_details")
oc.add("header_after_load",
       f"SELECT {HEADER_SQL_COLS} FROM header_hist UNION ALL SELECT SalesOrderID, OrderDate, DueDate, ShipDate, "
       "OnlineOrderFlag, CustomerID, SalesPersonID, TerritoryID, SubTotal, CAST(NULL AS DATE) AS modified_date "
       "FROM built_headers")
oc.add("fact_loaded",
       "SELECT d.ProductID, d.LineTotal, h.OrderDate, h.TerritoryID FROM detail_after_load d JOIN header_after_load h "
       "ON d.SalesOrderID = h.SalesOrderID JOIN cost_history c ON d.ProductID = c.ProductID AND h.OrderDate >= "
       "c.StartDate AND h.OrderDate <= coalesce(c.EndDate, DATE '9999-12-31')")
oc.add("rev_pairs_asof", _rev_pairs_sql(AS_OF, "fact_loaded"))
oc.add("rev_pairs_snap", _rev_pairs_sql(SNAPSHOT_DATE))
oc.add("vs_goal_snap",
       "SELECT Country, Subcategory, CurrentRevenue, PreviousYearRevenue, CurrentGoal, "
       "CAST(CurrentRevenue AS DOUBLE) / NULLIF(CurrentGoal, 0.0) - 1.0 AS PercCurrentGoal, "
       "CAST(CurrentRevenue AS DOUBLE) - CurrentGoal AS DeltaCurrentGoal FROM (SELECT *, "
       f"{_goal_sql('PreviousYearRevenue', SNAPSHOT_DATE)} AS CurrentGoal FROM rev_pairs_snap) g")
oc.add("prioritised_snap",
       "SELECT *, ['High','Medium','Low'][ntile(3) OVER (ORDER BY DeltaCurrentGoal, Country, Subcategory)] "
       "AS PriorityType FROM vs_goal_snap WHERE DeltaCurrentGoal < 0")
oc.add("report_export",
       f"SELECT Subcategory, Country, {_money_text('CurrentRevenue')} AS CurrentRevenues, "
       f"{_money_text('CurrentGoal')} AS CurrentGoalRevenues, {_pct_text('PercCurrentGoal')} AS PercCurrentGoal, "
       f"{_money_text('DeltaCurrentGoal')} AS DeltaCurrentGoal, PriorityType FROM prioritised_snap")
oc.add("action_import",
       "SELECT " + ", ".join(f"NULLIF({c}, '') AS {c}" for c in ACTION_IMPORT_COLUMNS) +
       " FROM (SELECT * FROM report_export UNION ALL SELECT * FROM action_import_fixed) u")


def _clean_num(col: str, strip: list[str], dtype: str) -> str:
    x = col
    for ch in strip:
        x = f"replace({x}, '{ch}', '')"
    return (f"CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN TRY_CAST({x} AS {dtype}) END")


def _currency_sql(col: str) -> str:
    return _clean_num(col, ["€", ",", '"', " "], "DECIMAL(18,2)")


def _percent_sql(col: str) -> str:
    return _clean_num(col, ["%", '"', " "], "DECIMAL(18,4)")


oc.add("snapshot",
       f"SELECT {_d(SNAPSHOT_DATE)} AS SnapshotDate, Subcategory, Country, PriorityType, "
       f"{_currency_sql('CurrentRevenues')} AS SnapshotRevenue, {_percent_sql('PercCurrentGoal')} AS "
       f"PercCurrentSnapshotGoal, {_currency_sql('DeltaCurrentGoal')} AS DeltaCurrentSnapshotGoal, "
       f"{_currency_sql('CurrentGoalRevenues')} AS CurrentSnapshotGoal FROM action_import")
oc.add("monitoring",
       "SELECT s.SnapshotDate, s.Country, s.Subcategory, s.PriorityType, s.SnapshotRevenue, s.CurrentSnapshotGoal, "
       "s.PercCurrentSnapshotGoal, s.DeltaCurrentSnapshotGoal, c.CurrentRevenue, "
       f"{_goal_sql('c.PreviousYearRevenue', AS_OF)} AS CurrentGoalToDate FROM snapshot s LEFT JOIN "
       "rev_pairs_asof c ON c.Country = s.Country AND c.Subcategory = s.Subcategory")


def loaded_fact(spark, t: SalesTables):
    """The fact over the history and the staged batch, after the daily load."""
    store = staged_store(spark, t)
    daily.daily_load(store, LOAD_BATCH)
    return fact_plan.fact_sales_margin(store.read("detail"), store.read("header"), t.cost_history)


def loaded_batch(spark, t: SalesTables):
    """(store, fact of the staged batch's own rows) after the daily load."""
    store = staged_store(spark, t)
    daily.daily_load(store, LOAD_BATCH)
    return store, fact_plan.fact_sales_margin(store.segment("detail", LOAD_BATCH), store.segment("header", LOAD_BATCH), t.cost_history)


def current_pairs(t: SalesTables, as_of, fact=None):
    dim_p = model.dim_product(t.product, t.product_subcategory, t.product_category)
    return mon.revenue_by_pair(sales_fact(t) if fact is None else fact, dim_p, t.territory, as_of)


def export_at_snapshot(t: SalesTables, pairs=None):
    vs = mon.current_vs_goal(current_pairs(t, SNAPSHOT_DATE) if pairs is None else pairs, SNAPSHOT_DATE)
    return mon.report_export(mon.prioritise(vs))


def import_via_csv(spark, t: SalesTables, pairs=None):
    """Report export (plus the dirty rows) written as CSV, then read back by position."""
    path = fresh_dir(spark, "action-import")
    files.write_csv(export_at_snapshot(t, pairs).unionByName(t.action_import), path)
    return files.read_csv_positional(spark, path, ACTION_IMPORT_COLUMNS)


def snapshot_table(spark, t: SalesTables, pairs=None):
    """W16 + S5: the cleaned snapshot replaces the previous one; later steps read the written table."""
    path = fresh_dir(spark, "action-snapshot")
    files.overwrite(mon.snapshot_from_import(import_via_csv(spark, t, pairs), SNAPSHOT_DATE), path)
    return spark.read.parquet(path)


def snapshot_and_current(spark, t: SalesTables):
    """(snapshot, current pairs after the daily load as of AS_OF). The history's fact is summed once by product and territory
    for both days; the load adds the sums of its own rows. The guard keeps a batch's orders apart from the history's,
    so the fact of the loaded tables is that of the history and that of the batch."""
    dim_p = model.dim_product(t.product, t.product_subcategory, t.product_category)
    history = mon.revenue_by_key(sales_fact(t), {"_snap": SNAPSHOT_DATE, "_now": AS_OF}).checkpoint(eager=True)
    snapshot = snapshot_table(spark, t, mon.pairs_of_keys(history, dim_p, t.territory, "_snap"))
    _, batch = loaded_batch(spark, t)
    now = ["ProductID", "TerritoryID", "cur_now", "prev_now"]
    keys = history.select(*now).unionByName(mon.revenue_by_key(batch, {"_now": AS_OF}).select(*now))
    return snapshot, mon.pairs_of_keys(keys, dim_p, t.territory, "_now")


@register("doc_current_vs_goal", with_ctes("SELECT * FROM vs_goal_snap", "vs_goal_snap"))
def q_doc_current_vs_goal(spark, sf_dir):
    """D3: goal formula for every (Country, Subcategory) at the snapshot date."""
    return mon.current_vs_goal(current_pairs(SalesTables.of(spark, sf_dir), SNAPSHOT_DATE), SNAPSHOT_DATE)


@register("doc_prioritisation", with_ctes(
    "SELECT Country, Subcategory, CurrentRevenue, CurrentGoal, PercCurrentGoal, DeltaCurrentGoal, PriorityType "
    "FROM prioritised_snap", "prioritised_snap"))
def q_doc_prioritisation(spark, sf_dir):
    """Pairs behind goal at the snapshot date, ranked High / Medium / Low by gap tercile."""
    t = SalesTables.of(spark, sf_dir)
    vs = mon.current_vs_goal(current_pairs(t, SNAPSHOT_DATE), SNAPSHOT_DATE)
    return mon.prioritise(vs).select("Country", "Subcategory", "CurrentRevenue", "CurrentGoal",
                                     "PercCurrentGoal", "DeltaCurrentGoal", "PriorityType")


@register("src_csv_positional", with_ctes("SELECT * FROM action_import", "action_import"))
def q_src_csv_positional(spark, sf_dir):
    """S1 (+S6): the commercial-action CSV read back by position, all text."""
    return import_via_csv(spark, SalesTables.of(spark, sf_dir))


@register("snapshot_create", with_ctes("SELECT * FROM snapshot", "snapshot"))
def q_snapshot_create(spark, sf_dir):
    """Import, clean, stamp, replace the snapshot, return it."""
    return snapshot_table(spark, SalesTables.of(spark, sf_dir))


@register("action_monitoring", with_ctes("SELECT * FROM monitoring", "monitoring"))
def q_action_monitoring(spark, sf_dir):
    """Frozen snapshot vs current-year revenue and goal to date (flagship)."""
    return mon.action_monitoring(*snapshot_and_current(spark, SalesTables.of(spark, sf_dir)), AS_OF)


@register("doc_recovery_kpis", with_ctes(
    "SELECT Country, Subcategory, PriorityType, CAST(DeltaCurrentSnapshotGoal AS DOUBLE) AS InitialGap, "
    "0.5 * abs(CAST(DeltaCurrentSnapshotGoal AS DOUBLE)) AS ExpectedRecovery, "
    "(CAST(CurrentRevenue AS DOUBLE) - CurrentGoalToDate) - CAST(DeltaCurrentSnapshotGoal AS DOUBLE) AS ActualRecovery, "
    "((CAST(CurrentRevenue AS DOUBLE) - CurrentGoalToDate) - CAST(DeltaCurrentSnapshotGoal AS DOUBLE)) / "
    "NULLIF(0.5 * abs(CAST(DeltaCurrentSnapshotGoal AS DOUBLE)), 0.0) AS Achievement FROM monitoring", "monitoring"))
def q_doc_recovery_kpis(spark, sf_dir):
    """Recovery KPIs on top of the monitoring view."""
    m = mon.action_monitoring(*snapshot_and_current(spark, SalesTables.of(spark, sf_dir)), AS_OF)
    return mon.recovery_kpis(m, 0.5)


# ---------------------------------------------------------------------------
# Database build: timeline shift, open latest, dimensions
# ---------------------------------------------------------------------------
SHIFT_TO = dt.date(2026, 11, 30)   # the "today" the history is moved to


def _shift_sql(col: str, src: str = "header_all") -> str:
    return (f"CAST({_d(SHIFT_TO)} + CAST(datediff('day', (SELECT max(OrderDate) FROM {src}), {col}) AS INTEGER) "
            "AS DATE)")


@register("timeline_shift_orders", with_ctes(
    f"SELECT SalesOrderID, {_shift_sql('OrderDate')} AS OrderDate, {_shift_sql('DueDate')} AS DueDate, "
    f"{_shift_sql('ShipDate')} AS ShipDate, OnlineOrderFlag, CustomerID, SalesPersonID, TerritoryID, SubTotal, "
    f"{_d(SHIFT_TO)} AS modified_date FROM header_all", "header_all"))
def q_timeline_shift_orders(spark, sf_dir):
    """Orders moved so the latest lands on SHIFT_TO."""
    return model.shift_orders(SalesTables.of(spark, sf_dir).header_all, SHIFT_TO)


@register("timeline_shift_costs", with_ctes(
    f"SELECT ProductID, {_shift_sql('StartDate')} AS StartDate, {_shift_sql('EndDate')} AS EndDate, StandardCost, "
    f"{_d(SHIFT_TO)} AS modified_date FROM cost_history_raw", "cost_history_raw", "header_all"))
def q_timeline_shift_costs(spark, sf_dir):
    """Cost intervals moved with the orders' anchor."""
    t = SalesTables.of(spark, sf_dir)
    return model.shift_history(t.cost_history_raw, t.header_all, SHIFT_TO)


@register("timeline_shift_prices", with_ctes(
    f"SELECT ProductID, {_shift_sql('StartDate')} AS StartDate, {_shift_sql('EndDate')} AS EndDate, ListPrice, "
    f"{_d(SHIFT_TO)} AS modified_date FROM price_history_raw", "price_history_raw", "header_all"))
def q_timeline_shift_prices(spark, sf_dir):
    """List-price intervals moved with the orders' anchor."""
    t = SalesTables.of(spark, sf_dir)
    return model.shift_history(t.price_history_raw, t.header_all, SHIFT_TO)


@register("open_latest_cost", with_ctes("SELECT * FROM cost_history", "cost_history"))
def q_open_latest_cost(spark, sf_dir):
    """The latest cost interval per product is open-ended."""
    return model.open_latest(SalesTables.of(spark, sf_dir).cost_history_raw)


@register("open_latest_price", with_ctes("SELECT * FROM price_history", "price_history"))
def q_open_latest_price(spark, sf_dir):
    """The latest list-price interval per product is open-ended."""
    return model.open_latest(SalesTables.of(spark, sf_dir).price_history_raw)


@register("dim_customer", with_ctes("SELECT * FROM dim_customer", "dim_customer"))
def q_dim_customer(spark, sf_dir):
    """Customer dimension (store + individual)."""
    t = SalesTables.of(spark, sf_dir)
    return model.dim_customer(t.customer_src, t.store, t.person)


@register("dim_product", with_ctes("SELECT * FROM dim_product", "dim_product"))
def q_dim_product(spark, sf_dir):
    """Product hierarchy dimension."""
    t = SalesTables.of(spark, sf_dir)
    return model.dim_product(t.product, t.product_subcategory, t.product_category)


oc.add("calendar_orders",
       "SELECT CAST(d AS DATE) AS Date FROM (SELECT unnest(generate_series(make_date(year(min(OrderDate)), 1, 1), "
       "make_date(year(max(OrderDate)), 12, 31), INTERVAL 1 DAY)) AS d FROM header_all) s")


@register("dim_calendar", with_ctes(
    "SELECT Date, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month, "
    "CAST(quarter(Date) AS INTEGER) AS Quarter, "
    "CAST(date_trunc('quarter', Date) AS DATE) AS QuarterStart, CAST(date_trunc('month', Date) AS DATE) AS "
    "MonthStart FROM calendar_orders", "calendar_orders"))
def q_dim_calendar(spark, sf_dir):
    """Date dimension over the whole years of the order history."""
    return model.calendar_for_orders(SalesTables.of(spark, sf_dir).header_all)


@register("dim_territory", with_ctes("SELECT TerritoryID, Name, GroupName FROM territory", "territory"))
def q_dim_territory(spark, sf_dir):
    """Territory dimension."""
    return model.dim_territory(SalesTables.of(spark, sf_dir).territory)


# ---------------------------------------------------------------------------
# Daily batch
# ---------------------------------------------------------------------------
def staged_store(spark, t: SalesTables, root: str | None = None) -> daily.TableStore:
    """History and staging as read-only base frames of a table store. The history isn't copied; the staged orders and
    their lines, which a load reads several times, are written once, and the lines are found without being shuffled
    if the staged orders are measured small."""
    def once(df, name):
        path = files.overwrite(df, fresh_dir(spark, f"staged-{name}"))
        return spark.read.schema(df.schema).parquet(path)
    orders = once(t.orders_temp, "orders")
    lines = once(t.lines_of(small_side(orders.select("SalesOrderID", "modified_date"))), "lines")
    return daily.TableStore(spark, root or fresh_dir(spark, "store"), {
        "header": t.header_hist.select(*daily.HEADER_COLS), "detail": t.detail_hist.select(*daily.DETAIL_COLS),
        "orders_temp": orders, "daily_details_temp": lines})


def _load(spark, sf_dir):
    store = staged_store(spark, SalesTables.of(spark, sf_dir))
    daily.daily_load(store, LOAD_BATCH)
    return store


@register("daily_build_headers", with_ctes("SELECT * FROM built_headers", "built_headers"))
def q_daily_build_headers(spark, sf_dir):
    """Pending staged orders rebuilt with their subtotal."""
    t = SalesTables.of(spark, sf_dir)
    return daily.build_headers(t.orders_temp, t.daily_details_temp)


@register("agg_order_subtotal", with_ctes(
    "SELECT SalesOrderID, CAST(SUM(CAST(CAST(UnitPrice * OrderQty AS DECIMAL(19,4)) * CAST(1 - UnitPriceDiscount "
    "AS DECIMAL(10,4)) AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS SubTotal FROM daily_details_temp GROUP BY "
    "SalesOrderID", "daily_details_temp"))
def q_agg_order_subtotal(spark, sf_dir):
    """G1: discounted value summed per staged order."""
    return daily.subtotals(SalesTables.of(spark, sf_dir).daily_details_temp)


@register("daily_load", with_ctes("SELECT * FROM detail_after_load", "detail_after_load"))
def q_daily_load(spark, sf_dir):
    """The detail history after the guarded daily load."""
    store = _load(spark, sf_dir)
    return store.read("detail")


@register("sink_append", with_ctes("SELECT * FROM header_after_load", "header_after_load"))
def q_sink_append(spark, sf_dir):
    """The header history after appending the day's rebuilt headers."""
    store = _load(spark, sf_dir)
    return store.read("header")


@register("agg_row_counts", with_ctes(
    "SELECT 'header' AS TableName, 'before' AS Stage, count(*) AS Rows FROM header_hist UNION ALL "
    "SELECT 'detail', 'before', count(*) FROM detail_hist UNION ALL "
    "SELECT 'header', 'after', count(*) FROM header_after_load UNION ALL "
    "SELECT 'detail', 'after', count(*) FROM detail_after_load", "header_after_load", "detail_after_load"))
def q_agg_row_counts(spark, sf_dir):
    """Row counts before and after the load (audit rows instead of printed messages)."""
    return daily.load_audit(_load(spark, sf_dir), LOAD_BATCH)


@register("sink_overwrite", with_ctes(
    "SELECT SalesOrderID, OrderDate, DueDate, ShipDate, OnlineOrderFlag, CustomerID, SalesPersonID, TerritoryID, "
    "processed OR SalesOrderID IN (SELECT SalesOrderID FROM built_headers) AS processed, modified_date "
    "FROM orders_temp", "orders_temp", "built_headers"))
def q_sink_overwrite(spark, sf_dir):
    """The staging table rewritten with loaded orders flagged processed."""
    store = _load(spark, sf_dir)
    return store.read("orders_temp")


@register("daily_gate", with_ctes(
    f"SELECT {_d(AS_OF)} AS AsOf, count(*) AS PendingRows, CASE WHEN count(*) > 0 THEN 'loaded' ELSE "
    f"'no data for today' END AS Action FROM orders_temp WHERE NOT processed AND CAST(modified_date AS DATE) = "
    f"{_d(AS_OF)}", "orders_temp"))
def q_daily_gate(spark, sf_dir):
    """Load only when there are pending staged orders for today."""
    t = SalesTables.of(spark, sf_dir)
    store = staged_store(spark, t)
    return daily.daily_gate(store, AS_OF, LOAD_BATCH)


@register("daily_reset", with_ctes(f"SELECT {DETAIL_SQL_COLS} FROM detail_hist", "detail_hist"))
def q_daily_reset(spark, sf_dir):
    """After load + reset, the detail history is back to what it was."""
    store = _load(spark, sf_dir)
    daily.daily_reset(store, LOAD_BATCH)
    return store.read("detail")


@register("daily_roundtrip", with_ctes(
    "SELECT 'header' AS TableName, count(*) AS OriginalRows, count(*) AS FinalRows, CAST(0 AS BIGINT) AS "
    "Differences FROM header_hist UNION ALL SELECT 'detail', count(*), count(*), 0 FROM detail_hist UNION ALL "
    "SELECT 'orders_temp', count(*), count(*), 0 FROM orders_temp", "header_hist", "detail_hist", "orders_temp"))
def q_daily_roundtrip(spark, sf_dir):
    """Load then reset leaves every table as it was (differences counted with exceptAll)."""
    t = SalesTables.of(spark, sf_dir)
    store = staged_store(spark, t)
    original = {"header": t.header_hist.select(*daily.HEADER_COLS),
                "detail": t.detail_hist.select(*daily.DETAIL_COLS), "orders_temp": t.orders_temp}
    daily.daily_load(store, LOAD_BATCH)
    daily.daily_reset(store, LOAD_BATCH)
    out = None
    for n, a in original.items():
        b = store.read(n)
        row = daily.table_differences(a, b).agg(F.count(F.lit(1)).alias("Differences")).select(
            F.lit(n).alias("TableName"), a.select(F.count(F.lit(1))).scalar().alias("OriginalRows"),
            b.select(F.count(F.lit(1))).scalar().alias("FinalRows"), "Differences")
        out = row if out is None else out.unionByName(row)
    return out


@register("copy_with_casts", with_ctes(
    "SELECT CAST(SalesOrderID AS BIGINT) AS SalesOrderID, CAST(OrderDate AS DATE) AS OrderDate, DueDate, ShipDate, "
    "OnlineOrderFlag, CustomerID, SalesPersonID, TerritoryID, CAST(SubTotal AS DECIMAL(19,4)) AS SubTotal, "
    f"modified_date, {_d(AS_OF)} AS LoadDate FROM header_all", "header_all"))
def q_copy_with_casts(spark, sf_dir):
    """S3: full copy with casts and a load-date stamp, written and read back."""
    t = SalesTables.of(spark, sf_dir)
    out = files.copy_with_casts(t.header_all, {"SalesOrderID": "bigint", "OrderDate": "date",
                                               "SubTotal": "decimal(19,4)"}, AS_OF)
    path = files.write_table(out, fresh_dir(spark, "copy"))
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Demand profile and offers
# ---------------------------------------------------------------------------
from saleslens.plans import profile  # noqa: E402


def profile_lines(t: SalesTables):
    return profile.profile_lines(t.header_hist, t.detail_all, t.cost_history)


def special_offers(t: SalesTables):
    """The offers kept by the load (ids below 7)."""
    return t.special_offer_src.where(F.col("SpecialOfferID") < 7)


oc.add("offer_ranked",
       "SELECT *, row_number() OVER (ORDER BY MinQty DESC, MaxQty ASC NULLS LAST, UnitPriceDiscount DESC, "
       "SpecialOfferID) AS rk FROM special_offer")
oc.add("offer_fallback",
       "SELECT coalesce(arg_min(SpecialOfferID, CASE WHEN UnitPriceDiscount = 0 THEN rk END), "
       "arg_max(SpecialOfferID, rk)) AS fb FROM offer_ranked")


def offer_lookup_sql(src: str) -> str:
    return ("SELECT q.OrderQty, coalesce(arg_min(r.SpecialOfferID, r.rk), (SELECT fb FROM offer_fallback)) AS "
            f"SpecialOfferID FROM (SELECT DISTINCT OrderQty FROM {src}) q LEFT JOIN offer_ranked r ON "
            "r.MinQty <= q.OrderQty AND (r.MaxQty IS NULL OR r.MaxQty >= q.OrderQty) GROUP BY q.OrderQty")


oc.add("offer_lookup_batch", offer_lookup_sql("daily_details_temp"))


@register("assign_offers", with_ctes(
    "SELECT d.SalesOrderID, d.SalesOrderDetailID, d.OrderQty, d.ProductID, k.SpecialOfferID, o.UnitPriceDiscount "
    "FROM daily_details_temp d LEFT JOIN offer_lookup_batch k ON d.OrderQty = k.OrderQty LEFT JOIN special_offer o "
    "ON o.SpecialOfferID = k.SpecialOfferID", "daily_details_temp", "offer_lookup_batch", "special_offer"))
def q_assign_offers(spark, sf_dir):
    """Every staged line gets the offer of its quantity tier."""
    t = SalesTables.of(spark, sf_dir)
    lines = t.daily_details_temp.select("SalesOrderID", "SalesOrderDetailID", "OrderQty", "ProductID")
    return profile.assign_offers(lines, special_offers(t))


def xpct_sql(lst: str, n: str, p: str) -> str:
    """Exact linear percentile over a sorted list, in decimal arithmetic."""
    scale = len(p.split(".")[1])
    pos = f"(CAST({n} - 1 AS DECIMAL(20,0)) * CAST('{p}' AS DECIMAL(10,{scale})))"
    lo = f"{lst}[CAST(floor({pos}) AS INTEGER) + 1]"
    hi = f"{lst}[CAST(ceil({pos}) AS INTEGER) + 1]"
    return f"({lo} + ({pos} - floor({pos})) * ({hi} - {lo}))"


def floor1_sql(x: str) -> str:
    return f"greatest(1, CAST(floor({x}) AS BIGINT))"


def ceil1_sql(x: str) -> str:
    return f"greatest(1, CAST(ceil({x}) AS BIGINT))"


oc.add("dly", "SELECT OrderDate, CAST(sum(OrderQty) AS BIGINT) AS DailyQty, count(DISTINCT SalesOrderID) AS DailyOrders "
              "FROM profile_lines GROUP BY OrderDate")
oc.add("per_order", "SELECT SalesOrderID, count(*) AS n_lines, sum(OrderQty) AS qty FROM profile_lines "
                    "GROUP BY SalesOrderID")
oc.add("gq", "SELECT avg(OrderQty) AS m, list_sort(list(OrderQty)) AS v, count(*) AS n FROM profile_lines")
oc.add("oq_lines", "SELECT avg(n_lines) AS m, list_sort(list(n_lines)) AS v, count(*) AS n FROM per_order")
oc.add("oq_qty", "SELECT avg(qty) AS m, list_sort(list(qty)) AS v, count(*) AS n FROM per_order")
oc.add("per_product", "SELECT ProductID, avg(OrderQty) AS m, stddev_samp(OrderQty) AS s FROM profile_lines "
                      "GROUP BY ProductID")
oc.add("cur_price", "SELECT ListPrice FROM price_history WHERE EndDate IS NULL AND ListPrice > 0")


def _describe_rows_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    stats = {"count": f"CAST(count({x}) AS DOUBLE)", "mean": f"round(avg({x}), 6)", "std": f"round(stddev_samp({x}), 6)",
             "min": f"min({x})", "p25": f"round(quantile_cont({x}, 0.25), 6)", "p50": f"round(quantile_cont({x}, 0.5), 6)",
             "p75": f"round(quantile_cont({x}, 0.75), 6)", "max": f"max({x})"}
    return " UNION ALL ".join(f"SELECT 'describe_{col}_{k}' AS Metric, {v} AS Value FROM profile_lines" for k, v in stats.items())


def _share_rows_sql(name: str, col: str, src: str) -> str:
    return (f"SELECT '{name}_share' AS Metric, CAST({col} AS VARCHAR) AS Key, round(CAST(count(*) AS DOUBLE) / (SELECT count({col}) "
            f"FROM {src}), 9) AS Value FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}")


oc.add("profile_keyed",
       "SELECT 'daily_qty' AS Metric, CAST(OrderDate AS VARCHAR) AS Key, CAST(DailyQty AS DOUBLE) AS Value FROM dly UNION ALL "
       "SELECT 'daily_orders', CAST(OrderDate AS VARCHAR), CAST(DailyOrders AS DOUBLE) FROM dly UNION ALL "
       "SELECT 'product_mean_qty', CAST(ProductID AS VARCHAR), round(m, 6) FROM per_product_list UNION ALL "
       f"SELECT 'product_p10', CAST(ProductID AS VARCHAR), CAST({floor1_sql(xpct_sql('v', 'n', '0.1'))} AS DOUBLE) FROM per_product_list UNION ALL "
       f"SELECT 'product_p90', CAST(ProductID AS VARCHAR), CAST({ceil1_sql(xpct_sql('v', 'n', '0.9'))} AS DOUBLE) FROM per_product_list UNION ALL "
       + " UNION ALL ".join([_share_rows_sql("product", "ProductID", "profile_lines"),
                             _share_rows_sql("customer", "CustomerID", "header_hist"),
                             _share_rows_sql("salesperson", "SalesPersonID", "header_hist")]))
oc.add("per_product_list", "SELECT ProductID, avg(OrderQty) AS m, list_sort(list(OrderQty)) AS v, count(*) AS n FROM profile_lines "
                           "GROUP BY ProductID")
oc.add("profile_described", " UNION ALL ".join(map(_describe_rows_sql, ("OrderQty", "UnitPrice", "UnitPriceDiscount"))))


@register("history_profile", with_ctes(
    "SELECT * FROM profile_keyed UNION ALL SELECT Metric, NULL, Value FROM profile_described UNION ALL "
    "SELECT Metric, NULL, Value FROM (SELECT 'mean_daily_qty' AS Metric, round(avg(DailyQty), 6) AS Value FROM dly "
    "UNION ALL SELECT 'std_daily_qty', round(stddev_pop(DailyQty), 6) FROM dly "
    "UNION ALL SELECT 'mean_daily_orders', round(avg(DailyOrders), 6) FROM dly "
    "UNION ALL SELECT 'std_daily_orders', round(stddev_pop(DailyOrders), 6) FROM dly "
    "UNION ALL SELECT 'mean_line_qty', round(avg(OrderQty), 6) FROM profile_lines "
    "UNION ALL SELECT 'std_line_qty', round(stddev_pop(OrderQty), 6) FROM profile_lines "
    "UNION ALL SELECT 'MeanQty', greatest(1.0, round(m, 6)) FROM gq "
    f"UNION ALL SELECT 'P10', {floor1_sql(xpct_sql('v', 'n', '0.1'))} FROM gq "
    f"UNION ALL SELECT 'P90', {ceil1_sql(xpct_sql('v', 'n', '0.9'))} FROM gq "
    "UNION ALL SELECT 'lines_mean', round(m, 6) FROM oq_lines "
    f"UNION ALL SELECT 'lines_p10', {floor1_sql(xpct_sql('v', 'n', '0.1'))} FROM oq_lines "
    f"UNION ALL SELECT 'lines_p90', greatest({floor1_sql(xpct_sql('v', 'n', '0.1'))}, "
    f"CAST(ceil({xpct_sql('v', 'n', '0.9')}) AS BIGINT)) FROM oq_lines "
    "UNION ALL SELECT 'qty_mean', round(m, 6) FROM oq_qty "
    f"UNION ALL SELECT 'qty_p10', {floor1_sql(xpct_sql('v', 'n', '0.1'))} FROM oq_qty "
    f"UNION ALL SELECT 'qty_p90', greatest({floor1_sql(xpct_sql('v', 'n', '0.1'))}, "
    f"CAST(ceil({xpct_sql('v', 'n', '0.9')}) AS BIGINT)) FROM oq_qty "
    "UNION ALL SELECT 'product_mean_avg', round(avg(greatest(1.0, m)), 6) FROM per_product "
    "UNION ALL SELECT 'product_std_avg', round(avg(greatest(1.0, coalesce(s, 1.0))), 6) FROM per_product "
    "UNION ALL SELECT 'price_mean', coalesce(round(avg(CAST(ListPrice AS DOUBLE)), 6), 100.0) FROM cur_price "
    "UNION ALL SELECT 'price_std', coalesce(round(stddev_pop(CAST(ListPrice AS DOUBLE)), 6), 50.0) FROM cur_price"
    ") u", "dly", "gq", "oq_lines", "oq_qty", "per_product", "cur_price", "profile_keyed", "profile_described"))
def q_history_profile(spark, sf_dir):
    """The full demand profile as (Metric, Key, Value)."""
    t = SalesTables.of(spark, sf_dir)
    # The lines are read once, into histograms in the checkpoint folder; all statistics come from those.
    hist = profile.profile_histogram(profile_lines(t)).checkpoint(eager=True)
    return profile.history_profile(hist, t.header_hist, t.price_history)
