"""Commercial-action monitoring: snapshot import (W16), current revenue vs goal
(W17), and the report export that feeds the import (D4 as text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from saleslens.functions.dates import (GROWTH_FACTOR, as_date, day_after, days_in_prior_year,
                                       elapsed_days_inclusive, year_start)
from saleslens.functions.money import SUM_MONEY
from saleslens.functions.text import format_currency, format_percent, parse_currency, parse_percent

SNAPSHOT_COLS = ["SnapshotDate", "Subcategory", "Country", "PriorityType", "SnapshotRevenue",
                 "PercCurrentSnapshotGoal", "DeltaCurrentSnapshotGoal", "CurrentSnapshotGoal"]

# Priority labels by gap tercile (largest gap first).
PRIORITY_LABELS = ["High", "Medium", "Low"]


def snapshot_from_import(raw: DataFrame, snapshot_date) -> DataFrame:
    """Clean the all-text import into the typed snapshot, stamped with its date."""
    return raw.select(
        as_date(snapshot_date).alias("SnapshotDate"), "Subcategory", "Country", "PriorityType",
        parse_currency("CurrentRevenues").alias("SnapshotRevenue"),
        parse_percent("PercCurrentGoal").alias("PercCurrentSnapshotGoal"),
        parse_currency("DeltaCurrentGoal").alias("DeltaCurrentSnapshotGoal"),
        parse_currency("CurrentGoalRevenues").alias("CurrentSnapshotGoal"))


def revenue_by_pair(fact: DataFrame, dim_product: DataFrame, territory: DataFrame, as_of) -> DataFrame:
    """G5 + G6: current-year-to-date and full prior-year revenue per (Country, Subcategory).

    The fact is first reduced to (ProductID, TerritoryID) with partial
    aggregation, so only that small result meets the product and territory
    dimensions; the CASE-guarded sums keep groups with no current sales at 0.
    """
    return pairs_of_keys(revenue_by_key(fact, {"": as_of}), dim_product, territory)


def revenue_by_key(fact: DataFrame, days: dict) -> DataFrame:
    """(ProductID, TerritoryID) with the current-year and prior-year revenue as of each named day, as ``cur<name>`` and
    ``prev<name>``: one pass over the fact for all days. Tables of parts of the fact add up."""
    od, lt = F.col("OrderDate"), F.col("LineTotal")
    zero = F.lit(0).cast("decimal(19,4)")
    sums = []
    for name, as_of in days.items():
        y0, y1, nxt = year_start(as_of), year_start(as_of, 1), day_after(as_of)
        sums += [F.sum(F.when((od >= y0) & (od < nxt), lt).otherwise(zero)).alias(f"cur{name}"),
                 F.sum(F.when((od >= y1) & (od < y0), lt).otherwise(zero)).alias(f"prev{name}")]
    return fact.groupBy("ProductID", "TerritoryID").agg(*sums)


def pairs_of_keys(per_key: DataFrame, dim_product: DataFrame, territory: DataFrame, name: str = "") -> DataFrame:
    """(Country, Subcategory, CurrentRevenue, PreviousYearRevenue) from the sums of ``revenue_by_key`` for one day."""
    per_key = per_key.select("ProductID", "TerritoryID", F.col(f"cur{name}").alias("cur"), F.col(f"prev{name}").alias("prev"))
    p = dim_product.select("ProductID", "Subcategory")
    t = territory.select("TerritoryID", F.col("Name").alias("Country"))
    return (per_key.join(p, "ProductID").join(t, "TerritoryID")
                   .groupBy("Country", "Subcategory")
                   .agg(F.sum("cur").cast(SUM_MONEY).alias("CurrentRevenue"),
                        F.sum("prev").cast(SUM_MONEY).alias("PreviousYearRevenue")))


def goal_to_date(prev_col, as_of):
    """F11 + F12: prior-year revenue / days in prior year x elapsed days x growth."""
    return (F.col(prev_col).cast("double") / F.nullif(days_in_prior_year(as_of), F.lit(0))
            * elapsed_days_inclusive(as_of) * F.lit(float(GROWTH_FACTOR)))


def action_monitoring(snapshot: DataFrame, current: DataFrame, as_of) -> DataFrame:
    """Every monitored pair with its current revenue and goal to date.

    ``current`` is ``revenue_by_pair``; a pair without any sale gets NULLs.
    """
    c = current.select("Country", "Subcategory", "CurrentRevenue",
                       goal_to_date("PreviousYearRevenue", as_of).alias("CurrentGoalToDate"))
    s = snapshot.select(*SNAPSHOT_COLS)
    return (s.join(c, ["Country", "Subcategory"], "left")
             .select("SnapshotDate", "Country", "Subcategory", "PriorityType", "SnapshotRevenue",
                     "CurrentSnapshotGoal", "PercCurrentSnapshotGoal", "DeltaCurrentSnapshotGoal",
                     "CurrentRevenue", "CurrentGoalToDate"))


def current_vs_goal(current: DataFrame, as_of) -> DataFrame:
    """D3: the goal formula for every (Country, Subcategory), with gap and ratio."""
    g = goal_to_date("PreviousYearRevenue", as_of)
    cur = F.col("CurrentRevenue").cast("double")
    return current.select("Country", "Subcategory", "CurrentRevenue", "PreviousYearRevenue",
                          g.alias("CurrentGoal")) \
        .withColumn("PercCurrentGoal", cur / F.nullif(F.col("CurrentGoal"), F.lit(0.0)) - F.lit(1.0)) \
        .withColumn("DeltaCurrentGoal", cur - F.col("CurrentGoal"))


def prioritise(vs_goal: DataFrame) -> DataFrame:
    """Pairs behind goal, ranked into terciles of the gap (largest gap = High).

    The window has no partition key, but it runs after aggregation to one row
    per (Country, Subcategory), a set bounded by the dimension sizes.
    """
    behind = vs_goal.where(F.col("DeltaCurrentGoal") < 0)
    w = Window.orderBy(F.col("DeltaCurrentGoal").asc(), F.col("Country").asc(), F.col("Subcategory").asc())
    labels = F.array(*[F.lit(x) for x in PRIORITY_LABELS])
    return behind.withColumn("PriorityType", F.element_at(labels, F.ntile(3).over(w)))


def report_export(prioritised: DataFrame) -> DataFrame:
    """The report's text export (what the import later reads): formatted amounts."""
    return prioritised.select(
        "Subcategory", "Country",
        format_currency("CurrentRevenue").alias("CurrentRevenues"),
        format_currency("CurrentGoal").alias("CurrentGoalRevenues"),
        format_percent("PercCurrentGoal").alias("PercCurrentGoal"),
        format_currency("DeltaCurrentGoal").alias("DeltaCurrentGoal"),
        "PriorityType")


def recovery_kpis(monitoring: DataFrame, expected_rate: float = 0.5) -> DataFrame:
    """Initial gap, expected and actual recovery, achievement ratio."""
    cur = F.col("CurrentRevenue").cast("double")
    goal = F.col("CurrentGoalToDate")
    initial = F.col("DeltaCurrentSnapshotGoal").cast("double")
    expected = F.lit(expected_rate) * F.abs(initial)
    actual = (cur - goal) - initial
    return monitoring.select(
        "Country", "Subcategory", "PriorityType", initial.alias("InitialGap"),
        expected.alias("ExpectedRecovery"), actual.alias("ActualRecovery"),
        (actual / F.nullif(expected, F.lit(0.0))).alias("Achievement"))
