"""Money arithmetic.

All amounts are DECIMAL(19,4) (the `money` type). Products are rounded back to
4 decimals after every multiply so results do not depend on intermediate
precision. Ratios are computed in double from exact decimal inputs, so both
Spark and any IEEE engine produce the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"
RATE = "decimal(10,4)"
SUM_MONEY = "decimal(38,4)"

# Fixed business constant: a simulated sale is priced at 60 % of list price.
UNIT_PRICE_MULTIPLIER = "0.60"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def line_total(unit_price="UnitPrice", qty="OrderQty", discount="UnitPriceDiscount") -> Column:
    """UnitPrice x OrderQty x (1 - discount), held at 4 decimals."""
    gross = (_c(unit_price) * _c(qty)).cast(MONEY)
    keep = (F.lit(1) - _c(discount)).cast(RATE)
    return (gross * keep).cast(MONEY)


def gross_line_value(unit_price="UnitPrice", qty="OrderQty") -> Column:
    """Undiscounted line value (what staged rows carry as LineTotal)."""
    return (_c(unit_price) * _c(qty)).cast(MONEY)


def margin(line_value="LineTotal", unit_cost="StandardCost", qty="OrderQty") -> Column:
    """line value minus cost of the goods sold."""
    return (_c(line_value) - (_c(unit_cost) * _c(qty)).cast(MONEY)).cast(MONEY)


def margin_pct(margin_col="ProductMargin", line_value="LineTotal") -> Column:
    """margin x 100, rounded to 2 decimals first, then divided by the line value.

    A zero line value yields NULL instead of a division error (stated deviation).
    """
    num = (_c(margin_col) * F.lit(100)).cast("decimal(10,2)").cast("double")
    return F.try_divide(num, _c(line_value).cast("double"))


def sale_price(list_price="ListPrice") -> Column:
    """list price x 0.60 rounded half-up to cents; NULL when missing or not positive."""
    lp = _c(list_price)
    return F.when(lp > 0, F.round(lp * F.lit(UNIT_PRICE_MULTIPLIER).cast("decimal(3,2)"), 2).cast(MONEY))


def coerce_numeric(text, default=0, to="double") -> Column:
    """text that is not a number becomes NULL, then the default."""
    return F.coalesce(_c(text).cast("string").try_cast(to), F.lit(default).cast(to))


def safe_ratio(num, den) -> Column:
    """F12 for doubles: NULL when the divisor is zero or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))
