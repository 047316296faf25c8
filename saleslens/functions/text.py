"""Text cleaning for imported report values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the import strips before converting.
CURRENCY_STRIP = ["€", ",", '"', " "]
PERCENT_STRIP = ["%", '"', " "]

# A plain decimal literal: sign, digits, optional point. Exponents, inner
# spaces or any other character make the value NULL, as a failed conversion does.
PLAIN_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def _strip(c: Column, chars: list[str]) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def _to_decimal(cleaned: Column, dtype: str) -> Column:
    return F.when(cleaned.rlike(PLAIN_DECIMAL), cleaned.try_cast(dtype))


def parse_currency(text, dtype: str = "decimal(18,2)") -> Column:
    """'-€ 180,450.50' -> -180450.50; anything unparsable -> NULL."""
    c = F.col(text) if isinstance(text, str) else text
    return _to_decimal(_strip(c, CURRENCY_STRIP), dtype)


def parse_percent(text, dtype: str = "decimal(18,4)") -> Column:
    """'-59.97%' -> -59.97. Thousands separators are not stripped, so '1,234.5%' -> NULL."""
    c = F.col(text) if isinstance(text, str) else text
    return _to_decimal(_strip(c, PERCENT_STRIP), dtype)


def full_name(first="FirstName", last="LastName") -> Column:
    """first name, one space, last name."""
    f = F.col(first) if isinstance(first, str) else first
    l = F.col(last) if isinstance(last, str) else last
    return F.concat(f, F.lit(" "), l)


def format_currency(amount) -> Column:
    """Report-export text of an amount: '€ 1,234.50' / '-€ 1,234.50'."""
    a = (F.col(amount) if isinstance(amount, str) else amount).cast("decimal(18,2)")
    return F.concat(F.when(a < 0, F.lit("-")).otherwise(F.lit("")), F.lit("€ "),
                    F.format_number(F.abs(a), 2))


def format_percent(ratio) -> Column:
    """Report-export text of a ratio: -0.5997 -> '-59.97%'."""
    r = F.col(ratio) if isinstance(ratio, str) else ratio
    p = (r * F.lit(100)).cast("decimal(18,2)")
    return F.concat(F.when(p < 0, F.lit("-")).otherwise(F.lit("")), F.format_number(F.abs(p), 2), F.lit("%"))
