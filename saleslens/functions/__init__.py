"""Scalar functions: money rules, text cleaning, calendar arithmetic."""
from saleslens.functions import dates, money, text  # noqa: F401
