"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from salestide.functions.money import as_double, growth_pct, line_amount, ratio, to_money
from salestide.functions.timefns import (
    as_of_column, interval, parse_timestamp, weekday_name,
)

__all__ = [
    "as_double", "growth_pct", "line_amount", "ratio", "to_money",
    "as_of_column", "interval", "parse_timestamp", "weekday_name",
]
