"""Display formatting as native column expressions.

Numbers are printed from integer parts: |x| * 10^d is rounded half-to-even
(``bround``) and split into integer and fraction digits, with optional
thousands separators. This mirrors Python's fixed-point formatting closely
and prints the same text in every SQL engine that rounds the same double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_num(x: Column, d: int, plus: bool = False, commas: bool = False) -> Column:
    """Fixed-point text of x with d decimals ('+' for non-negatives when ``plus``)."""
    scale = 10 ** d
    n = F.bround(F.abs(x) * scale, 0).cast("bigint")
    ip = F.floor(n / F.lit(scale)).cast("bigint") if d else n
    itxt = F.format_number(ip, 0) if commas else ip.cast("string")
    body = itxt if d == 0 else F.concat(itxt, F.lit("."), F.lpad((n % scale).cast("string"), d, "0"))
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+" if plus else ""))
    return F.when(x.isNotNull(), F.concat(sign, body))


def fmt_pct(x: Column, d: int = 1, plus: bool = False) -> Column:
    """Python's '{:.1%}' (or '{:+.1%}')."""
    return F.concat(fmt_num(x * 100, d, plus), F.lit("%"))


def fmt_currency(x: Column) -> Column:
    """'${:,.2f}' (Python keeps the sign after the dollar)."""
    return F.concat(F.lit("$"), fmt_num(x, 2, commas=True))


def format_value(x: Column, unit: Column) -> Column:
    """F8: by dictionary unit: ratio 12.3%, currency $1,234.50, count 1,234, other 4 decimals; NULL -> N/A."""
    return F.when(x.isNull(), F.lit("N/A")).otherwise(
        F.when(unit == "ratio", fmt_pct(x))
        .when(unit == "currency", fmt_currency(x))
        .when(unit == "count", fmt_num(x, 0, commas=True))
        .otherwise(fmt_num(x, 4))
    )


def format_value_decimal(x: Column, unit: Column) -> Column:
    """Display variant: count, currency, 'decimal' units as 0.00, else percent."""
    return F.when(x.isNull(), F.lit("N/A")).otherwise(
        F.when(unit == "count", fmt_num(x, 0, commas=True))
        .when(unit == "currency", fmt_currency(x))
        .when(unit == "decimal", fmt_num(x, 2))
        .otherwise(fmt_pct(x))
    )


def format_change(x: Column) -> Column:
    """'+5.3%' (plus sign only above zero); NULL -> N/A."""
    return F.when(x.isNull(), F.lit("N/A")).otherwise(
        F.concat(F.when(x > 0, F.lit("+")).otherwise(F.lit("")), fmt_pct(x))
    )
