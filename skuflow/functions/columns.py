"""Column-expression helpers.

All are built-in Spark expressions, so they stay inside whole-stage codegen.

Rounding rule: sums stay DECIMAL (exact, order-free). A ratio of two exact
numbers whose reference type is numeric (unit cost and price, averages of
stored figures) is divided in whole numbers and rounded half away from zero
exactly (`exact_div`). Other ratios are computed in DOUBLE and rounded with
``sign(x)*floor(|x|*10^n+0.5)/10^n``. Both are stored as DECIMAL(18, n) so
every later sum or product is exact again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_orders(orders: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """H1: drop excluded statuses; a NULL status is dropped too (NOT IN semantics)."""
    return orders.where(~F.col("order_status").isin(*excluded))


def as_double(c: Column | str) -> Column:
    return col(c).cast("double")


def round_half_up(c: Column | str, n: int = 2) -> Column:
    """H10 for DOUBLE values: half away from zero, returned as DECIMAL(18, n)
    (an INT when n == 0)."""
    x = as_double(c)
    scale = float(10 ** n)
    r = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale
    return r.cast("int") if n == 0 else r.cast(f"decimal(18,{n})")


def round_dec(c: Column | str, n: int = 2, precision: int = 18) -> Column:
    """H10 for exact DECIMAL values (Spark rounds decimals HALF_UP)."""
    return F.round(col(c), n).cast(f"decimal({precision},{n})")


def exact_div(num: Column | str, den: Column | str, n: int = 2, scale: int = 2) -> Column:
    """num / NULLIF(den, 0) rounded half away from zero to ``n`` places without any
    binary or intermediate rounding, as DECIMAL(18, n). ``num`` has at most
    ``scale`` decimal places, ``den`` is a whole number."""
    whole = "decimal(38,0)"
    top = (col(num).cast(f"decimal(38,{scale})") * F.lit(10 ** max(scale, n)).cast(f"decimal({max(scale, n) + 1},0)")).cast(whole)
    bottom = col(den).cast(whole) * F.lit(10 ** max(scale - n, 0)).cast(f"decimal({max(scale - n, 0) + 1},0)")
    x = (F.abs(top) * 2 + F.abs(bottom)).cast(whole)
    y = F.nullif((F.abs(bottom) * 2).cast(whole), F.lit(0).cast(whole))
    q = ((x - x % y) / y).cast(whole) * F.signum(top).cast("int") * F.signum(bottom).cast("int")
    return (q.cast(f"decimal(38,{n})") / F.lit(10 ** n)).cast(f"decimal(18,{n})")


def exact_avg(c: Column | str, n: int = 2, scale: int = 2) -> Column:
    """AVG of a decimal column with ``scale`` places, rounded exactly."""
    return exact_div(F.sum(col(c)), F.count(col(c)), n, scale)


def safe_pct(num: Column | str, den: Column | str, n: int = 2) -> Column:
    """H2: round(num * 100 / NULLIF(den, 0), n)."""
    return round_half_up(as_double(num) * 100.0 / F.nullif(as_double(den), F.lit(0.0)), n)


def money(c: Column | str, prefix: str = "$") -> Column:
    """H9: '$' + 999,999,990.00 style text; the value is rounded first."""
    return F.concat(F.lit(prefix), F.format_number(col(c).cast("decimal(38,2)"), 2))


def pct_text(c: Column | str, suffix: str = "%") -> Column:
    """H9: 990.0 style text (one decimal, no grouping) plus '%'."""
    return F.concat(col(c).cast("decimal(18,1)").cast("string"), F.lit(suffix))


def band(c: Column | str, cuts: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """H7: first label whose cut the value is below; last label otherwise.
    ``len(labels) == len(cuts) + 1``."""
    x = col(c)
    expr = F.when(x.isNull(), F.lit(null_label)) if null_label is not None else None
    for cut, label in zip(cuts, labels):
        expr = F.when(x < cut, label) if expr is None else expr.when(x < cut, label)
    return expr.otherwise(labels[-1])


def dominant(pairs: Sequence[tuple[Column | str, str]]) -> Column:
    """H6: label of the largest column (GREATEST ignores NULLs); ties go to the
    earlier pair and the last label is the fallback, as in a CASE on GREATEST."""
    cols = [col(c) for c, _ in pairs]
    top = F.greatest(*cols)
    expr = None
    for c, (_, label) in zip(cols[:-1], pairs[:-1]):
        expr = F.when(c == top, label) if expr is None else expr.when(c == top, label)
    return expr.otherwise(pairs[-1][1])


def opportunity(verdict: Column | str = "verdict") -> Column:
    """Money at stake per verdict (exact DECIMAL arithmetic on 2-dp inputs)."""
    v = col(verdict)
    return (F.when(v == "DISCONTINUE", F.greatest(-F.col("net_profit"), F.lit(0).cast("decimal(18,2)")))
            .when(v == "REDUCE STOCK", F.col("excess_units") * F.col("unit_cogs"))
            .when(v == "REORDER NOW", F.col("at_risk_units") * F.col("unit_price"))
            .otherwise(F.lit(0).cast("decimal(18,2)"))).cast("decimal(38,4)")
