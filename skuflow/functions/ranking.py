"""Distributed ranks, running totals, selections and per-key picks (H3, H4, H5, H8), exact
medians, and the size-checked broadcast.

An un-partitioned SQL window (``row_number() OVER (ORDER BY x)``) moves every row into one
task. Here the rows are dealt to value ranges instead: approximate percentiles of the first
sort key (one small aggregate) bound about as many ranges as the session has shuffle
partitions, and rows with an equal key always share a range. Counts and sums per range (one
row each) give what lies before a range; a window inside the range gives the rest. A key
that alone fills several ranges gets ranges of its own, split by the second sort key. The
bounds only decide how even the ranges are: results never depend on them, so nothing is
stored and a lost task is simply computed again.
"""

from __future__ import annotations

import math
import os.path
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ACCURACY = 10_000                  # percentile_approx: rank error of 1 / accuracy
_TIE_BITS = 20


def bounded_broadcast(df: DataFrame, max_rows: int, known: bool | None = None) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows;
    otherwise leave the join strategy to Spark (sort-merge / AQE). ``known``
    passes in a bound already proven by the caller (the pipeline checks all
    dimension tables in one job); ``None`` runs a capped count here."""
    if known is None:
        known = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if known else df


@dataclass(frozen=True)
class By:
    """A sort key: column, direction, and where nulls go."""

    column: str
    desc: bool = False
    nulls_first: bool = False

    def order(self) -> Column:
        c = F.col(self.column)
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def code(self, kind: T.DataType, prefix: str = "") -> Column:
        """A double that never falls while the sort key rises (equal keys have equal codes): numbers and
        times as they are, texts by six bytes after ``prefix``, which all of them share."""
        c = F.col(self.column)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            raw = c if isinstance(kind, T.BinaryType) else F.encode(c, "UTF-8")
            at = len(prefix.encode()) + 1
            x = F.conv(F.rpad(F.hex(F.substring(raw, at, 6)), 12, "0"), 16, 10).cast("double")
        elif isinstance(kind, T.DateType):
            x = F.unix_date(c).cast("double")
        elif isinstance(kind, T.TimestampNTZType):
            x = F.unix_micros(F.to_timestamp_ltz(c.cast("string"))).cast("double")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            x = F.when(F.isnan(c), F.lit(math.inf)).otherwise(c.cast("double"))
        else:
            x = c.cast("double")
        return F.coalesce(-x if self.desc else x, F.lit(-math.inf if self.nulls_first else math.inf))


def _below(bounds: Sequence[float], code: Column) -> Column:
    """How many of the sorted ``bounds`` are less than ``code``: first among every n-th, then among the n between."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    parts = [list(bounds[i:i + step]) for i in range(0, len(bounds), step)]
    whole = F.size(F.filter(F.lit([part[-1] for part in parts]), lambda b: b < code))
    inner = F.array(*[F.lit(part) for part in parts], F.lit([math.inf]))
    return whole * step + F.when(whole < len(parts), F.size(F.filter(F.element_at(inner, whole + 1), lambda b: b < code))).otherwise(0) \
        - F.when(whole == len(parts), len(parts) * step - len(bounds)).otherwise(0)


class ValueRanges:
    """``df`` dealt to value ranges of its sort keys (`By`). ``rows`` is ``df`` with the column
    ``_range``, which rises with the first key; only a key that fills ranges alone has several."""

    def __init__(self, df: DataFrame, order: Sequence[By], parts: int | None = None):
        self.df, self.order = df, list(order)
        self.parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        self.kinds = {f.name: f.dataType for f in df.schema.fields}
        self.prefix = self._prefixes()

    def _prefixes(self) -> dict[str, str]:
        texts = [b.column for b in self.order[:2] if isinstance(self.kinds[b.column], T.StringType)]
        if not texts:
            return {}
        ends = self.df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(texts) for n, f in (("lo", F.min), ("hi", F.max))]).first()
        return {c: os.path.commonprefix([ends[f"lo{i}"] or "", ends[f"hi{i}"] or ""]) for i, c in enumerate(texts)}

    def _code(self, i: int) -> Column:
        by = self.order[i]
        return by.code(self.kinds[by.column], self.prefix.get(by.column, ""))

    @cached_property
    def rows(self) -> DataFrame:
        at = [i / self.parts for i in range(1, self.parts)]
        found = (self.df.agg(F.percentile_approx(self._code(0), at, _ACCURACY).alias("b")).first()["b"] if at else None) or []
        bounds = sorted(set(found))
        df = self.df.withColumn("_code", self._code(0)).withColumn("_below", _below(bounds, F.col("_code")))
        ties = self._ties(df, bounds, {i: found.count(b) for i, b in enumerate(bounds) if found.count(b) > 1})
        alone, part = F.lit(False), F.lit(0)
        if ties:
            own = F.lit([b if i in ties else math.nan for i, b in enumerate(bounds)] + [math.nan])
            alone = (F.element_at(own, F.col("_below") + 1) == F.col("_code")) & (F.col("_below") < len(bounds))
            each = F.create_map(*[x for i, v in ties.items() for x in (F.lit(i), F.lit(v))])
            part = F.when(alone, F.size(F.filter(F.element_at(each, F.col("_below")), lambda b: b < self._code(1)))).otherwise(0)
        key = (2 * F.col("_below") + alone.cast("int")).cast("long")
        return df.withColumn("_range", F.shiftleft(key, _TIE_BITS) + part.cast("long")).drop("_code", "_below")

    def _ties(self, df: DataFrame, bounds: list[float], full: dict[int, int]) -> dict[int, list[float]]:
        """Of each bound that fills ranges alone (by its place, with how many bounds it makes up): bounds of
        the second key, in as many parts as it fills (to a power of two). Only codes that stand for one key
        are split: nulls and extremes, or texts that begin alike, may share a code."""
        if not full or len(self.order) < 2:
            return {}
        powers = {i: (n - 1).bit_length() for i, n in full.items()}
        grids = {p: [j / (1 << p) for j in range(1, 1 << p)] for p in set(powers.values())}
        power = F.element_at(F.create_map(*[F.lit(x) for kv in powers.items() for x in kv]), F.col("_below"))
        key, whole = F.col(self.order[0].column), F.lit([b if i in full else math.nan for i, b in enumerate(bounds)])
        one = ((F.min(key).eqNullSafe(F.max(key))) & (F.count(key).isin(0) | (F.count(key) == F.count(F.lit(1))))).alias("one")
        rows = (df.where(F.col("_below").isin(list(full)) & (F.element_at(whole, F.col("_below") + 1) == F.col("_code")))
                .withColumn("_power", power).groupBy("_below")
                .agg(one, *[F.percentile_approx(F.when(F.col("_power") == p, self._code(1)), grid, _ACCURACY).alias(f"p{p}") for p, grid in grids.items()]))
        return {r["_below"]: sorted(set(r[f"p{powers[r['_below']]}"])) for r in rows.collect() if r["one"]}

    def totals(self, value: Column | None = None) -> DataFrame:
        """Per range: rows (and sum) before it, and the sum up to the end of its key's ranges. One row a range."""
        aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum(value).alias("_s")] if value is not None else [])
        per = self.rows.groupBy("_range").agg(*aggs)
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        cols = ["_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"), "_n"]
        if value is not None:
            through = Window.orderBy(F.shiftright("_range", _TIE_BITS)).rangeBetween(Window.unboundedPreceding, 0)
            cols += [F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s_before"), F.sum("_s").over(through).alias("_s_through")]
        return per.select(*cols)


def global_rank(df: DataFrame, order: Sequence[By], name: str) -> DataFrame:
    """row_number() over the whole frame. ``order`` must end in a unique key so
    the result is deterministic (ties are otherwise arbitrary)."""
    ranges = ValueRanges(df, order)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*[b.order() for b in order]))
    out = ranges.rows.withColumn("_pos", place).join(F.broadcast(ranges.totals()), "_range")
    return out.withColumn(name, F.col("_n_before") + F.col("_pos")).select(*df.columns, name)


def global_running(df: DataFrame, value: str, order: Sequence[By], name: str | None = None,
                   rank_name: str | None = None, peers_name: str | None = None) -> DataFrame:
    """Running sum of ``value`` in a strict total ``order`` (ROWS frame); optionally the row
    number and the sum that rows with an equal first key share (SQL's default RANGE frame
    over that key)."""
    ranges = ValueRanges(df, order)
    inside = Window.partitionBy("_range").orderBy(*[b.order() for b in order])
    rows = ranges.rows.withColumns({
        "_pos": F.row_number().over(inside), "_run": F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "_peers": F.sum(value).over(Window.partitionBy("_range").orderBy(order[0].order()))})
    out = rows.join(F.broadcast(ranges.totals(F.col(value))), "_range")
    alone = F.shiftright("_range", _TIE_BITS) % 2 == 1
    made = {name: F.col("_s_before") + F.col("_run"), rank_name: F.col("_n_before") + F.col("_pos"),
            peers_name: F.when(alone, F.col("_s_through")).otherwise(F.col("_s_before") + F.col("_peers"))}
    made = {k: v for k, v in made.items() if k}
    return out.withColumns(made).select(*df.columns, *made)


def nth_row(df: DataFrame, order: Sequence[By], n: int) -> DataFrame:
    """The ``n``-th row (from 1) in a strict total ``order``; no row when there are fewer. Counts per
    value range tell which range holds it; only that range's rows are sorted (top-k)."""
    ranges = ValueRanges(df, order)
    at = ranges.totals().where((F.col("_n_before") < n) & (F.col("_n_before") + F.col("_n") >= n)).first()
    if at is None:
        return df.limit(0)
    inside = ranges.rows.where(F.col("_range") == at["_range"]).select(*df.columns)
    return inside.orderBy(*[b.order() for b in order]).offset(n - at["_n_before"] - 1).limit(1)


def medians(df: DataFrame, keys: Sequence[str], columns: dict[str, tuple[Column, int]], few: bool = False) -> DataFrame:
    """Exact medians (percentile_cont(0.5)) of several columns per group, in one pass each to find
    and to count: ``columns`` maps a name to (expression, decimal places). One row per group that
    has a value in any column (exactly one row without ``keys``), as DECIMAL(38, places + 1).

    Percentile sketches of fixed size bracket the middle of every group and column; then values
    inside the bracket are counted (those below only as one number), and a running count
    over the bracket's distinct values finds the middle one or two. A task's state is bounded by
    the sketches and the bracket, about 0.1 % of the values, and does not grow with a group's
    distinct values otherwise. ``few``: the groups are a fixed set of labels, so the brackets
    (one row each) may be broadcast."""
    names, by = list(columns), [*keys, "_m"]
    whole = [F.struct(F.lit(i).alias("_m"), (e.cast(f"decimal(38,{s})") * F.lit(10 ** s)).cast("long").alias("_x")) for i, (e, s) in enumerate(columns.values())]
    values = df.select(*keys, F.explode(F.array(*whole)).alias("_v")).select(*keys, "_v._m", "_v._x").where("_x is not null")
    margin = 5 / _ACCURACY
    ends = F.percentile_approx("_x", [0.5 - margin, 0.5 + margin], _ACCURACY)
    wide = lambda e: F.shiftright(F.abs(e), 50)  # noqa: E731  what a double cannot tell apart
    brackets = (values.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), ends.alias("_e"))
                .select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(by)], "_n", (F.col("_e")[0] - wide(F.col("_e")[0])).alias("_lo"),
                        (F.col("_e")[1] + wide(F.col("_e")[1])).alias("_hi")))
    same = None
    for i, k in enumerate(by):
        cond = F.col(k).eqNullSafe(F.col(f"_b{i}"))
        same = cond if same is None else same & cond
    inside = (values.join(F.broadcast(brackets) if few or not keys else brackets, same).where("_x <= _hi")
              .groupBy(*by, F.when(F.col("_x") >= F.col("_lo"), F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n")))
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy(F.col("_x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    first, second = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    x = F.col("_x")
    picked = (inside.withColumn("_upto", upto).groupBy(*by).agg(
        F.min(F.when(F.col("_upto") >= first, x)).alias("_a"), F.min(F.when(F.col("_upto") >= second, x)).alias("_z"),
        F.max(F.when(x.isNull() & (F.col("_upto") >= first), True)).alias("_missed"))
        .withColumn("_two", F.when(F.col("_missed") | F.col("_z").isNull(), F.raise_error(F.lit("median outside its bracket")).cast("decimal(38,0)"))
                    .otherwise(F.col("_a").cast("decimal(38,0)") + F.col("_z").cast("decimal(38,0)"))))
    out = []
    for i, name in enumerate(names):
        scale = columns[name][1]
        two = F.max(F.when(F.col("_m") == i, F.col("_two"))).cast("decimal(28,0)")
        out.append((two * F.lit(Decimal(5).scaleb(-scale - 1))).cast(f"decimal(38,{scale + 1})").alias(name))
    return picked.groupBy(*keys).agg(*out)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str]) -> DataFrame:
    """H4, DISTINCT ON (keys) ... ORDER BY order_col DESC: one partial+final
    aggregate with max_by, no window."""
    packed = F.max_by(F.struct(*[F.col(c).alias(c) for c in cols]), F.col(order_col)).alias("_v")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])


def modal_value(df: DataFrame, key: str, value: str, tie_rank: Column, name: str) -> DataFrame:
    """H5: per key, the most frequent value; ties by ``tie_rank`` then value."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.min_by(F.col(value), F.struct(-F.col("_n"), tie_rank, F.col(value)))
    return counts.groupBy(key).agg(pick.alias(name))


def scorecard(row: DataFrame, metrics: Sequence[tuple], value_type: str = "decimal(18,2)") -> DataFrame:
    """H8: turn one wide row into long rows (sort_order, metric, value,
    value_display). Each metric is (sort, label, value, display[, present])."""
    structs = []
    for m in metrics:
        sort, label, value, display = m[:4]
        present = m[4] if len(m) > 4 else F.lit(True)
        structs.append(F.struct(F.lit(sort).alias("sort_order"), F.lit(label).alias("metric"),
                                value.cast(value_type).alias("value"),
                                display.cast("string").alias("value_display"),
                                present.alias("_present")))
    return (row.select(F.explode(F.array(*structs)).alias("m"))
            .select("m.*").where("_present").drop("_present"))
