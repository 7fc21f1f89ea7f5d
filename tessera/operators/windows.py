"""Window operators that survive hot partition keys.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if
one key holds a third of the table, one task does a third of the work.  Each
operator here therefore has two plans:

``"window"``
    the ordinary Spark window (one shuffle on the key), used when no key
    holds more than ``max_rows_per_key`` rows;

``"split"``
    the rows of *hot* keys are range-partitioned on (key, window order,
    tie-breakers) and stored, so a hot key and even a heavy tie group is cut
    into ordered parts whatever the column types, while small hot keys share a
    part; the number of parts has a ceiling.  Windows then run per
    ``(key, part)``.  For keys that lie in several parts, one aggregate per
    (key, part, order value) gives a small summary per part, and windows over
    that summary supply what other parts contribute.  Offsets that reach back
    across a part's edge (``lag``, a ROWS frame) find copies of the at most K
    rows before it, the "halo".

Both plans give the same results.  Floating-point sums may differ in the last
bits, as they do between two runs of any plan; with ``scale`` given, amounts
are summed as exact decimals of that scale.  The order must be unique for row
numbers and lags to be defined: where tie-breakers leave rows tied, the split
plan orders them by a hash of the row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import exact
from tessera.session import materialize

# A key with more rows than this is split (about one comfortable task).  A
# session can set its own with the ``spark.tessera.maxRowsPerKey`` conf.
DEFAULT_MAX_ROWS_PER_KEY = 2_000_000
MAX_ROWS_CONF = "spark.tessera.maxRowsPerKey"


def max_rows_per_key_for(df: DataFrame, value: int | None = None) -> int:
    """The hot-key bound: the argument, else the session conf, else the default."""
    if value is not None:
        return int(value)
    return int(df.sparkSession.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS_PER_KEY)))


@dataclass
class OrderSpec:
    """Ordering of a window: one value column of any sortable type plus
    tie-breakers that make the order unique (row numbers, lags)."""

    column: str
    descending: bool = False
    tiebreak: list[str] = field(default_factory=list)

    def value_exprs(self) -> list[Column]:
        c = F.col(self.column)
        return [c.desc() if self.descending else c.asc()]

    def full_exprs(self) -> list[Column]:
        return self.value_exprs() + [F.col(t).asc() for t in self.tiebreak]

    def reversed_exprs(self) -> list[Column]:
        """The exact reverse of :meth:`full_exprs` (NULL placement flips too)."""
        c = F.col(self.column)
        return [c.asc() if self.descending else c.desc()] + [F.col(t).desc() for t in self.tiebreak]


def hot_keys(df: DataFrame, keys: list[str], max_rows_per_key: int, count: str = "n_rows") -> DataFrame:
    """Keys holding more than ``max_rows_per_key`` rows (partial aggregation first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > max_rows_per_key)


def choose_strategy(df: DataFrame, keys: list[str], max_rows_per_key: int | None = None) -> str:
    """``"split"`` when some key is hot, else ``"window"``.  One pass over the key columns."""
    return "window" if hot_keys(df, keys, max_rows_per_key_for(df, max_rows_per_key)).isEmpty() else "split"


def free_prefix(*frames: DataFrame) -> str:
    """A name prefix that no column of the frames has (names are case-insensitive)."""
    taken, prefix = [c.lower() for df in frames for c in df.columns], "__w_"
    while any(c.startswith(prefix) for c in taken):
        prefix = "_" + prefix
    return prefix


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs, as a window partition groups NULL keys."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


#: Ordered parts in all, at most so many times the shuffle width; small hot keys share parts.
PARTS_PER_SHUFFLE_PARTITION = 4


def part_count(spark, hot_rows: int, bound: int) -> int:
    """Ordered parts for so many hot rows: about half the bound each, but never more than the ceiling."""
    wanted = -(-2 * hot_rows // max(1, bound))
    return max(1, min(wanted, PARTS_PER_SHUFFLE_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))))


class _Parts:
    """All rows with a part number: hot keys cut into ordered parts, other keys whole in part -1.

    Range partitions don't know keys, so a small hot key lies in one part with
    many others and a large one runs through several.  Only keys of several
    parts need anything from other parts.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: OrderSpec, bound: int, hot: DataFrame, hot_rows: int, prefix: str):
        self.df, self.keys, self.order, self.p = df, keys, order, prefix
        p = prefix
        self.part, self.own, self.tie = f"{p}part", f"{p}own", f"{p}tie"
        self.group = [*keys, self.part]
        renamed = hot.select(*[F.col(k).alias(f"{p}k{i}") for i, k in enumerate(keys)])
        pairs = [(k, f"{p}k{i}") for i, k in enumerate(keys)]
        sortable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        rows = df.join(renamed, _same(df, renamed, pairs), "left_semi").withColumn(self.tie, F.xxhash64(*[F.col(f"`{c}`") for c in sortable]))
        self.full = [*order.full_exprs(), F.col(self.tie).asc()]
        ranged = rows.repartitionByRange(part_count(df.sparkSession, hot_rows, bound), *[F.col(k).asc() for k in keys], *self.full)
        # Stored, so that the parts stay what they are when a task runs again.
        self.hot = materialize(ranged.withColumn(self.part, F.spark_partition_id()), "ordered_parts")
        cold = df.join(renamed, _same(df, renamed, pairs), "left_anti")
        self.cold = cold.withColumns({self.tie: F.lit(0).cast("long"), self.part: F.lit(-1)})

    def col(self, name: str) -> Column:
        return F.col(self.p + name)

    def halos(self, reach: int) -> DataFrame:
        """Copies of the at most ``reach`` rows before each part that goes on with a key, numbered as that part's rows."""
        p, r = self.p, f"{self.p}r"
        back = Window.partitionBy(*self.group).orderBy(*self.order.reversed_exprs(), F.col(self.tie).desc())
        # A group limit before the shuffle: only the tails of the parts move.
        tails = self.hot.withColumn(r, F.row_number().over(back)).where(F.col(r) <= reach)
        tails = tails.select(*self.group, r, F.struct(*[F.col(f"`{c}`") for c in self.df.columns], self.tie).alias(f"{p}row"))
        upto = Window.partitionBy(*self.keys).orderBy(self.part, F.col(r).desc()).rowsBetween(-(reach - 1), 0)
        ends = tails.withColumn(f"{p}rows", F.collect_list(f"{p}row").over(upto)).where(F.col(r) == 1)
        after = F.lead(self.part).over(Window.partitionBy(*self.keys).orderBy(self.part))
        ends = ends.select(after.alias(self.part), f"{p}rows").where(F.col(self.part).isNotNull())
        return ends.select(self.part, F.explode(f"{p}rows").alias(f"{p}row")).select(f"{p}row.*", self.part)

    def carries(self, amount: Column | None) -> DataFrame:
        """One row per (key, part) of the keys of several parts: what the parts before and after contribute."""
        p, order = self.p, self.order
        s = F.sum(amount) if amount is not None else F.sum(F.lit(0))
        values = self.hot.groupBy(*self.group, F.struct(F.col(order.column).alias("o")).alias(f"{p}o")).agg(F.count(F.lit(1)).alias(f"{p}n"), s.alias(f"{p}s"))
        tied = F.struct(f"{p}n", f"{p}s")
        low, high = F.min_by(tied, f"{p}o"), F.max_by(tied, f"{p}o")
        low_o, high_o = F.min(f"{p}o"), F.max(f"{p}o")
        if order.descending:
            low, high, low_o, high_o = high, low, high_o, low_o
        parts = values.groupBy(*self.group).agg(
            F.sum(f"{p}n").alias(f"{p}n"), F.sum(f"{p}s").alias(f"{p}s"), F.count(F.lit(1)).alias(f"{p}d"),
            low_o.alias(f"{p}first"), high_o.alias(f"{p}last"), low.alias(f"{p}first_tied"), high.alias(f"{p}last_tied"),
        )
        w = Window.partitionBy(*self.keys).orderBy(self.part)
        earlier, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
        same_last = Window.partitionBy(*self.keys, f"{p}last").orderBy(self.part).rowsBetween(Window.unboundedPreceding, 0)
        same_first = Window.partitionBy(*self.keys, f"{p}first").orderBy(F.col(self.part).desc()).rowsBetween(Window.unboundedPreceding, 0)
        parts = parts.withColumns({
            f"{p}tied_upto": F.sum(f"{p}last_tied.{p}n").over(same_last),
            f"{p}tied_s_from": F.sum(f"{p}first_tied.{p}s").over(same_first),
            f"{p}goes_on": F.lag(f"{p}last").over(w).eqNullSafe(F.col(f"{p}first")),
            f"{p}goes_after": F.lead(f"{p}first").over(w).eqNullSafe(F.col(f"{p}last")),
        })
        none, whole = F.lit(0), Window.partitionBy(*self.keys)
        out = parts.select(
            *[F.col(k).alias(f"{p}j{i}") for i, k in enumerate(self.group)], F.count(F.lit(1)).over(whole).alias(f"{p}parts"),
            F.coalesce(F.sum(f"{p}n").over(earlier), none).alias(f"{p}rows_before"),
            (F.coalesce(F.sum(f"{p}d").over(earlier), none) - F.sum(F.col(f"{p}goes_on").cast("long")).over(upto)).alias(f"{p}values_before"),
            F.when(F.col(f"{p}goes_on"), F.lag(f"{p}tied_upto").over(w)).otherwise(none).alias(f"{p}tied_before"),
            F.sum(f"{p}s").over(earlier).alias(f"{p}sum_before"),
            F.when(F.col(f"{p}goes_after"), F.lead(f"{p}tied_s_from").over(w)).alias(f"{p}sum_after"),
            F.sum(f"{p}s").over(whole).alias(f"{p}key_sum"), f"{p}last",
        )
        return materialize(out.where(F.col(f"{p}parts") > 1).drop(f"{p}parts"), "part_carries")

    def rows(self, *, reach: int = 0, carry: bool = False, amount: Column | None = None) -> DataFrame:
        """Every row with its part; with ``reach``, halo copies too; with ``carry``, the carries (0 or NULL where nothing is carried)."""
        p = self.p
        out = self.hot.unionByName(self.cold).withColumn(self.own, F.lit(True))
        if reach:
            out = out.unionByName(self.halos(reach).withColumn(self.own, F.lit(False)))
        if not carry:
            return out
        carried = self.carries(amount)
        names = [f"{p}j{i}" for i in range(len(self.group))]
        out = out.join(carried, _same(out, carried, list(zip(self.group, names, strict=True))), "left").drop(*names)
        return out.withColumns({p + c: F.coalesce(F.col(p + c), F.lit(0)) for c in ("rows_before", "values_before", "tied_before")})

    def in_order(self, own: bool = False):
        """Window over a part's rows in full order, halo copies first; ``own``: without them.  One sort serves both."""
        if own:
            return Window.partitionBy(*self.group, self.own).orderBy(*self.full)
        return Window.partitionBy(*self.group).orderBy(F.col(self.own).asc(), *self.full)

    def by_value(self):
        """Window over a part's own rows by the order column, ties together."""
        return Window.partitionBy(*self.group, self.own).orderBy(*self.order.value_exprs())

    def finish(self, rows: DataFrame, added: list[str]) -> DataFrame:
        """The user's columns and the added ones, without the halo copies."""
        return rows.where(F.col(self.own)).select(*[f"`{c}`" for c in self.df.columns if c not in added], *[f"`{c}`" for c in added])


def _plan(df: DataFrame, keys: list[str], order: OrderSpec, strategy: str, max_rows_per_key: int | None, prefix: str | None = None) -> _Parts | None:
    """None for the plain window plan, else the rows in parts.  The keys are counted once."""
    if strategy not in ("auto", "window", "split"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "window":
        return None
    bound, prefix = max_rows_per_key_for(df, max_rows_per_key), prefix or free_prefix(df)
    hot = materialize(hot_keys(df, keys, bound, f"{prefix}n"), "hot_keys")
    hot_rows = int(hot.agg(F.coalesce(F.sum(f"{prefix}n"), F.lit(0))).first()[0])
    if strategy == "auto" and not hot_rows:
        return None
    return _Parts(df, keys, order, bound, hot, hot_rows, prefix)


def ordered_parts(
    df: DataFrame, keys: list[str], order: OrderSpec, amount: Column | None = None, *, reach: int = 0, max_rows_per_key: int | None = None, prefix: str = "w_"
) -> DataFrame:
    """All rows of ``df`` laid out so that windows written per (key, part), in SQL text too, stand hot keys.

    Adds, under ``prefix``: ``part`` (-1: the whole key), ``own`` (false: a copy
    of one of the at most ``reach`` rows before the part, for ``lag`` and ROWS
    frames; to be filtered out after them), ``tie`` (ends the order of rows
    that tie-breakers leave tied), and what other parts contribute:
    ``rows_before``, ``values_before`` (distinct order values),
    ``tied_before`` (earlier rows tied with the part's first), ``sum_before``,
    ``sum_after`` (of later rows tied with the part's last, ``last``) and
    ``key_sum`` of ``amount``.  A window runs over ``PARTITION BY key, w_part
    ORDER BY w_own, order, w_tie``; ranks and running totals over ``PARTITION
    BY key, w_part, w_own``.
    """
    clash = [c for c in df.columns if c.lower().startswith(prefix.lower())]
    if clash:
        raise ValueError(f"columns {clash} begin with {prefix!r}; choose another prefix")
    return _plan(df, keys, order, "split", max_rows_per_key, prefix).rows(reach=reach, carry=True, amount=amount)


def _plus(*parts: Column) -> Column:
    """Sum of the parts that are not NULL; NULL if none is."""
    total = reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0)) for x in parts])
    return F.when(F.coalesce(*parts).isNotNull(), total)


def with_rank_columns(
    df: DataFrame,
    keys: list[str],
    order: OrderSpec,
    value: str,
    *,
    lags: list[tuple[int, object]] = ((1, None), (2, 0)),
    lag_aliases: list[str] = ("prevRevenue", "prev2Revenue"),
    row_number_alias: str = "row_number",
    rank_alias: str = "rev_rank",
    dense_rank_alias: str = "rev_dense_rank",
    strategy: str = "auto",
    max_rows_per_key: int | None = None,
) -> DataFrame:
    """``lag`` of ``value`` (with defaults), ``row_number``, ``rank``, ``dense_rank`` over one key.

    Row numbers and lags follow the full order (order column, then
    tie-breakers); ``rank`` and ``dense_rank`` follow the order column alone,
    so ties share a rank.
    """
    lags = list(lags)
    lag_aliases = list(lag_aliases)[: len(lags)]
    added = [*lag_aliases, row_number_alias, rank_alias, dense_rank_alias]

    def plain(rows: DataFrame) -> DataFrame:
        w_rows = Window.partitionBy(*keys).orderBy(*order.full_exprs())
        w_vals = Window.partitionBy(*keys).orderBy(*order.value_exprs())
        cols = {a: F.lag(F.col(value), k, default).over(w_rows) for (k, default), a in zip(lags, lag_aliases, strict=False)}
        cols[row_number_alias] = F.row_number().over(w_rows).cast("long")
        cols[rank_alias] = F.rank().over(w_vals).cast("long")
        cols[dense_rank_alias] = F.dense_rank().over(w_vals).cast("long")
        return rows.withColumns(cols)

    split = _plan(df, keys, order, strategy, max_rows_per_key)
    if split is None:
        return plain(df)
    rows = split.rows(reach=max((k for k, _ in lags), default=0), carry=True)
    own, by_value, before = split.in_order(own=True), split.by_value(), split.col("rows_before")
    cols = {a: F.lag(F.col(value), k, default).over(split.in_order()) for (k, default), a in zip(lags, lag_aliases, strict=False)}
    cols[row_number_alias] = (before + F.row_number().over(own)).cast("long")
    # Rows tied with the part's first may continue a tie of earlier parts.
    tied = F.when(F.rank().over(by_value) == 1, split.col("tied_before")).otherwise(F.lit(0))
    cols[rank_alias] = (before + F.rank().over(by_value) - tied).cast("long")
    cols[dense_rank_alias] = (split.col("values_before") + F.dense_rank().over(by_value)).cast("long")
    return split.finish(rows.withColumns(cols), added)


def with_rolling_mean(
    df: DataFrame,
    keys: list[str],
    order: OrderSpec,
    value: str,
    *,
    preceding: int = 4,
    alias: str = "RollingAvg",
    scale: int | None = None,
    strategy: str = "auto",
    max_rows_per_key: int | None = None,
) -> DataFrame:
    """Mean over the current row and ``preceding`` earlier rows (a ROWS frame)."""
    amount = exact(value, scale)

    def mean(s: Column, n: Column) -> Column:
        return F.when(n > 0, s.cast("double") / n.cast("double"))

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order.full_exprs()).rowsBetween(-preceding, 0)
        return rows.withColumn(alias, mean(F.sum(amount).over(w), F.count(amount).over(w)))

    split = _plan(df, keys, order, strategy, max_rows_per_key)
    if split is None:
        return plain(df)
    w = split.in_order().rowsBetween(-preceding, 0)
    rows = split.rows(reach=preceding)
    return split.finish(rows.withColumn(alias, mean(F.sum(amount).over(w), F.count(amount).over(w))), [alias])


def with_income_ranking(
    df: DataFrame,
    keys: list[str],
    order: OrderSpec,
    value: str,
    *,
    row_number_alias: str = "ranked",
    total_alias: str = "windowedSum",
    running_alias: str = "windowedRunningTotal",
    scale: int | None = None,
    strategy: str = "auto",
    max_rows_per_key: int | None = None,
) -> DataFrame:
    """Row number, partition total and RANGE running total (ties share) of ``value`` on one key.

    Totals have the type ``sum`` gives; with ``scale`` they are exact decimals
    returned as double.
    """
    amount, added = exact(value, scale), [row_number_alias, total_alias, running_alias]

    def typed(c: Column) -> Column:
        return c.cast("double") if scale is not None else c

    def plain(rows: DataFrame) -> DataFrame:
        w_vals = Window.partitionBy(*keys).orderBy(*order.value_exprs())
        return rows.withColumns({
            row_number_alias: F.row_number().over(Window.partitionBy(*keys).orderBy(*order.full_exprs())).cast("long"),
            total_alias: typed(F.sum(amount).over(Window.partitionBy(*keys))),
            running_alias: typed(F.sum(amount).over(w_vals)),
        })

    split = _plan(df, keys, order, strategy, max_rows_per_key)
    if split is None:
        return plain(df)
    rows, kinds = split.rows(carry=True, amount=amount), plain(df).schema
    whole = F.sum(amount).over(Window.partitionBy(*split.group, split.own))
    # Rows tied with the part's last may go on into later parts.
    on_last = F.struct(F.col(order.column).alias("o")).eqNullSafe(split.col("last"))
    running = _plus(split.col("sum_before"), F.sum(amount).over(split.by_value()), F.when(on_last, split.col("sum_after")))
    out = rows.withColumns({
        row_number_alias: (split.col("rows_before") + F.row_number().over(split.in_order(own=True))).cast("long"),
        total_alias: typed(F.coalesce(split.col("key_sum"), whole)).cast(kinds[total_alias].dataType),
        running_alias: typed(running).cast(kinds[running_alias].dataType),
    })
    return split.finish(out, added)


def with_group_aggregate(df: DataFrame, keys: list[str], agg: Column, alias: str) -> DataFrame:
    """A whole-partition aggregate (``count(x) over (partition by k)``) on every row.

    Planned as ``groupBy(k).agg`` (partial aggregation, so hot keys are
    reduced map-side) joined back on the key with null-safe equality, as a
    window partition groups NULL keys.  The aggregate has one row per key;
    adaptive execution broadcasts it when its measured size is small, and
    otherwise splits skewed partitions of the shuffled join.
    """
    p = free_prefix(df)
    per_key = df.groupBy(*keys).agg(agg.alias(alias))
    renamed = per_key.select(*[F.col(k).alias(f"{p}g{i}") for i, k in enumerate(keys)], alias)
    return df.join(renamed, _same(df, renamed, [(k, f"{p}g{i}") for i, k in enumerate(keys)]), "inner").drop(*[f"{p}g{i}" for i in range(len(keys))])
