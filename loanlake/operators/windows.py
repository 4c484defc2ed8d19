"""Per-key ordered window metrics that survive a hot key.

``Window.partitionBy(key)`` sends every row of a key to one task; if a single
loan carries a third of all rows that task never finishes. ``windowed``
therefore routes rows in two ways:

* cold keys (row count <= ``max_rows_per_key``): the plain built-in window
  - one hash exchange on the key, one sort, WindowExec.
* hot keys: rows are range-partitioned on (key, order) - the range sampler
  splits one key over many tasks - checkpointed to the shared checkpoint
  folder so their numbering is stable across task retries, numbered densely
  (partition offset + position), cut into chunks of ``chunk_rows`` and each
  chunk receives the ``K`` rows before/after it as halo copies. A window over
  (key, chunk) then yields exactly the values of the unsplit window for every
  bounded ROWS frame and LAG/LEAD, with at most chunk_rows + 2K rows per group.
  The range sort takes a task per chunk, or per ``SORT_TASK_ROWS`` rows if chunks
  are smaller: what the driver samples, broadcasts and tracks grows with its tasks.
  Running totals over a RANGE frame on a coarse peer column (dates) are
  computed from per-(key, peer) subtotals, which partial aggregation shrinks
  before any shuffle.

The hot keys are a table of at most rows / max_rows_per_key rows, joined like
any other (NULL is a key); Catalyst decides by its size whether to broadcast it.
Money is summed as decimal cents, so both ways give the same bits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlake.session import ensure_checkpoint_dir

DEFAULT_MAX_ROWS_PER_KEY = 2_000_000
DEFAULT_CHUNK_ROWS = 1_000_000
#: The fewest rows that a task of the range sort is meant for.
SORT_TASK_ROWS = 250_000

_AGGS = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count}


@dataclass
class Rows:
    """A ROWS-frame aggregate or an offset function.

    fn: max | min | sum | count | lag | lead. For aggregates the frame is
    ``ROWS BETWEEN preceding PRECEDING AND following FOLLOWING``; for lag/lead
    ``preceding``/``following`` is the offset and ``default`` the fill value.
    """
    name: str
    fn: str
    expr: Column
    preceding: int = 0
    following: int = 0
    default: object = None

    def halo_before(self) -> int:
        return self.preceding if self.fn != "lead" else 0

    def halo_after(self) -> int:
        return self.following if self.fn != "lag" else 0

    def over(self, w) -> Column:
        if self.fn == "lag":
            return F.lag(self.expr, self.preceding, self.default).over(w)
        if self.fn == "lead":
            return F.lead(self.expr, self.following, self.default).over(w)
        return _AGGS[self.fn](self.expr).over(w.rowsBetween(-self.preceding, self.following))


@dataclass
class RunningSum:
    """SUM(expr) OVER (PARTITION BY key ORDER BY peer) with the default frame
    RANGE UNBOUNDED PRECEDING .. CURRENT ROW: rows with equal ``peer`` (NULL
    first) share one total. ``expr`` is money, summed in whole cents."""
    name: str
    expr: Column
    peer: str


@dataclass
class PeerAgg:
    """An aggregate over all rows of a key sharing ``peer`` (e.g. a loan-day):
    fn max | min | sum | count over the whole peer group, or ``last``: the
    value of ``expr`` at the greatest order among rows where it is not NULL."""
    name: str
    fn: str
    expr: Column
    peer: str


@dataclass
class Spec:
    key: list[str]
    order: list[str]
    rows: list[Rows] = field(default_factory=list)
    running: list[RunningSum] = field(default_factory=list)
    peers: list[PeerAgg] = field(default_factory=list)

    def halo(self) -> tuple[int, int]:
        return (max([r.halo_before() for r in self.rows] or [0]),
                max([r.halo_after() for r in self.rows] or [0]))


def _cents(expr: Column) -> Column:
    return expr.cast("decimal(28,2)")


def _agg(fn: str, expr: Column) -> Column:
    """An aggregate whose value does not depend on the order of its rows."""
    return F.sum(_cents(expr)) if fn == "sum" else _AGGS[fn](expr)


def _plain_value(fn: str, value: Column) -> Column:
    return value.cast("double") if fn == "sum" else value


def match_keys(df: DataFrame, other: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Join on equal key columns where NULL equals NULL; the columns of ``df``
    first, then the other columns of ``other``."""
    right = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)],
                         *[c for c in other.columns if c not in cols])
    cond = F.lit(True)
    for i, c in enumerate(cols):
        cond = cond & df[c].eqNullSafe(F.col(f"_k{i}"))
    return df.join(right, cond, how).drop(*[f"_k{i}" for i in range(len(cols))])


def _plain(df: DataFrame, specs: list[Spec]) -> DataFrame:
    cols = []
    for s in specs:
        w = Window.partitionBy(*s.key).orderBy(*s.order)
        cols += [r.over(w).alias(r.name) for r in s.rows]
        for rs in s.running:
            total = _agg("sum", rs.expr).over(Window.partitionBy(*s.key).orderBy(rs.peer))
            cols.append(_plain_value("sum", total).alias(rs.name))
        for pa in s.peers:
            wp = Window.partitionBy(*s.key, pa.peer)
            if pa.fn == "last":
                full = wp.orderBy(*s.order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                cols.append(F.last(pa.expr, ignorenulls=True).over(full).alias(pa.name))
            else:
                cols.append(_plain_value(pa.fn, _agg(pa.fn, pa.expr).over(wp)).alias(pa.name))
    return df.select("*", *cols)


def find_hot_keys(df: DataFrame, key: list[str], max_rows_per_key: int) -> DataFrame:
    """Keys with more rows than one window task should take. Partial
    aggregation collapses every key map-side, so this never skews."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows_per_key)


def sort_tasks(n_rows: int, chunk_rows: int) -> int:
    """Tasks of the range sort over ``n_rows`` hot rows."""
    return max(1, math.ceil(n_rows / max(chunk_rows, SORT_TASK_ROWS)))


def _chunked(hot: DataFrame, spec: Spec, n_rows: int, chunk_rows: int) -> DataFrame:
    """The ROWS frames of ``spec`` on hot keys."""
    ensure_checkpoint_dir(hot.sparkSession)
    before, after = spec.halo()
    if max(before, after) >= chunk_rows:
        raise ValueError("window frame wider than a chunk; raise chunk_rows")
    cols = hot.columns
    tagged = (hot.repartitionByRange(sort_tasks(n_rows, chunk_rows), *spec.key, *spec.order)
              .sortWithinPartitions(*spec.key, *spec.order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), 33)
    # One row per partition: dense numbering offsets (bounded by the tasks of the sort).
    offsets = (tagged.groupBy(pid.alias("_pid"))
               .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
               .withColumn("_off", F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")))
    numbered = (tagged.join(F.broadcast(offsets), pid == F.col("_pid"))
                .withColumn("_ord", F.col("_off") + F.col("_mid") - F.col("_first"))
                .withColumn("_chunk", F.floor(F.col("_ord") / chunk_rows))
                .select(*cols, "_ord", "_chunk"))
    pos = F.col("_ord") - F.col("_chunk") * chunk_rows
    parts = [numbered.withColumn("_halo", F.lit(False))]
    if before:
        parts.append(numbered.filter(pos >= chunk_rows - before)
                     .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_halo", F.lit(True)))
    if after:
        parts.append(numbered.filter(pos < after)
                     .withColumn("_chunk", F.col("_chunk") - 1).withColumn("_halo", F.lit(True)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = Window.partitionBy(*spec.key, "_chunk").orderBy("_ord")
    out = u.select("*", *[r.over(w).alias(r.name) for r in spec.rows]).filter(~F.col("_halo"))
    return out.drop("_ord", "_chunk", "_halo")


def _hot_spec(hot: DataFrame, spec: Spec, n_rows: int, chunk_rows: int) -> DataFrame:
    out = _chunked(hot, spec, n_rows, chunk_rows) if spec.rows else hot  # subtotals need no order
    for rs in spec.running:
        # Subtotals per (key, peer): partial aggregation shrinks the hot key
        # map-side; the peer column (a date) bounds the rows per key.
        upto = F.sum("_s").over(Window.partitionBy(*spec.key).orderBy(rs.peer))
        day = (out.groupBy(*spec.key, rs.peer).agg(_agg("sum", rs.expr).alias("_s"))
               .withColumn(rs.name, _plain_value("sum", upto)).drop("_s"))
        out = match_keys(out, day.checkpoint(), [*spec.key, rs.peer], "left")
    aggs: dict[str, list[Column]] = {}
    for pa in spec.peers:
        # Peer groups of a hot key: combinable subtotals per (key, peer).
        if pa.fn == "last":
            agg = F.max(F.when(pa.expr.isNotNull(), F.struct(*[F.col(o) for o in spec.order],
                                                             pa.expr.alias("_v"))))["_v"]
        else:
            agg = _plain_value(pa.fn, _agg(pa.fn, pa.expr))
        aggs.setdefault(pa.peer, []).append(agg.alias(pa.name))
    for peer, cols in aggs.items():
        # Written before the join, so that a hot loan-day is a plain exchange
        # on both sides and AQE can deal its rows to many tasks.
        grp = out.groupBy(*spec.key, peer).agg(*cols).checkpoint()
        out = match_keys(out, grp, [*spec.key, peer], "left")
    return out


def windowed(df: DataFrame, specs: list[Spec], max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY,
             chunk_rows: int = DEFAULT_CHUNK_ROWS, then: list[Spec] | None = None,
             known_hot: DataFrame | None = None) -> DataFrame:
    """Add the window columns of ``specs`` to ``df``; ``then`` specs run
    afterwards on the same routing and may read the columns ``specs`` made.

    All specs must share the leading key columns (hot keys are detected on
    them, once). With no hot key the plan is exactly the built-in window, and
    later specs partitioned by a superset of the key reuse its exchange.
    ``known_hot`` (a frame of the key columns and ``_n``) skips detection
    when the caller has the counts already.
    """
    then = then or []
    specs_all = specs + then
    common = [c for c in specs[0].key if all(c in s.key for s in specs_all)]
    if not common:
        raise ValueError("window specs need a common key")
    ensure_checkpoint_dir(df.sparkSession)
    keys = known_hot if known_hot is not None else find_hot_keys(df, common, max_rows_per_key).checkpoint()
    n_hot_rows = keys.agg(F.sum("_n")).first()[0]
    if not n_hot_rows:
        out = _plain(df, specs)
        return _plain(out, then) if then else out
    cold = _plain(match_keys(df, keys.select(*common), common, "left_anti"), specs)
    if then:
        cold = _plain(cold, then)
    hot = match_keys(df, keys.select(*common), common, "left_semi")
    for s in specs_all:
        hot = _hot_spec(hot, s, n_hot_rows, chunk_rows)
    return cold.unionByName(hot.select(*cold.columns))


@dataclass
class Calendar:
    """agg(expr) over RANGE BETWEEN ``days`` DAYS PRECEDING AND CURRENT ROW on
    a DATE order column. fn: max | min | sum | count."""
    name: str
    fn: str
    expr: Column
    days: int


_COMBINE = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.sum}


def _calendar_plain(df: DataFrame, key: list[str], date_col: str, aggs: list[Calendar]) -> DataFrame:
    order = F.unix_date(F.col(date_col))
    return df.select("*", *[_plain_value(a.fn, _agg(a.fn, a.expr).over(
        Window.partitionBy(*key).orderBy(order).rangeBetween(-a.days, 0))).alias(a.name) for a in aggs])


def _calendar_by_day(df: DataFrame, key: list[str], date_col: str, aggs: list[Calendar]) -> DataFrame:
    day = df.groupBy(*key, date_col).agg(*[_agg(a.fn, a.expr).alias(f"_d{i}") for i, a in enumerate(aggs)])
    order = F.unix_date(F.col(date_col))
    cols = [_plain_value(a.fn, _COMBINE[a.fn](f"_d{i}").over(
        Window.partitionBy(*key).orderBy(order).rangeBetween(-a.days, 0))).alias(a.name) for i, a in enumerate(aggs)]
    return match_keys(df, day.select(*key, date_col, *cols).checkpoint(), [*key, date_col], "left")


def calendar_windowed(df: DataFrame, key: list[str], date_col: str, aggs: list[Calendar],
                      max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """Calendar (day-range) frames on a DATE order column.

    Ordinary keys use the built-in RANGE window (one exchange). Every row of
    a key-day shares one frame, so for hot keys the frames are computed once
    per key-day from day subtotals - combined map-side, hence safe for a key
    with a third of all rows - and joined back; rows per key in that day
    window are bounded by the calendar, not by the data. Rows without a date
    frame each other."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = find_hot_keys(df, key, max_rows_per_key).select(*key).checkpoint()
    if keys.isEmpty():
        return _calendar_plain(df, key, date_col, aggs)
    cold = _calendar_plain(match_keys(df, keys, key, "left_anti"), key, date_col, aggs)
    hot = _calendar_by_day(match_keys(df, keys, key, "left_semi"), key, date_col, aggs)
    return cold.unionByName(hot.select(*cold.columns))
