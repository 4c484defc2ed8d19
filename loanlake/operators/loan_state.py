"""Per-loan window state: incremental fact refresh with bounded history reads.

Every fact window looks back at most 365 rows (delinquency frames, LAG) or 12
payment rows (on-time count), plus one running payment total. The state keeps
exactly that per loan:

  last_date/last_ts/last_id   order key of the loan's last valid event
  tail                        days past due of its last 365 events, oldest first
  pay_last_date, pay_tail     date of its last payment; on-time flags of its last 12 payments
  paid_total                  running payment total up to the last payment

A loan whose new events all come after its state (and whose new payments are
on later dates than its last payment) is refreshed from state + new rows
alone: the state arrays become context rows ahead of the new ones, and the
same window specs run over them. Any other loan falls back to the exact
recompute over its full history. Old fact rows of in-order loans never
change, so the touched partitions are just the new rows' dates plus the
fallback loans' dates; they are swapped as a unit, which keeps reruns
idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.operators import incremental, marts
from loanlake.operators.windows import DEFAULT_MAX_ROWS_PER_KEY, Rows, RunningSum, Spec, windowed
from loanlake.plans.schema_record import synced
from loanlake.session import ensure_checkpoint_dir

TAIL_ROWS = 365
PAY_TAIL_ROWS = 12
ORDER = ["_seq", "event_date", "event_timestamp", "event_id"]
#: Marks rows of a loan's full history that a refresh can change.
CHANGED = "is_changed__"
#: The staging columns that the state is made of.
STATE_INPUTS = ["loan_id", "event_id", "event_type", "event_date", "event_timestamp", "days_past_due",
                "payment_amount", "monthly_payment"]

STATE_SCHEMA = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("last_date", T.DateType()),
    T.StructField("last_ts", T.TimestampNTZType()),
    T.StructField("last_id", T.StringType()),
    T.StructField("tail", T.ArrayType(T.IntegerType())),
    T.StructField("pay_last_date", T.DateType()),
    T.StructField("pay_tail", T.ArrayType(T.IntegerType())),
    T.StructField("paid_total", T.DoubleType()),
])


def _inputs(stg: DataFrame) -> DataFrame:
    """Staging rows with the window inputs: _seq 0 (real rows), payment flag,
    on-time marker, payment amount for the running total."""
    p, d = F.col("payment_amount"), F.col("monthly_payment")
    is_pay = F.col("event_type") == "PAYMENT"
    return stg.select("*", F.lit(0).alias("_seq"), is_pay.alias("_is_payment"), F.lit(True).alias("_dk"),
                      F.when(p >= d, 1).alias("_ot"), F.coalesce(p, F.lit(0.0)).alias("_amt"))


def _specs() -> list[Spec]:
    dpd = F.col("days_past_due")
    delinquency = Spec(["loan_id", "_dk"], ORDER, rows=[
        Rows("max_dpd_30d", "max", dpd, 30), Rows("max_dpd_90d", "max", dpd, 90),
        Rows("_dpd_prev", "lag", dpd, 1, default=0),
        Rows("delinquency_count_12m", "count", F.when(dpd > 0, 1), 365)])
    payment = Spec(["loan_id", "_is_payment"], ORDER,
                   rows=[Rows("on_time_payments_12m", "count", F.col("_ot"), 12)],
                   running=[RunningSum("_cum", F.col("_amt"), "event_date")])
    return [delinquency, payment]


def build_state(rows: DataFrame, base_paid: DataFrame | None = None,
                max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY, known_hot: DataFrame | None = None) -> DataFrame:
    """State per loan from window-input rows (real rows, optionally preceded
    by context rows). The last 365 / 12 rows are found with LEAD over a
    bounded frame (skew-safe via ``windowed``) and collected per loan - at
    most 365 values each."""
    one = F.lit(1)
    real = rows.filter(F.col("_seq") == 0)
    marked = windowed(rows, [
        Spec(["loan_id", "_dk"], ORDER, rows=[Rows("_far", "lead", one, 0, TAIL_ROWS)]),
        Spec(["loan_id", "_is_payment"], ORDER, rows=[Rows("_pfar", "lead", one, 0, PAY_TAIL_ROWS)])],
        max_rows_per_key=max_rows_per_key, known_hot=known_hot)
    order = F.struct(*[F.col(c) for c in ORDER])
    tail = (marked.filter(F.col("_dk") & F.col("_far").isNull())
            .groupBy("loan_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"),
                                                                         F.col("days_past_due").alias("v"))))
                                    .alias("_t"))
            .select("loan_id", F.transform("_t", lambda x: x["v"]).alias("tail")))
    pay_tail = (marked.filter(F.col("_is_payment") & F.col("_pfar").isNull())
                .groupBy("loan_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"),
                                                                             F.col("_ot").alias("v"))))
                                        .alias("_t"))
                .select("loan_id", F.transform("_t", lambda x: x["v"]).alias("pay_tail")))
    last = real.groupBy("loan_id").agg(
        F.max(F.struct("event_date", "event_timestamp", "event_id")).alias("_l"),
        F.max(F.when(F.col("_is_payment"), F.col("event_date"))).alias("pay_last_date"),
        F.sum(F.when(F.col("_is_payment"), F.col("_amt")).cast("decimal(28,2)")).alias("_paid"))
    out = last.join(tail, "loan_id", "left").join(pay_tail, "loan_id", "left")
    if base_paid is not None:
        out = out.join(base_paid, "loan_id", "left")
    else:
        out = out.withColumn("_base", F.lit(None).cast("double")) \
            .withColumn("_base_pay_date", F.lit(None).cast("date"))
    return out.select(
        "loan_id", F.col("_l.event_date").alias("last_date"), F.col("_l.event_timestamp").alias("last_ts"),
        F.col("_l.event_id").alias("last_id"),
        F.coalesce("tail", F.array().cast("array<int>")).alias("tail"),
        F.coalesce("pay_last_date", "_base_pay_date").alias("pay_last_date"),
        F.coalesce("pay_tail", F.array().cast("array<int>")).alias("pay_tail"),
        (F.coalesce("_paid", F.lit(0)) + F.coalesce(F.col("_base").cast("decimal(28,2)"), F.lit(0)))
        .cast("double").alias("paid_total"))


def initial_state(stg: DataFrame, **kw) -> DataFrame:
    """State of every loan from its full staging history. Its few input columns are
    written once: counts, both tails and the last events read them."""
    ensure_checkpoint_dir(stg.sparkSession)
    return build_state(_inputs(stg.select(*STATE_INPUTS)).checkpoint(), **kw)


def _context(state: DataFrame, like: DataFrame) -> DataFrame:
    """State arrays as context rows ahead of a loan's new rows (negative
    _seq, NULL order columns), typed like ``like``."""
    dpd_ctx = state.select("loan_id", F.posexplode("tail").alias("_pos", "_v"), F.size("tail").alias("_n")) \
        .select("loan_id", (F.col("_pos") - F.col("_n")).alias("_seq"), F.col("_v").alias("days_past_due"),
                F.lit(True).alias("_dk"), F.lit(False).alias("_is_payment"),
                F.lit(None).cast("int").alias("_ot"), F.lit(0.0).alias("_amt"))
    pay_ctx = state.select("loan_id", F.posexplode("pay_tail").alias("_pos", "_v"), F.size("pay_tail").alias("_n")) \
        .select("loan_id", (F.col("_pos") - F.col("_n")).alias("_seq"), F.lit(0).alias("days_past_due"),
                F.lit(False).alias("_dk"), F.lit(True).alias("_is_payment"),
                F.col("_v").alias("_ot"), F.lit(0.0).alias("_amt"))
    ctx = dpd_ctx.unionByName(pay_ctx)
    missing = [F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns if c not in ctx.columns]
    return ctx.select(*ctx.columns, *missing).select(*like.columns)


def refresh_with_state(stg: DataFrame, target: DataFrame, state: DataFrame, since,
                       max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY):
    """One bounded refresh. Returns (rows for the touched event_date
    partitions, touched dates, new full state) or (None, [], state)."""
    from loanlake.functions.columns import ts_ntz_lit
    # New rows are read once and reused by routing, windows and state; what
    # later steps join with is written first, so no plan carries another's.
    ensure_checkpoint_dir(stg.sparkSession)
    fresh = _inputs(stg.filter(F.col("loaded_at") > ts_ntz_lit(since))).checkpoint()
    summary = fresh.groupBy("loan_id").agg(
        F.min(F.struct("event_date", "event_timestamp", "event_id")).alias("_first"),
        F.min(F.when(F.col("_is_payment"), F.col("event_date"))).alias("_first_pay"),
        F.min("event_date").alias("_d0"), F.max(F.col("event_date").isNull()).alias("_all"),
        F.count(F.when(F.col("event_date").isNull() | F.col("event_timestamp").isNull(), 1)).alias("_nulls"),
        F.count(F.lit(1)).alias("_new"))
    s = summary.join(state, "loan_id", "left")
    in_order = (F.col("last_id").isNull()
                | ((F.col("_first") > F.struct(F.col("last_date").alias("event_date"),
                                               F.col("last_ts").alias("event_timestamp"),
                                               F.col("last_id").alias("event_id")))
                   & (F.col("_first_pay").isNull() | F.col("pay_last_date").isNull()
                      | (F.col("_first_pay") > F.col("pay_last_date")))))
    routed = s.select("loan_id", "_d0", "_all", "_new", (in_order & (F.col("_nulls") == 0)).alias("_ok")).checkpoint()
    if routed.isEmpty():
        return None, [], state
    ok_keys = routed.filter("_ok").select("loan_id")
    late = routed.filter(~F.col("_ok")).select("loan_id", "_d0", "_all")
    touched_state = state.join(ok_keys, "loan_id", "left_semi").checkpoint()

    # In-order loans: context rows from the state + new rows, same specs.
    new_rows = fresh.join(ok_keys, "loan_id", "left_semi")
    rows_in = new_rows.unionByName(_context(touched_state, new_rows)).checkpoint()
    # Rows per in-order loan = its new rows + at most 377 context rows, so
    # the routing counts already tell which loans are hot.
    n_rows = F.col("_new") + TAIL_ROWS + PAY_TAIL_ROWS
    hot = routed.filter(F.col("_ok") & (n_rows > max_rows_per_key)).select("loan_id", n_rows.alias("_n"))
    w = windowed(rows_in, _specs(), max_rows_per_key=max_rows_per_key, known_hot=hot)
    base = touched_state.select("loan_id", F.col("paid_total").alias("_base"),
                                F.col("pay_last_date").alias("_base_pay_date"))
    paid = F.col("_cum").cast("decimal(28,2)") + F.coalesce(F.col("_base").cast("decimal(28,2)"), F.lit(0))
    w_real = (w.filter(F.col("_seq") == 0).join(base, "loan_id", "left")
              .withColumn("cumulative_payments", paid.cast("double")))
    ok_fact = marts.fact_select(w_real, stg.columns)
    ok_state = build_state(rows_in, base, max_rows_per_key=max_rows_per_key, known_hot=hot)

    # Loans with late or undated events: full-history recompute, rows that can have changed.
    rebuilt, new_state = ok_fact, ok_state.select(*state.columns)
    if not late.isEmpty():
        # The mark travels with the rows, so the wide fact is not sorted for another join.
        history = stg.join(late, "loan_id").withColumn(CHANGED, incremental.is_rebuilt()).select(*stg.columns, CHANGED).checkpoint()
        late_fact = marts.loan_portfolio(history, max_rows_per_key=max_rows_per_key).filter(CHANGED)
        rebuilt = rebuilt.unionByName(late_fact.select(*ok_fact.columns))
        late_state = initial_state(history, max_rows_per_key=max_rows_per_key)
        new_state = new_state.unionByName(late_state.select(*state.columns))
    rebuilt = rebuilt.checkpoint()
    new_state = state.join(routed.select("loan_id"), "loan_id", "left_anti").unionByName(new_state)
    dates = incremental.event_dates(rebuilt)
    if not dates:
        return None, [], new_state
    kept = (target.filter(incremental.in_dates(dates)).join(late, "loan_id", "left")
            .filter(~incremental.is_rebuilt()).drop("_d0", "_all")
            .join(rebuilt.select("event_id"), "event_id", "left_anti"))
    kept, rebuilt = synced(kept, rebuilt)
    return kept.unionByName(rebuilt), dates, new_state
