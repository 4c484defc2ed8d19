"""History (SCD type 2) and masking (Q9-Q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.operators.windows import DEFAULT_MAX_ROWS_PER_KEY, Rows, Spec, match_keys, windowed
from loanlake.session import ensure_checkpoint_dir

TRACKED = ["delinquency_bucket", "credit_tier"]


def scd2(df: DataFrame, key: str = "loan_id", tracked: list[str] | None = None,
         order: list[str] | None = None, ts: str = "event_timestamp",
         max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """Q9: one row per version of the tracked attributes of each key.

    A version starts at an event whose tracked values differ (NULL-safe) from
    the previous event's; it is valid until the next version starts. Both
    steps are per-key LAG/LEAD, run through ``windowed`` so a hot key is
    split rather than sent to one task.
    """
    tracked = tracked or TRACKED
    order = order or [ts, "event_id"]
    state = F.struct(*tracked)
    marked = windowed(df.withColumn("_state", state),
                      [Spec([key], order, rows=[Rows("_prev", "lag", F.col("_state"), 1)])],
                      max_rows_per_key=max_rows_per_key)
    starts = marked.filter(~F.col("_prev").eqNullSafe(F.col("_state")) | F.col("_prev").isNull()) \
        .select(key, *order[1:], F.col(ts).alias("valid_from"), *tracked)
    nxt = windowed(starts, [Spec([key], ["valid_from", *order[1:]],
                                 rows=[Rows("valid_to", "lead", F.col("valid_from"), 0, 1)])],
                   max_rows_per_key=max_rows_per_key)
    return nxt.select(key, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


# ---------------------------------------------------------------------------
# Versions kept run by run: a table of runs, one row per version with the event
# that starts it; the key's latest row also holds the last event seen of the key.
# ---------------------------------------------------------------------------

def _starts(df: DataFrame, key: str, tracked: list[str], order: list[str], max_rows_per_key: int,
            lead_in: list[str]) -> DataFrame:
    """Rows whose tracked values differ from those of the row before, in the order of ``lead_in`` and ``order``."""
    marked = windowed(df.withColumn("_state", F.struct(*tracked)),
                      [Spec([key], [*lead_in, *order], rows=[Rows("_prev", "lag", F.col("_state"), 1)])],
                      max_rows_per_key=max_rows_per_key)
    return marked.filter(~F.col("_prev").eqNullSafe(F.col("_state")) | F.col("_prev").isNull()).drop("_prev", "_state")


def _runs(starts: DataFrame, seen: DataFrame, key: str, tracked: list[str], order: list[str]) -> DataFrame:
    """Run rows from all starts of some keys; the latest of a key carries its last event seen."""
    last = match_keys(starts.groupBy(key).agg(F.max(F.struct(*order)).alias("_last")), seen, [key], "inner")
    current = F.struct(*order).eqNullSafe(F.col("_last"))
    return match_keys(starts, last, [key], "inner").select(key, *tracked, *order, F.when(current, F.col("_seen")).alias("seen"))


def build_runs(df: DataFrame, key: str = "loan_id", tracked: list[str] | None = None, ts: str = "event_timestamp",
               tie: str = "event_id", max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """The runs of every key from all its events."""
    tracked, order = tracked or TRACKED, [ts, tie]
    seen = df.groupBy(key).agg(F.max(F.struct(*order)).alias("_seen"))
    starts = _starts(df.select(key, *tracked, *order), key, tracked, order, max_rows_per_key, [])
    return _runs(starts, seen, key, tracked, order)


def merge_runs(runs: DataFrame, fresh: DataFrame, events: DataFrame, key: str = "loan_id", tracked: list[str] | None = None,
               ts: str = "event_timestamp", tie: str = "event_id",
               max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """The runs after ``fresh`` events arrived, in any order; ``events`` are all events.

    A key whose new events all come after the last one seen goes on from its
    latest run. A late event can split a run at events that the run no longer
    tells, so its key - and only such keys - is built anew from its own events,
    as is one with an event without a timestamp.
    """
    tracked, order = tracked or TRACKED, [ts, tie]
    ensure_checkpoint_dir(runs.sparkSession)
    fresh = fresh.select(key, *tracked, *order)
    summary = fresh.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"), F.max(F.struct(*order)).alias("_latest"),
                                     F.max(F.col(ts).isNull()).alias("_undated"))
    known = runs.filter("seen is not null").select(key, "seen")
    routed = match_keys(summary, known, [key], "left").select(
        key, "_latest", (F.col("seen").isNull() | ((F.col("_first") > F.col("seen")) & ~F.col("_undated")
                                                   & F.col(f"seen.{ts}").isNotNull())).alias("_ok")).checkpoint()
    untouched = match_keys(runs, routed.select(key), [key], "left_anti")
    # keys that go on: their latest run stands before the new events
    on = routed.filter("_ok").select(key)
    old = match_keys(runs, on, [key], "left_semi")
    before = old.filter("seen is not null").select(key, *tracked, *order, F.lit(0).alias("_seq"))
    after = match_keys(fresh, on, [key], "left_semi").withColumn("_seq", F.lit(1))
    new = _starts(before.unionByName(after), key, tracked, order, max_rows_per_key, ["_seq"]).filter("_seq = 1").drop("_seq")
    starts = old.drop("seen").unionByName(new)
    going_on = _runs(starts, routed.filter("_ok").select(key, F.col("_latest").alias("_seen")), key, tracked, order)
    late = routed.filter("not _ok").select(key)
    anew = build_runs(match_keys(events, late, [key], "left_semi"), key, tracked, ts, tie, max_rows_per_key)
    return untouched.unionByName(going_on).unionByName(anew)


def versions(runs: DataFrame, key: str = "loan_id", tracked: list[str] | None = None, ts: str = "event_timestamp",
             tie: str = "event_id", max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY) -> DataFrame:
    """Q9 rows, as ``scd2`` gives them, from the runs."""
    tracked = tracked or TRACKED
    starts = runs.withColumnRenamed(ts, "valid_from")
    nxt = windowed(starts, [Spec([key], ["valid_from", tie], rows=[Rows("valid_to", "lead", F.col("valid_from"), 0, 1)])],
                   max_rows_per_key=max_rows_per_key)
    return nxt.select(key, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def mask_borrowers(df: DataFrame, col: str = "borrower_id", keep: int = 4) -> DataFrame:
    """Q10: replace an identifier by its SHA-256 hash plus a display mask that
    keeps the first ``keep`` characters."""
    c = F.col(col)
    masked = F.concat(F.substring(c, 1, keep), F.repeat(F.lit("*"), F.greatest(F.length(c) - keep, F.lit(0))))
    return df.withColumn(f"{col}_hash", F.sha2(c, 256)).withColumn(f"{col}_masked", masked).drop(col)

