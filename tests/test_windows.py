"""The hot-key split path of ``windowed`` equals the plain window, including
when one key holds most of the rows and chunk edges cut through it."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanlake.operators import windows as W


def skewed(spark, n_hot=3000, n_cold=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_hot):          # one key with most rows, many ties on the date
        rows.append(("HOT", i // 40, i, rnd.choice([0, 0, 30, 60, 90, 120]), float(rnd.randint(1, 9))))
    for i in range(n_cold):
        rows.append((f"K{i % 37}", i // 5, i, rnd.choice([0, 30, 200]), float(rnd.randint(1, 9))))
    return spark.createDataFrame(rows, "k string, d int, t int, dpd int, amt double")


def specs():
    d = F.col("dpd")
    return [W.Spec(["k"], ["d", "t"], rows=[
        W.Rows("mx30", "max", d, 30), W.Rows("mx90", "max", d, 90),
        W.Rows("prev", "lag", d, 1, default=0), W.Rows("nxt", "lead", d, 0, 2, default=-1),
        W.Rows("cnt", "count", F.when(d > 0, 1), 365), W.Rows("around", "sum", F.col("amt"), 3, 2)],
        running=[W.RunningSum("cum", F.col("amt"), "d")])]


def plain(df):
    w = Window.partitionBy("k").orderBy("d", "t")
    d = F.col("dpd")
    return df.select("*", F.max(d).over(w.rowsBetween(-30, 0)).alias("mx30"),
                     F.max(d).over(w.rowsBetween(-90, 0)).alias("mx90"),
                     F.lag(d, 1, 0).over(w).alias("prev"), F.lead(d, 2, -1).over(w).alias("nxt"),
                     F.count(F.when(d > 0, 1)).over(w.rowsBetween(-365, 0)).alias("cnt"),
                     F.sum("amt").over(w.rowsBetween(-3, 2)).alias("around"),
                     F.sum("amt").over(Window.partitionBy("k").orderBy("d")).alias("cum"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_path_equals_plain_window(spark):
    df = skewed(spark)
    got = W.windowed(df, specs(), max_rows_per_key=500, chunk_rows=400)
    assert rows(got.select(*plain(df).columns)) == rows(plain(df))


def test_no_hot_key_gives_plain_plan(spark):
    df = skewed(spark, n_hot=10)
    out = W.windowed(df, specs(), max_rows_per_key=10_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan
    assert rows(out.select(*plain(df).columns)) == rows(plain(df))


def test_hot_keys_found_by_combinable_count(spark):
    df = skewed(spark)
    hot = W.find_hot_keys(df, ["k"], 500).collect()
    assert [r["k"] for r in hot] == ["HOT"]


@pytest.mark.parametrize("threshold", [10_000, 500])
def test_calendar_frames_on_dates(spark, threshold):
    df = skewed(spark).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    got = W.calendar_windowed(df, ["k"], "day", [W.Calendar("m3", "max", F.col("dpd"), 3),
                                                 W.Calendar("c3", "count", F.when(F.col("dpd") > 0, 1), 3)],
                              max_rows_per_key=threshold)
    w = Window.partitionBy("k").orderBy("d").rangeBetween(-3, 0)
    want = df.select("*", F.max("dpd").over(w).alias("m3"),
                     F.count(F.when(F.col("dpd") > 0, 1)).over(w).alias("c3"))
    assert rows(got.select(*want.columns)) == rows(want)


def test_peer_aggregates_split_equals_plain(spark):
    df = skewed(spark)
    d = F.col("dpd")
    first = [W.Spec(["k"], ["d", "t"], rows=[W.Rows("mx30", "max", d, 30)])]
    then = [W.Spec(["k"], ["d", "t"], peers=[
        W.PeerAgg("last_mx", "last", F.col("mx30"), "d"),
        W.PeerAgg("last_big", "last", F.when(d > 60, F.col("t")), "d"),
        W.PeerAgg("n_big", "count", F.when(d > 60, 1), "d"),
        W.PeerAgg("amt_day", "sum", F.col("amt"), "d")])]
    plain_out = W.windowed(df, first, max_rows_per_key=10_000, then=then)
    split_out = W.windowed(df, first, max_rows_per_key=500, chunk_rows=400, then=then)
    assert rows(split_out.select(*plain_out.columns)) == rows(plain_out)


def test_small_chunks_dont_multiply_the_tasks_of_the_range_sort(spark, monkeypatch):
    """Chunks of 50 rows in 3000: one sort task a spec, none for a spec of subtotals alone."""
    from pyspark.sql.classic.dataframe import DataFrame
    tasks, deal = [], DataFrame.repartitionByRange
    monkeypatch.setattr(DataFrame, "repartitionByRange", lambda self, n, *cols: tasks.append(n) or deal(self, n, *cols))
    df, d = skewed(spark), F.col("dpd")
    first = [W.Spec(["k"], ["d", "t"], rows=[W.Rows("mx30", "max", d, 30)])]
    then = [W.Spec(["k"], ["d", "t"], peers=[W.PeerAgg("last_mx", "last", F.col("mx30"), "d")])]
    got = W.windowed(df, first, max_rows_per_key=500, chunk_rows=50, then=then)
    want = W.windowed(df, first, max_rows_per_key=10_000, then=then)
    assert rows(got.select(*want.columns)) == rows(want)
    assert tasks == [1]


def test_sort_tasks_follow_rows_not_chunks(spark):
    assert W.sort_tasks(216_000_000, 1000) == 864 and W.sort_tasks(3_000_000, 1_000_000) == 3


def test_scd2_split_equals_plain(spark):
    from loanlake.operators import history
    df = skewed(spark).select(F.col("k").alias("loan_id"), F.col("t").cast("string").alias("event_id"),
                              F.col("t").cast("timestamp").alias("event_timestamp"),
                              (F.col("dpd") > 60).alias("delinquency_bucket"), F.lit("A").alias("credit_tier"))
    a = history.scd2(df, max_rows_per_key=10_000)
    b = history.scd2(df, max_rows_per_key=500)
    assert rows(a) == rows(b)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), before=st.integers(1, 40), after=st.integers(0, 15),
       chunk=st.integers(50, 300), hot_share=st.floats(0.3, 0.95))
def test_split_equals_plain_property(spark, seed, before, after, chunk, hot_share):
    rnd = random.Random(seed)
    n = 1200
    rows_ = [("HOT" if rnd.random() < hot_share else f"K{rnd.randint(0, 20)}", rnd.randint(0, 60), i,
              rnd.choice([0, 0, 30, 90, 200]), float(rnd.randint(0, 9))) for i in range(n)]
    df = spark.createDataFrame(rows_, "k string, d int, t int, dpd int, amt double")
    d = F.col("dpd")
    spec = [W.Spec(["k"], ["d", "t"], rows=[
        W.Rows("mx", "max", d, before), W.Rows("sm", "sum", F.col("amt"), before, after),
        W.Rows("lg", "lag", d, 1, default=-1), W.Rows("ld", "lead", d, 0, max(after, 1), default=-2)],
        running=[W.RunningSum("cum", F.col("amt"), "d")])]
    plain_out = W.windowed(df, spec, max_rows_per_key=10 ** 9)
    split_out = W.windowed(df, spec, max_rows_per_key=max(1, int(n * 0.2)), chunk_rows=max(chunk, before + after + 2))
    assert rows(split_out.select(*plain_out.columns)) == rows(plain_out)
