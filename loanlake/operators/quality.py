"""Data-quality checks (Q1-Q8, I5-I6). Every check returns a DataFrame of
findings computed in one distributed pass; ``gate`` turns findings into a
pass/fail decision. Nothing iterates rows on the driver."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake import schema as S
from loanlake.functions.columns import ts_ntz_lit


def schema_violations(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """Q1 (metadata part): missing columns, unexpected columns, type
    mismatches. Compares two schemas; no data is read."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in expected.fields:
        if f.name not in actual:
            out.append((f.name, "missing_column", f.dataType.simpleString()))
        elif actual[f.name] != f.dataType:
            out.append((f.name, "type_mismatch",
                        f"expected {f.dataType.simpleString()}, got {actual[f.name].simpleString()}"))
    names = {f.name for f in expected.fields}
    out += [(c, "unexpected_column", actual[c].simpleString()) for c in actual if c not in names]
    return out


def _unpivot(counts: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias(label), F.col(n).cast("bigint").alias(value)) for n in names])))


def length_violations(df: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Q1 (data part): rows per column longer than its VARCHAR(n)."""
    limits = limits or S.VARCHAR_LIMITS
    cols = [c for c in limits if c in df.columns]
    counts = df.agg(*[F.count(F.when(F.length(c) > limits[c], 1)).alias(c) for c in cols])
    return _unpivot(counts, cols, "column_name", "violations")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q2: NULLs per column, all columns in one scan."""
    cols = columns or df.columns
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    return _unpivot(counts, cols, "column_name", "null_count")


def range_rules() -> dict[str, Column]:
    """Range rules of the raw table: credit score 300-850, non-negative days
    past due / ratios / current balance, positive balance and rate."""
    return {
    "credit_score_300_850": ~F.col("credit_score").between(S.CREDIT_SCORE_MIN, S.CREDIT_SCORE_MAX),
    "days_past_due_non_negative": F.col("days_past_due") < 0,
    "ltv_ratio_non_negative": F.col("ltv_ratio") < 0,
    "dti_ratio_non_negative": F.col("dti_ratio") < 0,
    "original_balance_positive": F.col("original_balance") <= 0,
    "interest_rate_positive": F.col("interest_rate") <= 0,
    "current_balance_non_negative": F.col("current_balance") < 0,
    }


def range_violations(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Q3: rows breaking each range rule (NULL is not a range violation)."""
    rules = rules or range_rules()
    counts = df.agg(*[F.count(F.when(cond, 1)).alias(name) for name, cond in rules.items()])
    return _unpivot(counts, list(rules), "rule", "violations")


def orphan_summary(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Q4: child rows whose key has no parent. Child keys are first reduced
    to (key, rows) by a combinable count, so a hot key is one row before the
    join shuffle; parent keys are deduplicated the same way. One LEFT join on
    the key (both sides hash-partitioned once) marks orphans, one global
    aggregate counts them. NULL keys are not orphans."""
    ck = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"))
    pk = parent.filter(F.col(parent_key).isNotNull()).groupBy(F.col(parent_key).alias("_k")).agg(
        F.lit(True).alias("_p"))
    orphan = F.col("_p").isNull()
    return (ck.join(pk, "_k", "left")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("child_rows"),
                 F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
                 F.count(F.when(orphan, 1)).alias("orphan_keys"))
            .select(F.lit(name).alias("relationship"), "child_rows", "orphan_rows", "orphan_keys"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q5 detail: key values occurring more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def uniqueness_summary(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Q5: distinct keys, duplicated keys and surplus rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("distinct_keys"),
                 F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows")) \
        .select(F.lit(name).alias("check_name"), "distinct_keys", "duplicate_keys", "surplus_rows")


ACCEPTED_VALUES = {
    "event_type": S.EVENT_TYPES,
    "loan_type": S.LOAN_TYPES,
    "loan_purpose": S.LOAN_PURPOSES,
    "property_state": S.STATES,
    "tenant_id": S.TENANT_IDS,
}


def accepted_value_violations(df: DataFrame, domains: dict[str, list[str]] | None = None) -> DataFrame:
    """Q6: (column, value, rows) for values outside the domain; NULL passes."""
    domains = domains or ACCEPTED_VALUES
    cols = [c for c in domains if c in df.columns]
    pairs = df.select(F.explode(F.array(*[
        F.when(~F.col(c).isin(domains[c]), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")))
        for c in cols])).alias("p")).filter(F.col("p").isNotNull())
    return pairs.groupBy("p.column_name", "p.value").agg(F.count(F.lit(1)).alias("rows"))


def freshness(raw: DataFrame, as_of: dt.datetime, max_minutes: int = S.FRESHNESS_MINUTES,
              by: str = "tenant_id") -> DataFrame:
    """Q7: latest load per tenant and its age in whole seconds at ``as_of``."""
    last = raw.groupBy(by).agg(F.max("loaded_at").alias("last_loaded_at"))
    age_us = F.unix_micros(ts_ntz_lit(as_of).cast("timestamp")) - F.unix_micros(
        F.col("last_loaded_at").cast("timestamp"))
    return last.select(by, "last_loaded_at",
                       F.floor(age_us / 1_000_000).cast("bigint").alias("age_seconds"),
                       (age_us > max_minutes * 60 * 1_000_000).alias("is_stale"))


def volume_anomalies(raw: DataFrame, trailing_hours: int = 24, z_limit: float = 3.0,
                     by: str = "tenant_id") -> DataFrame:
    """Q8: rows loaded per tenant-hour vs the previous ``trailing_hours``
    clock hours (a RANGE frame on the hour number, so quiet hours are not
    counted as data). z = (n - mean) / sample stddev, computed from exact
    integer sums. One row per tenant-hour: bounded by the calendar."""
    hourly = raw.groupBy(by, F.date_trunc("hour", "loaded_at").cast("timestamp_ntz").alias("load_hour")) \
        .agg(F.count(F.lit(1)).alias("event_count"))
    hour_no = F.floor(F.unix_seconds(F.col("load_hour").cast("timestamp")) / 3600)
    w = Window.partitionBy(by).orderBy(hour_no).rangeBetween(-trailing_hours, -1)
    n = F.col("event_count")
    k, s1, s2 = F.count(n).over(w), F.sum(n).over(w), F.sum(n * n).over(w)
    out = hourly.select("*", k.alias("_k"), s1.alias("_s1"), s2.alias("_s2"))
    kd = F.col("_k").cast("double")
    mean = F.col("_s1").cast("double") / kd
    var = (F.col("_k") * F.col("_s2") - F.col("_s1") * F.col("_s1")).cast("double") / (
        F.col("_k") * (F.col("_k") - 1)).cast("double")
    z = F.when((F.col("_k") >= 2) & (var > 0), (n.cast("double") - mean) / F.sqrt(var))
    return out.select(by, "load_hour", "event_count", F.col("_k").alias("trailing_hours_seen"),
                      F.when(F.col("_k") > 0, mean).alias("trailing_mean"), z.alias("z_score"),
                      F.coalesce(F.abs(z) > z_limit, F.lit(False)).alias("is_anomaly"))


@dataclass
class GateResult:
    passed: bool
    failures: list[dict]


def gate(findings: dict[str, DataFrame], count_col: dict[str, str]) -> GateResult:
    """A check fails when any finding row has a positive count. Each
    findings frame is small (one row per rule/column), so it is collected."""
    failures = []
    for name, df in findings.items():
        col = count_col.get(name)
        rows = df.filter(F.col(col) > 0).collect() if col else df.collect()
        failures += [{"check": name, **r.asDict()} for r in rows]
    return GateResult(not failures, failures)
