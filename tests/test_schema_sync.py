"""Schema sync of the tables kept in place (H3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from loanlake.functions.columns import ts_ntz_lit
from loanlake.operators import incremental, marts, staging
from loanlake.plans import pipeline, tables
from loanlake.plans.schema_record import (Record, plain, plan_sync, read_record, read_table, record_path, reshape,
                                          wider)
from loanlake.plans.tables import read_raw
from loanlake.schema import extra_fields
from loanlake.sources import fixtures, landing

CUTS = [dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 18), dt.datetime(2024, 2, 10)]


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def test_wider_types(spark):
    t = T.DataType.fromDDL
    for a, b, want in [("int", "bigint", "bigint"), ("smallint", "int", "int"), ("float", "double", "double"),
                       ("int", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
                       ("decimal(10,2)", "decimal(14,2)", "decimal(14,2)"), ("string", "string", "string"),
                       ("bigint", "double", None), ("string", "int", None), ("decimal(10,2)", "decimal(10,4)", None)]:
        want = t(want) if want else None
        assert wider(t(a), t(b)) == want == wider(t(b), t(a)), (a, b)


def test_plan_of_a_sync(spark):
    old = Record(schema("id string, n int, gone string"), 3, ("before",))
    same = plan_sync(old, schema("gone string, id string, n smallint"))
    assert not same.changed and same.record.version == 3 and same.record.schema == schema("gone string, id string, n int")
    s = plan_sync(old, schema("id string, n bigint, fresh date"))
    assert (s.added, s.removed, s.retyped, s.rewrite) == (("fresh",), ("gone",), ("n",), False)
    assert s.record == Record(schema("id string, n bigint, fresh date"), 4, ("before", "gone"))
    back = plan_sync(old, schema("id string, n int, gone string, before string"))
    assert back.rewrite and back.record.dropped == ()
    assert plan_sync(old, schema("id int, n int, gone string")).rewrite
    assert Record.from_json(s.record.to_json()) == s.record


def test_files_of_older_types_read_under_the_record(spark, scratch):
    path = os.path.join(scratch, "t")
    for k, (old, new) in enumerate([("smallint", "int"), ("int", "bigint"), ("float", "double"), ("int", "double"),
                                    ("date", "timestamp_ntz"), ("decimal(10,2)", "decimal(14,2)")]):
        one = f"{path}{k}"
        value = F.lit("2024-01-02") if old == "date" else F.lit(7)
        spark.range(3).select("id", value.cast(old).alias("v")).write.parquet(one)
        spark.range(3, 5).select("id", value.cast(new).alias("v"), F.lit("x").alias("w")).write.mode("append").parquet(one)
        tables.write_marker(spark, record_path(one), Record(schema(f"id bigint, v {new}, w string")).to_json())
        got = read_table(spark, one).collect()
        assert len(got) == 5 and len({r["v"] for r in got}) == 1 and sum(r["w"] is None for r in got) == 3


def cfg(scratch, land, **kw):
    return pipeline.PipelineConfig(landing_dir=land, raw_path=os.path.join(scratch, "raw"), fact_path=os.path.join(scratch, "fact"),
                                   rejects_path=os.path.join(scratch, "rejects"), audit_path=os.path.join(scratch, "audit"), **kw)


def land_parts(spark, scratch, fields):
    """Landing folders of the events loaded up to each cut, with their run's extra fields."""
    raw = fixtures.loan_events(spark, SF_SMALL).filter("borrower_id is not null")
    lo, out = dt.datetime(2020, 1, 1), []
    for k, (hi, extra) in enumerate(zip(CUTS, fields)):
        part = raw.filter((F.col("loaded_at") >= ts_ntz_lit(lo)) & (F.col("loaded_at") < ts_ntz_lit(hi)))
        for name, typ in extra:
            value = F.length("event_id") if typ in ("int", "bigint", "double") else F.lower("event_type")
            part = part.withColumn(name, value.cast(typ))
        columns = [c for c in part.columns if c not in ("loaded_at", "batch_id")]
        out.append(os.path.join(scratch, f"land{k}"))
        landing.write_landing(part, out[-1], columns=columns)
        lo = hi
    return out


def rows(df, columns):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def check(spark, scratch, extra, columns):
    """The fact has these extra columns and equals a build from the raw table."""
    raw = read_raw(spark, os.path.join(scratch, "raw"))
    fact = read_table(spark, os.path.join(scratch, "fact"))
    want = marts.loan_portfolio(staging.stage_loans(raw, extra=extra))
    assert fact.columns == [*marts.FACT_COLUMNS, *extra]
    assert [(c, fact.schema[c].dataType.simpleString()) for c in extra] == columns
    names = [c for c in fact.columns if c not in ("dbt_updated_at", "loan_age_years")]
    assert rows(reshape(fact, fact.schema), names) == rows(reshape(want, fact.schema), names)


@pytest.mark.parametrize("with_state,by_date", [(False, True), (True, False)])
def test_added_widened_and_dropped_fields_through_the_pipeline(spark, scratch, with_state, by_date):
    state = os.path.join(scratch, "state") if with_state else None
    fields = [(("channel", "string"),), (("channel", "string"), ("score", "int")), (("score", "bigint"),)]
    lands = land_parts(spark, scratch, fields)
    audits = []
    for k, (land, extra) in enumerate(zip(lands, fields)):
        audits.append(pipeline.run_pipeline(spark, cfg(scratch, land, batch_id=f"r{k}", as_of=CUTS[k], state_root=state,
                                                       raw_by_event_date=by_date, extra_fields=extra)))
        kinds = [[("channel", "string")], [("channel", "string"), ("score", "int")], [("score", "bigint")]][k]
        check(spark, scratch, tuple(n for n, _ in extra), kinds)
    assert [a["schema_version"] for a in audits] == [0, 1, 2]
    assert read_record(spark, os.path.join(scratch, "fact")).dropped == ("channel",)
    # the raw table keeps what was dropped from the fact
    assert {"channel", "score"} <= set(read_raw(spark, os.path.join(scratch, "raw")).columns)


def test_a_name_that_comes_back_has_no_old_values(spark, scratch):
    path = os.path.join(scratch, "fact")
    s = staging.stage_loans(fixtures.loan_events(spark, SF_SMALL))
    steps = [s.withColumn("note", F.lit("first")), s, s.withColumn("note", F.when(F.col("loaded_at") >= ts_ntz_lit(CUTS[1]), F.lit("third")))]
    since = None
    for k, (hi, src) in enumerate(zip(CUTS, steps)):
        part = src.filter(F.col("loaded_at") < ts_ntz_lit(hi))
        if k == 0:
            first = marts.loan_portfolio(part)
            tables.clustered(first, "event_date", ["loan_id"]).write.partitionBy("event_date").parquet(path)
        else:
            target = read_table(spark, path)
            changed, dates = incremental.changed_partitions(part, target, since)
            pipeline.swap_in(spark, changed, dates, target, path, ["loan_id"], os.path.join(scratch, f"stage{k}"))
        since = part.agg(F.max("loaded_at")).first()[0]
        got = read_table(spark, path)
        assert ("note" in got.columns) == (k != 1)
    values = {r["note"] for r in got.select("note").distinct().collect()}
    assert values == {None, "third"}
    assert rows(got, got.columns) == rows(marts.loan_portfolio(part).select(*got.columns), got.columns)
    # an incompatible type is cast once in every partition
    target = read_table(spark, path)
    part = part.withColumn("note", F.lit(5)).withColumn("loaded_at", F.col("loaded_at") + F.expr("interval 30 days"))
    changed, dates = incremental.changed_partitions(part.filter("loan_id < 'LN-2'").unionByName(part.filter("loan_id >= 'LN-2'")), target, since)
    pipeline.swap_in(spark, changed, dates, target, path, ["loan_id"], os.path.join(scratch, "stage9"))
    assert read_table(spark, path).schema["note"].dataType == T.IntegerType()


def test_crash_in_the_swap_keeps_record_and_rows_together(spark, scratch, monkeypatch):
    fields = [(), (("score", "int"),), (("score", "int"),)]
    lands = land_parts(spark, scratch, fields)
    pipeline.run_pipeline(spark, cfg(scratch, lands[0], batch_id="r0", as_of=CUTS[0]))
    real = tables.finish_swap
    for after_record in (False, True):
        def die(spark_, path, after_record=after_record):
            mark = tables.read_marker(spark_, tables.swap_marker(path))
            if mark is None:
                return False
            if after_record:
                tables.write_marker(spark_, record_path(path), mark["record"])
                assert read_table(spark_, path).count() > 0              # old files, new schema
            raise RuntimeError("lost the driver")
        monkeypatch.setattr(tables, "finish_swap", die)
        k = 1 + after_record
        with pytest.raises(RuntimeError):
            pipeline.run_pipeline(spark, cfg(scratch, lands[k], batch_id=f"x{k}", as_of=CUTS[k], extra_fields=fields[k]))
        monkeypatch.setattr(tables, "finish_swap", real)
        pipeline.run_pipeline(spark, cfg(scratch, lands[k], batch_id=f"y{k}", as_of=CUTS[k] + dt.timedelta(hours=1), extra_fields=fields[k]))
        check(spark, scratch, ("score",), [("score", "int")])


def test_extra_fields_are_checked(spark, scratch):
    with pytest.raises(ValueError, match="names of the record"):
        extra_fields((("loan_id", "string"),))
    docs = spark.createDataFrame([('{"event_id": "e", "score": "no"}', "f")], "doc string, source string")
    got = landing.parse_tagged(docs, extra=(("score", "int"),)).collect()[0]
    assert got["reason"] == "bad_field:score" and got["score"] is None
    land = land_parts(spark, scratch, [(("score", "int"),), (("score", "string"),), ()])
    pipeline.run_pipeline(spark, cfg(scratch, land[0], batch_id="a", as_of=CUTS[0], extra_fields=(("score", "int"),)))
    with pytest.raises(ValueError, match="another type"):
        pipeline.run_pipeline(spark, cfg(scratch, land[1], batch_id="b", as_of=CUTS[1], extra_fields=(("score", "string"),)))
    assert plain(read_raw(spark, os.path.join(scratch, "raw")).schema)["score"].dataType == T.IntegerType()
