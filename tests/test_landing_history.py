"""Each landing file is loaded once, as it is."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from loanlake.plans import pipeline
from loanlake.plans.tables import read_raw
from loanlake.sources import landing
from test_ingest import event, write


def cfg(scratch, land, **kw):
    return pipeline.PipelineConfig(landing_dir=land, raw_path=os.path.join(scratch, "raw"), fact_path=os.path.join(scratch, "fact"),
                                   rejects_path=os.path.join(scratch, "rejects"), audit_path=os.path.join(scratch, "audit"), **kw)


def lines(*ids):
    return "".join(json.dumps(event(i)) + "\n" for i in ids)


def run(spark, scratch, land, batch, day, **kw):
    return pipeline.run_pipeline(spark, cfg(scratch, land, batch_id=batch, as_of=dt.datetime(2024, 2, day), **kw))


def test_a_rewritten_file_is_loaded_an_untouched_one_is_not(spark, scratch):
    land = os.path.join(scratch, "land")
    write(os.path.join(land, "ds=1"), "a [1] {x}.json", lines(1, 2))
    write(os.path.join(land, "ds=1"), "b.json", lines(3))
    write(land, "_hidden.json", lines(9))
    a = run(spark, scratch, land, "a", 1)
    assert (a["files"], a["rows_inserted"]) == (2, 3)
    assert run(spark, scratch, land, "b", 2)["status"] == "skipped"
    write(os.path.join(land, "ds=1"), "a [1] {x}.json", lines(1, 2, 4))      # longer
    c = run(spark, scratch, land, "c", 3)
    assert (c["files"], c["rows_inserted"], c["rows_skipped"]) == (1, 1, 2)
    time.sleep(1.1)
    write(os.path.join(land, "ds=1"), "b.json", lines(5))                    # as long as before
    d = run(spark, scratch, land, "d", 4)
    assert (d["files"], d["rows_inserted"]) == (1, 1)
    assert sorted(r["event_id"] for r in read_raw(spark, os.path.join(scratch, "raw")).collect()) == ["e-1", "e-2", "e-3", "e-4", "e-5"]
    assert run(spark, scratch, land, "e", 5)["status"] == "skipped"


def test_more_files_than_a_run_takes_wait_for_the_next(spark, scratch):
    land = os.path.join(scratch, "land")
    for i in range(5):
        write(land, f"f{i}.json", lines(i))
    got = [run(spark, scratch, land, f"r{k}", k + 1, max_files=2)["rows_inserted"] for k in range(4)]
    assert got == [2, 2, 1, 0]


def test_a_hundred_thousand_names(spark, scratch):
    land, loaded = os.path.join(scratch, "land"), os.path.join(scratch, "loaded")
    for d in range(100):
        os.makedirs(os.path.join(land, f"ds={d}"))
        for i in range(1000):
            open(os.path.join(land, f"ds={d}", f"{i}.json"), "w").close()
    found = landing.landing_files(spark, land)
    assert found.rdd.getNumPartitions() <= 64
    found.withColumn("batch_id", F.lit("old")).write.parquet(loaded)
    assert landing.new_files(spark, land, loaded) == []
    write(os.path.join(land, "ds=7"), "5.json", lines(1))
    write(os.path.join(land, "ds=8"), "new.json", lines(2))
    new = landing.new_files(spark, land, loaded)
    assert sorted(os.path.basename(f[0]) for f in new) == ["5.json", "new.json"]
    landing.mark_loaded(spark, new, loaded, "next")
    assert landing.new_files(spark, land, loaded) == []


def test_a_folder_that_is_not_there(spark, scratch):
    assert landing.new_files(spark, os.path.join(scratch, "none"), os.path.join(scratch, "loaded")) == []
