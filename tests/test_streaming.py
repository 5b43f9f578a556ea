"""The streaming daily load equals the single-pass datelist backfill."""

import shutil

from pyspark.sql import functions as F

from conftest import rows
from dimforge.operators.datelist import datelist_backfill
from dimforge.sinks.publish import read_partition
from dimforge.streaming.daily_load import start_datelist_stream


def test_stream_of_event_files_builds_the_datelist(spark, sf_dir, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{sf_dir}/events.parquet", src / "part-0.parquet")
    schema = spark.read.parquet(str(src)).schema
    table = str(tmp_path / "user_datelist")
    q = start_datelist_stream(spark, str(src), schema, table, keys=["user_id"], ts_col="ts",
                              checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(600)
    assert q.exception() is None
    events = spark.read.parquet(str(src))
    last = events.select(F.max(F.to_date("ts"))).first()[0]
    want = datelist_backfill(events, keys=["user_id"], ts_col="ts", lo="2024-01-01", hi=last.isoformat())
    got = read_partition(spark, table, "curr_date", last)
    assert rows(got, ["user_id", "dates_active"]) == rows(want, ["user_id", "dates_active"])
