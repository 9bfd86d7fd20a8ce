"""Windows of an event stream: closed by the watermark, kept open over runs, late events left out."""

import datetime as dt

from lumengrid.streaming import cases


def put(spark, folder, name, rows):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), kind, v) for m, kind, v in rows], "ts timestamp_ntz, event_type string, value double")
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def windows(df):
    return sorted((r["start"].hour * 60 + r["start"].minute, r["event_type"], r["n"], r["total"]) for r in df.collect())


def test_windows_close_over_runs(spark, tmp_path):
    source, target = f"{tmp_path}/in/*", f"{tmp_path}/out"
    put(spark, f"{tmp_path}/in", "one", [(0, "a", 1.0), (59, "a", 2.0), (30, "b", 5.0), (70, "a", 4.0), (185, "a", 7.0)])
    # The watermark is at 65 minutes: the first hour is closed.
    assert windows(cases.closed_windows(spark, source, target)) == [(0, "a", 2, 3.0), (0, "b", 1, 5.0)]
    put(spark, f"{tmp_path}/in", "two", [(20, "a", 100.0), (80, "a", 8.0), (400, "b", 1.0)])  # the first is too late, the second is not
    first = windows(cases.closed_windows(spark, source, target))
    assert first == [(0, "a", 2, 3.0), (0, "b", 1, 5.0), (60, "a", 2, 12.0), (180, "a", 1, 7.0)]
    assert windows(cases.closed_windows(spark, source, target)) == first
