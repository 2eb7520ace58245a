"""Readers and writers."""

from __future__ import annotations

import pytest

from slotcast.functions import scalar as X
from slotcast.plans import reports
from slotcast.session import scratch_path
from slotcast.sources import sinks, tables


def test_run_log_skips_blank_and_malformed_lines(spark, tmp_path):
    path = tmp_path / "runs.jsonl"
    path.write_text('{"ts":"2026-01-01T10:00:00","lb":88.0,"note":"a","unknown":1}\n\n{"ts": broken\n'
                    '{"ts":"2026-01-02T10:00:00","blend_calib":0.5,"eval":{"res_mean":0.1}}\n')
    rows = tables.read_run_log(spark, str(path)).orderBy("ts").collect()
    assert [(r["ts"][:10], r["lb"], r["blend_calib"]) for r in rows] == [("2026-01-01", 88.0, None), ("2026-01-02", None, 0.5)]
    assert rows[1]["eval"]["res_mean"] == 0.1
    history = reports.run_history(tables.read_run_log(spark, str(path))).orderBy("ts").collect()
    assert [(r["lb"], r["weights"], r["calibration"]) for r in history] == [("88.00", "-", "1.000,0.000"), ("-", "-", "1.000,0.000")]


def test_run_log_keeps_valid_lines_with_a_mistyped_field(spark, tmp_path):
    path = tmp_path / "runs.jsonl"
    path.write_text('{"ts":"a","lb":"n/a","note":"x"}\n{"ts":"b","n_feat":50.0,"lb":1.5}\n{"ts":"c","lb":NaN}\nno json\n'
                    '{"ts":"d","lb":2.5\n{"ts":"e","w":{"lgbm":"?","cat":0.5}}\n')
    rows = {r["ts"]: r for r in tables.read_run_log(spark, str(path)).collect()}
    assert set(rows) == {"a", "b", "c", "e"}
    assert rows["a"]["lb"] is None and rows["a"]["note"] == "x" and rows["b"]["lb"] == 1.5 and rows["e"]["w"]["cat"] == 0.5


def test_columns_go_by_name(spark, tmp_path):
    names = ["geohash", "Index", "other", "day", "timestamp", "RoadType", "NumberofLanes", "LargeVehicles", "Landmarks", "Weather",
             "Temperature"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\nqp0000,7,z,48,1:15,Street,2.0,Allowed,,Sunny,NaN\n")
    row = tables.read_observations(spark, str(tmp_path / "a.csv"), labelled=False).first()
    assert (row["Index"], row["geohash"], row["NumberofLanes"], row["Landmarks"], row["Temperature"]) == (7, "qp0000", 2, None, None)
    with pytest.raises(Exception, match="demand"):
        tables.read_observations(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text(",".join(names) + "\nqp0000,x7,z,48,1:15,Street,2,Allowed,,Sunny,1\n")
    with pytest.raises(Exception, match="column Index"):
        tables.read_observations(spark, str(tmp_path / "b.csv"), labelled=False).collect()


def test_long_geohashes_keep_all_characters(spark):
    from slotcast.functions.geo import decode

    keys = ["u4pruydqqvj", "u4pruydqqvj8n", "u4pruydqqvj8p", "u4pruydqqvj8nnnnnnnn", "bad!", None]
    rows = {r["geohash"]: r for r in decode(spark.createDataFrame([(k,) for k in keys], "geohash string")).collect()}
    assert rows["u4pruydqqvj"]["lat"] == pytest.approx(57.64911, abs=1e-5) and rows["u4pruydqqvj"]["lon"] == pytest.approx(10.40744, abs=1e-5)
    assert rows["u4pruydqqvj8n"]["lon"] != rows["u4pruydqqvj8p"]["lon"] or rows["u4pruydqqvj8n"]["lat"] != rows["u4pruydqqvj8p"]["lat"]
    assert rows["u4pruydqqvj8nnnnnnnn"]["valid"] and not rows["bad!"]["valid"]
    with pytest.raises(Exception, match="more than 24"):
        decode(spark.createDataFrame([("u" * 25,)], "geohash string")).collect()


def test_view_keys_differ_beyond_32000_users(spark):
    from slotcast.sources.events_view import observations

    path = scratch_path(spark, "events")
    users = [5, 31_999, 32_005, 64_005, 1_024_005, 9_000_005]
    spark.createDataFrame([(u, 1.0, "click", "k1") for u in users], "user_id bigint, value double, event_type string, props string").selectExpr(
        "user_id", "value", "event_type", "props", "timestamp'2024-01-20 10:00:00' as ts").write.parquet(f"{path}/events.parquet")
    keys = [r["geohash"] for r in observations(spark, path).select("geohash").distinct().collect()]
    assert len(keys) == len(users) and "qp0005" in keys


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from slotcast import session

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: None)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


def test_options_and_stored_tables_do_not_stay(spark):
    import os

    from slotcast import session

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with session.tuned(spark):
            assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    with session.stored_tables_dropped(spark):
        stored = session.materialize(spark.range(3)).inputFiles()[0].removeprefix("file:")
        assert os.path.exists("/" + stored.lstrip("/"))
    assert not os.path.exists("/" + stored.lstrip("/"))


def test_missing_files_are_empty_tables(spark):
    assert tables.read_run_log(spark, scratch_path(spark, "nothing")).count() == 0
    assert tables.read_optional(spark, scratch_path(spark, "nothing"), "a bigint").count() == 0


def test_append_keeps_earlier_records(spark):
    path = scratch_path(spark, "runs")
    for note in ("first", "second"):
        sinks.append_run_record(spark.sql(f"select '{note}' as note, 0.5D as blend_raw"), path)
    assert {r["note"] for r in tables.read_run_log(spark, path).collect()} == {"first", "second"}


def test_observations_round_trip_and_nan(spark, observed):
    path = scratch_path(spark, "csv")
    rows = observed([("qp0000", 48, 75, 0.123456789), ("qp0001", 49, 0, 0.5)], temperature=[float("nan"), 3.5])
    rows.drop("hour", "minute", "minute_of_day").write.csv(path, header=True)
    back = {r["Index"]: r for r in tables.read_observations(spark, path).collect()}
    assert back[0]["demand"] == 0.123456789 and back[0]["timestamp"] == "1:15"
    assert back[0]["Temperature"] is None and back[1]["Temperature"] == 3.5


def test_predictions_and_document(spark):
    path = scratch_path(spark, "out")
    sinks.write_predictions(spark.sql("select 7L as Index, 0.25D as demand, 1 as other"), path)
    assert [tuple(r) for r in spark.read.csv(path, header=True, inferSchema=True).collect()] == [(7, 0.25)]
    report = spark.sql("select * from values ('a', 'x', 1D), ('a', 'y', 2D), ('b', 'z', 3D) as t(section, item, value)")
    assert reports.evaluation_document(report).first()["eval"] == {"a": {"x": 1.0, "y": 2.0}, "b": {"z": 3.0}}


def test_null_counts(spark):
    rows = sinks.null_counts(spark.sql("select * from values (1, null), (2, 'x'), (null, null) as t(a, b)")).collect()
    assert {r["column"]: r["n_null"] for r in rows} == {"a": 1, "b": 2}


def test_lanes_must_not_be_null(spark):
    with pytest.raises(Exception, match="must not be null"):
        spark.sql("select cast(null as string) as lanes").selectExpr(X.required_int("lanes", "lanes")).collect()


@pytest.mark.parametrize("value,bucket", [(0.0, 0), (0.0299, 0), (0.03, 1), (0.07, 2), (0.15, 3), (1.0, 3), (None, None)])
def test_buckets_are_left_closed(spark, value, bucket):
    shown = "cast(null as double)" if value is None else f"{value}D"
    assert spark.sql(f"select {X.bucket(shown)} as b").first()["b"] == bucket
