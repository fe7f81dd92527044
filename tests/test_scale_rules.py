"""Nothing is lost silently: mismatched chunks, days, boxes, latitudes and
folders fail or keep every row; hot cells split without changing pairs."""

import os
import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, pings
from tracklens.config import EncounterConfig, ScoreWeights
from tracklens.operators import filters as flt
from tracklens.operators import proximity as prox
from tracklens.operators import reaction as rx
from tracklens.operators import score as sc
from tracklens.operators import tracks as tr
from tracklens.operators import trajectory as tj
from tracklens.plans import materialize as mat
from tracklens.plans.catalog import QUERIES, Fixture
from tracklens.sources.ais_csv import parse_ais
from tracklens.sources.fixture import pings_from_events
from tracklens.sources.store import DAY_COLUMN, read_pings, write_pings

CFG = EncounterConfig()
SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture()
def zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_event_is_a_ping(spark, sf):
    events = spark.read.parquet(f"/root/testdata/{sf}/events.parquet")
    assert pings_from_events(spark, events).count() == events.count()


def test_chunks_of_another_length_fail(spark):
    rows = [{"mmsi": 5, "t": 60 * i, "lat": 55.0 + i * 1e-3} for i in range(200)]
    clean = tr.clean_tracks(pings(spark, rows), replace(CFG, track_chunk_s=3600), ("event_id",))
    events = spark.createDataFrame([(5, T0 + 7200)], "mmsi long, event_unix long")
    assert rx.event_window_pings(events, clean, 120, 3600).count() > 0
    with pytest.raises(Exception, match="was not made with chunks of 7200 s"):
        rx.event_window_pings(events, clean, 120, 7200).collect()
    with pytest.raises(Exception, match="was not made with chunks"):
        tr.previous_fix(clean, replace(CFG, track_chunk_s=1800), ("event_id",)).collect()


@pytest.mark.parametrize("tz", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_days_texts_and_reports_do_not_depend_on_the_session_zone(spark, zone, scratch, tz):
    zone(tz)
    unix = 1640973600  # 2021-12-31 18:00:00 UTC
    rows = [{"mmsi": 5, "t": unix - T0, "lat": 55.0, "lon": 14.2}]
    path = os.path.join(scratch, "p")
    write_pings(pings(spark, rows, with_id=False), path)
    kept = flt.time_window(read_pings(spark, path), CFG, DAY_COLUMN)
    assert [str(r[DAY_COLUMN]) for r in kept.collect()] == ["2021-12-31"]
    text = spark.createDataFrame([(" 31/12/2021 18:00:00", "5", "55.0", "14.2", "1", "1", "n", "s", "m")], "`# Timestamp` string, MMSI string, Latitude string, Longitude string, SOG string, COG string, Name string, `Ship type` string, `Type of mobile` string")
    assert parse_ais(text).first()["ts_unix"] == unix
    assert spark.range(1).select(tj.utc_text(F.lit(unix + 61))).first()[0] == "2021-12-31 18:01:01"


def test_a_foreign_day_column_is_not_a_filter(spark):
    df = pings(spark, [{"mmsi": 5, "t": 0, "lat": 55.0}]).withColumn("day", F.lit("Wednesday"))
    assert flt.time_window(df, CFG).count() == 1


@pytest.mark.parametrize("lat,radius", [(75.0, 500.0), (0.0, 300.0), (55.225, 50.0), (-60.0, 800.0)])
def test_box_contains_circle(spark, lat, radius):
    cfg = replace(CFG, center_lat=lat, center_lon=10.0, radius_nm=radius, grid_cell_deg=0.1)
    rnd = random.Random(1)
    rows = [(max(-90.0, min(90.0, lat + rnd.uniform(-1.2, 1.2) * radius / 60)), 10 + rnd.uniform(-1, 1) * 60) for _ in range(4000)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    assert flt.radius_filter(df, cfg).count() == flt.within_radius(df, cfg).count() > 20


def test_areas_at_the_pole_or_antimeridian_are_refused():
    with pytest.raises(ValueError, match="pole or the antimeridian"):
        replace(CFG, center_lat=89.5).validate()
    with pytest.raises(ValueError, match="pole or the antimeridian"):
        replace(CFG, center_lon=179.5).validate()


@pytest.mark.parametrize("strategy", ["border", "neighbors"])
def test_pings_beyond_the_grid_latitude_fail(spark, strategy):
    rows = [{"mmsi": m, "t": 0, "lat": 88.0, "lon": 14.0 + m * 1e-3, "sog": 5.0} for m in (1, 2)]
    with pytest.raises(Exception, match="a ping lies beyond latitude"):
        prox.proximity_pairs(prox.pairing_pings(pings(spark, rows), CFG), CFG, strategy).collect()


def test_materialize_needs_the_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(mat, "shared_checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        mat.materialize(spark.range(3))


def test_one_file_a_bucket(spark):
    df = mat.materialize(spark.range(5000).select((F.col("id") % 97).alias("mmsi"), F.col("id")), ["mmsi"], num_buckets=5)
    assert df.select(F.input_file_name()).distinct().count() == 5 and df.count() == 5000


def test_default_cleaning_shuffles_pings_once(spark):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    df = tr.clean_tracks(fx.notsar.drop("event_id"), CFG)
    df.collect()
    lines = plan(df).split("\n")
    wide = [x for x in lines if "Exchange hashpartitioning" in x and "ReusedExchange" not in x and "track_chunk" in x]
    assert len(wide) == 1 and "REPARTITION_BY_COL" in wide[0], wide


def test_density_counts_candidate_cells_only(spark):
    fx = Fixture(spark, SF)
    df = prox.find_candidates(fx.clean, CFG, fx.order, pp=fx.pp)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"count\(distinct mmsi|Aggregate \[grid_lat.*mmsi", logical) and "LeftSemi" in logical
    assert df.count() > 100  # grows with the table


def test_fixture_reaches_every_branch(spark):
    fx = Fixture(spark, SF)
    assert fx.bbox.count() > fx.radius.count()
    raw = rx.event_reaction(rx.silence_flags(fx.cands, fx.clean, CFG), fx.clean, CFG)
    w = CFG.weights
    r = raw.agg(
        F.max("max_sog_drop"), F.max("closing_speed_kn"), F.max("distance_nm"), F.min("silence_b"), F.max("silence_count"), F.count("*")
    ).first()
    assert r[0] > w.cap_sog_drop and r[1] > w.cap_closing_speed and r[2] * 1852 > w.distance_free_m and r[3] < 0 and r[4] == 2
    assert r[5] < Fixture(spark, "/root/testdata/sf0.1").cands.count()


def test_no_reaction_threshold_is_the_knot(spark):
    base = {"silence_count": 0, "min_silence_s": 999999, "max_cog_change": 0.0, "post_event_divergence": 0.0, "closing_speed_kn": 0.0, "distance_nm": 0.0, "scene_density": 1.0}
    df = spark.createDataFrame([(1.5,)], "max_sog_drop double").withColumns({k: F.lit(v) for k, v in base.items()})
    score = lambda knot: sc.collision_score(df, replace(CFG, weights=ScoreWeights(no_reaction_below_kn=knot))).first()["collision_score"]
    assert score(1.0) == pytest.approx(12.0) and score(2.0) == pytest.approx(12.0 - 0.5 * 10)


def test_salted_cells_give_the_same_pairs(spark):
    rnd = random.Random(5)
    rows = [
        {"mmsi": m, "t": 5 + k, "lat": 55.2 + rnd.uniform(0, 0.0005), "lon": 14.2 + rnd.uniform(0, 0.0005), "sog": 5.0}
        for m in range(1, 41) for k in range(0, 50, 5)
    ]
    pp = prox.pairing_pings(pings(spark, rows), CFG)

    def run(cfg):
        df = prox.proximity_pairs(pp, cfg).withColumn("task", F.spark_partition_id())
        out = df.select("mmsi_a", "mmsi_b", "ts_unix_a", "ts_unix_b", "task").collect()
        return sorted(tuple(r)[:4] for r in out), len({r.task for r in out})

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "-1", "false"), strict=True):
            spark.conf.set(k, v)
        plain, one = run(CFG)
        salted, several = run(replace(CFG, cell_salts=6))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plain == salted and len(plain) > 1000 and one == 1 and several > 2


def test_windows_need_no_ping_shuffle(spark):
    fx = Fixture(spark, SF)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    top = mat.materialize(fx.top.select("*"))
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = tj.trajectories(fx.clean, top, CFG)
        assert df.count() > 0
        lines = plan(df).split("\n")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    scans = [i for i, x in enumerate(lines) if "FileScan parquet spark_catalog.default.tracklens_" in x]
    assert not any("Broadcast" in x for x in lines)
    for i in scans:
        assert not any("Exchange" in x for x in lines[max(0, i - 2) : i])


def test_stage_counts_reads_few_times(spark):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    fx.clean.count(), fx.pp.count()
    p = QUERIES["stage_counts"](fx)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation ", p)) <= 8
