"""Plan checks: no cartesian products or Python UDFs, one shuffle of the
pings for track cleaning, pushdown into the Parquet scan."""

import os
import re

from tracklens.config import EncounterConfig
from tracklens.operators import tracks as tr
from tracklens.operators.filters import select_pings
from tracklens.operators.proximity import pairing_pings
from tracklens.operators.tracks import clean_tracks
from tracklens.plans.catalog import Fixture
from tracklens.plans.pipeline import detect_encounters
from tracklens.sources.store import DAY_COLUMN, read_pings, write_pings

CFG = EncounterConfig()


def _plan(df):
    """Executed plan; for an adaptive plan only its final part."""
    p = df._jdf.queryExecution().executedPlan().toString()
    return p.split("== Initial Plan ==")[0]


def test_pipeline_has_no_cartesian_or_python(spark):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    res = detect_encounters(fx.raw, CFG, order=("event_id",))
    for df in (res.scored, res.top, res.trajectories, res.lines, res.report):
        p = _plan(df)
        assert "CartesianProduct" not in p
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # the only nested-loop join is the 1-row dataset-end scalar of the silence check
    # (planned once; the B side reuses its broadcast)
    res.scored.collect()
    p = _plan(res.scored)
    assert p.count("BroadcastNestedLoopJoin") <= 1


def test_clean_tracks_shuffles_pings_once(spark):
    fx = Fixture(spark, "/root/testdata/sf0.01")
    df = clean_tracks(fx.notsar, CFG, ("event_id",))
    df.collect()
    p = _plan(df)
    big = [line for line in p.split("\n") if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(big) == 1, big
    assert "ReusedExchange" in p
    # windows keyed by vessel and chunk reuse that partitioning (no exchange on ts_unix)
    assert not re.search(r"Exchange hashpartitioning\(mmsi#\d+L, track_chunk#\d+L, ts_unix", p)


def test_parquet_store_prunes_and_pushes_down(spark, scratch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    fx = Fixture(spark, "/root/testdata/sf0.001")
    path = os.path.join(scratch, "pings")
    write_pings(fx.raw.drop("event_id"), path)
    df = select_pings(read_pings(spark, path), CFG, DAY_COLUMN).select("mmsi", "lat")
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(day" in p
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(lat,", p)
    assert re.search(r"ReadSchema: struct<mmsi:bigint,ts_unix:bigint,lat:double,lon:double,mobile_type:string>", p)
    assert df.count() == fx.notsar.count()


def test_pairing_lag_reuses_bucketed_track_table(spark):
    """Over the clean-track table (bucketed by mmsi, track_chunk) the pairing
    lag and its boundary summary need no shuffle of the pings."""
    from tracklens.operators.proximity import pairing_pings

    fx = Fixture(spark, "/root/testdata/sf0.01")
    df = pairing_pings(fx.clean, CFG, ("event_id",))
    df.collect()
    p = _plan(df)
    assert "REPARTITION_BY_COL" not in p
    assert not re.search(r"Exchange hashpartitioning\(mmsi#\d+L, track_chunk#\d+L", p)


def test_event_window_join_does_not_shuffle_pings(spark):
    """Even when nothing may be broadcast, the +-120 s window join reads the
    bucketed clean-track table without an exchange on the ping side."""
    from tracklens.operators import reaction as rx

    fx = Fixture(spark, "/root/testdata/sf0.01")
    events = fx.events
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        df = rx.event_window_pings(events, fx.clean, CFG.reaction_window_s, CFG.track_chunk_s)
        chunked = sorted(tuple(r) for r in df.select("mmsi", "event_unix", "ts_unix", "offset_s").collect())
        p = _plan(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in p
    lines = p.split("\n")
    scans = [i for i, line in enumerate(lines) if "FileScan parquet spark_catalog.default.tracklens_" in line]
    assert scans
    for i in scans:
        # between the join's Sort and the ping-table scan there is no Exchange
        assert not any("Exchange" in line for line in lines[max(0, i - 2) : i]), lines[max(0, i - 3) : i + 1]
    minute = sorted(
        tuple(r)
        for r in rx.event_window_pings(events, fx.clean, CFG.reaction_window_s)
        .select("mmsi", "event_unix", "ts_unix", "offset_s")
        .collect()
    )
    assert chunked == minute and len(chunked) > 100


def test_track_bucket_count_is_configurable(spark):
    from dataclasses import replace

    from tracklens.plans.pipeline import detect_encounters

    fx = Fixture(spark, "/root/testdata/sf0.001")
    cfg = replace(CFG, track_buckets=3)
    res = detect_encounters(fx.raw, cfg, order=("event_id",))
    agg = res.clean.groupBy("mmsi", "track_chunk").count()
    agg.collect()
    p = _plan(agg)
    assert "SelectedBucketsCount: 3 out of 3" in p
    assert "Exchange" not in p
    base = detect_encounters(fx.raw, CFG, order=("event_id",))
    cols = ["rank", "mmsi_a", "mmsi_b", "ts_unix_a", "collision_score"]
    assert sorted(tuple(r) for r in res.top.select(*cols).collect()) == sorted(
        tuple(r) for r in base.top.select(*cols).collect()
    )


def _events(spark, folder):
    rows = spark.range(4000).selectExpr("id AS event_id", "IF(id % 9 = 0, 'error', 'view') AS event_type", "CAST(id % 37 AS DOUBLE) / 2 AS value")
    rows.write.parquet(f"{folder}/events.parquet")
    return folder


def test_candidates_write_no_table_of_the_moving_vessels_pings(spark, scratch):
    fx = Fixture(spark, _events(spark, scratch))
    assert fx.cands.count() > 0
    assert "clean" not in fx.__dict__
    sides = [sorted(map(str, df.collect())) for df in (fx.pp, pairing_pings(fx.clean, CFG, fx.order).select(*fx.pp.columns))]
    assert sides[0] == sides[1] and len(sides[0]) > 1000


def test_pairing_from_a_long_list_of_moving_vessels_is_the_same(spark, scratch, monkeypatch):
    fx = Fixture(spark, _events(spark, scratch))
    expected = sorted(map(str, fx.pp.collect()))
    monkeypatch.setattr(tr, "BROADCAST_VESSELS", 0)
    other = Fixture(spark, scratch)
    assert sorted(map(str, other.pp.select(*fx.pp.columns).collect())) == expected


def test_pairing_lag_moves_no_pings_and_reads_the_summary_narrowly(spark, scratch):
    """From the cleaned table and the list of moving vessels: no shuffle of the
    pings, and the summary of the chunks reads only what a fix needs."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    fx = Fixture(spark, _events(spark, scratch))
    df = pairing_pings(fx.moving, CFG, fx.order)
    df.collect()
    p = _plan(df)
    assert not re.search(r"Exchange hashpartitioning\(mmsi#\d+L, track_chunk#\d+L", p)
    read = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "lat:" in s]
    assert sorted("name:" in s for s in read) == [False, True], read
