import json
import os

from tracklens.plans.catalog import Fixture
from tracklens.plans.pipeline import run_job


def test_run_job_writes_results(spark, scratch):
    fx = Fixture(spark, "/root/testdata/sf0.001")
    out = os.path.join(scratch, "out")
    counts = run_job(spark, fx.raw, out, order=("event_id",))
    assert counts["clean"] > 0 and counts["candidates"] > 0
    top = spark.read.parquet(f"{out}/top").orderBy("rank").collect()
    assert [r.rank for r in top] == list(range(1, len(top) + 1))
    rep = [json.loads(line) for f in os.listdir(f"{out}/report_json") if f.endswith(".json") for line in open(f"{out}/report_json/{f}")]
    assert len(rep) == 1 and rep[0]["timestamp_utc"].endswith(" UTC")
    traj = spark.read.parquet(f"{out}/trajectories")
    assert set(r.phase for r in traj.collect()) <= {"before", "after"}


def test_run_job_leaves_no_tables(spark, scratch):
    from pathlib import Path

    from tracklens.plans.materialize import shared_checkpoint_dir

    fx = Fixture(spark, "/root/testdata/sf0.001")
    raw, n_clean = fx.raw, fx.clean.count()  # tables of the caller's
    folder = Path(shared_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    files = lambda: {f.name for f in folder.iterdir() if any(f.iterdir())}
    names = lambda: {t.name for t in spark.catalog.listTables()}
    before = files(), names()
    out = os.path.join(scratch, "out")
    counts = run_job(spark, raw, out, order=("event_id",))
    assert (files(), names()) == before
    assert counts["scored"] == spark.read.parquet(f"{out}/scored").count() == counts["candidates"] and counts["clean"] == n_clean
    empty = os.path.join(scratch, "empty")
    assert run_job(spark, raw.limit(0), empty, order=("event_id",)) == {"clean": 0, "candidates": 0, "scored": 0}
    assert spark.read.parquet(f"{empty}/report").count() == 0 and (files(), names()) == before


def test_tables_go_when_the_job_fails(spark):
    import pytest

    from tracklens.plans.materialize import materialize, workspace

    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(ZeroDivisionError), workspace(spark):
        table = materialize(spark.range(7), ["id"])
        assert table.n_rows == 7 and len({t.name for t in spark.catalog.listTables()}) == len(before) + 1
        1 / 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_buckets_follow_the_bytes_of_the_input(spark, scratch):
    from tracklens.config import EncounterConfig
    from tracklens.operators.tracks import TRACK_KEYS, clean_tracks
    from tracklens.plans.materialize import data_buckets, materialize

    fx = Fixture(spark, "/root/testdata/sf0.001")
    assert data_buckets(fx.raw) == int(spark.conf.get("spark.sql.shuffle.partitions"))  # few bytes
    size = sum(os.path.getsize(f.removeprefix("file:")) for f in fx.raw.inputFiles())
    small, large = [data_buckets(clean_tracks(x, fx.cfg, fx.order), size // 20) for x in (fx.raw.where("event_id < 0"), fx.raw)]
    assert 20 <= large <= 22 and small <= large
    cfg = EncounterConfig(track_buckets=large)
    table = materialize(clean_tracks(fx.raw, cfg, fx.order), TRACK_KEYS, num_buckets=large, dealt=True)
    assert table.n_rows == clean_tracks(fx.raw, fx.cfg, fx.order).count()
    plan = clean_tracks(fx.raw, cfg, fx.order)._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning(mmsi#" in plan and f", {large})" in plan


def test_display_name_fallback(spark):
    from tracklens.operators.trajectory import display_name

    df = spark.createDataFrame([("NORTHERN GULL", 1), (None, 219000007), ("", 5)], "name string, mmsi long")
    assert [r.l for r in df.select(display_name("name", "mmsi").alias("l")).collect()] == [
        "NORTHERN GULL",
        "MMSI 219000007",
        "MMSI 5",
    ]


def test_csv_to_report_end_to_end(spark, scratch):
    """Fixture pings written as AIS CSV text, read back with the CSV source
    and run through the whole job with the default (content) track order."""
    from pyspark.sql import functions as F

    from tracklens.plans.pipeline import detect_encounters
    from tracklens.schema import CSV_COLUMNS
    from tracklens.sources.ais_csv import read_ais_csv

    fx = Fixture(spark, "/root/testdata/sf0.001")
    text = fx.raw.select(
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias(CSV_COLUMNS["ts"]),
        F.col("mobile_type").alias(CSV_COLUMNS["mobile_type"]),
        F.col("mmsi").cast("string").alias(CSV_COLUMNS["mmsi"]),
        F.col("lat").cast("string").alias(CSV_COLUMNS["lat"]),
        F.col("lon").cast("string").alias(CSV_COLUMNS["lon"]),
        F.lit("Under way using engine").alias("Navigational status"),
        F.col("sog").cast("string").alias(CSV_COLUMNS["sog"]),
        F.col("cog").cast("string").alias(CSV_COLUMNS["cog"]),
        F.col("name").alias(CSV_COLUMNS["name"]),
        F.col("ship_type").alias(CSV_COLUMNS["ship_type"]),
    )
    path = os.path.join(scratch, "csv")
    text.write.option("header", "true").csv(path)
    pings = read_ais_csv(spark, path)
    assert pings.count() == fx.valid.count()
    res = detect_encounters(pings)
    top = res.top.orderBy("rank").collect()
    assert len(top) == 5 and all(r.mmsi_a < r.mmsi_b for r in top)
    rep = res.report.collect()
    assert len(rep) == 1 and rep[0].timestamp_utc.startswith("2021-12-")
