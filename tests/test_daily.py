import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, pings
from tracklens.config import EncounterConfig
from tracklens.operators.day_state import day_state, merge_states, state_genuine_last_ping, state_last_ping, state_medians, state_silence_flags
from tracklens.operators.filters import select_pings
from tracklens.operators.reaction import genuine_last_ping, last_ping, silence_flags
from tracklens.operators.tracks import clean_tracks, median_speed, moving_vessels
from tracklens.plans.daily import from_store, ingest_day, ingested_days
from tracklens.sources.store import DAY_COLUMN, read_pings, write_pings

CFG = EncounterConfig()
DAYS = [dt.date(2021, 12, 1) + dt.timedelta(days=k) for k in range(4)]
MIDNIGHT = 82800  # seconds from T0 (01:00) to the end of its day


def month(spark, seed=1):
    """Tracks over four days: repeats and jumps at and around each midnight, a
    vessel that is absent for two days, one that is stationary, one without SOG."""
    rnd = random.Random(seed)
    rows = []
    for v in range(12):
        t, lat = rnd.randrange(3600), 55.0 + v * 1e-2
        while t < MIDNIGHT + 3 * 86400:
            day = (t + 3600) // 86400
            if not (v == 3 and day in (1, 2)):  # (but for a few pings at midnight)
                jump = 0.6 if rnd.random() < 0.1 else 0.0
                sog = {4: 0.1, 5: None}.get(v, rnd.choice([0.4, 3.0, 7.5, 12.25, None]))
                row = {"mmsi": 219000000 + v, "t": t, "lat": lat + jump + rnd.random() * 1e-4, "sog": sog}
                rows += [row] * rnd.choice([1, 1, 1, 2])
            near = (MIDNIGHT - t) % 86400
            t += rnd.choice([0, 10, 20]) if near < 100 or near > 86300 else rnd.randrange(1, 9000) if near > 9000 else max(1, near - 60)
        for k in range(3):  # a jump right at midnight
            for step, jump in ((-5, 0.0), (5, 0.6 * (v % 2))):
                rows.append({"mmsi": 219000000 + v, "t": MIDNIGHT + k * 86400 + step, "lat": 55.0 + v * 1e-2 + jump, "sog": 5.0})
    rnd.shuffle(rows)
    return pings(spark, rows)


def ingest(spark, df, folder, order):
    write_pings(df, f"{folder}/pings")
    stored = read_pings(spark, f"{folder}/pings")
    for day in DAYS:
        ingest_day(spark, stored.where(F.col(DAY_COLUMN) == F.lit(day)).drop(DAY_COLUMN), day, f"{folder}/store", CFG, order)
    return from_store(spark, f"{folder}/store", CFG)


def same(a, b):
    cols = sorted(set(a.columns) - {"day", "track_chunk"})
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert key(a) == key(b)


@pytest.mark.parametrize("order", [("event_id",), None])
def test_days_add_up_to_the_month(spark, scratch, order):
    df = month(spark) if order else month(spark).drop("event_id")
    store = ingest(spark, df, scratch, order)
    df = select_pings(df, CFG)
    whole = clean_tracks(df, CFG, order).cache()
    assert store.days == DAYS and whole.count() > 300
    same(store.cleaned, whole)
    same(store.clean, moving_vessels(whole, CFG))
    same(state_medians(store.state), median_speed(whole))
    same(state_last_ping(store.state), last_ping(whole))
    clean = moving_vessels(whole, CFG)
    same(state_genuine_last_ping(store.state, store.movers, CFG), genuine_last_ping(clean, CFG))
    cands = clean.groupBy().agg(F.lit(219000003).cast("long").alias("mmsi_a"), F.lit(219000001).cast("long").alias("mmsi_b"), (F.max("ts_unix") - 60).alias("ts_unix_a"))
    same(state_silence_flags(cands, store.state, store.movers, CFG), silence_flags(cands, clean, CFG))
    without_carry = clean_tracks(df.where(F.col("ts_unix") >= T0 + MIDNIGHT), CFG, order)
    assert without_carry.count() != whole.where(F.col("ts_unix") >= T0 + MIDNIGHT).count()  # the boundary matters here


def test_days_come_in_order_and_hold_their_own_pings(spark, scratch):
    df = pings(spark, [{"t": 0, "lat": 55.0}, {"t": 60, "lat": 55.0001}])
    ingest_day(spark, df, DAYS[0], scratch, CFG, ("event_id",))
    for day in DAYS[:1]:
        with pytest.raises(ValueError, match="is not after"):
            ingest_day(spark, df, day, scratch, CFG, ("event_id",))
    with pytest.raises(Exception, match="does not lie in 2021-12-03"):
        ingest_day(spark, df, DAYS[2], scratch, CFG, ("event_id",))
    assert ingested_days(spark, scratch) == DAYS[:1]
    ingest_day(spark, df.limit(0), DAYS[3], scratch, CFG, ("event_id",))  # a day without pings, after a gap
    store = from_store(spark, scratch, CFG)
    assert store.days == [DAYS[0], DAYS[3]] and store.cleaned.count() == 2 and state_last_ping(store.state).count() == 1


def test_a_day_writes_no_state_of_earlier_days(spark, scratch):
    """Each day's state holds that day's pings only, so a day costs the same
    however many came before; the days' states add up when the store is read."""
    for k in range(3):
        df = pings(spark, [{"mmsi": 219000000 + k, "t": k * 86400 + 60 * i, "lat": 55.0 + i * 1e-4, "sog": 5.0 + i} for i in range(4)])
        ingest_day(spark, df, DAYS[k], scratch, CFG, ("event_id",))
    assert [spark.read.parquet(f"{scratch}/state/day={d}").count() for d in DAYS[:3]] == [4, 4, 4]
    store = from_store(spark, scratch, CFG)
    same(store.state, day_state(store.cleaned))
    # a store of an earlier version kept one state through its last day
    merged = spark.read.parquet(*[f"{scratch}/state/day={d}" for d in DAYS[:2]])
    merged.write.parquet(f"{scratch}/old/state/through={DAYS[1]}")
    for part in ("clean", "carry", "days"):
        shutil.copytree(f"{scratch}/{part}", f"{scratch}/old/{part}")
    shutil.copytree(f"{scratch}/state/day={DAYS[2]}", f"{scratch}/old/state/day={DAYS[2]}")
    same(from_store(spark, f"{scratch}/old", CFG).state, store.state)


def test_states_merge_in_any_order(spark):
    df = month(spark, 2)
    parts = [df.where(F.col("event_id") % 3 == k) for k in range(3)]
    states = [day_state(p) for p in parts]
    same(merge_states(states[2], merge_states(states[0], states[1])), day_state(df))
    same(merge_states(day_state(df.limit(0)), states[1]), states[1])
    with pytest.raises(ValueError, match="holds no complete day"):
        from_store(spark, "/tmp/there-is-no-such-store", CFG)


def test_trajectories_read_only_the_days_of_their_windows(spark, scratch):
    from pathlib import Path

    from tracklens.operators.trajectory import trajectories

    ingest(spark, month(spark), scratch, ("event_id",))
    store = from_store(spark, f"{scratch}/store", CFG)
    midnight = T0 + MIDNIGHT
    events = [(1, 219000001, 219000002, midnight + 100), (2, 219000006, 219000007, midnight - 4000)]
    top = spark.createDataFrame(
        [(k, a, b, "A", None, t, t + 30) for k, a, b, t in events], "rank int, mmsi_a long, mmsi_b long, name_a string, name_b string, ts_unix_a long, ts_unix_b long"
    )
    whole = trajectories(store.cleaned.drop(DAY_COLUMN), top, CFG).cache()
    assert whole.where(F.col("ts_unix") < midnight).count() > 0 and whole.where(F.col("ts_unix") >= midnight).count() > 0
    pruned = trajectories(store.cleaned, top, CFG, DAY_COLUMN)
    same(pruned, whole)
    assert "dynamicpruning" in pruned._jdf.queryExecution().toString().lower()
    for f in Path(f"{scratch}/store/clean/day={DAYS[3]}").glob("*.parquet"):
        f.write_bytes(b"not a Parquet file")  # a day without a window is not opened
    same(trajectories(store.cleaned, top, CFG, DAY_COLUMN), whole)
